"""Registered queries: weekly rollups, highlights, takeaways, report, payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.operators import report as RP
from feedlake.operators import select as sel
from feedlake.operators import verdicts as V
from feedlake.operators import weekly as W
from feedlake.plans.catalog import ORACLE, register
from feedlake.plans.oracle_views import view, with_views
from feedlake.plans.q_scalar import _MONTHS_LIST, _duck_capitalize, _duck_case
from feedlake.sources import fixtures as fx

WKEY = "severity_rank, score desc, published_at, hash, entry_id"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


view("v_store", """
select *, strftime(published_at, '%G-W%V') as week,
       'reason ' || cast(entry_id as varchar) as reason,
       case when entry_id % 3 = 0 then upper(title) else '' end as translated_title,
       case severity when 'critical' then 0 when 'important' then 1 when 'notable' then 2 else 3 end as severity_rank
from v_verdicts where kept""", ["v_verdicts"])
view("v_wk", """
select week, n, ws, ws + interval '6 days 23 hours 59 minutes 59 seconds' as we, ws + interval '6 days 15 hours' as gen
from (select week, count(*) as n, date_trunc('week', min(published_at)) as ws from v_store group by week) t""",
     ["v_store"])
view("v_topref", f"""
select i.*, cast(row_number() over (partition by f.week order by f.pos) as int) as rank
from (select week, hash, case when rn = 1 then 1 else rn + 1 end as pos
      from (select week, hash, row_number() over (partition by week order by score desc, entry_id) as rn
            from v_store) b where rn <= 4
      union all select week, {q(fx.UNKNOWN_REF)}, 2 from v_wk) f
join (select * from (select *, row_number() over (partition by week, hash
                                                  order by published_at desc, hash desc, entry_id desc) as k
                     from v_store) t where k = 1) i on i.week = f.week and i.hash = f.hash
where f.pos <= 3""", ["v_store", "v_wk"])
_CATS = ", ".join(f"({i + 1}, '{c}')" for i, c in enumerate(vocab.CATEGORIES))
view("v_counts", f"""
select w.week, cast(c.ord as int) as ord, c.category, coalesce(n.n, 0) as n
from v_wk w cross join (values {_CATS}) c(ord, category)
left join (select week, category, count(*) as n from v_store group by week, category) n
  on n.week = w.week and n.category = c.category""", ["v_wk", "v_store"])
view("v_tk", """
select week, 1 as rank, week || ' trend' as text from v_wk
union all select week, 2, 'watch ' || cast(n as varchar) from v_wk""", ["v_wk"])


def _store(spark, base):
    return fx.store(spark, base)


def _fields(spark, base):
    return W.recap_fields(fx.recap_docs(spark, base))


# ------------------------------------------------------------------ S7, S8, F5, L2
@register("period_scan", with_views("""
select p.week, p.week_start, p.week_end, s.entry_id, s.hash, s.published_at
from v_store s join (select distinct strftime(published_at, '%G-W%V') as week,
                            date_trunc('week', published_at) as week_start,
                            date_trunc('week', published_at) + interval '6 days 23 hours 59 minutes 59 seconds' as week_end
                     from v_verdicts) p
  on s.published_at between p.week_start and p.week_end""", "v_store", "v_verdicts"))
def q_period_scan(spark, base):
    out = W.period_scan(_store(spark, base), W.periods(fx.verdicts(spark, base)))
    return (out.select("week", "week_start", "week_end", "entry_id", "hash", "published_at")
            .orderBy("published_at", "hash"))


# ------------------------------------------------------------------ A5
@register("week_totals", with_views("select week, count(*) as n_kept from v_store group by week",
                                    "v_store"))
def q_week_totals(spark, base):
    return W.week_totals(_store(spark, base))


# ------------------------------------------------------------------ A3, J5, F8, X17
@register("category_counts", with_views("select week, ord, category, n from v_counts", "v_counts"))
def q_category_counts(spark, base):
    return W.category_counts(_store(spark, base)).select("week", F.col("ord").cast("int"),
                                                        "category", "n")


@register("category_counts_nonzero", with_views(
    "select week, ord, category, n from v_counts where n > 0", "v_counts"))
def q_category_counts_nonzero(spark, base):
    return W.category_counts_nonzero(_store(spark, base)).select(
        "week", F.col("ord").cast("int"), "category", "n")


# ------------------------------------------------------------------ A2, W6
@register("category_ranked", with_views(f"""
select week, category, cast(row_number() over (partition by week, category order by {WKEY}) as int) as rank,
       entry_id from v_store""", "v_store"))
def q_category_ranked(spark, base):
    return W.category_ranked(_store(spark, base)).select("week", "category",
                                                         F.col("rank").cast("int"), "entry_id")


# ------------------------------------------------------------------ W5, W9
@register("fallback_recap_top", with_views(f"""
select week, cast(rank as int) as rank, entry_id from (
  select *, row_number() over (partition by week order by {WKEY}) as rank from v_store) t
where rank <= 3""", "v_store"))
def q_fallback_recap_top(spark, base):
    out = sel.fallback_recap_top(_store(spark, base), "week", W.WEEK_TIEBREAK)
    return out.select("week", F.col("rank").cast("int"), "entry_id")


# ------------------------------------------------------------------ J3, W7, M3
@register("recap_top_referenced", with_views(
    "select week, rank, hash, entry_id from v_topref", "v_topref"))
def q_recap_top_referenced(spark, base):
    out = W.top_referenced(_store(spark, base), _fields(spark, base))
    return out.select("week", "rank", "hash", "entry_id")


# ------------------------------------------------------------------ F6, X16
@register("takeaways", with_views("select week, cast(rank as int) as rank, text from v_tk", "v_tk"))
def q_takeaways(spark, base):
    return W.takeaways(_fields(spark, base))


# ------------------------------------------------------------------ T5, Q1
@register("late_items", with_views("""
select week, entry_id, published_at, cast(cast(published_at as date) as timestamp) + interval 27 hours as run_ts
from v_store
where cast(cast(published_at as date) as timestamp) + interval 27 hours
      > date_trunc('week', published_at) + interval '6 days 15 hours'""", "v_store"))
def q_late_items(spark, base):
    s = _store(spark, base).withColumn("run_ts", fx.run_of(F.col("published_at")))
    return W.late_items(s).select("week", "entry_id", "published_at", "run_ts")


# ------------------------------------------------------------------ R1-R6, A8, K5
_SEV_FR = dict(zip(vocab.SEVERITIES, vocab.SEVERITIES_FR))


def _long(x: str) -> str:
    return (f"(cast(day({x}) as varchar) || ' ' || {_MONTHS_LIST}[month({x})] || ' ' || "
            f"cast(year({x}) as varchar))")


def _catm(c):
    return _duck_case(c, vocab.CATEGORY_MARKERS, q(vocab.DEFAULT_CATEGORY_MARKER))


def _catl(c):
    return _duck_case(c, vocab.CATEGORY_LABELS, _duck_capitalize(c))


_TITLE = "coalesce(nullif(translated_title, ''), title)"
_REPORT_SQL = with_views(f"""
with blocks as (
  select week, 1 as b, 0 as s1, 0 as s2,
         [{q(RP.H_TITLE)} || string_split(week, '-W')[-1] || ' (du ' || strftime(ws, '%d/%m/%Y') || ' au '
            || strftime(we, '%d/%m/%Y') || ')', '', {q(RP.H_GENERATED)} || strftime(gen, '%d/%m/%Y à %H:%M')] as arr
  from v_wk
  union all select week, 2, 0, 0, ['', {q(RP.H_OVERVIEW)}, '', {q(RP.H_RETAINED)} || cast(n as varchar),
                                    {q(RP.H_PERIOD)} || {_long('ws')} || ' → ' || {_long('we')}] from v_wk
  union all select week, 3, 0, 0, ['', {q(RP.H_TOP)}] from v_wk
  union all select week, 3, 1, rank,
         ['', '### ' || cast(rank as varchar) || '. [' || {_TITLE} || '](' || link || ')', '',
          '**Criticité** : ' || {_duck_case('severity', vocab.REPORT_SEVERITY_MARKERS, q(vocab.REPORT_DEFAULT_SEVERITY_MARKER))}
            || ' ' || {_duck_case('severity', _SEV_FR, 'severity')} || '  ',
          '**Catégorie** : ' || {_catm('category')} || ' ' || {_duck_case('category', vocab.CATEGORY_LABELS, 'category')} || '  ',
          '**Source** : ' || source || '  ', '**Raison** : ' || reason] from v_topref
  union all select week, 3, 1, 0, ['', {q(vocab.REPORT_NO_TOP)}] from v_wk w
         where not exists (select 1 from v_topref t where t.week = w.week)
  union all select week, 4, 0, 0, ['', {q(RP.H_SPLIT)}, '', {q(RP.H_TABLE)}, {q(RP.H_RULE)}] from v_wk
  union all select week, 4, 1, ord, ['| ' || {_catm('category')} || ' ' || {_catl('category')} || ' | '
                                     || cast(n as varchar) || ' |'] from v_counts
  union all select week, 5, 0, 0, ['', {q(RP.H_TRENDS)}, '',
         'Semaine ' || week || ' : ' || cast(n as varchar) || ' articles retenus.'] from v_wk
  union all select week, 6, 0, 0, ['', {q(RP.H_TAKEAWAYS)}, ''] from v_wk
  union all select week, 6, 1, rank, [cast(rank as varchar) || '. ' || text] from v_tk
  union all select week, 7, 0, 0, ['', {q(RP.H_ALL)}] from v_wk
  union all select week, 7, ord, 0, ['', '### ' || {_catm('category')} || ' ' || {_catl('category')}, '']
         from v_counts where n > 0
  union all select r.week, 7, c.ord, r.rank, ['- [' || {_TITLE} || '](' || link || ') — _' || reason || '_']
         from (select *, row_number() over (partition by week, category order by {WKEY}) as rank from v_store) r
         join (values {_CATS}) c(ord, category) on c.category = r.category
),
lines as (select week, b, s1, s2, unnest(generate_series(1, len(arr))) as k, arr from blocks)
select week, cast(row_number() over (partition by week order by b, s1, s2, k) as int) as line_no, arr[k] as line
from lines""", "v_wk", "v_topref", "v_counts", "v_tk", "v_store")


def _stored(spark, base):
    """The store as the weekly job sees it: a parquet table partitioned by week."""
    from feedlake.sources.tables import materialize
    return materialize(_store(spark, base), "verdict-store", partition_by="week")


@register("weekly_report", _REPORT_SQL)
def q_weekly_report(spark, base):
    store = _stored(spark, base)
    docs = fx.recap_docs_from(store)
    return RP.weekly_report_lines(store, W.recap_fields(docs))


# ------------------------------------------------------------------ K5: the written files
@register("weekly_report_files", f"""
select week || '.md' as file, md5(string_agg(line, chr(10) order by line_no) || chr(10)) as content_md5
from ({_REPORT_SQL}) t group by week""")
def q_weekly_report_files(spark, base):
    """One file for each week, read back whole."""
    from feedlake.session import scratch_path
    path = scratch_path(spark, "weekly-files")
    RP.write_weekly_report(q_weekly_report(spark, base), path)
    files = spark.read.text(path, wholetext=True)
    return files.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"),
                        F.md5(F.col("value").cast("binary")).alias("content_md5"))


# ------------------------------------------------------------------ R8
_TOPLINE = ("{sev} || ' [' || translate(title, '[]', '()') || '](' || link || ')' || chr(10) || '   __'")


@register("payload_size_guard", with_views(f"""
with h as (select run_ts, count(*) as n_scored, count_if(kept) as n_kept,
                  'day ' || cast(any_value(cast(published_at as date)) as varchar) as headline
           from v_daily group by run_ts),
t as (select run_ts, sum(length(line)) + (count(*) - 1) * 2 as tl from (
        select run_ts, {_duck_case('severity', vocab.MESSAGE_SEVERITY_MARKERS, q(vocab.MESSAGE_DEFAULT_SEVERITY_MARKER))}
               || ' [' || translate(title, '[]', '()') || '](' || link || ')' || chr(10) || '   __' as line
        from v_top) x group by run_ts),
o as (select run_ts, sum(length(line)) + (count(*) - 1) as ol from (
        select run_ts, '• ' || {_duck_case('severity', vocab.MESSAGE_SEVERITY_MARKERS, q(vocab.MESSAGE_DEFAULT_SEVERITY_MARKER))}
               || ' [' || translate(title, '[]', '()') || '](' || link || ')' as line
        from v_other) x group by run_ts),
s as (select h.run_ts,
        length(case when length('☀️ Veille du ' || {_long('h.run_ts')}) > 256
                    then substring('☀️ Veille du ' || {_long('h.run_ts')}, 1, 255) || '…'
                    else '☀️ Veille du ' || {_long('h.run_ts')} end)
        + length('**' || headline || '**' || chr(10) || chr(10) || '📊 ' || cast(n_scored as varchar)
                 || ' articles analysés • ' || cast(n_kept as varchar) || ' retenus')
        + coalesce(least(t.tl, 1024) + {len(RP.M_TOP_NAME)}, 0)
        + coalesce(least(o.ol, 1024) + {len(RP.M_OTHER_NAME)}, 0)
        + {len(vocab.DIGEST_DEFAULT_SUMMARY) + len(RP.M_SUMMARY_NAME)} + {len(vocab.DEFAULT_FOOTER)} as total_len,
        (t.tl is not null)::int + (o.ol is not null)::int + 1 as n_fields
      from h left join t on t.run_ts = h.run_ts left join o on o.run_ts = h.run_ts)
select run_ts, cast(total_len as int) as total_len, cast(n_fields as int) as n_fields,
       total_len > {vocab.LIMIT_TOTAL} as guarded,
       cast(case when total_len > {vocab.LIMIT_TOTAL} then least(n_fields, 2) else n_fields end as int) as n_fields_sent
from s""", "v_daily", "v_top", "v_other"))
def q_payload_size_guard(spark, base):
    f = _digest_fields(spark, base)
    return f.select("run_ts", "total_len", F.col("n_fields").cast("int"), "guarded",
                    F.col("n_fields_sent").cast("int"))


def _digest_fields(spark, base):
    items = fx.daily_items(spark, base)
    verd = fx.daily_verdicts(spark, base).withColumn("reason", F.lit(""))
    docs = (fx.responses(spark, base).filter(F.col("batch_no") == 0)
            .withColumn("run_ts", fx.run_of(F.col("day"))))
    header = V.digest_header(items, fx.answers(spark, base), docs)
    top = sel.daily_top(verd)
    other = sel.daily_other(verd)
    return RP.digest_fields(header, top, other)


# ------------------------------------------------------------------ P12
WEEK_TEMPLATE = "Semaine du {date_debut} au {date_fin}.\nArticles : {articles_json}"


@register("pack_week_requests", with_views(f"""
select week, cast(batch_no as int) as batch_no, count(*) as n_items,
       replace(replace(replace({q(WEEK_TEMPLATE)}, '{{articles_json}}',
               to_json(list({{'hash_unique': hash, 'titre': coalesce(nullif(translated_title, ''), title),
                              'resume': 'summary of ' || title, 'source': source, 'criticite': severity,
                              'categorie': category, 'score': score, 'raison_courte': reason}} order by pos))),
               '{{date_debut}}', strftime(any_value(date_trunc('week', published_at)), '%d/%m/%Y')),
               '{{date_fin}}', strftime(any_value(date_trunc('week', published_at)) + interval 6 days, '%d/%m/%Y')) as prompt
from (select *, row_number() over (partition by week order by published_at, hash, entry_id) as pos,
             (row_number() over (partition by week order by published_at, hash, entry_id) - 1) // 50 as batch_no
      from v_store) t
group by week, batch_no""", "v_store"))
def q_pack_week_requests(spark, base):
    """Weekly request documents: display title, verdict fields, period dates."""
    from feedlake.functions import dates as D
    from feedlake.functions.text import display_title
    s = (_store(spark, base)
         .withColumn("display", display_title(F.col("translated_title"), F.col("title")))
         .withColumn("summary", F.concat(F.lit("summary of "), F.col("title"))))
    fields = {"hash_unique": "hash", "titre": "display", "resume": "summary", "source": "source",
              "criticite": "severity", "categorie": "category", "score": "score",
              "raison_courte": "reason"}
    packed = V.pack_requests(s, WEEK_TEMPLATE, group="week", order=W.WEEK_TIEBREAK,
                             fields=fields)
    wk = W.periods(s).select("week", "week_start", "week_end")
    out = packed.join(wk, "week", "inner")
    out = out.withColumn("prompt", F.replace(F.replace("prompt", F.lit("{date_debut}"),
                                                       D.date_fr_short("week_start")),
                                             F.lit("{date_fin}"), D.date_fr_short("week_end")))
    return out.select("week", "batch_no", "n_items", "prompt")


# ------------------------------------------------------------------ weekly ops on orders x lineitem
view("v_order_store", """
select l.l_orderkey as entry_id, sha256(cast(l.l_orderkey as varchar) || '-' || cast(l.l_linenumber as varchar)) as hash,
       l.l_shipdate as published_at, l.l_linestatus = 'O' as kept,
       case substring(o.o_orderpriority, 1, 1) when '1' then 'critical' when '2' then 'important'
            when '3' then 'notable' else 'ignore' end as severity,
       greatest(1, least(10, cast(trunc(l.l_quantity / 5) as int))) as score,
       case l.l_returnflag when 'R' then 'security' when 'A' then 'backend' else 'general' end as category,
       strftime(l.l_shipdate, '%G-W%V') as week
from lineitem l join orders o on o.o_orderkey = l.l_orderkey""")


@register("order_week_totals", with_views("""
select week, count(*) as n_kept from v_order_store where kept group by week""", "v_order_store"))
def q_order_week_totals(spark, base):
    """A5 over the line-item store (hundreds of weeks)."""
    return W.week_totals(fx.order_store(spark, base).filter("kept"))


@register("order_recap_top", with_views(f"""
select week, cast(rank as int) as rank, hash from (
  select *, row_number() over (partition by week order by
      case severity when 'critical' then 0 when 'important' then 1 when 'notable' then 2 else 3 end,
      score desc, published_at, hash, entry_id) as rank
  from v_order_store where kept) t
where rank <= 3""", "v_order_store"))
def q_order_recap_top(spark, base):
    """W5 over the line-item store: partial top-3 per task, then final."""
    out = sel.fallback_recap_top(fx.order_store(spark, base), "week", W.WEEK_TIEBREAK)
    return out.select("week", F.col("rank").cast("int"), "hash")


@register("order_category_ranked", with_views(f"""
select week, category, cast(row_number() over (partition by week, category order by
      case severity when 'critical' then 0 when 'important' then 1 when 'notable' then 2 else 3 end,
      score desc, published_at, hash, entry_id) as int) as rank, hash
from v_order_store where kept""", "v_order_store"))
def q_order_category_ranked(spark, base):
    """W6 over the line-item store with the skew-safe ordinal."""
    out = W.category_ranked(fx.order_store(spark, base).filter("kept"))
    return out.select("week", "category", F.col("rank").cast("int"), "hash")


# ------------------------------------------------------------------ M4 weekly, W5
FALLBACK_WEEK = "2024-W02"


@register("recap_with_fallback", with_views(f"""
select week, rank, hash, entry_id from v_topref where week <> '{FALLBACK_WEEK}'
union all
select week, cast(rank as int), hash, entry_id from (
  select *, row_number() over (partition by week order by {WKEY}) as rank from v_store
  where week = '{FALLBACK_WEEK}') t where rank <= 3""", "v_topref", "v_store"))
def q_recap_with_fallback(spark, base):
    """The answer of one week is cut off: that week falls back to the sort key."""
    store = _store(spark, base)
    docs = fx.recap_docs(spark, base)
    docs = docs.withColumn("doc", F.when(F.col("week") == FALLBACK_WEEK, F.substring("doc", 1, 30))
                           .otherwise(F.col("doc")))
    _, top = W.recap_selection(store, docs)
    return top.select("week", F.col("rank").cast("int"), "hash", "entry_id")


# ------------------------------------------------------------------ R7, X1, X2 (message texts)
_MSEV = _duck_case("severity", vocab.MESSAGE_SEVERITY_MARKERS, q(vocab.MESSAGE_DEFAULT_SEVERITY_MARKER))
_DTITLE = f"({q(RP.M_DAILY_TITLE)} || {_long('h.run_ts')})"


def _duck_clip(x: str, n: int) -> str:
    return f"(case when length({x}) > {n} then substring({x}, 1, {n - 1}) || '…' else {x} end)"


@register("digest_message", with_views(f"""
with h as (select run_ts, count(*) as n_scored, count_if(kept) as n_kept,
                  'day ' || cast(any_value(cast(published_at as date)) as varchar) as headline
           from v_daily group by run_ts),
t as (select run_ts, string_agg(line, chr(10) || chr(10) order by rank) as txt from (
        select run_ts, rank, {_MSEV} || ' [' || translate(title, '[]', '()') || '](' || link || ')'
               || chr(10) || '   __' as line from v_top) x group by run_ts),
o as (select run_ts, string_agg(line, chr(10) order by rank) as txt from (
        select run_ts, rank, '• ' || {_MSEV} || ' [' || translate(title, '[]', '()') || '](' || link || ')' as line
        from v_other) x group by run_ts)
select h.run_ts, {_duck_clip(_DTITLE, vocab.LIMIT_TITLE)} as title,
       '**' || headline || '**' || chr(10) || chr(10) || '📊 ' || cast(n_scored as varchar)
         || ' articles analysés • ' || cast(n_kept as varchar) || ' retenus' as description,
       {_duck_clip('t.txt', vocab.LIMIT_FIELD)} as top_value,
       {_duck_clip('o.txt', vocab.LIMIT_FIELD)} as other_value,
       {q(vocab.DIGEST_DEFAULT_SUMMARY)} as summary_value
from h left join t on t.run_ts = h.run_ts left join o on o.run_ts = h.run_ts""",
                                         "v_daily", "v_top", "v_other"))
def q_digest_message(spark, base):
    """Texts of the daily message: only the list prefix that can fit in a
    1,024-character field is gathered, plus the list's total length."""
    f = _digest_fields(spark, base)
    return f.select("run_ts", "title", "description", "top_value", "other_value", "summary_value")


# ------------------------------------------------------------------ R7, K7: the JSON itself
@register("digest_payload", ORACLE["digest_message"])
def q_digest_payload(spark, base):
    """The fields of the message, read from its JSON."""
    p = RP.digest_payload(_digest_fields(spark, base))
    embed = "struct<title string, description string, fields array<struct<name string, value string>>>"
    e = F.from_json("payload", f"embeds array<{embed}>")["embeds"][0]

    def value(name):
        named = F.filter(e["fields"], lambda f: f["name"] == name)
        return F.get(named, F.lit(0))["value"]

    return p.select("run_ts", e["title"].alias("title"), e["description"].alias("description"),
                    value(RP.M_TOP_NAME).alias("top_value"), value(RP.M_OTHER_NAME).alias("other_value"),
                    value(RP.M_SUMMARY_NAME).alias("summary_value"))


# ------------------------------------------------------------------ R9 (message texts)
_ARCHIVE = "https://git.example.org/team/archive"


@register("recap_message", with_views(f"""
with t as (select week, string_agg('**' || cast(rank as varchar) || '.** ' || {_MSEV} || ' ['
                   || translate({_TITLE}, '[]', '()') || '](' || link || ')' || chr(10) || '   _' || reason || '_',
                   chr(10) || chr(10) order by rank) as txt
           from v_topref group by week),
c as (select week, string_agg({_catm('category')} || ' **' || {_catl('category')} || '** — ' || cast(n as varchar),
                              chr(10) order by ord) as txt
      from v_counts where n > 0 group by week),
k as (select week, string_agg('**' || cast(rank as varchar) || '.** ' || text, chr(10) order by rank) as txt
      from v_tk group by week)
select w.week,
       {_duck_clip(q(RP.M_RECAP_TITLE) + " || w.week", vocab.LIMIT_TITLE)} as title,
       {_duck_clip("'**Du ' || " + _long('w.ws') + " || ' au ' || " + _long('w.we') + " || '**' || chr(10) || chr(10) || '📊 **' || cast(w.n as varchar) || '** articles retenus cette semaine'", vocab.LIMIT_DESCRIPTION)} as header_text,
       {_duck_clip("coalesce(t.txt, " + q(vocab.REPORT_NO_TOP) + ")", vocab.LIMIT_DESCRIPTION)} as top_block,
       {_duck_clip("coalesce(c.txt, " + q(vocab.MESSAGE_NO_SPLIT) + ")", vocab.LIMIT_DESCRIPTION)} as split_block,
       {_duck_clip("'Semaine ' || w.week || ' : ' || cast(w.n as varchar) || ' articles retenus.'", vocab.LIMIT_DESCRIPTION)} as trends_block,
       {_duck_clip("coalesce(k.txt, " + q(vocab.REPORT_NO_TAKEAWAYS) + ")", vocab.LIMIT_DESCRIPTION)} as takeaways_block,
       '[{RP.M_ARCHIVE_TEXT}](' || '{_ARCHIVE}' || '/blob/main/docs/reports/' || w.week || '.md)' as archive_block
from v_wk w left join t on t.week = w.week left join c on c.week = w.week left join k on k.week = w.week""",
                                        "v_wk", "v_topref", "v_counts", "v_tk"))
def q_recap_message(spark, base):
    store = _stored(spark, base)
    b = RP.recap_blocks(store, W.recap_fields(fx.recap_docs_from(store)), archive_base=_ARCHIVE)
    return b.drop("generated_at")


# ------------------------------------------------------------------ R9: the JSON itself
@register("recap_payload", ORACLE["recap_message"])
def q_recap_payload(spark, base):
    """The blocks of the weekly message, read from its JSON."""
    store = _stored(spark, base)
    p = RP.recap_payload(store, W.recap_fields(fx.recap_docs_from(store)), archive_base=_ARCHIVE)
    e = F.from_json("payload", "embeds array<struct<title string, description string>>")["embeds"]
    blocks = ["header_text", "top_block", "split_block", "trends_block", "takeaways_block", "archive_block"]
    return p.select("week", e[0]["title"].alias("title"),
                    *[F.get(e, F.lit(i))["description"].alias(b) for i, b in enumerate(blocks)])
