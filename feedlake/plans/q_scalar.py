"""Registered queries: column functions, ingest and source gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions import coerce as C
from feedlake.functions import dates as D
from feedlake.functions import labels as L
from feedlake.functions import text as T
from feedlake.operators import ingest as I
from feedlake.plans.catalog import register
from feedlake.plans.oracle_views import with_views
from feedlake.sources import fixtures as fx
from feedlake.sources.tables import table

WS = T.WS_CLASS


def _duck_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _duck_clean(x: str) -> str:
    return (f"substring(trim(regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), "
            f"'{WS}+', ' ', 'g')), 1, 500)")


def _duck_case(col: str, mapping: dict, default_sql: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"(case {col} {whens} else {default_sql} end)"


def _duck_capitalize(x: str) -> str:
    return f"(upper(substring({x}, 1, 1)) || lower(substring({x}, 2)))"


# ----------------------------------------------------------------- P4-P6
@register("clean_html", f"select page_id, {_duck_clean('html')} as summary from pages")
def q_clean_html(spark, base):
    """Tags to spaces, white space collapsed, 500 code points."""
    return table(spark, base, "pages").select("page_id", T.clean_html("html").alias("summary"))


# ----------------------------------------------------------------- P3
_SF_IN = """
select page_id,
       case page_id % 3 when 0 then '' when 1 then null else html end as s,
       case page_id % 4 when 0 then null when 1 then '' else url end as d
from pages"""


@register("summary_fallback", f"""
select page_id, coalesce(nullif(s, ''), nullif(d, ''), '') as summary from ({_SF_IN}) t""")
def q_summary_fallback(spark, base):
    p = table(spark, base, "pages")
    s = F.when(F.col("page_id") % 3 == 0, F.lit("")).when(F.col("page_id") % 3 == 1, F.lit(None)) \
        .otherwise(F.col("html"))
    d = F.when(F.col("page_id") % 4 == 0, F.lit(None)).when(F.col("page_id") % 4 == 1, F.lit("")) \
        .otherwise(F.col("url"))
    return p.select("page_id", T.summary_fallback(s, d).alias("summary"))


# ----------------------------------------------------------------- P8, X22
@register("item_hash", "select page_id, sha256(url) as hash from pages")
def q_item_hash(spark, base):
    return table(spark, base, "pages").select("page_id", T.item_hash("url").alias("hash"))


# ----------------------------------------------------------------- P7, C6
@register("best_date", """
select event_id,
       case event_id % 4 when 3 then timestamp '2024-02-01 00:00:00'
            else date_trunc('second', ts) end as published_at
from events""")
def q_best_date(spark, base):
    """Feed dates as text (RFC 822 with GMT / EST, ISO 8601 in ``updated``),
    parsed; neither present falls back to the fetch time."""
    ev = table(spark, base, "events")
    m = F.col("event_id") % 4
    ts = F.col("ts")
    est = ts - F.expr("interval 5 hours")
    pub = (F.when(m == 0, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
           .when(m == 2, F.date_format(est, "EEE, d MMM yyyy HH:mm:ss 'EST'")))
    upd = (F.when(m == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .when(m == 0, F.date_format(ts + F.expr("interval 1 day"), "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    fetched = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    best = F.coalesce(D.parse_feed_date(pub), D.parse_feed_date(upd), fetched)
    return ev.select("event_id", best.alias("published_at"))


# ----------------------------------------------------------------- P10
@register("display_title", with_views("""
select entry_id, coalesce(nullif(tt, ''), title) as display_title
from (select entry_id, title,
             case entry_id % 3 when 0 then null when 1 then '' else upper(title) end as tt
      from v_verdicts) t""", "v_verdicts"))
def q_display_title(spark, base):
    v = fx.verdicts(spark, base)
    tt = F.when(F.col("entry_id") % 3 == 0, F.lit(None)).when(F.col("entry_id") % 3 == 1, F.lit("")) \
        .otherwise(F.upper("title"))
    return v.select("entry_id", T.display_title(tt, F.col("title")).alias("display_title"))


# ----------------------------------------------------------------- X1
def _duck_clip(x: str, n: int) -> str:
    return f"(case when length({x}) > {n} then concat(substring({x}, 1, {n - 1}), '…') else {x} end)"


@register("clip_text", f"""
select doc_id, {_duck_clip('text', 256)} as clip_256, {_duck_clip('text', 1024)} as clip_1024,
       {_duck_clip('text', 4096)} as clip_4096 from documents""")
def q_clip_text(spark, base):
    d = table(spark, base, "documents")
    return d.select("doc_id", T.clip_text("text", 256).alias("clip_256"),
                    T.clip_text("text", 1024).alias("clip_1024"),
                    T.clip_text("text", 4096).alias("clip_4096"))


# ----------------------------------------------------------------- X2
@register("escape_brackets",
          "select doc_id, translate(text, '[]', '()') as escaped from documents")
def q_escape_brackets(spark, base):
    d = table(spark, base, "documents")
    return d.select("doc_id", T.escape_brackets("text").alias("escaped"))


# ----------------------------------------------------------------- X3, X4
_LABELS_SQL = with_views(f"""
select entry_id,
       {_duck_case('raw_category', vocab.CATEGORY_LABELS, _duck_capitalize('raw_category'))} as category_label,
       {_duck_case('raw_category', vocab.CATEGORY_MARKERS, "'" + vocab.DEFAULT_CATEGORY_MARKER + "'")} as category_marker,
       {_duck_case('raw_severity', vocab.REPORT_SEVERITY_MARKERS, "'" + vocab.REPORT_DEFAULT_SEVERITY_MARKER + "'")} as report_marker,
       {_duck_case('raw_severity', vocab.MESSAGE_SEVERITY_MARKERS, "'" + vocab.MESSAGE_DEFAULT_SEVERITY_MARKER + "'")} as message_marker
from v_verdicts_raw""", "v_verdicts_raw")


@register("labels", _LABELS_SQL)
def q_labels(spark, base):
    r = fx.verdicts_raw(spark, base)
    return r.select("entry_id",
                    L.category_label("raw_category").alias("category_label"),
                    L.category_marker("raw_category").alias("category_marker"),
                    L.report_severity_marker("raw_severity").alias("report_marker"),
                    L.message_severity_marker("raw_severity").alias("message_marker"))


# ----------------------------------------------------------------- X5, X8
@register("week_label", """
select event_id, strftime(ts, '%G-W%V') as week,
       string_split(strftime(ts, '%G-W%V'), '-W')[-1] as week_no
from events""")
def q_week_label(spark, base):
    ev = table(spark, base, "events")
    wk = D.week_label("ts")
    return ev.select("event_id", wk.alias("week"), D.week_number(wk).alias("week_no"))


# ----------------------------------------------------------------- X7
@register("week_bounds", """
select event_id, date_trunc('week', ts) as week_start,
       date_trunc('week', ts) + interval '6 days 23 hours 59 minutes 59 seconds' as week_end
from events""")
def q_week_bounds(spark, base):
    ev = table(spark, base, "events")
    return ev.select("event_id", D.week_start("ts").alias("week_start"),
                     D.week_end("ts").alias("week_end"))


# ----------------------------------------------------------------- X9, X10
_MONTHS_LIST = "[" + ", ".join(f"'{m}'" for m in vocab.MONTHS_FR) + "]"


@register("format_dates", f"""
select event_id,
       concat(cast(day(ts) as varchar), ' ', {_MONTHS_LIST}[month(ts)], ' ', cast(year(ts) as varchar)) as date_long,
       strftime(ts, '%d/%m/%Y') as date_short,
       strftime(ts, '%d/%m/%Y à %H:%M') as date_time
from events""")
def q_format_dates(spark, base):
    ev = table(spark, base, "events")
    return ev.select("event_id", D.date_fr_long("ts").alias("date_long"),
                     D.date_fr_short("ts").alias("date_short"),
                     D.datetime_fr("ts").alias("date_time"))


# ----------------------------------------------------------------- X6
_ARCHIVE_BASE = "https://git.example.org/team/archive/"


@register("archive_link", with_views(f"""
select week, case when base is null or base = '' then null
                  else rtrim(base, '/') || '/blob/main/' || replace(path, '\\', '/') end as link
from (select distinct strftime(published_at, '%G-W%V') as week,
             case when cast(right(strftime(published_at, '%G-W%V'), 2) as int) % 2 = 0
                  then '{_ARCHIVE_BASE}' end as base,
             'docs\\reports\\' || strftime(published_at, '%G-W%V') || '.md' as path
      from v_verdicts) t""", "v_verdicts"))
def q_archive_link(spark, base):
    v = fx.verdicts(spark, base)
    wk = D.week_label("published_at")
    w = v.select(wk.alias("week")).distinct()
    b = F.when(F.substring("week", -2, 2).cast("int") % 2 == 0, F.lit(_ARCHIVE_BASE))
    path = F.concat(F.lit("docs\\reports\\"), F.col("week"), F.lit(".md"))
    return w.select("week", T.archive_link(b, path).alias("link"))


# ----------------------------------------------------------------- X11-X15
@register("validate_verdicts", with_views("""
select entry_id, hash, severity, category, score, kept from v_verdicts""", "v_verdicts"))
def q_validate(spark, base):
    v = fx.verdicts(spark, base)
    return v.select("entry_id", "hash", "severity", "category", "score", "kept")


# ----------------------------------------------------------------- X13, X12 on JSON values
# fixed JSON cases: value text, expected truthiness / expected score
KEPT_CASES = [("true", True), ("false", False), ("1", True), ("0", False), ('"false"', True),
              ('""', False), ("[]", False), ("null", False), (None, False)]
SCORE_CASES = [("0", 1), ("11", 10), ("12.5", 10), ('"9"', 9), ('" 7 "', 7), ('"9.7"', 1),
               ('"abc"', 1), ("null", 1), ("[1]", 1), ("true", 1), (None, 1)]


def _case_sql(col: str, cases, as_value) -> str:
    whens = " ".join(f"when {i} then {as_value(v)}" for i, v in enumerate(cases))
    return f"(case {col} {whens} end)"


@register("truthiness", f"""
select event_id,
       {_case_sql('event_id % 9', [c[1] for c in KEPT_CASES], lambda b: 'true' if b else 'false')} as kept,
       {_case_sql('event_id % 11', [c[1] for c in SCORE_CASES], str)} as score
from events""")
def q_truthiness(spark, base):
    """Python ``bool(x)`` and ``int(x)`` of JSON answer values."""
    ev = table(spark, base, "events")

    def doc(cases, mod, field):
        expr = None
        for i, (txt, _) in enumerate(cases):
            body = "{}" if txt is None else '{"' + field + '": ' + txt + "}"
            cond = F.col("event_id") % mod == i
            expr = F.when(cond, F.lit(body)) if expr is None else expr.when(cond, F.lit(body))
        return F.try_parse_json(expr)

    kv = F.try_variant_get(doc(KEPT_CASES, 9, "kept"), "$.kept", "variant")
    sv = F.try_variant_get(doc(SCORE_CASES, 11, "score"), "$.score", "variant")
    return ev.select("event_id", C.truthy(kv).alias("kept"), C.score_of(sv).alias("score"))


# ----------------------------------------------------------------- F2, S5
_RF_IN = """
select entry_id,
       case entry_id % 7 when 0 then ' ' || chr(160) else link end as link,
       case entry_id % 11 when 0 then chr(8195) || title || ' ' when 5 then chr(28) else title end as title
from v_entries"""


def _rf_input(spark, base):
    e = fx.entries(spark, base)
    link = F.when(F.col("entry_id") % 7 == 0, F.lit(" \u00a0")).otherwise(F.col("link"))
    title = (F.when(F.col("entry_id") % 11 == 0, F.concat(F.lit(" "), F.col("title"), F.lit(" ")))
             .when(F.col("entry_id") % 11 == 5, F.lit("\x1c")).otherwise(F.col("title")))
    return e.select("entry_id", link.alias("link"), title.alias("title"))


@register("required_fields", with_views(f"""
select entry_id, {_duck_strip('link')} as link, {_duck_strip('title')} as title
from ({_RF_IN}) t
where length({_duck_strip('link')}) > 0 and length({_duck_strip('title')}) > 0""", "v_entries"))
def q_required_fields(spark, base):
    return I.required_fields(_rf_input(spark, base)).select("entry_id", "link", "title")


@register("entry_quarantine", with_views(f"""
select entry_id, case when length({_duck_strip('link')}) = 0 then 'missing_link' else 'missing_title' end as reason
from ({_RF_IN}) t
where length({_duck_strip('link')}) = 0 or length({_duck_strip('title')}) = 0""", "v_entries"))
def q_entry_quarantine(spark, base):
    return I.entry_rejections(_rf_input(spark, base)).select("entry_id", "reason")


# ----------------------------------------------------------------- S1, S2
@register("sources_by_category", with_views("""
select category, count(*) as n_sources from v_sources group by category""", "v_sources"))
def q_sources_by_category(spark, base):
    return I.sources_by_category(fx.sources_registry(spark, base))


@register("secure_sources", with_views("""
select source, url, category from v_sources where regexp_matches(url, '^https://[^/?#]+', 'i')""",
                                       "v_sources"))
def q_secure_sources(spark, base):
    return I.secure_sources(fx.sources_registry(spark, base))


# ----------------------------------------------------------------- P1, J4, U1
_NORM_SQL = f"""
select e.entry_id, sha256({_duck_strip('e.link')}) as hash, {_duck_strip('e.link')} as link,
       {_duck_strip('e.title')} as title, {_duck_clean('e.summary')} as summary,
       e.source, s.category as source_category, e.published_at
from v_entries e
join (select * from v_sources where regexp_matches(url, '^https://[^/?#]+', 'i')) s on s.source = e.source
where length({_duck_strip('e.link')}) > 0 and length({_duck_strip('e.title')}) > 0"""


@register("normalize_items", with_views(_NORM_SQL, "v_entries", "v_sources"))
def q_normalize(spark, base):
    items = I.normalize(fx.entries(spark, base), fx.sources_registry(spark, base))
    return items.select("entry_id", "hash", "link", "title", "summary", "source",
                        "source_category", "published_at")


@register("entries_per_source", with_views(f"""
select source, count(*) as n_entries from ({_NORM_SQL}) t group by source""",
                                           "v_entries", "v_sources"))
def q_entries_per_source(spark, base):
    items = I.normalize(fx.entries(spark, base), fx.sources_registry(spark, base))
    return I.entries_per_source(items)
