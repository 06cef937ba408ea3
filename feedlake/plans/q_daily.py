"""Registered queries: recency, ledger, scoring surface and daily selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.operators import ledger as LG
from feedlake.operators import recency as R
from feedlake.operators import select as sel
from feedlake.operators import verdicts as V
from feedlake.plans.catalog import register
from feedlake.plans.oracle_views import view, with_views
from feedlake.sources import fixtures as fx

KEY = "severity_rank, score desc, response_pos"
PRIO = "('critical', 'important')"

view("v_top", f"""
select * from (select *, row_number() over (partition by run_ts order by {KEY}) as rank
               from v_daily where kept and severity in {PRIO}) t where rank <= 3""", ["v_daily"])
view("v_other", f"""
select *, row_number() over (partition by d.run_ts order by {KEY}) as rank
from (select d.* from v_daily d anti join v_top t on t.run_ts = d.run_ts and t.response_pos = d.response_pos
      where d.kept) d""", ["v_daily", "v_top"])
view("v_pairs", """
select r.run_ts, v.entry_id, v.hash, v.link, v.published_at
from v_runs r join v_verdicts v
  on v.published_at <= r.run_ts and v.published_at >= r.run_ts - interval 24 hours""",
     ["v_runs", "v_verdicts"])
view("v_status", "select run_ts, extract(day from run_ts) % 6 <> 0 as ok from v_runs", ["v_runs"])
view("v_new_pairs", """
select p.* from (select * from v_pairs p anti join v_ledger l on l.hash = p.hash) p
left join (select p.hash, min(p.run_ts) as first_ok
           from (select * from v_pairs p anti join v_ledger l on l.hash = p.hash) p
           join v_status s on s.run_ts = p.run_ts where s.ok group by p.hash) f on f.hash = p.hash
where f.first_ok is null or p.run_ts <= f.first_ok""", ["v_pairs", "v_ledger", "v_status"])
view("v_answers", """
select run_ts, cast(row_number() over (partition by run_ts order by entry_id) as int) as response_pos,
       case when source = 'signup' then upper(hash) else hash end as hash, entry_id
from v_daily""", ["v_daily"])

NOW = "2024-01-20 12:00:00"


def _items(spark, base):
    return fx.daily_items(spark, base)


# ------------------------------------------------------------------ F1
@register("recent_items", with_views(f"""
select entry_id, hash, published_at from v_verdicts
where published_at >= timestamp '{NOW}' - interval 24 hours""", "v_verdicts"))
def q_recent(spark, base):
    v = fx.verdicts(spark, base)
    return R.recent(v, NOW).select("entry_id", "hash", "published_at")


# ------------------------------------------------------------------ J6
@register("items_per_run", with_views("select run_ts, entry_id, hash from v_pairs", "v_pairs"))
def q_items_per_run(spark, base):
    pairs = R.items_per_run(fx.verdicts(spark, base), fx.runs(spark, base))
    return pairs.select("run_ts", "entry_id", "hash")


# ------------------------------------------------------------------ J1, U4, L4
@register("new_items", with_views("""
select v.entry_id, v.hash from v_verdicts v anti join v_ledger l on l.hash = v.hash""",
                                  "v_verdicts", "v_ledger"))
def q_new_items(spark, base):
    return LG.new_items(fx.verdicts(spark, base), fx.ledger(spark, base)).select("entry_id", "hash")


def _new_pairs(spark, base):
    pairs = R.items_per_run(fx.verdicts(spark, base), fx.runs(spark, base))
    return LG.new_per_run(pairs, fx.ledger(spark, base), fx.run_status(spark, base))


# ------------------------------------------------------------------ C1
@register("new_per_run", with_views("select run_ts, entry_id, hash from v_new_pairs", "v_new_pairs"))
def q_new_per_run(spark, base):
    return _new_pairs(spark, base).select("run_ts", "entry_id", "hash")


# ------------------------------------------------------------------ K6, F7
@register("commit_gate", with_views("""
select distinct p.run_ts, p.hash, p.link as url from v_new_pairs p
join v_status s on s.run_ts = p.run_ts where s.ok""", "v_new_pairs", "v_status"))
def q_commit_gate(spark, base):
    return LG.gated_marks(_new_pairs(spark, base), fx.run_status(spark, base))


# ------------------------------------------------------------------ K1, U3
@register("ledger_first_wins", with_views("""
select hash, arg_min(url, {'s': seen_at, 'u': url}) as url, min(seen_at) as seen_at
from (select hash, link || '#' || cast(entry_id as varchar) as url, published_at as seen_at from v_verdicts) m
group by hash""", "v_verdicts"))
def q_ledger_first_wins(spark, base):
    v = fx.verdicts(spark, base)
    marks = v.select("hash", F.concat("link", F.lit("#"), F.col("entry_id").cast("string")).alias("url"),
                     F.col("published_at").alias("seen_at"))
    return LG.first_wins(marks)


# ------------------------------------------------------------------ K2
@register("ledger_purge", with_views("""
select hash, url, seen_at from v_ledger where seen_at >= timestamp '2024-01-20 00:00:00' - interval 10 days""",
                                     "v_ledger"))
def q_ledger_purge(spark, base):
    return LG.purge(fx.ledger(spark, base), "2024-01-20 00:00:00", days=10)


# ------------------------------------------------------------------ K3
@register("verdict_upsert", with_views("""
select hash, entry_id, run_ts as recorded_at, severity, score, category
from (select *, row_number() over (partition by hash order by run_ts desc, response_pos desc) as rn
      from v_daily where kept) t where rn = 1""", "v_daily"))
def q_verdict_upsert(spark, base):
    """Stored verdicts (runs before the 16th) upserted with the later runs."""
    d = fx.daily_verdicts(spark, base).filter("kept").withColumn("recorded_at", F.col("run_ts"))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    out = V.upsert(d.filter(F.col("run_ts") < cut), d.filter(F.col("run_ts") >= cut))
    return out.select("hash", "entry_id", "recorded_at", "severity", "score", "category")


# ------------------------------------------------------------------ X18, X19, M2
@register("parse_responses", with_views("""
select run_ts, cast(row_number() over (partition by run_ts order by entry_id) as int) as response_pos,
       hash, severity, score, kept, category from v_daily""", "v_daily"))
def q_parse_responses(spark, base):
    return fx.answers(spark, base).select("run_ts", F.col("response_pos").cast("int"), "hash", "severity", "score",
                                          "kept", "category")


# ------------------------------------------------------------------ J2, F3
@register("verdict_match", with_views("""
select a.run_ts, a.response_pos, a.hash, i.entry_id
from v_answers a join (select run_ts, hash, max(entry_id) as entry_id from v_daily group by run_ts, hash) i
  on i.run_ts = a.run_ts and i.hash = a.hash""", "v_answers", "v_daily"))
def q_verdict_match(spark, base):
    a = fx.answers_with_errors(spark, base).select("run_ts", "response_pos", "hash")
    items = _items(spark, base).select("run_ts", "hash", "entry_id", "entry_pos")
    return V.match(a, items).select("run_ts", F.col("response_pos").cast("int"), "hash", "entry_id")


# ------------------------------------------------------------------ M7
@register("response_coverage", with_views("""
select coalesce(i.run_ts, a.run_ts) as run_ts, coalesce(i.hash, a.hash) as hash,
       coalesce(i.n_items, 0) as n_items, coalesce(a.n_answers, 0) as n_answers,
       case when coalesce(a.n_answers, 0) = 0 then 'missing' when coalesce(i.n_items, 0) = 0 then 'unknown'
            when a.n_answers > 1 then 'repeated' else 'ok' end as status
from (select run_ts, hash, count(*) as n_items from v_daily group by run_ts, hash) i
full outer join (select run_ts, hash, count(*) as n_answers from v_answers group by run_ts, hash) a
  on i.run_ts = a.run_ts and i.hash = a.hash""", "v_daily", "v_answers"))
def q_response_coverage(spark, base):
    items = _items(spark, base).select("run_ts", "hash")
    return V.coverage(items, fx.answers_with_errors(spark, base).select("run_ts", "hash")) \
        .select("run_ts", "hash", "n_items", "n_answers", "status")


# ------------------------------------------------------------------ A1, P13
@register("digest_header", with_views(f"""
select run_ts, count(*) as n_scored, count_if(kept) as n_kept,
       'day ' || cast(any_value(cast(published_at as date)) as varchar) as headline,
       '{vocab.DIGEST_DEFAULT_SUMMARY}' as summary, false as is_fallback
from v_daily group by run_ts""", "v_daily"))
def q_digest_header(spark, base):
    docs = (fx.responses(spark, base).filter(F.col("batch_no") == 0)
            .withColumn("run_ts", fx.run_of(F.col("day"))))
    return V.digest_header(_items(spark, base), fx.answers(spark, base), docs) \
        .select("run_ts", "n_scored", "n_kept", "headline", "summary", "is_fallback")


# ------------------------------------------------------------------ W1, L1
@register("ranked_verdicts", with_views(f"""
select run_ts, cast(row_number() over (partition by run_ts order by {KEY}) as int) as rank, entry_id
from v_daily where kept""", "v_daily"))
def q_ranked(spark, base):
    return sel.ranked(fx.daily_verdicts(spark, base), "run_ts", ["response_pos"]) \
        .select("run_ts", F.col("rank").cast("int"), "entry_id")


# ------------------------------------------------------------------ W3, Q10
@register("daily_other", with_views("""
select run_ts, cast(rank as int) as rank, entry_id from v_other""", "v_other"))
def q_daily_other(spark, base):
    return sel.daily_other(fx.daily_verdicts(spark, base)) \
        .select("run_ts", F.col("rank").cast("int"), "entry_id")


# ------------------------------------------------------------------ U2, F4
@register("kept_items", with_views("""
select run_ts, 'top' as section, cast(rank as int) as rank, entry_id from v_top
union all
select run_ts, 'other' as section, cast(rank as int) as rank, entry_id from v_other""", "v_top", "v_other"))
def q_kept_items(spark, base):
    return V.digest_items(fx.daily_verdicts(spark, base)) \
        .select("run_ts", "section", F.col("rank").cast("int"), "entry_id")


# ------------------------------------------------------------------ W4, Q11
@register("fallback_digest", with_views(f"""
select run_ts, cast(rn as int) as rank, entry_id, '{vocab.FALLBACK_SEVERITY}' as severity,
       {vocab.FALLBACK_SCORE} as score,
       case when source_category in ('security','backend','frontend','devops','ai','general')
            then source_category else 'general' end as category,
       '{vocab.FALLBACK_REASON}' as reason
from (select *, row_number() over (partition by run_ts order by source, entry_id) as rn from v_daily) t
where rn <= 8""", "v_daily"))
def q_fallback_digest(spark, base):
    out = sel.fallback_digest(_items(spark, base))
    return out.select("run_ts", F.col("rank").cast("int"), "entry_id", "severity", "score",
                      "category", "reason")


# ------------------------------------------------------------------ M4
@register("digest_with_fallback", with_views(f"""
select run_ts, 'top' as section, cast(rank as int) as rank, entry_id, false as is_fallback from v_top
where extract(day from cast(published_at as date)) not in (7, 21)
union all
select run_ts, 'other', cast(rank as int), entry_id, false from v_other
where extract(day from cast(published_at as date)) not in (7, 21)
union all
select run_ts, 'other', cast(rn as int), entry_id, true
from (select *, row_number() over (partition by run_ts order by source, entry_id) as rn from v_daily
      where extract(day from cast(published_at as date)) in (7, 21)) t where rn <= 8""",
                                             "v_top", "v_other", "v_daily"))
def q_digest_with_fallback(spark, base):
    """Answers of the 7th and 21st are cut off: those runs fall back."""
    docs = fx.responses(spark, base)
    docs = docs.withColumn("doc", F.when(F.dayofmonth("day").isin(7, 21), F.substring("doc", 1, 40))
                           .otherwise(F.col("doc"))).withColumn("run_ts", fx.run_of(F.col("day")))
    ok = V.usable(docs, "run_ts")
    out = V.with_fallback(_items(spark, base), fx.daily_verdicts(spark, base), ok)
    return out.select("run_ts", "section", F.col("rank").cast("int"), "entry_id", "is_fallback")


# ------------------------------------------------------------------ W8
@register("quota_enforced", with_views(f"""
with k as (select run_ts, entry_id, severity, severity_rank, score, response_pos from v_daily where kept),
s1 as (
  select run_ts, entry_id, severity, severity_rank, score, response_pos from (
    select *, row_number() over (partition by run_ts, severity order by {KEY}) as r from k
    where severity in ('critical', 'important', 'notable')) t
  where (severity in {PRIO} and r <= 2) or (severity = 'notable' and r <= 3)
  union all
  select * from k where severity not in ('critical', 'important', 'notable')),
s2 as (
  select run_ts, entry_id, severity, severity_rank, score, response_pos from (
    select *, row_number() over (partition by run_ts order by {KEY}) as r from s1
    where severity in {PRIO}) t where r <= 3
  union all
  select * from s1 where severity not in {PRIO})
select run_ts, cast(rank as int) as rank, entry_id, severity from (
  select *, row_number() over (partition by run_ts order by {KEY}) as rank from s2) t
where rank <= 6""", "v_daily"))
def q_quota(spark, base):
    return sel.quota_enforced(fx.daily_verdicts(spark, base)) \
        .select("run_ts", F.col("rank").cast("int"), "entry_id", "severity")


# ------------------------------------------------------------------ M1, P11, S9, X20, X21
TEMPLATE = "Classe les articles suivants.\nArticles : {articles_json}\nRéponds en JSON."
BATCH = 50


@register("pack_requests", with_views(f"""
select run_ts, cast(batch_no as int) as batch_no, count(*) as n_items,
       replace('{TEMPLATE}', '{{articles_json}}',
               to_json(list({{'hash_unique': hash, 'titre': title, 'resume': 'summary of ' || title,
                              'source': source, 'categorie_source': source_category}} order by pos))) as prompt
from (select *, row_number() over (partition by run_ts order by entry_id) as pos,
             (row_number() over (partition by run_ts order by entry_id) - 1) // {BATCH} as batch_no
      from v_daily) t
group by run_ts, batch_no""", "v_daily"))
def q_pack_requests(spark, base):
    out = V.pack_requests(_items(spark, base), TEMPLATE, batch_items=BATCH)
    return out.select("run_ts", F.col("batch_no").cast("int"), "n_items", "prompt")


# ------------------------------------------------------------------ A7
@register("stage_counts", with_views("""
select run_ts, 'recent' as stage, count(*) as n from v_pairs group by run_ts
union all select run_ts, 'new', count(*) from v_new_pairs group by run_ts
union all select run_ts, 'kept', count(*) from v_daily where kept group by run_ts
union all select p.run_ts, 'marked', count(distinct p.hash) from v_new_pairs p
          join v_status s on s.run_ts = p.run_ts where s.ok group by p.run_ts""",
                                     "v_pairs", "v_new_pairs", "v_daily", "v_status"))
def q_stage_counts(spark, base):
    from feedlake.operators.metrics import stage_counts
    pairs = R.items_per_run(fx.verdicts(spark, base), fx.runs(spark, base))
    new = LG.new_per_run(pairs, fx.ledger(spark, base), fx.run_status(spark, base))
    kept = fx.daily_verdicts(spark, base).filter("kept")
    marks = LG.gated_marks(new, fx.run_status(spark, base))
    return stage_counts({"recent": pairs, "new": new, "kept": kept,
                         "marked": marks.select("run_ts", "hash").distinct()})


# ------------------------------------------------------------------ K3, K4 on files
@register("verdict_store_write", ORACLE_UPSERT := with_views("""
select hash, entry_id, run_ts as recorded_at, severity, score, category
from (select *, row_number() over (partition by hash order by run_ts desc, response_pos desc) as rn
      from v_daily where kept) t where rn = 1""", "v_daily"))
def q_verdict_store_write(spark, base):
    """Kept verdicts upserted into a parquet store in two commits (runs
    before the 16th, then the rest) and read back."""
    from feedlake.session import scratch_path
    from feedlake.sources import store as ST
    path = scratch_path(spark, "verdict-store")
    d = fx.daily_verdicts(spark, base).filter("kept").withColumn("recorded_at", F.col("run_ts"))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    ST.upsert_store(spark, d.filter(F.col("run_ts") < cut), path)
    ST.upsert_store(spark, d.filter(F.col("run_ts") >= cut), path)
    return ST.read_store(spark, path).select("hash", "entry_id", "recorded_at", "severity",
                                             "score", "category")


# ------------------------------------------------------------------ J6 with arrival times
view("v_fetched", """
select entry_id, hash, published_at, published_at + ((entry_id % 5) - 2) * interval 10 hours as fetched_at
from v_verdicts""", ["v_verdicts"])


@register("items_per_run_fetched", with_views("""
select r.run_ts, v.entry_id, v.hash from v_runs r join v_fetched v
  on v.fetched_at <= r.run_ts and v.published_at >= r.run_ts - interval 744 hours""", "v_runs", "v_fetched"))
def q_items_per_run_fetched(spark, base):
    """Items that land late or are dated ahead, and a window of 31 days."""
    v = fx.verdicts(spark, base).withColumn(
        "fetched_at", F.col("published_at") + F.make_dt_interval(hours=((F.col("entry_id") % 5) - 2).cast("int") * 10))
    return R.items_per_run(v, fx.runs(spark, base), hours=744, fetched_col="fetched_at") \
        .select("run_ts", "entry_id", "hash")


# ------------------------------------------------------------------ M2 in the original's schema
@register("parse_reference_answers", with_views("""
select run_ts, cast(row_number() over (partition by run_ts order by entry_id) as int) as response_pos,
       hash, severity, score, kept, category from v_daily""", "v_daily"))
def q_parse_reference_answers(spark, base):
    docs = fx.reference_responses(spark, base).withColumn("run_ts", fx.run_of(F.col("day")))
    return V.validate(V.parse_documents(docs, "run_ts", offset_col="first_pos")).select(
        "run_ts", F.col("response_pos").cast("int"), "hash", "severity", "score", "kept", "category")


# ------------------------------------------------------------------ P13, M4: header of the fallback
_FLAWED = ", ".join(map(str, fx.CUT_DAYS + fx.MISSING_DAYS))
_BAD_RUN = f"extract(day from run_ts - interval 27 hours) in ({_FLAWED})"


@register("digest_header_fallback", with_views(f"""
select run_ts, case when bad then least(n_scored, {vocab.FALLBACK_ITEMS}) else n_kept end as n_kept, n_scored,
       case when bad then '' else headline end as headline,
       case when bad then '{vocab.DIGEST_FALLBACK_SUMMARY.replace("'", "''")}' else '{vocab.DIGEST_DEFAULT_SUMMARY}' end as summary,
       bad as is_fallback
from (select run_ts, {_BAD_RUN} as bad, count(*) as n_scored, count_if(kept) as n_kept,
             'day ' || cast(any_value(cast(published_at as date)) as varchar) as headline
      from v_daily group by run_ts) t""", "v_daily"))
def q_digest_header_fallback(spark, base):
    """Runs whose answer is cut off or missing say that they fell back."""
    docs = fx.flawed_responses(spark, base)
    return V.digest_header(_items(spark, base), fx.answers(spark, base), docs.filter(F.col("batch_no") == 0),
                           ok_runs=V.usable(docs, "run_ts")) \
        .select("run_ts", "n_scored", "n_kept", "headline", "summary", "is_fallback")


# ------------------------------------------------------------------ the whole daily job
view("v_job", """
select a.run_ts, a.response_pos, a.hash, a.severity, a.severity_rank, a.score, a.kept, n.entry_id
from (select *, row_number() over (partition by run_ts order by entry_id) as response_pos
      from (select * exclude (response_pos) from v_daily)) a
join (select run_ts, hash, max(entry_id) as entry_id from v_new_pairs group by run_ts, hash) n
  on n.run_ts = a.run_ts and n.hash = a.hash""", ["v_daily", "v_new_pairs"])
view("v_unanswered", f"""
select p.run_ts, {1 << 40} + pos as response_pos, p.hash, 'notable' as severity, 2 as severity_rank, 5 as score, true as kept, p.entry_id
from (select *, row_number() over (partition by run_ts order by entry_id) as pos from v_new_pairs) p
anti join v_daily a on a.run_ts = p.run_ts and a.hash = p.hash""", ["v_daily", "v_new_pairs"])
view("v_job_top", f"""
select * from (select *, row_number() over (partition by run_ts order by {KEY}) as rank
               from v_job where kept and severity in {PRIO}) t where rank <= 3""", ["v_job"])


def _daily_job(spark, base):
    """Ledger and store paths, and the job's frames: prior ledger, flawed answers, known outcomes."""
    from feedlake.plans.daily import run_daily
    from feedlake.session import scratch_path
    from feedlake.sources import store as ST
    ledger, store = scratch_path(spark, "job-ledger"), scratch_path(spark, "job-store")
    ST.append_ledger(fx.ledger(spark, base), ledger)
    items = _items(spark, base).drop("run_ts", "response_pos")
    out = run_daily(spark, items, None, fx.runs(spark, base), ledger, store,
                    answers=fx.flawed_responses(spark, base), run_status=fx.run_status(spark, base))
    return ledger, store, out


@register("daily_job_marks", with_views("""
select hash, min(seen_at) as seen_at from (
  select hash, seen_at from v_ledger
  union all select p.hash, p.run_ts from v_new_pairs p join v_status s on s.run_ts = p.run_ts where s.ok) t
group by hash""", "v_ledger", "v_new_pairs", "v_status"))
def q_daily_job_marks(spark, base):
    """The ledger after the job: what it had, and the runs that published."""
    from feedlake.sources import store as ST
    return ST.read_ledger(spark, _daily_job(spark, base)[0]).select("hash", "seen_at")


@register("daily_job_digest", with_views(f"""
select run_ts, 'top' as section, cast(rank as int) as rank, entry_id, false as is_fallback
from v_job_top where not {_BAD_RUN}
union all
select run_ts, 'other', cast(row_number() over (partition by run_ts order by {KEY}) as int), entry_id, response_pos >= {1 << 40}
from (from v_job union all by name from v_unanswered) j
anti join v_job_top t on t.run_ts = j.run_ts and t.response_pos = j.response_pos
where kept and not {_BAD_RUN}
union all
select run_ts, 'other', cast(rn as int), entry_id, true
from (select p.run_ts, p.entry_id, row_number() over (partition by p.run_ts order by v.source, p.entry_id) as rn
      from v_new_pairs p join v_verdicts v on v.entry_id = p.entry_id where {_BAD_RUN.replace('run_ts', 'p.run_ts')}) t
where rn <= {vocab.FALLBACK_ITEMS}""", "v_job", "v_unanswered", "v_job_top", "v_new_pairs", "v_verdicts"))
def q_daily_job_digest(spark, base):
    """The job's selection, runs without a usable answer on the fallback."""
    return _daily_job(spark, base)[2]["digest_items"].select(
        "run_ts", "section", F.col("rank").cast("int"), "entry_id", "is_fallback")


# ------------------------------------------------------------------ M7, M4: requests against answers
#: Answers cut off, by (day of month + request number): two in three at first, then one in three, one in six.
CUT_IN_ROUND = {1: (3, (0, 1)), 2: (3, (0,)), 3: (6, (0,))}


@register("answer_reconciliation", with_views(f"""
with sent as (
  select *, case when k % 3 = 2 then 1 when k % 3 = 1 then 2 when k % 6 = 3 then 3 end as attempt
  from (select *, extract(day from run_ts) + batch_no as k
        from (select *, (row_number() over (partition by run_ts order by entry_id) - 1) // {V.DEFAULT_BATCH_ITEMS} as batch_no
              from v_daily) d) d),
answered as (select distinct run_ts, hash from sent where attempt is not null and source <> 'signup')
select s.run_ts, s.batch_no, count(*) as n_sent, count(a.hash) as n_answered, count(*) - count(a.hash) as n_missing,
       cast(any_value(s.attempt) as int) as attempt,
       case when count(a.hash) = count(*) then 'answered' when count(a.hash) = 0 then 'unanswered' else 'partial' end as status
from (select distinct run_ts, batch_no, hash, attempt from sent) s
left join answered a on a.run_ts = s.run_ts and a.hash = s.hash
group by s.run_ts, s.batch_no""", "v_daily"))
def q_answer_reconciliation(spark, base):
    """Requests asked for in rounds until their answers can be read, and what those answers left out.

    The answering side leaves the ``signup`` items out and cuts documents off by a rule of day and round.
    """
    sent = V.batched(_items(spark, base))
    requests = V.pack_requests(sent, "{articles_json}")

    def ask(pending, attempt):
        n, cut = CUT_IN_ROUND[attempt]
        own = sent.join(pending.select("run_ts", "batch_no"), ["run_ts", "batch_no"], "left_semi")
        item = F.struct("hash", "severity", "score", "kept", "category")
        docs = own.groupBy("run_ts", "batch_no").agg(F.to_json(F.struct(
            F.collect_list(F.when(F.col("source") != "signup", item)).alias("items"))).alias("doc"))
        broken = ((F.dayofmonth("run_ts") + F.col("batch_no")) % n).isin(*cut)
        return docs.withColumn("doc", F.when(broken, F.left("doc", F.length("doc") - 3)).otherwise(F.col("doc")))

    found, _ = V.ask_in_rounds(requests, ask)
    answered = V.validate(V.parse_documents(found, "run_ts"))
    return (V.reconcile(sent, answered).join(found.select("run_ts", "batch_no", "attempt"), ["run_ts", "batch_no"], "left")
            .select("run_ts", "batch_no", "n_sent", "n_answered", "n_missing", "attempt", "status"))
