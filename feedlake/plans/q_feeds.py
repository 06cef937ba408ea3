"""Registered queries: landed feed files (XML), scoring rules and scorers."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.operators import ingest as I
from feedlake.operators import scoring as S
from feedlake.plans.catalog import register
from feedlake.plans.oracle_views import with_views
from feedlake.sources import feeds as FD
from feedlake.sources import fixtures as fx


# ------------------------------------------------------------------ S3, U1, P1
def _feed_sql() -> str:
    from feedlake.plans.q_scalar import _NORM_SQL
    body = _NORM_SQL.replace("select e.entry_id, ", "select ", 1).replace(
        "e.source, s.category as source_category, e.published_at",
        "e.source, s.category as source_category, date_trunc('second', e.published_at) as published_at")
    return with_views(f"""
select source, hash, link, title, summary, published_at, source_category from ({body}) t""",
                      "v_entries", "v_sources")


@register("feed_entries", _feed_sql())
def q_feed_entries(spark, base):
    """Feed files read back, normalised against the registry."""
    path = fx.feed_docs(spark, base)
    ents = FD.entries(FD.read_feeds(spark, path))
    reg = fx.sources_registry(spark, base)
    return I.normalize(ents, reg).select("source", "hash", "link", "title", "summary",
                                         "published_at", "source_category")


# ------------------------------------------------------------------ S4
@register("feed_quarantine", """
select source, case when length(source) % 2 = 0 then 'parse_error' end as reason,
       case when length(source) % 2 = 0 then count(distinct file_no) else 0 end as n_files, count(*) as n_entries
from (select regexp_extract(url, '^https?://([^/?#]+)', 1) as source, page_id % 4 as file_no from pages) p
group by source""")
def q_feed_quarantine(spark, base):
    """Files of all pages, some of them broken off: what goes to quarantine, and the entries that are read all the same."""
    feeds = FD.read_feeds(spark, fx.broken_feeds(spark, base))
    bad = FD.quarantine(feeds).groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_files"))
    return (FD.entries(feeds).groupBy("source").agg(F.count(F.lit(1)).alias("n_entries")).join(bad, "source", "left")
            .select("source", "reason", F.coalesce("n_files", F.lit(0).cast("bigint")).alias("n_files"), "n_entries"))


# ------------------------------------------------------------------ M6
# fixed values: extra rules on common words of the page titles, so the
# fixture exercises matching and precedence (the rubric rules rarely match)
FIXTURE_RULES = S.RULES + [
    (11, S.word("the|that"), "notable", "general", 4),
    (12, S.word("der|die|und|sch"), "important", "backend", 5),
    (13, S.word("le|la|les|des"), "critical", "security", 3),
    (14, S.word("el|los|las|en"), "ignore", "devops", 2),
]


def _rubric_sql(out_cols: str = "entry_id", in_cols: str = "entry_id",
                text_sql: str | None = None, view_name: str = "v_entries",
                rule_list=tuple(FIXTURE_RULES)) -> str:
    from feedlake.plans.q_scalar import _duck_clean
    rules = S._ordered(rule_list)
    text = text_sql or f"(coalesce(title, '') || ' ' || coalesce({_duck_clean('summary')}, ''))"
    rid = " ".join(f"when regexp_matches(txt, '{r[1]}') then {r[0]}" for r in rules)

    def pick(i, default):
        return ("(case rule_id " + " ".join(f"when {r[0]} then {r[i]!r}" for r in rules)
                + f" else {default!r} end)").replace('"', "'")
    return with_views(f"""
select {out_cols}, rule_id, {pick(2, 'ignore')} as severity, {pick(3, 'general')} as category,
       cast({pick(4, 1)} as int) as score, {pick(2, 'ignore')} <> 'ignore' as kept
from (select {out_cols}, cast(case {rid} end as int) as rule_id
      from (select {in_cols}, {text} as txt from {view_name}) t) t""", view_name)


@register("rubric_score", _rubric_sql("entry_id", "entry_id, title, summary"))
def q_rubric_score(spark, base):
    """Rule table matched on title + cleaned summary of every entry."""
    from feedlake.functions.text import clean_html
    e = fx.entries(spark, base)
    out = S.rubric_score(e, S.rule_text(F.col("title"), clean_html(F.col("summary"))),
                         FIXTURE_RULES)
    return out.select("entry_id", "rule_id", "severity", "category", "score", "kept")


# ------------------------------------------------------------------ M6: words of a rule table
# fixed values: word rules with the words of the fixture rules
WORD_RULES = [(11, ["the", "that"], "notable", "general", 4),
              (12, ["der", "die", "und", "sch"], "important", "backend", 5),
              (13, ["le", "la", "les", "des"], "critical", "security", 3),
              (14, ["el", "los", "las", "en"], "ignore", "devops", 2)]


@register("keyword_rules", _rubric_sql("entry_id", "entry_id, title, summary",
                                       rule_list=[(i, S.word("|".join(w)), *rest) for i, w, *rest in WORD_RULES]))
def q_keyword_rules(spark, base):
    """A rule table of words, joined on words, over every entry."""
    from feedlake.functions.text import clean_html
    rules = spark.createDataFrame(WORD_RULES, "rule_id int, words array<string>, severity string, category string, weight int")
    out = S.keyword_join(fx.entries(spark, base),
                         S.rule_text(F.col("title"), clean_html(F.col("summary"))), rules)
    return out.select("entry_id", "rule_id", "severity", "category", "score", "kept")


# ------------------------------------------------------------------ M5
def _score_items_sql() -> str:
    from feedlake.plans.q_scalar import _duck_clean
    text = f"(coalesce(title, '') || ' ' || coalesce({_duck_clean('summary')}, ''))"
    sql = _rubric_sql("run_ts, hash", "cast(cast(published_at as date) as timestamp) + interval 27 hours "
                      "as run_ts, sha256(link) as hash, title, summary", text, "v_entries")
    return sql.replace("select run_ts, hash, rule_id, ", "select run_ts, hash, ", 1)


@register("score_items", _score_items_sql())
def q_score_items(spark, base):
    """Pandas keyword scorer (Arrow batches) over every entry's title and
    cleaned summary; must agree with the CASE form of the same rules."""
    from feedlake.functions.text import clean_html, item_hash
    e = fx.entries(spark, base).select(
        fx.run_of(F.col("published_at")).alias("run_ts"), item_hash(F.col("link")).alias("hash"),
        "title", clean_html(F.col("summary")).alias("summary"))
    return S.score_items(e, S.keyword_scorer(FIXTURE_RULES)).select(
        "run_ts", "hash", "severity", "category", "score", "kept")
