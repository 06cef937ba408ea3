"""Weekly rollups over stored verdicts, all weeks in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions import coerce as C
from feedlake.functions import dates as D
from feedlake.functions import text as T
from feedlake.operators import select as sel
from feedlake.operators.ranking import ordinal, top_k

# Weekly order ties fall back to publication order (the period scan's order).
WEEK_TIEBREAK = ["published_at", "hash", "entry_id"]


def periods(df: DataFrame, ts: str = "published_at") -> DataFrame:
    """ISO weeks present in ``df`` with their bounds."""
    return (df.select(D.week_label(ts).alias("week"), D.week_start(ts).alias("week_start"))
            .distinct().withColumn("week_end", D.week_end(F.col("week_start"))))


def period_scan(store: DataFrame, periods_df: DataFrame) -> DataFrame:
    """Kept verdicts with ``week_start <= published_at <= week_end``.

    The periods table is keyed by week start, so the range predicate becomes
    an equi-join on the row's own week start plus a residual check; a store
    partitioned by ``week`` is pruned by the join's dynamic partition filter.
    """
    kept = store.filter(F.col("kept"))
    p = periods_df.withColumnRenamed("week", "__pweek")
    between = F.col("published_at").between(F.col("week_start"), F.col("week_end"))
    if "week" in store.columns:
        # join on the partition column: the store's scan is pruned to the
        # requested weeks (dynamic partition pruning)
        j = kept.join(p, kept["week"] == p["__pweek"], "inner").filter(between)
        return j.drop("week").withColumnRenamed("__pweek", "week")
    kept = kept.withColumn("__ws", D.week_start("published_at"))
    j = kept.join(p, kept["__ws"] == p["week_start"], "inner").filter(between)
    return j.drop("__ws").withColumnRenamed("__pweek", "week")


def week_totals(store: DataFrame) -> DataFrame:
    return store.groupBy("week").agg(F.count(F.lit(1)).alias("n_kept"))


def category_counts(store: DataFrame, weeks: DataFrame | None = None) -> DataFrame:
    """Per week and vocabulary category, zero-filled, with display order.

    Each week row is expanded to the six categories with a generator
    (``explode`` of a literal array), then left-joined to the counts.
    """
    wk = weeks if weeks is not None else store.select("week").distinct()
    cats = F.array(*[F.struct(F.lit(i + 1).alias("ord"), F.lit(c).alias("category"))
                     for i, c in enumerate(vocab.CATEGORIES)])
    grid = wk.select("week", F.inline(cats))
    counts = store.groupBy("week", "category").agg(F.count(F.lit(1)).alias("n"))
    return (grid.join(counts, ["week", "category"], "left")
            .withColumn("n", F.coalesce(F.col("n"), F.lit(0).cast("bigint"))))


def category_counts_nonzero(store: DataFrame) -> DataFrame:
    """Only the categories that have rows (A4, F8), in display order."""
    return category_counts(store).filter(F.col("n") > 0)


def category_ranked(store: DataFrame) -> DataFrame:
    """Rank within (week, category) by the sort key (A2, W6); skew-safe ordinal."""
    return ordinal(store, ["week", "category"], sel.sort_key(WEEK_TIEBREAK), out="rank")


def latest_per_hash(store: DataFrame) -> DataFrame:
    """The original's hash index keeps the last row of a repeated hash."""
    order = [F.col(c).desc() for c in WEEK_TIEBREAK]
    return top_k(store, ["week", "hash"], order, 1, out="__r").drop("__r")


def recap_fields(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Parse weekly answers: trends text with default, referenced hashes,
    takeaways (M3)."""
    v = F.try_parse_json(F.col(doc_col))
    return docs.select(
        "week",
        T.default_text(C.text_of(F.try_variant_get(v, "$.tendances", "variant")),
                       vocab.RECAP_DEFAULT_TRENDS).alias("trends"),
        F.coalesce(F.try_variant_get(v, "$.top_3_hashes", "array<string>"),
                   F.array().cast("array<string>")).alias("refs"),
        F.coalesce(F.try_variant_get(v, "$.a_retenir", "array<variant>"),
                   F.array().cast("array<variant>")).alias("takeaways_raw"),
        (v.isNotNull() & F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))
        .alias("usable"))


def top_referenced(store: DataFrame, fields: DataFrame, n: int = vocab.RECAP_TOP) -> DataFrame:
    """Ordered lookup join (J3, W7, Q13): the first ``n`` referenced hashes,
    in the answer's order, unknown ones dropped, renumbered from 1."""
    refs = fields.select("week", F.posexplode(F.slice("refs", 1, n)).alias("__pos", "hash"))
    # at most n references per week: semi-join the store to them first, so
    # only referenced rows reach the last-wins shuffle
    wanted = store.join(refs.select("week", "hash").distinct(), ["week", "hash"], "left_semi")
    hit = refs.join(latest_per_hash(wanted), ["week", "hash"], "inner")
    # at most n rows per week: a plain window is bounded here
    from pyspark.sql import Window
    w = Window.partitionBy("week").orderBy("__pos")
    return hit.withColumn("rank", F.row_number().over(w).cast("int")).drop("__pos")


def takeaways(fields: DataFrame, n: int = vocab.TAKEAWAYS_MAX) -> DataFrame:
    """Cut to ``n`` first, then strip and drop blanks; renumber."""
    t = fields.select("week", F.posexplode(F.slice("takeaways_raw", 1, n)).alias("__pos", "__v"))
    t = t.withColumn("text", C.text_of(F.col("__v"))).filter(F.length("text") > 0)
    from pyspark.sql import Window
    w = Window.partitionBy("week").orderBy("__pos")
    return t.select("week", F.row_number().over(w).cast("int").alias("rank"), "text")


def late_items(store_with_runs: DataFrame, recap_offset: str = "6 days 15 hours") -> DataFrame:
    """Items of a week scored after that week's recap ran (T5, Q1): the
    recap (Sunday 15:00 UTC) could not include them; their weeks need a rebuild."""
    recap_ts = D.week_start("published_at") + F.expr(f"interval {recap_offset}")
    return store_with_runs.filter(F.col("run_ts") > recap_ts)


def recap_selection(store: DataFrame, docs: DataFrame | None, n: int = vocab.RECAP_TOP):
    """Highlights and texts per week with the fallback switch.

    Weeks whose answer parses use the referenced highlights; the others get
    the first ``n`` by the sort key and the fallback trends text. Returns
    ``(fields, top)``.
    """
    weeks = store.select("week").distinct()
    if docs is None:
        parsed = weeks.select("week", F.lit(None).cast("string").alias("trends"),
                              F.lit(None).cast("array<string>").alias("refs"),
                              F.lit(None).cast("array<variant>").alias("takeaways_raw"),
                              F.lit(False).alias("usable"))
    else:
        parsed = weeks.join(recap_fields(docs), "week", "left") \
            .withColumn("usable", F.coalesce(F.col("usable"), F.lit(False)))
    good = parsed.filter(F.col("usable"))
    bad = parsed.filter(~F.col("usable"))
    fields = good.unionByName(bad.select(
        "week", F.lit(vocab.RECAP_FALLBACK_TRENDS).alias("trends"),
        F.lit(None).cast("array<string>").alias("refs"),
        F.array().cast("array<variant>").alias("takeaways_raw"), "usable"))
    top_good = top_referenced(store, good)
    top_bad = sel.fallback_recap_top(store.join(bad.select("week"), "week", "left_semi"),
                                     "week", WEEK_TIEBREAK, n).withColumn("rank", F.col("rank").cast("int"))
    return fields, top_good.unionByName(top_bad, allowMissingColumns=True)
