"""Ingest: source registry gate, entry normalisation, per-source counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions import text as T


def secure_sources(sources: DataFrame) -> DataFrame:
    """Sources whose URL is https with a host; any other source yields no rows."""
    return sources.filter(T.url_is_secure(F.col("url")))


def sources_by_category(sources: DataFrame) -> DataFrame:
    return sources.groupBy("category").agg(F.count(F.lit(1)).alias("n_sources"))


def required_fields(entries: DataFrame) -> DataFrame:
    """Strip link and title (Unicode white space); drop entries missing either."""
    return (entries.withColumn("link", T.strip_ws(F.col("link")))
            .withColumn("title", T.strip_ws(F.col("title")))
            .filter((F.coalesce(F.length("link"), F.lit(0)) > 0)
                    & (F.coalesce(F.length("title"), F.lit(0)) > 0)))


def entry_rejections(entries: DataFrame) -> DataFrame:
    """Entries that cannot become items, with the reason."""
    link = T.strip_ws(F.col("link"))
    title = T.strip_ws(F.col("title"))
    reason = (F.when(F.coalesce(F.length(link), F.lit(0)) == 0, F.lit("missing_link"))
              .when(F.coalesce(F.length(title), F.lit(0)) == 0, F.lit("missing_title")))
    return entries.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def normalize(entries: DataFrame, sources: DataFrame, fetched_at=None) -> DataFrame:
    """Feed entries to items (P1..P8, J4): source gate and attributes, required
    fields, cleaned summary, best date, identity hash.

    ``entries`` needs ``source, link, title`` and optionally ``summary``,
    ``description``, ``published``/``updated`` texts or ``published_at``.
    """
    cols = set(entries.columns)
    reg = secure_sources(sources).select("source", F.col("category").alias("source_category"))
    e = entries.drop("source_category") if "source_category" in cols else entries
    e = required_fields(e)
    summary = T.summary_fallback(F.col("summary") if "summary" in cols else F.lit(None),
                                 F.col("description") if "description" in cols else F.lit(None))
    e = e.withColumn("summary", T.clean_html(summary))
    if "published_at" not in cols:
        from feedlake.functions.dates import parse_feed_date
        fetched = fetched_at if fetched_at is not None else F.current_timestamp()
        e = e.withColumn("published_at", F.coalesce(
            parse_feed_date(F.col("published")) if "published" in cols else F.lit(None),
            parse_feed_date(F.col("updated")) if "updated" in cols else F.lit(None),
            F.col("fetched_at") if "fetched_at" in cols else fetched.cast("timestamp_ntz")))
    if "fetched_at" not in cols and fetched_at is not None:
        e = e.withColumn("fetched_at", fetched_at.cast("timestamp_ntz"))
    e = e.withColumn("hash", T.item_hash(F.col("link")))
    # the registry's size is left to adaptive execution: it is measured when
    # its shuffle ends, and broadcast under spark.sql.autoBroadcastJoinThreshold
    return e.join(reg, "source", "inner")


def entries_per_source(items: DataFrame) -> DataFrame:
    return items.groupBy("source").agg(F.count(F.lit(1)).alias("n_entries"))
