"""The weekly job over any set of ISO weeks: store scan (partition pruned),
highlights with fallback, report lines and files, weekly message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators import report as RP
from feedlake.operators import weekly as W
from feedlake.sources import store as ST


def run_weekly(spark: SparkSession, store_path: str, weeks: list[str] | None = None,
               recap_docs: DataFrame | None = None, report_path: str | None = None,
               archive_base: str | None = None) -> dict[str, DataFrame]:
    """Build (and optionally write) the weekly documents. ``recap_docs``:
    (week, doc) model answers; weeks without a usable one fall back."""
    store = ST.read_store(spark, store_path, weeks).filter(F.col("kept"))
    fields, top = W.recap_selection(store, recap_docs)
    lines = RP.weekly_report_lines(store, fields, top)
    if report_path:
        RP.write_weekly_report(lines, report_path)
    payload = RP.recap_payload(store, fields, archive_base=archive_base, top=top)
    return {"store": store, "top": top, "lines": lines, "payload": payload}


def rebuild_late_weeks(spark: SparkSession, store_path: str, late: DataFrame,
                       recap_docs: DataFrame | None = None, report_path: str | None = None
                       ) -> dict[str, DataFrame]:
    """Rebuild the weeks that received late items (T5, Q1): the store is
    semi-joined to the late weeks (partition pruning at run time) and the
    weekly job reruns for those weeks only, overwriting their report files."""
    weeks = late.select("week").distinct()
    store = ST.read_store(spark, store_path).join(weeks, "week", "left_semi").filter(F.col("kept"))
    fields, top = W.recap_selection(store, recap_docs)
    lines = RP.weekly_report_lines(store, fields, top)
    if report_path:
        RP.write_weekly_report(lines, report_path)
    return {"store": store, "top": top, "lines": lines}
