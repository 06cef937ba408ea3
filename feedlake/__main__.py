"""Command line: the daily and weekly jobs over landed files and tables.

    python -m feedlake daily  --feeds DIR --sources FILE.csv --ledger DIR --store DIR
                              --out DIR [--runs TS[,TS...]] [--answers DIR] [--status DIR]
                              [--arrival landed|published] [--hours N] [--journal DIR]
    python -m feedlake weekly --store DIR --reports DIR --out DIR [--weeks W[,W...]]
                              [--recaps DIR] [--archive-base URL]

Runs default to the time at which the job begins (one run). Answer documents
are JSON files with ``run_ts``, ``first_pos`` and ``doc`` fields; weekly answers
have ``week`` and ``doc``. Payloads are written first, as text by run; store and
ledger are committed after that, for the runs that ``--status`` (JSON rows
``run_ts``, ``ok``) reports as published, or all. ``--journal`` writes that commit
ahead, so that the next job completes it if this one is killed. Entries count from the time
their file landed; ``--arrival published`` replays history by publication date.
Files and entries that could not be read go to ``quarantine``.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import functions as F

from feedlake.session import get_session


def _runs(spark, runs: str | None):
    """Run times as fixed values; without any, the time at which the job began."""
    values = ([r.strip() for r in runs.split(",") if r.strip()] if runs
              else [datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")])
    return spark.createDataFrame([(v,) for v in values], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("run_ts"))


def daily(args) -> None:
    from feedlake.plans.daily import run_daily
    from feedlake.sources import feeds as FD
    spark = get_session(master=args.master)
    landed = FD.read_feeds(spark, args.feeds)
    feeds = FD.entries(landed)
    if args.arrival == "published":
        feeds = feeds.drop("fetched_at")
    sources = spark.read.option("header", True).csv(args.sources).select("source", "url", "category")
    runs = _runs(spark, args.runs)

    def stamped(path):
        if not path:
            return None
        df = spark.read.json(path)
        return df.withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz"))

    def publish(payload):
        """The payload files are the publication; --status tells what became of them."""
        (payload.select("run_ts", "payload").write.mode("overwrite")
         .partitionBy("run_ts").text(f"{args.out}/payloads"))
        return stamped(args.status)

    out = run_daily(spark, feeds, sources, runs, args.ledger, args.store,
                    answers=stamped(args.answers), hours=args.hours, publish=publish,
                    journal_path=args.journal)
    out["requests"].write.mode("overwrite").json(f"{args.out}/requests")
    FD.quarantine(landed).write.mode("overwrite").json(f"{args.out}/quarantine/files")
    (out["rejected"].select("source", "file", "entry_pos", "reason", "link", "title")
     .write.mode("overwrite").json(f"{args.out}/quarantine/entries"))


def weekly(args) -> None:
    from feedlake.plans.weekly import run_weekly
    spark = get_session(master=args.master)
    weeks = [w.strip() for w in args.weeks.split(",")] if args.weeks else None
    recaps = spark.read.json(args.recaps) if args.recaps else None
    out = run_weekly(spark, args.store, weeks, recaps, report_path=args.reports,
                     archive_base=args.archive_base)
    out["payload"].select("payload").write.mode("overwrite").text(f"{args.out}/payloads")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="feedlake")
    p.add_argument("--master", help="Spark master; by default what spark-submit says")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--feeds", required=True)
    d.add_argument("--sources", required=True)
    d.add_argument("--ledger", required=True)
    d.add_argument("--store", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--runs")
    d.add_argument("--answers")
    d.add_argument("--status")
    d.add_argument("--arrival", choices=["landed", "published"], default="landed")
    d.add_argument("--hours", type=int, default=24)
    d.add_argument("--journal")
    w = sub.add_parser("weekly")
    w.add_argument("--store", required=True)
    w.add_argument("--reports", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--weeks")
    w.add_argument("--recaps")
    w.add_argument("--archive-base")
    args = p.parse_args(argv)
    {"daily": daily, "weekly": weekly}[args.cmd](args)


if __name__ == "__main__":
    main()
