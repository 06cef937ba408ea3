"""The command line runs the daily then the weekly job on landed files."""

import glob

from pyspark.sql import functions as F

from feedlake.__main__ import main
from feedlake.session import scratch_path
from feedlake.sources import fixtures as fx


def test_cli_daily_weekly(spark, base):
    feeds = fx.feed_docs(spark, base)
    src = scratch_path(spark, "sources")
    fx.sources_registry(spark, base).coalesce(1).write.option("header", True).csv(src)
    runs = ",".join(str(r.run_ts) for r in fx.entries(spark, base)
                    .select(fx.run_of(F.col("published_at")).alias("run_ts")).distinct().collect())
    ledger, store, out = (scratch_path(spark, n) for n in ("cli-ledger", "cli-store", "cli-out"))
    main(["daily", "--feeds", feeds, "--sources", src, "--ledger", ledger, "--store", store,
          "--out", out, "--runs", runs, "--arrival", "published"])
    assert glob.glob(f"{out}/payloads/run_ts=*/part-*")
    assert spark.read.parquet(ledger).count() > 0
    reports = scratch_path(spark, "cli-reports")
    main(["weekly", "--store", store, "--reports", reports, "--out", out + "-w"])
    assert glob.glob(f"{out}-w/payloads/part-*")
