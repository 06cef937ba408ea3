"""Plan shapes the scale design depends on."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from feedlake.operators import ledger as LG
from feedlake.operators import weekly as W
from feedlake.sources import fixtures as fx
from feedlake.sources.tables import materialize


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_limits_before_shuffle(spark, base):
    plan = plan_of(E.queries()["daily_top"](spark, base))
    # partial WindowGroupLimit below the exchange, final one above it
    assert re.search(r"WindowGroupLimit[\s\S]*Exchange[\s\S]*WindowGroupLimit", plan)


def test_range_join_is_an_equi_join(spark, base):
    plan = plan_of(E.queries()["items_per_run"](spark, base))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "__day" in plan


def test_expanded_items_are_not_shuffled_by_day(spark, base):
    """Runs that the planner can't tell to be few (they come from a table that it takes for large) are broadcast all the same."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        for name in ("items_per_run", "items_per_run_fetched"):
            plan = plan_of(E.queries()[name](spark, base))
            assert re.search(r"BroadcastHashJoin \[__day#\d+\]", plan) and "hashpartitioning(__day" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_daily_job_is_not_computed_again_for_each_reader(spark, base):
    """The selection that commit and result read is made of written tables, and their small ones are broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        plan = plan_of(E.queries()["daily_job_digest"](spark, base))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "partitioning(" not in plan and "from_json" not in plan and "parse_json" not in plan


def test_ledger_filtered_by_broadcast_batch_hashes(spark, base):
    plan = plan_of(LG.new_items(fx.verdicts(spark, base), fx.ledger(spark, base)))
    assert re.search(r"BroadcastHashJoin \[hash#\d+\], \[hash#\d+\], LeftSemi", plan)


def test_scan_reads_only_needed_columns(spark, base):
    df = E.queries()["clean_html"](spark, base)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"page_id", "html"}


def test_period_scan_prunes_week_partitions(spark, base):
    store = materialize(fx.store(spark, base), "plan-store", partition_by="week")
    periods = W.periods(fx.verdicts(spark, base)).filter(F.col("week") == "2024-W02")
    plan = plan_of(W.period_scan(store, periods))
    assert re.search(r"PartitionFilters: \[[^\]]*week#\d+ = 2024-W02", plan)


def test_ledger_log_is_read_without_aggregation(spark, base):
    """With the batch's size unknown to the planner: one exchange of hashes, none below an aggregate of the ledger."""
    from feedlake.session import scratch_path
    from feedlake.sources import store as ST
    path = scratch_path(spark, "plan-ledger")
    ST.append_ledger(fx.ledger(spark, base), path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(LG.new_items(fx.verdicts(spark, base), ST.read_ledger_log(spark, path)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "min_by" not in plan and "ReadSchema: struct<hash:string>" in plan


def test_word_rules_join_on_words(spark, base):
    plan = plan_of(E.queries()["keyword_rules"](spark, base))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
