"""Selection, ranking and fallbacks: edge rows and properties."""

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from feedlake.operators import select as sel
from feedlake.operators.ranking import ordinal
from feedlake.sources import fixtures as fx

RUN = datetime(2026, 5, 25, 3)
SCHEMA = "run_ts timestamp_ntz, response_pos int, severity string, score int, kept boolean"


def verdicts(spark, data):
    return spark.createDataFrame([(RUN, *r) for r in data], SCHEMA)


def test_priority_cap_and_overflow(spark):
    v = verdicts(spark, [(1, "critical", 9, True), (2, "important", 9, True),
                         (3, "critical", 7, True), (4, "important", 10, True),
                         (5, "critical", 10, True), (6, "ignore", 10, True),
                         (7, "notable", 3, False)])
    top = [r.response_pos for r in sel.daily_top(v).orderBy("rank").collect()]
    other = [r.response_pos for r in sel.daily_other(v).orderBy("rank").collect()]
    assert top == [5, 1, 3]
    assert other == [4, 2, 6]          # priority overflow, then the kept "ignore"


def test_top_other_partition_kept(spark, base):
    v = fx.daily_verdicts(spark, base)
    top = sel.daily_top(v).select("run_ts", "response_pos")
    other = sel.daily_other(v).select("run_ts", "response_pos")
    kept = v.filter("kept").select("run_ts", "response_pos")
    assert top.groupBy("run_ts").count().agg(F.max("count")).first()[0] <= 3
    union = top.unionByName(other)
    assert union.count() == kept.count()
    assert union.exceptAll(kept).count() == 0 and kept.exceptAll(union).count() == 0


def test_ordinal_equals_row_number_with_hot_group(spark, base):
    ev = spark.read.parquet(f"{base}/events.parquet")
    # one hot group holding every "view"/"click" row plus many small ones
    g = F.when(F.col("event_type").isin("view", "click"), F.lit(-1)).otherwise(F.col("user_id"))
    df = ev.withColumn("g", g)
    order = [F.col("value").desc(), F.col("event_id")]
    got = ordinal(df, ["g"], order, out="pos").select("event_id", "pos")
    w = Window.partitionBy("g").orderBy(*order)
    exp = df.withColumn("pos", F.row_number().over(w)).select("event_id", "pos")
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0


def test_fallback_first_eight(spark):
    items = spark.createDataFrame(
        [(RUN, f"s{i % 3}", i, f"h{i}", "cloud" if i == 0 else "security") for i in range(12)],
        "run_ts timestamp_ntz, source string, entry_pos int, hash string, source_category string")
    out = sel.fallback_digest(items).orderBy("rank").collect()
    assert len(out) == 8
    assert [(r.source, r.entry_pos) for r in out][:3] == [("s0", 0), ("s0", 3), ("s0", 6)]
    assert {r.severity for r in out} == {"notable"} and {r.score for r in out} == {5}
    assert out[0].category == "general"


def test_quota(spark):
    data = [(i, s, 10 - i, True) for i, s in enumerate(
        ["critical"] * 3 + ["important"] * 3 + ["notable"] * 4 + ["ignore"] * 2)]
    v = verdicts(spark, data)
    out = sel.quota_enforced(v).orderBy("rank").collect()
    sev = [r.severity for r in out]
    assert len(out) == 6
    assert sev.count("critical") == 2 and sev.count("important") == 1
    assert sev.count("notable") == 3


def test_ordinal_null_group_is_one_group(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 3), (3, "a", 1), (4, None, 9)],
                               "id int, g string, v int")
    got = {r.id: r.pos for r in ordinal(df, ["g"], ["v"], out="pos").collect()}
    assert got == {2: 1, 1: 2, 4: 3, 3: 1}
