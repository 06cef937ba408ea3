"""Properties from the survey's test plan."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedlake.operators import weekly as W
from feedlake.operators.ranking import ordinal
from feedlake.session import scratch_path
from feedlake.sources import fixtures as fx
from feedlake.sources import store as ST


def test_week_total_equals_category_sum(spark, base):
    s = fx.store(spark, base)
    tot = {r.week: r.n_kept for r in W.week_totals(s).collect()}
    cats = {r.week: r.n for r in W.category_counts(s).groupBy("week").agg(F.sum("n").alias("n")).collect()}
    assert tot == cats


def test_ledger_is_monotone(spark):
    path = scratch_path(spark, "ledger-mono")
    t = datetime(2026, 1, 1)
    seen = set()
    for day in range(3):
        marks = spark.createDataFrame([(f"h{i}", f"u{day}", t + timedelta(days=day)) for i in range(day, day + 3)],
                                      "hash string, url string, seen_at timestamp_ntz")
        ST.append_ledger(marks, path)
        now = {r.hash: (r.url, r.seen_at) for r in ST.read_ledger(spark, path).collect()}
        assert seen <= set(now)
        # first sighting never changes
        assert now["h2"] == ("u0", t)
        seen = set(now)


rows_strategy = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 10 ** 6)),
                         min_size=1, max_size=300)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, hot=st.integers(0, 3))
def test_ordinal_matches_row_number(spark, rows, hot):
    # make one group hold at least a third of the rows
    data = [(i, g, k, v) for i, (g, k, v) in enumerate(rows)]
    data += [(len(rows) + i, hot, i % 5, i) for i in range(len(rows) // 2 + 1)]
    df = spark.createDataFrame(data, "id long, g int, k int, v long")
    order = [F.col("k").desc(), F.col("v"), F.col("id")]
    got = ordinal(df, ["g"], order, out="pos", num_partitions=7).select("id", "pos")
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order))) \
        .select("id", "pos")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


_WS_CHARS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        　​"
text_strategy = st.text(alphabet=st.sampled_from(list(_WS_CHARS) + list("ab<>/pé😀&;x")),
                        max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(text_strategy, min_size=1, max_size=60))
def test_text_functions_match_python(spark, texts):
    """Brute force: Python's own str/re semantics, which the original used."""
    import re
    from feedlake.functions import text as T
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: (r.c, r.st, r.cl) for r in df.select(
        "i", T.clean_html("s", 20).alias("c"), T.strip_ws("s").alias("st"),
        T.clip_text("s", 10).alias("cl")).collect()}
    for i, t in enumerate(texts):
        clean = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", t)).strip()[:20]
        clip = t if len(t) <= 10 else t[:9] + "…"
        assert got[i] == (clean, t.strip(), clip), repr(t)
