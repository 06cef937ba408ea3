"""Column functions: golden vectors and edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedlake.functions import coerce as C
from feedlake.functions import dates as D
from feedlake.functions import text as T
from feedlake.operators import recency as R


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


WEEK_CASES = [
    (datetime(2026, 5, 27, 14, 30), datetime(2026, 5, 25), datetime(2026, 5, 31, 23, 59, 59), "2026-W22"),
    (datetime(2026, 5, 25, 0, 0), datetime(2026, 5, 25), datetime(2026, 5, 31, 23, 59, 59), "2026-W22"),
    (datetime(2026, 5, 31, 19, 0), datetime(2026, 5, 25), datetime(2026, 5, 31, 23, 59, 59), "2026-W22"),
    (datetime(2026, 1, 5, 10, 0), datetime(2026, 1, 5), datetime(2026, 1, 11, 23, 59, 59), "2026-W02"),
    (datetime(2025, 12, 29, 10, 0), datetime(2025, 12, 29), datetime(2026, 1, 4, 23, 59, 59), "2026-W01"),
    (datetime(2027, 1, 1, 10, 0), datetime(2026, 12, 28), datetime(2027, 1, 3, 23, 59, 59), "2026-W53"),
]


def test_week_helpers(spark):
    df = rows(spark, [(c[0],) for c in WEEK_CASES], "ts timestamp_ntz")
    got = df.select(D.week_start("ts").alias("s"), D.week_end("ts").alias("e"),
                    D.week_label("ts").alias("l"), "ts").orderBy("ts").collect()
    exp = sorted(WEEK_CASES)
    for g, e in zip(got, exp):
        assert (g.s, g.e, g.l) == (e[1], e[2], e[3])


def test_week_number_and_dates(spark):
    df = rows(spark, [(datetime(2026, 5, 7, 9, 5),)], "ts timestamp_ntz")
    r = df.select(D.week_number(F.lit("2026-W07")).alias("n"), D.date_fr_long("ts").alias("l"),
                  D.date_fr_short("ts").alias("s"), D.datetime_fr("ts").alias("d")).first()
    assert (r.n, r.l, r.s, r.d) == ("07", "7 mai 2026", "07/05/2026", "07/05/2026 à 09:05")


def test_recency_window(spark):
    now = datetime(2026, 5, 25, 12, 0)
    ages = {"5h": datetime(2026, 5, 25, 7), "23h": datetime(2026, 5, 24, 13),
            "25h": datetime(2026, 5, 24, 11), "24h": datetime(2026, 5, 24, 12),
            "24h1s": datetime(2026, 5, 24, 11, 59, 59), "future": datetime(2026, 6, 1)}
    df = rows(spark, list(ages.items()), "name string, published_at timestamp_ntz")
    kept = {r.name for r in R.recent(df, F.lit(now).cast("timestamp_ntz")).collect()}
    assert kept == {"5h", "23h", "24h", "future"}
    assert R.recent(df.limit(0), F.lit(now)).count() == 0


@pytest.mark.parametrize("url,ok", [
    ("https://h/x", True), ("HTTPS://h/x", True), ("http://h", False), ("https://", False),
    ("", False), ("not a url", False), (None, False)])
def test_url_gate(spark, url, ok):
    df = rows(spark, [(url,)], "url string")
    assert df.select(T.url_is_secure("url").alias("v")).first().v is ok


@pytest.mark.parametrize("raw,expected", [
    ("a<b>x</b>c", "a x c"),
    ("a  b", "a b"),
    ("a b", "a b"),
    ("a\x1cb", "a b"),
    ("x &amp; y", "x &amp; y"),
    ("keep <p unclosed", "keep <p unclosed"),
    ("  <p> lead </p>  ", "lead"),
])
def test_clean_html(spark, raw, expected):
    df = rows(spark, [(raw,)], "s string")
    assert df.select(T.clean_html("s").alias("v")).first().v == expected


@pytest.mark.parametrize("n", [499, 500, 501])
def test_truncate_code_points(spark, n):
    df = rows(spark, [("é" * n,)], "s string")
    assert len(df.select(T.clean_html("s").alias("v")).first().v) == min(n, 500)


def test_truncate_emoji_at_500(spark):
    s = "a" * 499 + "😀" + "b"
    df = rows(spark, [(s,)], "s string")
    assert df.select(T.clean_html("s").alias("v")).first().v == "a" * 499 + "😀"


def test_summary_fallback(spark):
    df = rows(spark, [("", "desc"), (None, None), ("sum", "desc")], "s string, d string")
    got = [r.v for r in df.select(T.summary_fallback("s", "d").alias("v")).collect()]
    assert got == ["desc", "", "sum"]


def test_required_strip(spark):
    df = rows(spark, [("  https://x  ",)], "s string")
    assert df.select(T.strip_ws("s").alias("v")).first().v == "https://x"


@pytest.mark.parametrize("text,limit,expected", [
    ("abcd", 5, "abcd"), ("abcde", 5, "abcde"), ("abcdef", 5, "abcd…")])
def test_clip(spark, text, limit, expected):
    df = rows(spark, [(text,)], "s string")
    assert df.select(T.clip_text("s", limit).alias("v")).first().v == expected


def test_escape_and_archive_link(spark):
    df = rows(spark, [("a [b] c", "https://h/o/r//", "docs\\reports\\2026-W22.md"),
                      ("x", None, "p")], "t string, b string, p string")
    got = df.select(T.escape_brackets("t").alias("e"), T.archive_link("b", "p").alias("l")).collect()
    assert got[0].e == "a (b) c"
    assert got[0].l == "https://h/o/r/blob/main/docs/reports/2026-W22.md"
    assert got[1].l is None


SCORE = [("0", 1), ("11", 10), ("12.5", 10), ('"9"', 9), ('" 7 "', 7), ('"9.7"', 1),
         ('"abc"', 1), ("null", 1), ("[1]", 1), ("true", 1), (None, 1), ("-3", 1), ("7.9", 7)]
KEPT = [("true", True), ("false", False), ("1", True), ("0", False), ('"false"', True),
        ('""', False), ("[]", False), ("null", False), (None, False), ('{"a":1}', True),
        ("{}", False), ("[0]", True), ("0.0", False), ("2.5", True)]


def _doc(field, txt):
    return "{}" if txt is None else '{"' + field + '": ' + txt + "}"


def test_score_coercion(spark):
    df = rows(spark, [(_doc("score", t), e) for t, e in SCORE], "d string, e int")
    v = F.try_variant_get(F.try_parse_json("d"), "$.score", "variant")
    for r in df.select(C.score_of(v).alias("g"), "e", "d").collect():
        assert r.g == r.e, r.d


def test_kept_truthiness(spark):
    df = rows(spark, [(_doc("kept", t), e) for t, e in KEPT], "d string, e boolean")
    v = F.try_variant_get(F.try_parse_json("d"), "$.kept", "variant")
    for r in df.select(C.truthy(v).alias("g"), "e", "d").collect():
        assert r.g == r.e, r.d


def test_text_of(spark):
    df = rows(spark, [('{"r": " x "}',), ('{"r": null}',), ("{}",)], "d string")
    v = F.try_variant_get(F.try_parse_json("d"), "$.r", "variant")
    assert [r.t for r in df.select(C.text_of(v).alias("t")).collect()] == ["x", "", ""]


def test_allow_lists_and_clamp(spark):
    df = rows(spark, [("critique", "ia", None), ("urgent", "cloud", 42), ("notable", "ai", 0)],
              "s string, c string, n int")
    got = df.select(C.allow_severity("s").alias("s"), C.allow_category("c").alias("c"),
                    C.clamp_score("n").alias("n")).collect()
    assert [tuple(r) for r in got] == [("critical", "ai", 1), ("ignore", "general", 10),
                                       ("notable", "ai", 1)]


def test_feed_date_parse(spark):
    df = rows(spark, [("Mon, 08 Jan 2024 10:00:00 GMT",), ("Mon, 8 Jan 2024 09:30:00 EST",),
                      ("2024-01-08T10:00:00Z",), ("08 Jan 2024 10:00:00 +0200",), ("garbage",)],
              "s string")
    got = [r.v for r in df.select(D.parse_feed_date("s").alias("v")).collect()]
    assert got == [datetime(2024, 1, 8, 10), datetime(2024, 1, 8, 14, 30), datetime(2024, 1, 8, 10),
                   datetime(2024, 1, 8, 8), None]


@pytest.mark.parametrize("raw,expected", [
    ("a b", "a b"), ("a  b", "a b"), ("a\x85b", "a b"), ("a　\n b", "a b"),
    (" a\x1fb ", "a b"), ("a\x0bb", "a b"), ("a​b", "a​b"),
])
def test_clean_html_unicode_space(spark, raw, expected):
    df = rows(spark, [(raw,)], "s string")
    assert df.select(T.clean_html("s").alias("v")).first().v == expected


def test_strip_keeps_inner_unicode_space(spark):
    df = rows(spark, [(" a b\x1c",)], "s string")
    assert df.select(T.strip_ws("s").alias("v")).first().v == "a b"


def test_feed_dates_of_many_shapes(spark):
    from datetime import datetime

    from feedlake.functions.dates import parse_feed_date
    want = datetime(2024, 1, 8, 10, 0, 0)
    texts = {"Mon, 08 Jan 2024 10:00:00 GMT": want, "Monday, 8 January 2024 10:00 UT": want, "8 Jan 24 05:00:00 EST": want,
             "08 Jan 2024 11:00:00 +01:00": want, "08-Jan-2024 11:00:00 +0100": want, "Mon 8 Jan 2024 10:00:00": want,
             "2024-01-08T10:00:00Z": want, "2024-01-08T11:00:00+01:00": want, "2024-01-08 10:00:00": want,
             "8 Jan 99 10:00:00 Z": datetime(1999, 1, 8, 10), "8 Jan 2024 10:00:00 XYZ": None, "soon": None, "": None,
             "32 Jan 2024 10:00:00 GMT": None}
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = {r.t: r.d for r in rows.select("t", parse_feed_date("t").alias("d")).collect()}
    assert got == {**texts, None: None}
