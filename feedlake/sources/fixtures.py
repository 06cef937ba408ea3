"""Canonical views over the driver tables.

The feeds and model answers the library works on are not in the driver
tables, so each view derives them from a table (pages, events) with plain
column expressions. Work grows with the tables: every view is a projection,
filter or aggregate over a full scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import coerce
from feedlake.functions.text import item_hash
from feedlake.sources.tables import table

HOST_RE = r"^https?://([^/?#]+)"
ORIGIN_RE = r"^(https?://[^/?#]+)"


def _case(col, mapping: list[tuple[object, str]], default: str):
    expr = None
    for key, val in mapping:
        expr = (F.when(col == F.lit(key), F.lit(val)) if expr is None
                else expr.when(col == F.lit(key), F.lit(val)))
    return expr.otherwise(F.lit(default))


def entries(spark: SparkSession, base: str) -> DataFrame:
    """v_entries: parsed feed entries (pages, dated by the event of the same number)."""
    p = table(spark, base, "pages").select("page_id", "url", "html")
    e = table(spark, base, "events").select("event_id", "ts")
    return (p.join(e, p.page_id == e.event_id)
            .select(F.col("page_id").alias("entry_id"),
                    F.regexp_extract("url", HOST_RE, 1).alias("source"),
                    F.col("url").alias("link"),
                    F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
                    F.col("html").alias("summary"),
                    F.col("ts").alias("published_at"),
                    _case(F.col("page_id") % 5, [(0, "security"), (1, "backend"),
                                                 (2, "frontend"), (3, "devops")],
                          "general").alias("source_category")))


def verdicts_raw(spark: SparkSession, base: str) -> DataFrame:
    """v_verdicts_raw: unvalidated scoring rows, one per event."""
    ev = table(spark, base, "events")
    et = F.col("event_type")
    return ev.select(
        F.col("event_id").alias("entry_id"),
        et.alias("source"),
        F.concat(F.lit("https://"), et, F.lit(".example.com/"),
                 F.col("user_id").cast("string"), F.lit("/"),
                 F.get_json_object("props", "$.k")).alias("link"),
        F.concat(et, F.lit(" "), F.col("event_id").cast("string")).alias("title"),
        F.col("ts").alias("published_at"),
        _case(et, [("error", "security"), ("purchase", "backend"), ("click", "frontend"),
                   ("view", "devops")], "general").alias("source_category"),
        _case(et, [("error", "critical"), ("purchase", "important"), ("click", "notable"),
                   ("view", "ignore")], "urgent").alias("raw_severity"),
        F.col("value").alias("raw_score"),
        (F.col("event_id") % 2 == 0).alias("kept"),
        _case(F.col("user_id") % 7, [(0, "security"), (1, "backend"), (2, "frontend"),
                                      (3, "devops"), (4, "ai"), (5, "general")],
              "cloud").alias("raw_category"),
    )


def validate(raw: DataFrame) -> DataFrame:
    """Validation of scoring rows: allow-lists with defaults, score clamp."""
    return raw.select(
        "entry_id", "source", "link", "title", "published_at", "source_category", "kept",
        item_hash(F.col("link")).alias("hash"),
        coerce.allow_severity(F.col("raw_severity")).alias("severity"),
        coerce.allow_category(F.col("raw_category")).alias("category"),
        coerce.clamp_score(F.col("raw_score").cast("int")).alias("score"),
    )


def verdicts(spark: SparkSession, base: str) -> DataFrame:
    """v_verdicts: validated verdicts."""
    return validate(verdicts_raw(spark, base))


LEDGER_CUTOFF = "2024-01-15 00:00:00"


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """v_ledger: hashes processed before the cut-off, first sighting kept."""
    v = verdicts(spark, base)
    return (v.filter(F.col("published_at") < F.lit(LEDGER_CUTOFF).cast("timestamp_ntz"))
            .groupBy("hash")
            .agg(F.min("link").alias("url"), F.min("published_at").alias("seen_at")))


def runs(spark: SparkSession, base: str) -> DataFrame:
    """v_runs: one run per day at 03:00 UTC (the day after each publication day)."""
    v = verdicts(spark, base)
    day = F.col("published_at").cast("date").cast("timestamp_ntz")
    return v.select((day + F.expr("interval 27 hours")).alias("run_ts")).distinct()


def sources_registry(spark: SparkSession, base: str) -> DataFrame:
    """v_sources: source registry derived from page hosts."""
    p = table(spark, base, "pages").select("url")
    host = F.regexp_extract("url", HOST_RE, 1)
    return p.select(
        host.alias("source"),
        F.concat(F.regexp_extract("url", ORIGIN_RE, 1), F.lit("/feed")).alias("url"),
        _case(F.length(host) % 5, [(0, "security"), (1, "backend"), (2, "frontend"),
                                   (3, "devops")], "general").alias("category"),
    ).distinct()


ANSWER_BATCH = 200


def responses(spark: SparkSession, base: str) -> DataFrame:
    """v_responses: model-answer JSON documents, one per (day, batch).

    The items of a day are numbered in answer order and cut into batches of
    at most ``ANSWER_BATCH`` (one request batch gets one answer), so no
    document grows with the data. ``first_pos`` is the answer position of
    the document's first item minus one.
    """
    from feedlake.operators.ranking import ordinal
    r = verdicts_raw(spark, base).withColumn("day", F.col("published_at").cast("date"))
    r = ordinal(r, ["day"], ["entry_id"], out="__pos")
    r = r.withColumn("batch_no", ((F.col("__pos") - 1) / ANSWER_BATCH).cast("int"))
    items = F.transform(
        F.array_sort(F.collect_list(F.struct("__pos", "link", "raw_severity", "raw_score",
                                             "kept", "raw_category"))),
        lambda i: F.struct(item_hash(i["link"]).alias("hash"),
                           i["raw_severity"].alias("severity"),
                           i["raw_score"].alias("score"),
                           i["kept"].alias("kept"),
                           i["raw_category"].alias("category")))
    return (r.groupBy("day", "batch_no")
            .agg(F.to_json(F.struct(
                F.concat(F.lit("day "), F.col("day").cast("string")).alias("headline"),
                items.alias("items"))).alias("doc"))
            .withColumn("first_pos", F.col("batch_no") * ANSWER_BATCH))


def reference_responses(spark: SparkSession, base: str) -> DataFrame:
    """The same answers in the original's schema: French keys and codes."""
    names = {'"items":': '"articles_analyses":', '"headline":': '"tldr":', '"hash":': '"hash_unique":',
             '"severity":': '"criticite":', '"kept":': '"garde":', '"category":': '"categorie":',
             '"critical"': '"critique"', '"notable"': '"interessant"',
             '"security"': '"securite"', '"ai"': '"ia"'}
    doc = F.col("doc")
    for ours, theirs in names.items():
        doc = F.replace(doc, F.lit(ours), F.lit(theirs))
    return responses(spark, base).withColumn("doc", doc)


#: Days of the month whose answers are cut off, and that have no answer at all.
CUT_DAYS, MISSING_DAYS = (7, 21), (14,)


def flawed_responses(spark: SparkSession, base: str) -> DataFrame:
    """Answers by run; those of some days are cut off, those of others missing."""
    docs = responses(spark, base).filter(~F.dayofmonth("day").isin(*MISSING_DAYS))
    return (docs.withColumn("doc", F.when(F.dayofmonth("day").isin(*CUT_DAYS), F.substring("doc", 1, 40))
                            .otherwise(F.col("doc")))
            .withColumn("run_ts", run_of(F.col("day"))))


#: Files that one host's pages are dealt over.
FILES_PER_HOST = 4


def broken_feeds(spark: SparkSession, base: str) -> str:
    """Feed files of all pages, a few for each host; those of hosts whose name
    has an even length break off in the middle of a last entry."""
    from feedlake.session import scratch_path
    path = scratch_path(spark, "broken-feeds")
    pages = table(spark, base, "pages").select(
        F.regexp_extract("url", HOST_RE, 1).alias("source"), (F.col("page_id") % FILES_PER_HOST).alias("file_no"), "page_id")
    line = F.concat(F.lit("<item><title>Page "), F.col("page_id").cast("string"),
                    F.lit("</title><link>https://x.example.org/</link></item>"))
    whole = pages.select("source", "file_no", F.lit(0).alias("last"), line.alias("value"))
    cut = (pages.filter(F.length("source") % 2 == 0).select("source", "file_no").distinct()
           .select("source", "file_no", F.lit(1).alias("last"), F.lit("<item><title>Cut").alias("value")))
    order = ["source", "file_no"]
    (whole.unionByName(cut).repartition(*order).sortWithinPartitions(*order, "last").drop("last")
     .write.partitionBy(*order).text(path))
    return path


def run_of(published_at) -> "F.Column":
    """The daily run that scores an item: 03:00 UTC the morning after."""
    day = published_at.cast("date").cast("timestamp_ntz")
    return day + F.expr("interval 27 hours")


def daily_verdicts(spark: SparkSession, base: str) -> DataFrame:
    """Verdicts keyed by run, with their position in the run's answer."""
    return (verdicts(spark, base)
            .withColumn("run_ts", run_of(F.col("published_at")))
            .withColumn("response_pos", F.col("entry_id")))


def daily_items(spark: SparkSession, base: str) -> DataFrame:
    """Items as scored by each run, in arrival order ``entry_pos``."""
    return (daily_verdicts(spark, base)
            .withColumn("entry_pos", F.col("entry_id"))
            .withColumn("summary", F.concat(F.lit("summary of "), F.col("title"))))


def answers(spark: SparkSession, base: str) -> DataFrame:
    """Parsed and validated answers of every day's answer document."""
    from feedlake.operators import verdicts as V
    docs = responses(spark, base).withColumn("run_ts", run_of(F.col("day")))
    return V.validate(V.parse_documents(docs, "run_ts", offset_col="first_pos"))


def answers_with_errors(spark: SparkSession, base: str) -> DataFrame:
    """Answers where the model altered some hashes (upper case for the
    ``signup`` source): those rows reference no known item."""
    a = answers(spark, base)
    src = verdicts_raw(spark, base).select(
        item_hash(F.col("link")).alias("__h"), F.col("source").alias("__src")).distinct()
    bad = src.filter(F.col("__src") == "signup").select(F.col("__h").alias("hash")).distinct()
    flagged = a.join(bad.withColumn("__bad", F.lit(True)), "hash", "left")
    return (flagged.withColumn("hash", F.when(F.col("__bad"), F.upper("hash"))
                               .otherwise(F.col("hash"))).drop("__bad"))


def run_status(spark: SparkSession, base: str) -> DataFrame:
    """Publication outcome per run: runs on days 6, 12, 18, 24, 30 failed."""
    return runs(spark, base).withColumn("ok", F.dayofmonth("run_ts") % 6 != 0)


def store(spark: SparkSession, base: str) -> DataFrame:
    """Stored kept verdicts with their ISO week (the weekly job's input)."""
    from feedlake.functions.dates import week_label
    return (verdicts(spark, base).filter(F.col("kept"))
            .withColumn("week", week_label(F.col("published_at")))
            .withColumn("reason", F.concat(F.lit("reason "), F.col("entry_id").cast("string")))
            .withColumn("translated_title",
                        F.when(F.col("entry_id") % 3 == 0, F.upper(F.col("title")))
                        .otherwise(F.lit(""))))


UNKNOWN_REF = "not-a-known-hash"


def recap_docs(spark: SparkSession, base: str) -> DataFrame:
    """Weekly model answers: trends text, referenced highlights (the four
    best-scored of the week with an unknown hash in second place) and four
    takeaways (one blank)."""
    return recap_docs_from(store(spark, base))


def recap_docs_from(s: DataFrame) -> DataFrame:
    """Weekly answers built from a given store (see ``recap_docs``)."""
    from feedlake.operators.ranking import top_k
    n = s.groupBy("week").agg(F.count(F.lit(1)).alias("n"))
    best = top_k(s, ["week"], [F.col("score").desc(), F.col("entry_id")], 4, out="r")
    refs = (best.groupBy("week")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "hash"))),
                             lambda x: x["hash"]).alias("best")))
    refs = refs.withColumn("refs", F.concat(F.slice("best", 1, 1), F.array(F.lit(UNKNOWN_REF)),
                                            F.slice("best", 2, 3)))
    j = n.join(refs, "week", "left")
    doc = F.to_json(F.struct(
        F.concat(F.lit("Semaine "), F.col("week"), F.lit(" : "), F.col("n").cast("string"),
                 F.lit(" articles retenus.")).alias("tendances"),
        F.col("refs").alias("top_3_hashes"),
        F.array(F.concat(F.lit(" "), F.col("week"), F.lit(" trend ")), F.lit(""),
                F.concat(F.lit("watch "), F.col("n").cast("string")), F.lit("extra"))
        .alias("a_retenir")))
    return j.select("week", doc.alias("doc"))


# Landed feed files for the XML path: one RSS document per source written by
# Spark from v_entries, plus a cut-off file (good entry, then truncation), a
# file with nothing parseable and an entry without a link.
BROKEN_FEEDS = {
    "source=cutoff.example.org/feed.xml":
        "<channel><item><title>Kept entry</title><link>https://cutoff.example.org/a</link>"
        "<pubDate>Mon, 08 Jan 2024 10:00:00 GMT</pubDate></item>\n<item><title>Cut",
    "source=garbage.example.org/feed.xml": "<channel><item><<<>>> not xml",
    "source=nolink.example.org/feed.xml":
        "<channel><item><title>No link here</title><pubDate>Mon, 08 Jan 2024 10:00:00 GMT"
        "</pubDate></item></channel>",
}


def feed_docs(spark: SparkSession, base: str) -> str:
    """Write the feed files to a fresh folder under the checkpoint folder."""
    from feedlake.session import scratch_path
    from feedlake.sources.feeds import write_atom, write_rss
    path = scratch_path(spark, "feeds")
    e = entries(spark, base)
    # each source publishes one format: RSS when its host name has an even
    # length, Atom otherwise; together they carry every entry
    even = F.length("source") % 2 == 0
    write_rss(e.filter(even), path)
    write_atom(e.filter(~even), path)
    extra = [(k, v) for k, v in BROKEN_FEEDS.items()]
    # small fixed files: written through Hadoop's file system API of the session
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for rel, body in extra:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{rel}")
        fs = p.getFileSystem(conf)
        out = fs.create(p, True)
        out.write(bytearray(body.encode("utf-8")))
        out.close()
    return path


def order_store(spark: SparkSession, base: str) -> DataFrame:
    """A large verdict store: one stored verdict per line item, dated by its
    ship date, with severity from the order priority (orders joined to
    lineitem; about six line items per order, years of weeks)."""
    from feedlake.functions.dates import week_label
    li = table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                              "l_shipdate", "l_linestatus", "l_returnflag")
    o = table(spark, base, "orders").select("o_orderkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return j.select(
        F.col("l_orderkey").alias("entry_id"),
        item_hash(key).alias("hash"),
        F.col("l_shipdate").alias("published_at"),
        (F.col("l_linestatus") == "O").alias("kept"),
        _case(F.substring("o_orderpriority", 1, 1), [("1", "critical"), ("2", "important"),
                                                     ("3", "notable")], "ignore").alias("severity"),
        coerce.clamp_score((F.col("l_quantity") / 5).cast("int")).alias("score"),
        _case(F.col("l_returnflag"), [("R", "security"), ("A", "backend")], "general")
        .alias("category"),
    ).withColumn("week", week_label(F.col("published_at")))
