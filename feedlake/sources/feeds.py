"""Feed documents: landed RSS / Atom files, read in one scan for both formats.

A file is one fetch, so it is read whole, as one row (the writers here bound a
file's entries); its entries are cut out and each is parsed by ``from_xml`` with the schema of its format. Parsing
problems never fail a run: an entry that can't be parsed, or what is left of a
file that breaks off in one, is a ``_corrupt_record`` row (PERMISSIVE mode) that
goes to quarantine, while the good entries are kept, as the original reader
keeps a malformed feed's entries when it has any (S3, S4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

#: Names of landed feed files.
FEED_FILES = "*.{xml,txt}"

RSS_ITEM = Ty.StructType([
    Ty.StructField("title", Ty.StringType()),
    Ty.StructField("link", Ty.StringType()),
    Ty.StructField("description", Ty.StringType()),
    Ty.StructField("summary", Ty.StringType()),
    Ty.StructField("pubDate", Ty.StringType()),
    Ty.StructField("updated", Ty.StringType()),
    Ty.StructField("guid", Ty.StringType()),
    Ty.StructField("_corrupt_record", Ty.StringType()),
])

#: An entry of either format, and the beginning of one that may not end.
_ENTRY = r"(?s)<(item|entry)(?=[\s>])(?![^>]*/>).*?</\1\s*>"
_OPEN = r"(?s)<(item|entry)(?=[\s>]|$)(?![^>]*/>).*"

#: Tasks that one source's entries are written by at most.
TASKS_PER_SOURCE = 16
#: Entries of one file at most. A file is read whole, as one row, so it must not grow with the source.
ENTRIES_PER_FILE = 500

_TEXT = Ty.StructType([Ty.StructField("_VALUE", Ty.StringType()),
                       Ty.StructField("_type", Ty.StringType())])
ATOM_ENTRY = Ty.StructType([
    Ty.StructField("title", _TEXT),
    Ty.StructField("link", Ty.ArrayType(Ty.StructType([
        Ty.StructField("_href", Ty.StringType()), Ty.StructField("_rel", Ty.StringType())]))),
    Ty.StructField("summary", _TEXT),
    Ty.StructField("content", _TEXT),
    Ty.StructField("published", Ty.StringType()),
    Ty.StructField("updated", Ty.StringType()),
    Ty.StructField("_corrupt_record", Ty.StringType()),
])


def _source_of_file() -> F.Column:
    """Feed files are landed as ``.../source=<name>/...``."""
    return F.regexp_extract(F.input_file_name(), r"source=([^/]+)/", 1)


def read_feeds(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """RSS items and Atom entries of every landed feed file, one schema.

    ``entry_pos`` is an entry's 1-based place in its file. What follows the
    last whole entry of a file that breaks off is one row of its own.
    """
    reader = spark.readStream if stream else spark.read
    files = (reader.format("text").option("wholetext", "true").option("pathGlobFilter", FEED_FILES)
             .option("recursiveFileLookup", "true").schema("value string").load(path))
    left_over = F.regexp_extract(F.regexp_replace("value", _ENTRY, " "), _OPEN, 0)
    found = files.select(
        F.url_decode(_source_of_file()).alias("source"), F.input_file_name().alias("file"), *_landing(),
        F.regexp_extract_all("value", F.lit(_ENTRY), F.lit(0)).alias("__whole"), left_over.alias("__rest"))
    rest = F.when(F.length("__rest") > 0, F.array("__rest")).otherwise(F.array().cast("array<string>"))
    # the number is taken before: a row of the explode that had the array beside it would carry the whole file
    cut = found.select("source", "file", "fetched_at", F.size("__whole").alias("__n"), F.concat("__whole", rest).alias("__all"))
    rows = cut.select("source", "file", "fetched_at", "__n", F.posexplode("__all").alias("__at", "__xml"))
    whole = F.col("__at") < F.col("__n")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    of = lambda tag, schema: F.from_xml(
        F.when(whole & F.startswith(F.col("__xml"), F.lit(f"<{tag}")), F.col("__xml")), schema, options)
    rows = rows.withColumn("__rss", of("item", RSS_ITEM)).withColumn("__atom", of("entry", ATOM_ENTRY))
    alternate = F.filter("__atom.link", lambda l: l["_rel"].isNull() | (l["_rel"] == "alternate"))
    return rows.select(
        "source", "file",
        F.coalesce("__rss.title", "__atom.title._VALUE").alias("title"),
        F.coalesce("__rss.link", F.get(alternate, 0)["_href"]).alias("link"),
        F.coalesce("__rss.summary", "__atom.summary._VALUE").alias("summary"),
        F.coalesce("__rss.description", "__atom.content._VALUE").alias("description"),
        F.coalesce("__rss.pubDate", "__atom.published").alias("published"),
        F.coalesce("__rss.updated", "__atom.updated").alias("updated"),
        F.when(~whole, F.left("__xml", F.lit(1000))).otherwise(
            F.coalesce("__rss._corrupt_record", "__atom._corrupt_record")).alias("_corrupt_record"),
        "fetched_at", (F.col("__at") + 1).cast("bigint").alias("entry_pos"))


def entries(feeds: DataFrame) -> DataFrame:
    """Parsed entries, with ``entry_pos``."""
    return feeds.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def _landing() -> list[F.Column]:
    """Landing time of the file: a ``fetched=<time>`` folder names
    the time, else the file's own modification time stands."""
    named = F.regexp_extract(F.input_file_name(), r"fetched=([^/]+)/", 1)
    return [F.coalesce(F.try_to_timestamp(F.url_decode(F.nullif(named, F.lit("")))).cast("timestamp_ntz"),
                       F.col("_metadata.file_modification_time").cast("timestamp_ntz")).alias("fetched_at")]


def quarantine(feeds: DataFrame) -> DataFrame:
    """One row per file that had a parse problem, with an excerpt."""
    bad = feeds.filter(F.col("_corrupt_record").isNotNull())
    return (bad.groupBy("source", "file")
            .agg(F.count(F.lit(1)).alias("n_corrupt"),
                 F.count("title").alias("n_partial"),
                 F.substring(F.min("_corrupt_record"), 1, 200).alias("excerpt"))
            .withColumn("reason", F.lit("parse_error")))


def _dealt(out: DataFrame) -> DataFrame:
    """A busy source's entries dealt over several tasks, by all their columns: copies of a link don't pile up in one."""
    return out.repartition("source", F.pmod(F.xxhash64(*out.columns), F.lit(TASKS_PER_SOURCE)))


def write_atom(entries_df: DataFrame, path: str) -> None:
    """Land entries as Atom files, one directory per source: title and
    summary carry a type attribute, the link is an attribute list."""
    out = entries_df.select(
        "source",
        F.struct(F.lit("text").alias("_type"), F.col("title").alias("_VALUE")).alias("title"),
        F.array(F.struct(F.col("link").alias("_href"), F.lit("alternate").alias("_rel")))
        .alias("link"),
        F.struct(F.lit("html").alias("_type"), F.col("summary").alias("_VALUE")).alias("summary"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"))
    (_dealt(out).write.mode("append").format("xml").option("maxRecordsPerFile", ENTRIES_PER_FILE)
     .option("rootTag", "feed").option("rowTag", "entry")
     .partitionBy("source").save(path))


def write_rss(entries_df: DataFrame, path: str) -> None:
    """Land entries as RSS files, one directory per source (test fixtures,
    replays). ``entries_df``: source, title, link, summary, published_at."""
    out = entries_df.select(
        "source", "title", "link", F.col("summary").alias("description"),
        F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("pubDate"))
    (_dealt(out).write.mode("overwrite").format("xml").option("maxRecordsPerFile", ENTRIES_PER_FILE)
     .option("rootTag", "channel").option("rowTag", "item")
     .partitionBy("source").save(path))
    # the XML writer names files part-*.xml
