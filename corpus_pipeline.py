"""Corpus pipeline: quality rules, near-duplicate join, decontamination,
mixing to target weights, tokens in the binary format.

Each stage works on all rows that the one before kept.  Stages but the last
return the columns of ``documents``:

1. quality rules: documents that the rules reject go.
2. n-gram Jaccard join: near duplicates are documents whose sets of five-word
   n-grams have a Jaccard similarity of 0.8 or more (the query op9 has its own
   values, 3 and 0.9).  Of each class one document stays, the one with the
   class's smallest doc_id (of rows that repeat it, one for each text); rows with null
   doc_id, and documents without words, stay.
3. benchmark decontamination: documents with an occurrence of a benchmark
   window go.
4. mixing: a document stands as often as the mix takes its words, rounded
   (documents without words once, as they cost nothing).
5. token ids: doc_id, start, n_tokens, ids_crc32 of every row, read back from
   the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import decontam, mixing, ngram_join, quality
from feedlake.llm.queries import encoded, table
from feedlake.llm.scratch import written

#: The near-duplicate stage: words of an n-gram, least similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked by five-word n-grams at 80 % or more; op9's values are its query's only."""
    classes = ngram_join.classes(docs, percent=NEAR_PERCENT, n=NEAR_WORDS).filter("doc_id is not null")
    rows = classes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("c"),
                                         F.max("n_shingles").alias("s"))
    # the rows to take out, so that the join's smaller side holds copies only
    out = written(rows.filter("c <> doc_id or (n > 1 and s > 0)").select("doc_id", (F.col("c") == F.col("doc_id")).alias("one")),
                  "copies")
    kept = docs.join(out, "doc_id", "left_anti")
    if not out.filter("one").isEmpty():
        rest = [c for c in docs.columns if c not in ("doc_id", "text")]
        repeats = docs.join(out.filter("one"), "doc_id", "left_semi").groupBy("doc_id", "text")
        kept = kept.unionByName(repeats.agg(F.min(F.struct(*rest, F.lit(0))).alias("least")).select(
            "doc_id", "text", *(F.col("least")[c].alias(c) for c in rest)))
    return kept.select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.find(docs, table(spark, sf_dir, "benchmark")).filter("n_hit = 0").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.mix(docs).filter("size > 0")
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    # in a source's shuffled order the documents before one place stand once more
    # than those after it, so two numbers and that place say it for all of them
    of_source = taken.withColumns({"mix_times": times, "mix_place": F.struct(*mixing.place())}).groupBy(
        mixing.source_key().alias("mix_source")).agg(
        F.min("mix_times").alias("mix_least"), F.max("mix_times").alias("mix_most"),
        F.max_by("mix_place", F.struct("mix_times", "mix_place")).alias("mix_last"))
    of_source = written(of_source, "times")
    small = of_source.count() <= mixing.BROADCAST_SOURCES
    joined = docs.withColumns({"mix_key": mixing.source_key(), "mix_at": F.struct(*mixing.place())}).join(
        F.broadcast(of_source) if small else of_source, F.col("mix_key") == F.col("mix_source"), "left")
    stands = F.when(~F.coalesce(F.col("text").rlike(mixing.WORD), F.lit(False)), 1).when(
        F.col("mix_at") <= F.col("mix_last"), F.col("mix_most")).otherwise(F.col("mix_least"))
    return (joined.withColumn("mix_stands", stands).filter("mix_stands > 0")
            .withColumn("mix_copy", F.explode(F.sequence(F.lit(1), "mix_stands"))).select(*docs.columns))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(spark, docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_ids),
]

#: No DuckDB form: the trained ratio and the coder have none; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
