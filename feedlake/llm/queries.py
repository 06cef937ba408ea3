"""Registered queries of the subpackage and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import (
    chat, decontam, langid, license_scan, lm, merkle, mixing, ngram_join, phrases, quality, ring, secret_scan, tokens,
)
from feedlake.llm.scratch import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "llr")


@register("op2_mix_sources", mixing.ORACLE_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "slot")


@register("op3_decontaminate", decontam.ORACLE_SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          table(spark, sf_dir, "benchmark"), keep_text=False)
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item"])))
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents written in the token format to the shared folder and read back."""
    import public_tokenizers

    path = fresh_path(spark, "tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_tokens(spark, path)


@register("op7_token_ids")
def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, table(spark, sf_dir, "documents"))


@register("op9_ngram_jaccard_join", ngram_join.ORACLE_SQL)
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def crc_fold(n: int):
    """crc32 of doc_id's text modulo n; a null doc_id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


@register("op8_lm_scores")
def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.train(docs.filter(crc_fold(5) != 1))
    return lm.score(docs.withColumn("held_out", crc_fold(5) == 1), model).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(crc_fold(5) != 0), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.identify(docs.select("doc_id", "text", (crc_fold(5) == 0).alias("held_out")), model)


@register("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    spelt = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *(of(k).alias(f"n_{k}") for k in secret_scan.KINDS),
                        F.sha2(spelt(F.filter("secrets", lambda s: s["kind"] != "markov")), 256).alias("base_sha256"),
                        spelt(F.col("secrets")).alias("spans"))


@register("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"),
                                                                   x["end"].cast("string"))), ",").alias("licenses"),
        F.coalesce(F.aggregate("licenses", F.lit(0).cast("long"), lambda a, x: a + x["differences"]),
                   F.lit(0)).alias("differences"),
        F.array_max(F.transform("licenses", lambda x: x["saved"])).alias("best_saved"))


#: Tools that the turns of ``conversations`` are read as calls of.
_TURN = {"type": "object", "required": ["text", "turn"], "additionalProperties": False}
_FIELDS = {"turn": {"type": "integer", "minimum": 0}, "after": {"type": "string"}}
TURN_TOOLS = {
    "ask": _TURN | {"properties": _FIELDS | {"text": {"type": "string", "minLength": 2}}},
    "tell": _TURN | {"properties": _FIELDS | {"text": {"type": "string", "minLength": 1, "maxLength": 250}}},
    "open": _TURN | {"properties": _FIELDS | {"text": {"type": "string", "pattern": r"\w"}, "turn": {"const": 0}}},
}


def turn_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns read as tool traffic: a user's (or system's) turn is a call, the assistant's next turn its result.

    A call's id is made of its conversation and turn; later calls need the result two turns before.
    """
    spelt = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    turn = F.col("turn")
    asked = turns.filter("role is distinct from 'assistant'")
    after = F.when(turn >= 2, spelt(turn - 2))
    calls = asked.select(
        "conv_id", turn.alias("pos"), spelt(turn).alias("call_id"),
        F.when(turn == 0, "open").when(F.col("text").endswith("?"), "ask").otherwise("tell").alias("name"),
        F.to_json(F.struct("text", "turn", after.alias("after"))).alias("arguments"),
        F.when(after.isNotNull(), F.array(after)).alias("needs"))
    results = turns.filter("role = 'assistant'").select(
        "conv_id", turn.alias("pos"), spelt(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


@register("op5_chat_tool_calls")
def op5_chat_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = turn_calls(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame([(k, chat.canonical(v)) for k, v in TURN_TOOLS.items()], "name string, schema string")
    return chat.format_calls(calls, results, schemas)


@register("op11_phrase_collocations", phrases.ORACLE_SQL)
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@register("op12_ring_shards")
def op12_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.place(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), F.col("home").alias("home_shard"))


@register("op13_merkle_manifest", merkle.ORACLE_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(merkle.build(table(spark, sf_dir, "documents")))
