"""The pipeline's stages against brute force on the smallest tables and on edge rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from feedlake.llm import mixing, quality
from feedlake.llm.queries import QUERIES, table
from tests_llm_helpers import LOWER, WORD, brute_classes, decon_words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


@pytest.fixture(scope="module")
def documents(spark, base):
    return table(spark, base, "documents").select(COLUMNS)


def test_stage_names_and_columns(spark, base, documents):
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, documents, base).columns == COLUMNS


def test_quality_stage_keeps_what_the_verdict_keeps(spark, base, documents):
    model = quality.train(documents, table(spark, base, "labels"))
    kept = {r.doc_id for r in quality.judge(documents, model).filter("kept").collect()}
    got = P.quality_rules(spark, documents, base).collect()
    assert {r.doc_id for r in got} == kept and len(got) == len(kept)
    labels = {r.doc_id: r for r in table(spark, base, "labels").collect()}
    clean = [i for i, r in labels.items() if r.quality == 1 and not r.toxic]
    long_enough = {r.doc_id for r in quality.judge(documents, model).filter("not base_failed").collect()}
    lost = [i for i in clean if i in long_enough and i not in kept]
    assert len(lost) <= 0.02 * len(clean)


def test_duplicate_stage_keeps_one_of_each_class(spark, base, documents):
    rows = [tuple(r) for r in documents.collect()]
    want = brute_classes([(r[0], r[1]) for r in rows], 80, 5)
    got = P.near_duplicates(spark, documents, base)
    assert {r.doc_id for r in got.collect()} == {i for i, c in want.items() if i == c}
    odd = spark.createDataFrame([(5, "a b c d", "en", "s", 1), (3, "A b c d", "en", "s", 1), (3, "A b c d", "en", "s", 1),
                                 (None, "a b c d", "en", "s", 1), (7, None, "en", "s", 1), (7, None, "en", "s", 1), (8, "", "en", "s", 1)],
                                documents.schema)
    left = [(r.doc_id, r.text) for r in P.near_duplicates(spark, odd, base).collect()]
    assert sorted(left, key=str) == sorted([(3, "A b c d"), (None, "a b c d"), (7, None), (7, None), (8, "")], key=str)


def test_duplicate_stage_links_five_words_at_80_percent(spark, base, documents):
    stage = dict(P.STAGES)["n-gram Jaccard join"]
    rows = [tuple(r) for r in documents.collect()]
    want = brute_classes([(r[0], r[1]) for r in rows], 80, 5)
    assert len(set(want.values())) < len(set(brute_classes([(r[0], r[1]) for r in rows]).values()))
    words = [f"w{i}" for i in range(50)]
    edited = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(words))
    # one edit: 41 of 51 five-word n-grams (45 of 51 of three words, below 90 %); two more: 36 of 56 and 31 of 61
    made = [(4, edited(), "en", "s", 1), (5, edited(25), "en", "s", 1), (6, edited(8, 25, 40), "en", "s", 1)]
    assert sorted(r.doc_id for r in stage(spark, spark.createDataFrame(made, documents.schema), base).collect()) == [4, 6]


def test_decontamination_stage(spark, base, documents):
    patterns = {}
    for r in table(spark, base, "benchmark").collect():
        words = decon_words(r.text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1) if n else ():
            patterns.setdefault(n, set()).add(tuple(words[i:i + n]))
    want = set()
    for r in documents.collect():
        words = decon_words(r.text)
        if not any(tuple(words[i:i + n]) in found for n, found in patterns.items() for i in range(len(words) - n + 1)):
            want.add(r.doc_id)
    got = P.decontaminated(spark, documents, base).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want) and len(want) < documents.count()


def test_mixing_stage_repeats_by_what_the_mix_takes(spark, base, documents):
    extra = spark.createDataFrame([(10_000, None, "en", "src0", 0), (10_001, "", "en", None, 0), (None, "x y z", "en", "src0", 0)],
                                  documents.schema)
    docs = documents.union(extra)
    want = {r.doc_id: 1 if r.size == 0 else int(r.taken / r.size + 0.5) for r in mixing.mix(docs).collect()}
    got = Counter(r.doc_id for r in P.mixed(spark, docs, base).collect())
    assert got == Counter({i: n for i, n in want.items() if n})


def test_stages_on_an_empty_table(spark, base, documents):
    nothing = documents.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, nothing, base).count() == 0


def test_whole_run(spark, base, documents):
    from tokenizers import Tokenizer

    import public_tokenizers

    docs = documents
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, base)
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at, want = 0, []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = own.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, P.run(spark, base).collect())) == sorted(want)


def test_every_dealt_operator_is_registered(spark, base):
    import __spark_entry__ as E

    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
    assert {"pipeline", *QUERIES} <= set(E.queries())


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_secret_scan", "op6_language_id", "op8_lm_scores", "op10_license_scan",
                                  "op7_token_ids"])
def test_one_row_for_each_document(spark, base, documents, name):
    got = QUERIES[name](spark, base)
    assert got.groupBy("doc_id").count().agg(F.max("count"), F.count("*")).first()[:] == (1, documents.count())


def test_base_values_of_queries(spark, base, documents):
    """Contract columns that are plain functions of a text."""
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op8_lm_scores"](spark, base).collect():
        assert r.n_tokens == len(WORD.findall((texts[r.doc_id] or "").translate(LOWER))) + 1
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    for r in QUERIES["op6_language_id"](spark, base).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
