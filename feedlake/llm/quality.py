"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target
and the raw corpus, beside plain counts of words, symbols and repeats.

Method.  Word 1- and 2-grams are hashed into ``BUCKETS`` buckets.  Two
multinomials are counted over them: the raw corpus (every document) and the
trusted target (labelled good documents).  A document's score is the mean over
its n-grams of ``log((target + A) / (raw * T/R + A))``: the additive ``A``
draws rare buckets to 0, the mean makes it independent of length.  A document
is kept when its score reaches a threshold that is fixed before scoring: the
cut that best parts held-out bad from good labelled documents, a lost good one
weighing ``GOOD_WEIGHT`` times a kept bad one.  Every document is compared with
the same number, so the verdict is deterministic.

Labels are read as a bounded sample (``max_labels`` rows, the smallest by a
hash of doc_id), so they can be broadcast; corpus counts cover all documents.

Edge cases: a null text has no words (base_failed, not kept); an empty text
likewise; without labels of both kinds there is no threshold and only the base
rules decide; a repeated doc_id gives one row for each input row; a label row
with null doc_id or null quality is ignored; conflicting labels of a document
count as the worse one.  Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm import words as W

BUCKETS = 1 << 16
ADDITIVE = 5.0
MAX_LABELS = 20_000
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
BINS_PER_UNIT = 64
#: A good document lost counts as so many bad ones kept.
GOOD_WEIGHT = 5
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[0x0A] = True

METRICS = T.StructType([T.StructField(n, T.LongType()) for n in
                        ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
VERDICT = T.StructType([*METRICS.fields, T.StructField("base_failed", T.BooleanType()),
                        T.StructField("llr", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _in_text(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Identity of ``h`` within its text."""
    return W.mix(h ^ W.mix(text.astype(np.uint64) + np.uint64(1)))


def measure(texts: W.Flat, words: W.Words) -> dict[str, np.ndarray]:
    """The five base counts of each text."""
    data, n = texts.data, len(texts.offsets) - 1
    chars = W.code_points(data)
    lines = W.split(texts, NEWLINE)
    worded = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    line_text = lines.text[worded]
    _, kept = np.unique(_in_text(lines.hash[worded], line_text), return_index=True)
    dup_lines = np.bincount(line_text, minlength=n) - np.bincount(line_text[kept], minlength=n)

    h, at = W.windows(words, REPEAT_WINDOW)
    covered = np.zeros(len(words.hash) + 1, dtype=np.int64)
    if len(h):
        key = _in_text(h, words.text[at])
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered += np.bincount(at[twice], minlength=len(covered))
        covered -= np.bincount(at[twice] + REPEAT_WINDOW, minlength=len(covered))
    return {
        "n_words": words.count,
        "word_chars": _per_text(chars[words.end] - chars[words.start], words.first),
        "n_symbols": _per_text(SYMBOLS[data], texts.offsets),
        "n_dup_lines": dup_lines,
        "n_repeat_words": _per_text(np.cumsum(covered[:-1]) > 0, words.first),
    }


def features(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word 1- and 2-gram."""
    pair, at = W.windows(words, 2)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    bucket = np.concatenate([words.hash, pair]) >> shift
    text = words.text
    return bucket.astype(np.int64), np.concatenate([text, text[at]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in W.slices(batch):
            bucket, text = features(W.split(W.flat(part.column("text")), W.SPACE))
            raw += np.bincount(bucket, minlength=BUCKETS)
            good = part.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            trusted += np.bincount(bucket[good[text]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    for i in range(0, len(used), 10_000):
        at = used[i:i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(trusted[at])],
                                         names=["bucket", "raw", "trusted"])


def label_sample(labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """At most ``max_labels`` rows (doc_id, good, held): the smallest by hash of doc_id.

    good: quality 1 and not toxic; bad: quality 0; others are left out.  One in
    four is held out of the counts, for the threshold.
    """
    per_doc = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
               .groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
               .withColumn("good", F.when((F.col("q") == 1) & (F.col("t") == 0), True).when(F.col("q") == 0, False))
               .filter(F.col("good").isNotNull()))
    spread = F.xxhash64("doc_id")
    return (per_doc.orderBy(spread, "doc_id").limit(max_labels)
            .select(F.col("doc_id").alias("label_id"), "good",
                    (F.pmod(F.shiftright(spread, 7), F.lit(4)) == 0).alias("held")))


class Model:
    """Log-likelihood ratio of every bucket, and the threshold."""

    def __init__(self, llr: np.ndarray, threshold: float) -> None:
        self.llr, self.threshold = llr, threshold

    def score(self, words: W.Words) -> np.ndarray:
        """Mean ratio over each text's n-grams; 0 for a text without words."""
        bucket, text = features(words)
        n = len(words.first) - 1
        count = np.bincount(text, minlength=n)
        return np.bincount(text, weights=self.llr[bucket], minlength=n) / np.maximum(count, 1)


def best_cut(scores: list[tuple[float, bool, int]]) -> float:
    """Cut on (bin start, good, count) with the largest rejected share of bad less
    GOOD_WEIGHT times that of good; halfway to the next lower bin; -inf without both kinds."""
    goods, bads = (sum(n for _, g, n in scores if g is kind) for kind in (True, False))
    if not goods or not bads:
        return float("-inf")
    edges = sorted({b for b, _, _ in scores})
    below = {True: 0, False: 0}
    gaps = []
    for b in edges:
        gaps.append((below[False] * goods - GOOD_WEIGHT * below[True] * bads, b))
        for b2, g, n in scores:
            if b2 == b:
                below[g] += n
    best = max(g for g, _ in gaps)
    at = next(i for i, (g, _) in enumerate(gaps) if g == best)
    previous = edges[at - 1] if at else edges[at]
    return (previous + 1 / BINS_PER_UNIT + edges[at]) / 2 if at else edges[at]


def train(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    """Count both multinomials over whole ``docs`` and set the threshold.

    Reads docs once for the counts (65,536 rows come to the driver at any
    size), and once more for the labelled sample's scores.
    """
    sample = label_sample(labels, max_labels).persist()
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"), "left")
    counted = (texts.select("text", F.coalesce(F.col("good") & ~F.col("held"), F.lit(False)).alias("trusted"))
               .mapInArrow(_count, "bucket long, raw long, trusted long")
               .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")))
    raw, trusted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counted.collect():
        raw[row.bucket], trusted[row.bucket] = row.raw, row.trusted
    expected = raw * (trusted.sum() / max(raw.sum(), 1))
    model = Model(np.log((trusted + ADDITIVE) / (expected + ADDITIVE)), float("-inf"))

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                score = model.score(W.split(W.flat(part.column("text")), W.SPACE))
                bins = np.floor(score * BINS_PER_UNIT).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bins), part.column("good")], names=["bin", "good"])

    held = (docs.select("doc_id", "text").filter(F.col("text").isNotNull())
            .join(F.broadcast(sample.filter("held")), F.col("doc_id") == F.col("label_id"))
            .select("text", "good").mapInArrow(calibrate, "bin long, good boolean")
            .groupBy("bin", "good").count().collect())
    sample.unpersist()
    model.threshold = best_cut([(r["bin"] / BINS_PER_UNIT, r["good"], r["count"]) for r in held])
    return model


def judge(docs: DataFrame, model: Model, keep_text: bool = True) -> DataFrame:
    """``docs`` with the base counts, base_failed, llr and kept; one narrow pass."""
    own = {f.name for f in VERDICT}
    carried = [f for f in docs.schema if f.name not in own and (keep_text or f.name != "text")]
    read = docs.select(*[f.name for f in docs.schema if f.name not in own])
    out = T.StructType([*carried, *VERDICT.fields])
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                texts = W.flat(part.column("text"))
                words = W.split(texts, W.SPACE)
                counts = measure(texts, words)
                failed = (counts["n_words"] < MIN_WORDS) | (
                    100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
                score = model.score(words)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), *(pa.array(counts[f.name].astype(np.int64)) for f in METRICS),
                     pa.array(failed), pa.array(score), pa.array(~failed & (score >= model.threshold))],
                    names=[f.name for f in out])

    return read.mapInArrow(run, out)
