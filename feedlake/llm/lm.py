"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Tokens are words and one end for each text; the context of a first token is
the text's beginning.  The model is a folder of sorted arrays in the shared
folder, which workers map into memory (np.load with mmap_mode):

``word-S``    sorted word hashes of hash range S; a word's number is its place
              over all ranges, so numbers are exact and dense
``uses-S``    count of each word of range S
``pair-S``    sorted (context number << 32 | word number) of shard S
``pairs-S``   counts of pair-S in a byte; 255: see ``many-S`` (place, count)
``after-S``   for each word number of range S as a context: tokens, and distinct
              words seen once, twice, three or more times after it; as a word:
              distinct contexts

Counting is one pass for words and one for pairs.  A task counts its own
tokens and hands each shard one packed array, so a word or pair, however
frequent, costs an entry for each task.  Every array grows with the corpus;
nothing is pruned.  What comes to the driver is one row of totals per shard.

Order 2: a third order was not built; its disk use was only estimated (README).

Edge cases: null and empty texts have the end only; unknown words share the
uniform part of the unigrams; a model of no texts gives every token 1/(V+1)
= 1; discounts fall back to 0.5, 1, 1.5 where counts of counts are too few;
repeated rows count and are scored as often as they stand.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm import words as W
from feedlake.llm.scratch import fresh_path, posix_path, written

END = np.uint64(0x9D8A7F6E5C4B3A21)
FLUSH = 2_000_000
MANY = 255
AFTER = np.dtype([("tokens", "<u8"), ("once", "<u4"), ("twice", "<u4"), ("more", "<u4"), ("contexts", "<u4")])
FALLBACK = (0.5, 1.0, 1.5)
PACKED = "shard int, keys binary, counts binary"


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes under zstandard; sorted ones by their gaps first."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.uint64)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def merge(keys: list[np.ndarray], *values: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Distinct sorted keys and the sums of their values."""
    joined = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    if not len(joined):
        return (np.empty(0, np.uint64), *(np.empty(0, np.uint64) for _ in values))
    order = np.argsort(joined, kind="stable")
    joined = joined[order]
    first = np.flatnonzero(np.concatenate(([True], joined[1:] != joined[:-1])))
    return (joined[first], *(np.add.reduceat(np.concatenate(v)[order], first) for v in values))


def by_range(keys: np.ndarray, shards: int) -> list[slice]:
    """Slices of sorted 64-bit hashes by equal ranges."""
    cut = np.searchsorted(keys, np.array([(s << 64) // shards for s in range(1, shards)], dtype=np.uint64))
    edges = [0, *cut.tolist(), len(keys)]
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def by_mix(keys: np.ndarray, shards: int) -> tuple[np.ndarray, list[slice]]:
    """(order, slices): keys[order] is by shard of the mixed key and sorted within it, if keys are sorted."""
    shard = ((W.mix(keys) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    return order, [slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Write under another name first, so that a repeated task leaves a whole file."""
    path = f"{folder}/{name}.npy"
    with open(own := f"{path}.{uuid.uuid4().hex}", "wb") as out:
        np.save(out, values)
    os.replace(own, path)


class Model(NamedTuple):
    """What a worker needs beside the folder; sizes of the order of the number of shards."""

    folder: str
    shards: int
    bases: np.ndarray       # first word number of each range, and the number of words
    tokens: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    rest: float             # weight of the uniform part of the unigrams
    pairs: int              # distinct pairs

    @property
    def words(self) -> int:
        return int(self.bases[-1])

    def array(self, name: str, shard: int) -> np.ndarray:
        return _mapped(f"{self.folder}/{name}-{shard}.npy")

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each sorted distinct hash, -1 if unknown."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        for shard, part in enumerate(by_range(hashes, self.shards)):
            known = self.array("word", shard) if part.stop > part.start else ()
            if len(known):
                at = np.searchsorted(known, hashes[part])
                found = known[np.minimum(at, len(known) - 1)] == hashes[part]
                out[part] = np.where(found, self.bases[shard] + at, -1)
        return out

    def _of(self, name: str, numbers: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Entries of per-word arrays for sorted numbers; negative ones keep what out has."""
        edges = np.searchsorted(numbers, self.bases[:-1])
        edges = np.append(edges, len(numbers))
        for shard in range(self.shards):
            part = slice(int(edges[shard]), int(edges[shard + 1]))
            if part.stop > part.start:
                out[part] = self.array(name, shard)[numbers[part] - self.bases[shard]]
        return out

    def uses(self, numbers: np.ndarray) -> np.ndarray:
        return self._of("uses", numbers, np.zeros(len(numbers), np.uint64))

    def after(self, numbers: np.ndarray) -> np.ndarray:
        return self._of("after", numbers, np.zeros(len(numbers), AFTER))

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pair keys."""
        out = np.zeros(len(keys), dtype=np.int64)
        order, parts = by_mix(keys, self.shards)
        for shard, part in enumerate(parts):
            known = self.array("pair", shard) if part.stop > part.start else ()
            if not len(known):
                continue
            wanted = keys[order[part]]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            count = np.where(known[at] == wanted, self.array("pairs", shard)[at], 0).astype(np.int64)
            if (count == MANY).any():
                place, value = self.array("many", shard)
                high = count == MANY
                count[high] = value[np.searchsorted(place, at[high])]
            out[order[part]] = count
        return out


_maps: dict[str, np.ndarray] = {}


def _mapped(path: str) -> np.ndarray:
    if path not in _maps:
        with open(path, "rb") as f:
            np.lib.format.read_magic(f)
            empty = 0 in np.lib.format.read_array_header_1_0(f)[0]
        _maps[path] = np.load(path) if empty else np.load(path, mmap_mode="r")  # an empty file can't be mapped
    return _maps[path]


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, ends included; index of each text's first token and the total)."""
    texts = W.flat(column)
    words = W.split(W.Flat(W.lower_ascii(texts.data), texts.offsets), W.SPACE)
    n = len(words.first) - 1
    first = words.first + np.arange(n + 1)
    out = np.full(len(words.hash) + n, END)
    out[np.arange(len(words.hash)) + words.text] = words.hash
    return out, first


def _counted(shards: int, keys_of: Callable[[pa.Array], np.ndarray], split) -> Callable:
    """Map function: packed counts of the keys of a task's texts, by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            keys, counts = merge([k for k, _ in held], [c for _, c in held])
            held.clear()
            order, parts = split(keys)
            keys, counts = keys[order], counts[order]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(shards, dtype=np.int32)), pa.array([pack_sorted(keys[p]) for p in parts], pa.binary()),
                 pa.array([pack(counts[p]) for p in parts], pa.binary())], names=["shard", "keys", "counts"])

        for batch in batches:
            for part in W.slices(batch):
                keys, counts = np.unique(keys_of(part.column("text")), return_counts=True)
                held.append((keys, counts.astype(np.uint64)))
                if sum(len(k) for k, _ in held) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


def _of_shard(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    keys, counts = merge([unpack_sorted(k) for k in table.column("keys").to_pylist()],
                         [unpack(c) for c in table.column("counts").to_pylist()])
    return table.column("shard")[0].as_py(), keys, counts


def _histogram(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4, more."""
    return [int(x) for x in np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:]]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts 1 to 4."""
    n1, n2, n3, n4 = n[:4]
    if min(n1, n2, n3) == 0:
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    out = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return out if all(0 < d <= i for i, d in enumerate(out, 1)) else FALLBACK


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    counts = counts.astype(np.float64)
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)], 0)


def train(docs: DataFrame) -> Model:
    """Count the texts of ``docs`` (column text) into a new model folder."""
    spark = docs.sparkSession
    folder = posix_path(fresh_path(spark, "kneser-ney"))
    os.makedirs(folder)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("text")
    every = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(None).cast("binary").alias("keys"),
                                       F.lit(None).cast("binary").alias("counts"))

    def grouped(packed: DataFrame, reduce, schema: str) -> DataFrame:
        return packed.unionByName(every).groupBy("shard").applyInArrow(lambda t: reduce(t.filter(t.column("keys").is_valid()), t), schema)

    def word_file(table: pa.Table, whole: pa.Table) -> pa.Table:
        shard = whole.column("shard")[0].as_py()
        _, keys, counts = _of_shard(table) if len(table) else (0, np.empty(0, np.uint64), np.empty(0, np.uint64))
        save(folder, f"word-{shard}", keys)
        save(folder, f"uses-{shard}", counts)
        return pa.table({"shard": pa.array([shard], pa.int32()), "words": [len(keys)], "tokens": [int(counts.sum())]})

    counted = texts.mapInArrow(_counted(shards, lambda c: _tokens(c)[0], lambda k: (slice(None), by_range(k, shards))), PACKED)
    rows = sorted(grouped(counted, word_file, "shard int, words long, tokens long").collect())
    bases = np.concatenate(([0], np.cumsum([r.words for r in rows]))).astype(np.int64)
    if bases[-1] + 1 >= 1 << 32:
        raise ValueError(f"{bases[-1]} distinct words; pair keys hold 32-bit numbers")
    start = Model(folder, shards, bases, sum(r.tokens for r in rows), FALLBACK, FALLBACK, 1.0, 0)

    def pair_keys(column: pa.Array) -> np.ndarray:
        token, first = _tokens(column)
        distinct, inverse = np.unique(token, return_inverse=True)
        return _pairs(start.numbers(distinct)[inverse], first, start.words)

    def pair_file(table: pa.Table, whole: pa.Table) -> pa.Table:
        shard = whole.column("shard")[0].as_py()
        _, keys, counts = _of_shard(table) if len(table) else (0, np.empty(0, np.uint64), np.empty(0, np.uint64))
        save(folder, f"pair-{shard}", keys)
        save(folder, f"pairs-{shard}", np.minimum(counts, MANY).astype(np.uint8))
        many = np.flatnonzero(counts >= MANY)
        save(folder, f"many-{shard}", np.stack([many.astype(np.uint64), counts[many]]))
        # what each context has after it, and each word before it, for the owners of their numbers
        ones = [(counts == i).astype(np.uint64) for i in (1, 2)] + [(counts > 2).astype(np.uint64)]
        context, *sums = merge([keys >> np.uint64(32)], [counts], *([x] for x in ones))
        word, contexts = merge([keys & np.uint64(0xFFFFFFFF)], [np.ones(len(keys), np.uint64)])
        cut = [np.append(np.searchsorted(x, bases[:-1].astype(np.uint64)), len(x)) for x in (context, word)]
        own = [[slice(int(c[s]), int(c[s + 1])) for s in range(shards)] for c in cut]
        return pa.table({
            "owner": pa.array(np.arange(shards, dtype=np.int32)),
            "contexts": pa.array([pack_sorted(context[p]) for p in own[0]], pa.binary()),
            "sums": pa.array([pack(np.concatenate([x[p] for x in sums])) for p in own[0]], pa.binary()),
            "words": pa.array([pack_sorted(word[p]) for p in own[1]], pa.binary()),
            "seen": pa.array([pack(contexts[p]) for p in own[1]], pa.binary()),
            "histogram": pa.array([_histogram(counts) if s == 0 else [0] * 5 for s in range(shards)], pa.list_(pa.int64()))})

    counted = texts.mapInArrow(_counted(shards, pair_keys, lambda k: by_mix(k, shards)), PACKED)
    parts = written(grouped(counted, pair_file, "owner int, contexts binary, sums binary, words binary, seen binary, "
                                                "histogram array<long>"), "contexts")

    def after_file(table: pa.Table) -> pa.Table:
        shard = table.column("owner")[0].as_py()
        size = int(bases[shard + 1] - bases[shard]) + (shard == shards - 1)  # the last has the texts' beginning too
        out = np.zeros(size, AFTER)
        for context, sums, word, seen in zip(*(table.column(c).to_pylist() for c in ("contexts", "sums", "words", "seen")),
                                             strict=True):
            at = unpack_sorted(context).astype(np.int64) - bases[shard]
            for field, value in zip(("tokens", "once", "twice", "more"), unpack(sums).reshape(4, -1), strict=True):
                out[field][at] += value.astype(out[field].dtype)  # a context stands once in each row
            out["contexts"][unpack_sorted(word).astype(np.int64) - bases[shard]] += unpack(seen).astype(np.uint32)
        save(folder, f"after-{shard}", out)
        return pa.table({"histogram": pa.array([_histogram(out["contexts"])], pa.list_(pa.int64()))})

    places = [F.sum(F.col("histogram")[i]) for i in range(5)]
    word_counts = [int(x or 0) for x in parts.groupBy("owner").applyInArrow(after_file, "histogram array<long>")
                   .agg(*places).first()]
    pair_counts = [int(x or 0) for x in parts.agg(*places).first()]
    pairs = sum(pair_counts)
    d = discounts(word_counts)
    kept = sum(n * x for n, x in zip((*word_counts[:2], sum(word_counts[2:])), d, strict=True))
    return start._replace(pair_discounts=discounts(pair_counts), word_discounts=d, pairs=pairs,
                          rest=kept / pairs if pairs else 1.0)


def _pairs(numbers: np.ndarray, first: np.ndarray, begin: int) -> np.ndarray:
    """Pair key of every token with the one before it."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[first[:-1]] = begin
    return (before.astype(np.uint64) << np.uint64(32)) | numbers.astype(np.uint64)


SCORES = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                       T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])


def score_texts(model: Model, column: pa.Array) -> dict[str, np.ndarray]:
    """Counts and log10 scores of each text."""
    token, first = _tokens(column)
    n, v = len(first) - 1, model.words
    text = np.repeat(np.arange(n), np.diff(first))
    distinct, inverse = np.unique(token, return_inverse=True)
    numbers = model.numbers(distinct)
    order = np.argsort(numbers, kind="stable")
    uses, after = np.zeros(len(distinct), np.uint64), np.zeros(len(distinct), AFTER)
    uses[order], after[order] = model.uses(numbers[order]), model.after(numbers[order])
    base = np.log10((uses + 0.5) / (model.tokens + 0.5 * (v + 1)))
    unigram = _discounted(after["contexts"], model.word_discounts) / max(model.pairs, 1) + model.rest / (v + 1)

    unknown = v + 1  # a number that no pair of the model has
    own = np.where(numbers < 0, unknown, numbers)[inverse]
    keys, pair = np.unique(_pairs(own, first, v), return_inverse=True)
    count = model.pair_counts(keys)
    # statistics of each token's context: the token before, or the beginning
    begin = model.after(np.array([v])) if v else np.zeros(1, AFTER)
    stats = np.concatenate([after, begin])
    place = np.empty(len(token), np.int64)
    place[1:] = inverse[:-1]
    place[first[:-1]] = len(after)
    context = stats[place]
    total = context["tokens"].astype(np.float64)
    d1, d2, d3 = model.pair_discounts
    left = context["once"] * d1 + context["twice"] * d2 + context["more"] * d3
    lower = unigram[inverse]
    seen = np.maximum(total, 1)
    probability = np.where(total > 0, _discounted(count, model.pair_discounts)[pair] / seen + left / seen * lower, lower)
    total_of = lambda x: np.bincount(text, weights=x, minlength=n)
    return {"n_tokens": np.diff(first).astype(np.int64), "n_known": total_of(uses[inverse] > 0).astype(np.int64),
            "base_score": total_of(base[inverse]), "score": total_of(np.log10(probability))}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with n_tokens, n_known, base_score, score (log10; perplexity is 10^(-score/n_tokens))."""
    own = {f.name for f in SCORES}
    carried = [f for f in docs.schema if f.name not in own and f.name != "text"]
    names, out = [f.name for f in carried], T.StructType([*carried, *SCORES.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                got = score_texts(model, part.column("text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *(pa.array(got[f.name]) for f in SCORES)],
                                                 names=[f.name for f in out])

    return docs.select(*names, "text").mapInArrow(run, out)
