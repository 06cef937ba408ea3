"""Exact n-gram Jaccard join: classes of documents linked at ``percent`` or more.

The defaults (3 words, 90 %) are those of the query op9; the pipeline's stage
gives its own (5 words, 80 %).

1. Sets.  A document's set holds the hashes of its distinct word n-grams.
   Documents with equal sets (size and a 128-bit sum) share a representative.
2. Token counts.  Tokens are counted over all sets by cells, CELLS or more for
   each token, into files of the counts' magnitudes (bit lengths).
3. Rare prefixes.  Two sets that link share ``percent`` of the larger one's tokens
   at least, so by any common order of the tokens the first ``size - needed + 1``
   of both hold a token of both.  The order is by magnitude, rare tokens first, so
   a passage that many documents share is seldom in it; a token that only one set
   has (magnitude 1) is no key, and a set of which all of the prefix is such links
   with nothing.  Tokens that share a cell only move each other in that order.
   Bands of sizes are cut so that two linked sets lie in one band or in
   neighbours; a key is a prefix token with a pair of neighbouring bands.
4. Candidates.  Tasks sort their keys and hand on one document for each, with a
   link to each other one of their own; so a key, however frequent, has one
   entry for each task.  Components of these links hold every linked pair.
5. Signature trees.  Each component's sets are read in blocks of bounded size;
   a tree over two blocks (see sigtree.py) finds the exact links by dual
   traversal.  First, every block meets the first one.  Where that leaves more
   than one class in a component, the documents outside its largest class
   meet all blocks.  So a group of copies costs rows in proportion to its size,
   and pairs are only taken in full among documents that don't hang together.
6. Components of the links found give the classes.

Edge cases: null or empty texts have the empty set and link with nothing; a
text with fewer words than n is one n-gram; rows with null doc_id link with
nothing (component_id null); rows that repeat a doc_id are one node, each with
its own result row; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm import sigtree
from feedlake.llm import words as W
from feedlake.llm.components import components, contracted
from feedlake.llm.lm import _mapped, merge, pack, pack_sorted, save, unpack, unpack_sorted
from feedlake.llm.scratch import fresh_path, posix_path, written

N = 3
PERCENT = 90
BLOCK_DOCS = 64
#: Documents on each side of a unit when what is left over meets all blocks.
WIDE_DOCS = 256
BLOCK_TOKENS = 1_000_000
FLUSH_KEYS = 2_000_000
#: Cells for each token of the corpus, at least; bits of the cells of one file.
CELLS = 4
FILE_BITS = 24
#: Tokens of the corpus for each shard of keys.
TOKENS_PER_SHARD = 4_000_000
#: Set identities that a task remembers, to pass over its copies.
SEEN = 1_000_000


def _sum64(values: np.ndarray, bins: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2^64 of uint64 values by bin; exact."""
    counts = np.bincount(bins, minlength=n)
    if len(counts) and counts.max() >= 1 << 20:
        out = np.zeros(n, dtype=np.uint64)
        np.add.at(out, bins, values)
        return out
    low = np.bincount(bins, weights=(values & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=n)
    high = np.bincount(bins, weights=(values >> np.uint64(32)).astype(np.float64), minlength=n)
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))


class Sets:
    """Distinct n-gram hashes of a run of texts: token, text of each, size of each text's set."""

    def __init__(self, column: pa.Array, n: int) -> None:
        texts = W.flat(column)
        words = W.split(W.Flat(W.lower_ascii(texts.data), texts.offsets), W.SPACE)
        token, at = W.windows(words, n)
        text = words.text[at]
        few = np.flatnonzero((words.count > 0) & (words.count < n))
        if len(few):
            whole = np.array([W.mix(np.array([W.windows(W.Words(words.start, words.end, np.array([0, c]),
                                                                  words.hash[f:f + c]), c)[0][0] ^ np.uint64(c)]))[0]
                              for f, c in zip(words.first[few], words.count[few], strict=True)], dtype=np.uint64)
            token, text = np.concatenate([token, whole]), np.concatenate([text, few])
        _, kept = np.unique(W.mix(token ^ W.mix(text.astype(np.uint64) + np.uint64(1))), return_index=True)
        self.n = len(texts.offsets) - 1
        self.token, self.text = token[kept], text[kept]
        self.size = np.bincount(self.text, minlength=self.n)

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """A 128-bit identity of each set."""
        return (_sum64(W.mix(self.token ^ np.uint64(0xA5A5A5A5A5A5A5A5)), self.text, self.n),
                _sum64(W.mix(self.token * np.uint64(0x9E3779B97F4A7C15)), self.text, self.n))

    def each(self) -> list[np.ndarray]:
        """Sorted tokens of each set."""
        order = np.lexsort((self.token, self.text))
        return np.split(self.token[order], np.cumsum(self.size)[:-1])


class Distinct:
    """Which sets of a run a task has not had yet; it may forget, which only costs space."""

    def __init__(self) -> None:
        self.seen: set[tuple[int, int]] = set()

    def __call__(self, sets: Sets) -> np.ndarray:
        if len(self.seen) > SEEN:
            self.seen.clear()
        new = np.zeros(sets.n, dtype=bool)
        for i, identity in enumerate(zip(*(x.tolist() for x in sets.sums()), strict=True)):
            if identity not in self.seen:
                self.seen.add(identity)
                new[i] = True
        return new


class Counts(NamedTuple):
    """Magnitudes of the cells' counts (a token's cell: its highest ``bits`` bits), four bits each, in files."""

    folder: str
    bits: int

    @property
    def file_bits(self) -> int:
        return min(self.bits, FILE_BITS)

    def of(self, token: np.ndarray) -> np.ndarray:
        cell = token >> np.uint64(64 - self.bits)
        order = np.argsort(cell)
        number = (cell[order] >> np.uint64(self.file_bits)).astype(np.int64)
        place = (cell[order] & np.uint64((1 << self.file_bits) - 1)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
        found = np.zeros(len(number), dtype=np.uint8)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                at = place[a:b]
                found[a:b] = _mapped(f"{self.folder}/counts-{number[a]}.npy")[at >> 1] >> (4 * (at & 1)).astype(np.uint8) & 15
        out = np.empty(len(token), dtype=np.uint8)
        out[order] = found
        return out


class Bands:
    """Size bands, and the keys of sets: tokens of their rare prefixes with pairs of bands."""

    def __init__(self, percent: int, largest: int) -> None:
        self.percent = percent
        bounds = [1]
        while bounds[-1] <= largest:
            bounds.append(100 * bounds[-1] // percent + 1)
        self.bounds = np.array(bounds)

    def keys(self, sets: Sets, chosen: np.ndarray, magnitude: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, text) of the chosen texts; ``magnitude``: of each token's count."""
        order = np.lexsort((sets.token, magnitude, sets.text))
        text = sets.text[order]
        place = np.arange(len(text)) - np.searchsorted(text, np.arange(sets.n))[text]
        prefix = sets.size + (-self.percent * sets.size // 100) + 1  # size less the least overlap, and one
        taken = order[chosen[text] & (place < prefix[text]) & (magnitude[order] > 1)]
        token, text = sets.token[taken], sets.text[taken]
        band = (np.searchsorted(self.bounds, sets.size, side="right") - 1)[text]
        pairs = [W.mix(token + W.mix((band - lower + 2).astype(np.uint64))) for lower in (0, 1)]
        return np.concatenate(pairs), np.concatenate([text, text])


def _identities(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                sets = Sets(part.column("text"), n)
                one, two = sets.sums()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sets.size.astype(np.int64)), pa.array(one.view(np.int64)),
                     pa.array(two.view(np.int64))], names=["doc_id", "n_shingles", "f1", "f2"])

    return run


def _star(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, smallest id of each, and distinct links: smallest id, another id)."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    least = ids[new][np.cumsum(new) - 1]
    far = least != ids
    links = np.unique(np.stack([least[far], ids[far]], axis=1), axis=0) if far.any() else np.empty((0, 2), np.int64)
    return keys[new], ids[new], links[:, 0], links[:, 1]


def _cells(n: int, counts: Counts):
    """A task's cells by file: those of one token, and those of more with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = Distinct()
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            cells, n_tokens = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            number = (cells >> np.uint64(counts.file_bits)).astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(cells) else np.empty(0, np.int64)
            cuts = np.append(first, len(cells))
            rows = [(cells[a:b], n_tokens[a:b], n_tokens[a:b] > 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(number[first]), pa.array([pack_sorted(c[~m]) for c, _, m in rows], pa.binary()),
                 pa.array([pack_sorted(c[m]) for c, _, m in rows], pa.binary()),
                 pa.array([pack(k[m]) for _, k, m in rows], pa.binary())], names=["file", "one", "more", "n"])

        for batch in batches:
            for part in W.slices(batch):
                sets = Sets(part.column("text"), n)
                held.append(sets.token[distinct(sets)[sets.text]] >> np.uint64(64 - counts.bits))
                if sum(map(len, held)) >= FLUSH_KEYS:
                    yield flush()
        if held:
            yield flush()

    return run


def token_counts(docs: DataFrame, n: int, n_tokens: int) -> Counts:
    """Count the tokens of ``docs`` (text) by cells; ``n_tokens``: about as many as there are."""
    spark = docs.sparkSession
    folder = posix_path(fresh_path(spark, "token-counts"))
    os.makedirs(folder)
    counts = Counts(folder, max(16, (CELLS * n_tokens).bit_length()))

    def file_of(table: pa.Table) -> pa.Table:
        number = table.column("file")[0].as_py()
        table = table.filter(table.column("one").is_valid())
        one, more = ([unpack_sorted(x) for x in table.column(c).to_pylist()] for c in ("one", "more"))
        cells, sums = merge([*one, *more], [*(np.ones(len(x), np.uint64) for x in one),
                                            *(unpack(x) for x in table.column("n").to_pylist())])
        magnitude = np.zeros(1 << counts.file_bits, dtype=np.uint8)
        magnitude[(cells & np.uint64((1 << counts.file_bits) - 1)).astype(np.int64)] = np.minimum(
            np.log2(np.maximum(sums, 1).astype(np.float64)).astype(np.int64) + 1, 15)
        save(folder, f"counts-{number}", magnitude[::2] | magnitude[1::2] << np.uint8(4))
        return pa.table({"file": [number]})

    counted = docs.select("text").mapInArrow(_cells(n, counts), "file long, one binary, more binary, n binary")
    nothing = F.lit(None).cast("binary")
    every = spark.range(1 << (counts.bits - counts.file_bits)).select(
        F.col("id").alias("file"), *(nothing.alias(c) for c in ("one", "more", "n")))
    counted.unionByName(every).groupBy("file").applyInArrow(file_of, "file long").agg(F.count("file")).collect()
    return counts


def _keys(n: int, percent: int, largest: int, shards: int, counts: Counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, distinct = Bands(percent, largest), Distinct()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            keys, ids, a, b = _star(np.concatenate([k for k, _ in held]), np.concatenate([i for _, i in held]))
            held.clear()
            cut = np.searchsorted(keys, [np.uint64((s << 64) // shards) for s in range(1, shards)])
            links = np.linspace(0, len(a), shards + 1).astype(np.int64)[1:-1]
            parts = [*(np.split(x, cut) for x in (keys, ids)), *(np.split(x, links) for x in (a, b))]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(shards, dtype=np.int32)),
                 *(pa.array([x.tobytes() for x in column], pa.binary()) for column in parts)],
                names=["shard", "keys", "ids", "a", "b"])

        for batch in batches:
            for part in W.slices(batch):
                sets = Sets(part.column("text"), n)
                ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                chosen = distinct(sets)  # an equal set of this task has the same keys
                key, text = bands.keys(sets, chosen, counts.of(sets.token))
                held.append((key, ids[text]))
                if sum(len(k) for k, _ in held) >= FLUSH_KEYS:
                    yield flush()
        if held:
            yield flush()

    return run


def _links(table: pa.Table) -> pa.Table:
    """Links of one shard of keys and those its tasks had found, as stars."""
    def joined(column: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=kind)

    _, _, a, b = _star(joined("keys", np.uint64), joined("ids", np.int64))
    root, node = contracted(np.concatenate([a, joined("a", np.int64)]), np.concatenate([b, joined("b", np.int64)]))
    return pa.table({"a": root, "b": node})


def _trees(n: int, percent: int):
    """Star links of each unit's classes; units come sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: pa.Table) -> pa.RecordBatch:
            ids = rows.column("doc_id").to_numpy()
            sets = Sets(rows.column("text").combine_chunks(), n).each()
            least = sigtree.classes(sets, percent)
            other = np.flatnonzero(ids[least] != ids)
            return pa.RecordBatch.from_arrays([pa.array(ids[least[other]]), pa.array(ids[other])], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        unit = None
        for batch in batches:
            units = batch.column("unit").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(units[1:] != units[:-1]) + 1).tolist(), len(units)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and units[a] != unit:
                    yield found(pa.Table.from_batches(held))
                    held = []
                unit = units[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def _traversed(texts: DataFrame, units: DataFrame, n: int, percent: int) -> DataFrame:
    """Links found by the trees of ``units`` (doc_id, unit) over ``texts`` (doc_id, text)."""
    rows = texts.join(units, "doc_id").select("unit", "doc_id", "text")
    return written(rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(_trees(n, percent), "a long, b long"),
                   "tree-links")


def classes(docs: DataFrame, percent: int = PERCENT, n: int = N) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id: long, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(docs.mapInArrow(_identities(n), "doc_id long, n_shingles long, f1 long, f2 long"), "sets")
    real = sets.filter("n_shingles > 0 and doc_id is not null")
    same = written(real.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep")), "same")
    largest = same.agg(F.coalesce(F.max("n_shingles"), F.lit(1))).first()[0]

    n_tokens = same.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    shards = max(1, -(-n_tokens // TOKENS_PER_SHARD))
    known = docs.filter("doc_id is not null")
    counts = token_counts(known, n, n_tokens)
    packed = known.mapInArrow(
        _keys(n, percent, largest, shards, counts), "shard int, keys binary, ids binary, a binary, b binary")
    near = written(packed.groupBy("shard").applyInArrow(_links, "a long, b long"), "near")
    # links of repeated doc_ids and of equal sets, then one node for each set
    repeated = written(real.groupBy("doc_id").agg(F.count_distinct("n_shingles", "f1", "f2").alias("k")).filter("k > 1"),
                       "repeated")
    any_repeated = not repeated.isEmpty()
    reps = real.join(same, ["n_shingles", "f1", "f2"]).select("doc_id", "rep")
    if not any_repeated:  # else a node may stand for its own set and for another's
        reps = reps.filter("doc_id <> rep")
    reps = written(reps.distinct(), "reps")
    sizes = same.groupBy("rep").agg(F.max("n_shingles").alias("n_shingles"))
    for side in ("a", "b"):
        near = (near.join(reps.select(F.col("doc_id").alias(side), F.col("rep").alias("r")), side, "left")
                .withColumn(side, F.coalesce("r", side)).drop("r"))
    groups = written(components(near.filter("a <> b").distinct()).join(sizes, F.col("node") == F.col("rep"))
                     .select("node", "component", "n_shingles"), "groups")

    total = (groups.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("tokens"))
             .select("component", *(F.ceil(F.greatest(F.col("n") / size, F.col("tokens") / BLOCK_TOKENS)).cast("long").alias(name)
                                    for name, size in (("blocks", BLOCK_DOCS), ("wide", WIDE_DOCS)))))
    total = written(total, "blocks")
    blocked = (groups.join(total, "component")
               .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    blocked = written(blocked, "blocked")
    texts = written(docs.filter("text is not null").join(blocked.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"),
                    "texts")
    meet = F.when((F.col("block") > 0) | (F.col("blocks") == 1), F.array("block")) \
        .otherwise(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1))
    units = blocked.select(F.col("node").alias("doc_id"), "component", F.explode(meet).alias("block"))
    links = _traversed(texts, units.select("doc_id", F.xxhash64("component", "block").alias("unit")), n, percent)
    found = components(links)

    split = blocked.filter("blocks > 1")
    if not split.isEmpty():
        classed = written(split.join(found.select("node", F.col("component").alias("class")), "node", "left")
                          .withColumn("class", F.coalesce("class", "node")), "classed")
        members = classed.groupBy("component", "class").agg(F.count(F.lit(1)).alias("n"))
        main = members.groupBy("component").agg(F.max_by("class", F.struct("n", "class")).alias("main"),
                                                F.sum("n").alias("all"), F.max("n").alias("most"))
        open_ = written(main.filter("all > most").withColumn("turns", F.ceil((F.col("all") - F.col("most")) / WIDE_DOCS)
                                                             .cast("long")), "open")
        if not open_.isEmpty():
            rest = classed.join(open_, "component")
            turn = F.pmod(F.xxhash64("node", F.lit(1)), F.col("turns"))
            left = rest.filter("class <> main").select(
                "node", "component", turn.alias("turn"),
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("wide") - 1)).alias("block"))
            right = rest.select("node", "component",
                                F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)).alias("turn"),
                                F.pmod(F.xxhash64("node", F.lit(2)), F.col("wide")).alias("block"))
            again = left.unionByName(right).distinct().select(
                F.col("node").alias("doc_id"), F.xxhash64("component", "turn", "block").alias("unit"))
            found = components(links.union(_traversed(texts, again, n, percent)))

    named = same.join(found.withColumnRenamed("component", "class"), F.col("rep") == F.col("node"), "left").select(
        "n_shingles", "f1", "f2", F.coalesce("class", "rep").alias("component_id"))
    # texts of a repeated doc_id are one node: its classes are joined too
    if any_repeated:
        own = real.join(repeated, "doc_id", "left_semi").join(named, ["n_shingles", "f1", "f2"])
        merged = components(own.select(F.col("component_id").alias("a"), F.col("doc_id").alias("b"))
                            .union(own.select("component_id", "component_id"))).select("node", F.col("component").alias("m"))
        named = named.join(merged, F.col("component_id") == F.col("node"), "left").withColumn(
            "component_id", F.coalesce("m", "component_id")).drop("node", "m")
    named = written(named, "named")
    return (sets.withColumn("known", F.col("n_shingles") > 0)
            .join(named.withColumn("known", F.lit(True)), ["n_shingles", "f1", "f2", "known"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


#: Pairs by common shingles, links, then the smallest doc_id that links reach.
ORACLE_SQL = r"""
with recursive doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from doc_words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as common
  from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 90 * (x.n + y.n - common)),
reach as (
  select doc_id as node, doc_id as found from sizes
  union
  select links.b, found from reach join links on links.a = reach.node)
select d.doc_id, cast(coalesce(s.n, 0) as bigint) as n_shingles, coalesce(r.component_id, d.doc_id) as component_id
from doc_words d left join sizes s using (doc_id)
left join (select node as doc_id, min(found) as component_id from reach group by node) r using (doc_id)
"""
