"""Merkle manifest of a dataset as a postorder append log.

A leaf is the SHA-256 of a row's columns; leaves of a language ascend by
doc_id.  While several nodes remain, every two neighbours become their parent
and a lone last one its own; the subroots of the languages likewise give root.

1. Leaves are hashed by Spark and numbered by a range partitioning, so that a
   language of any size is dealt over many tasks.
2. Aligned builders each take 2^BITS leaves and append a node as soon as it is
   complete: a leaf, then the parents it finishes, and at the end those of an
   unfinished last run.  A builder keeps one open node for each level.  Its log
   is one row; the roots of all builders are the leaves of the next layer, up
   to a layer of one builder for each language, then a tree over subroots.
3. In postorder a subtree's nodes stand together and a full subtree of height h
   has 2^(h+1) - 1 of them, so a node's place follows from its level and number
   alone (``place``).  A proof reads its siblings at such places: those below a
   builder's root from its own log, those above joined on once for each builder.

What a task holds is one builder's log (2^BITS leaves); the driver sees the
root and the number of builders.

Edge cases: null columns are hashed as ``-``; null languages are one, the
first; rows with null doc_id come first in their language, and rows of equal
doc_id in order of their leaf's digest; a lone leaf is its language's subroot;
an empty table has no root and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.scratch import written
from feedlake.operators.ranking import ordinal

#: A builder's leaves, as a power of two.
BITS = 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ALONE, LEFT, RIGHT = b"\x00", b"\x01", b"\x02"
SIZE = 32
LOG = "tree string, block long, n int, nodes binary, root binary"


def place(level: int, number: int, leaves: int) -> int:
    """Place in the log of the node ``number`` of a level, of a tree over ``leaves``."""
    end = (number + 1) << level
    if end <= leaves:  # a full subtree, complete with its last leaf
        return 2 * (end - 1) - (end - 1).bit_count() + level
    lowest = (leaves & -leaves).bit_length()  # first level whose last node is not full
    return 2 * leaves - leaves.bit_count() + level - lowest


def parent(*children: bytes) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def append_log(leaves: list[bytes], height: int) -> list[bytes]:
    """Nodes in the order of their completion; the last one is the root at ``height``."""
    log: list[bytes] = []
    open_: dict[int, bytes] = {}
    for j, node in enumerate(leaves):
        log.append(node)
        level = 0
        while j >> level & 1:
            node = parent(open_[level], node)
            log.append(node)
            level += 1
        open_[level] = node
    last = None
    for level in range(height):
        if len(leaves) >> level & 1:
            last = parent(open_[level]) if last is None else parent(open_[level], last)
        elif last is not None:
            last = parent(last)
        else:
            continue
        log.append(last)
    return log


def height_of(n: int, block: int, bits: int) -> int:
    """A first builder that is not full is its tree's only one: its root is the tree's."""
    return (n - 1).bit_length() if block == 0 and n < 1 << bits else bits


def siblings(log: memoryview, number: int, n: int, height: int) -> bytes:
    """Path of a leaf within a log: for each level a byte for the sibling's side, then its digest if there is one."""
    path = []
    for level in range(height):
        other = number >> level ^ 1
        if other << level >= n:
            path.append(ALONE)
            continue
        at = SIZE * place(level, other, n)
        path += [LEFT if other & 1 == 0 else RIGHT, log[at:at + SIZE]]
    return b"".join(path)


def folded(leaf: bytes, path: bytes) -> tuple[bytes, str]:
    """(root that a path leads to, SHA-256 of the path's digests)."""
    seen = hashlib.sha256()
    at = 0
    while at < len(path):
        side = path[at:at + 1]
        at += 1
        if side == ALONE:
            leaf = parent(leaf)
            continue
        other = path[at:at + SIZE]
        at += SIZE
        seen.update(other.hex().encode())
        leaf = parent(other, leaf) if side == LEFT else parent(leaf, other)
    return leaf, seen.hexdigest()


def leaf_of(**changed: Column) -> Column:
    """Digest of a row: each column as ``-`` or its byte count, ``:`` and value."""
    spelt = [changed.get(c, F.col(c)).cast("string") for c in COLUMNS]
    return F.unhex(F.sha2(F.concat(*(
        F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
        for c in spelt)), 256))


def tree_of() -> Column:
    """Order key of a language: null first, then by UTF-8 bytes; never null."""
    return F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "lang"))


class Manifest(NamedTuple):
    """``layers``: the logs of each layer's builders, languages' leaves first; ``top``: those over the subroots."""

    layers: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def _builders(entries: DataFrame, bits: int, extra: str = "") -> DataFrame:
    """Logs of aligned runs of ``entries`` (tree, number, digest, and for the leaves doc_id and tampered)."""
    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("number")
        n, block = len(rows), rows.column("number")[0].as_py() >> bits
        log = append_log(rows.column("digest").to_pylist(), height_of(n, block, bits))
        out = {"tree": [rows.column("tree")[0].as_py()], "block": [block], "n": pa.array([n], pa.int32()),
               "nodes": [b"".join(log)], "root": [log[-1]]}
        if extra:
            out |= {"doc_ids": pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "tampered": pa.array([rows.column("tampered").to_pylist()], pa.list_(pa.binary()))}
        return pa.table(out)

    blocked = entries.withColumn("block", F.shiftright("number", bits))
    return written(blocked.groupBy("tree", "block").applyInArrow(build, LOG + extra), "merkle-log")


def _layers(entries: DataFrame, bits: int, extra: str = "") -> list[DataFrame]:
    layers = [_builders(entries, bits, extra)]
    while (layers[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = layers[-1].select("tree", F.col("block").alias("number"), F.col("root").alias("digest"))
        layers.append(_builders(above, bits))
    return layers


def build(docs: DataFrame, bits: int = BITS) -> Manifest:
    """The logs of ``docs`` (COLUMNS), in the shared folder."""
    tampers = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1)
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree_of().alias("tree"), leaf_of().alias("digest"),
                         F.when(tampers, leaf_of(n_chars=more)).alias("tampered"))
    numbered = ordinal(leaves, ["tree"], ["doc_id", "digest"], out="pos").withColumn("number", F.col("pos") - 1)
    layers = _layers(numbered.select("tree", "number", "digest", "doc_id", "tampered"), bits,
                     ", doc_ids array<long>, tampered array<binary>")
    subroots = layers[-1].select(F.lit("").alias("all"), "tree", "root")
    top = _layers(ordinal(subroots, ["all"], ["tree"], out="pos").select(
        F.col("all").alias("tree"), (F.col("pos") - 1).alias("number"), F.col("root").alias("digest")), bits)
    last = top[-1].select(F.lower(F.hex("root"))).first()
    return Manifest(layers, top, last[0] if last else None)


def _paths(layer: DataFrame, bits: int) -> DataFrame:
    """Path of each entry of a layer within its builder's log."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, n, log in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "n", "nodes")), strict=True):
                paths = [siblings(memoryview(log), i, n, height_of(n, block, bits)) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * n), pa.array([block] * n), pa.array([(block << bits) + i for i in range(n)]),
                     pa.array(paths, pa.binary())], names=["tree", "block", "number", "path"])

    return layer.select("tree", "block", "n", "nodes").mapInArrow(run, "tree string, block long, number long, path binary")


def _above(layers: list[DataFrame], ends: DataFrame, bits: int) -> DataFrame:
    """Path from each builder's root of the lowest layer up; ``ends``: tree, block 0, path beyond the tree's root."""
    path = ends
    for layer in reversed(layers[1:]):
        path = _paths(layer, bits).join(path.withColumnRenamed("path", "rest"), ["tree", "block"]).select(
            "tree", F.col("number").alias("block"), F.concat("path", "rest").alias("path"))
    return path


def proofs(manifest: Manifest, bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each leaf."""
    spark = manifest.layers[0].sparkSession
    root = F.lit(manifest.root).cast("string")
    nothing = spark.createDataFrame([("", 0, b"")], "tree string, block long, path binary")
    beyond = _above(manifest.top, nothing, bits).withColumnRenamed("path", "rest")
    numbers = _paths(manifest.top[0], bits).join(beyond, ["tree", "block"]).select(
        "number", F.concat("path", "rest").alias("path"))
    subroots = manifest.layers[-1].select(F.lit("").alias("all"), "tree", "root")
    ends = written(ordinal(subroots, ["all"], ["tree"], out="pos").withColumn("number", F.col("pos") - 1)
                   .join(numbers, "number").select("tree", F.lower(F.hex("root")).alias("subroot"), "path"), "merkle-ends")
    above = _above(manifest.layers, ends.select("tree", F.lit(0).cast("long").alias("block"), "path"), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("block", "n", "nodes", "doc_ids", "tampered", "path", "subroot")
        for batch in batches:
            for block, n, log, doc_ids, tampered, up, subroot in zip(
                    *(batch.column(c).to_pylist() for c in names), strict=True):
                own, height, rows = memoryview(log), height_of(n, block, bits), []
                for i, changed in enumerate(tampered):
                    at = SIZE * place(0, i, n)
                    leaf = log[at:at + SIZE]
                    reached, digest = folded(leaf if changed is None else changed, siblings(own, i, n, height) + up)
                    rows.append((leaf.hex(), digest, reached.hex()))
                columns = [pa.array(c, pa.string()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), columns[0], pa.array([subroot] * n), *columns[1:]],
                    names=["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])

    logs = manifest.layers[0].join(above, ["tree", "block"]).join(ends.select("tree", "subroot"), "tree")
    found = logs.select("block", "n", "nodes", "doc_ids", "tampered", "path", "subroot").mapInArrow(
        run, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    return found.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                        (F.col("folded_root") == root).alias("verified"))


def _spelt_sql(*columns: str) -> str:
    return " || ".join(f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end" for c in columns)


#: The trees level by level, and every leaf folded with its siblings; crc32 bit by bit.
ORACLE_SQL = rf"""
with recursive hashed as (
  select doc_id, coalesce('=' || lang, '') as tree, sha256({_spelt_sql(*COLUMNS)}) as leaf,
         sha256({_spelt_sql('doc_id', 'source', 'lang', '(n_chars::hugeint + 1)', 'text')}) as tampered,
         xor(list_reduce([4294967295::bigint] || list_transform(range(1, len(doc_id::varchar) + 1),
                                                                lambda i: ascii((doc_id::varchar)[i])::bigint),
                         lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                                  lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 7 = 0 as hit
  from documents),
leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i,
         count(*) over (partition by tree) as m from hashed),
nodes as (
  select tree, 0 as level, i, m, leaf as h from leaves
  union all
  select tree, level + 1, i // 2, (m + 1) // 2, sha256(string_agg(h, '' order by i)) from nodes
  where m > 1 group by tree, level, i // 2, m),
subroots as (
  select tree, h, row_number() over (order by tree) - 1 as i, count(*) over () as m from nodes where m = 1),
tops as (
  select 0 as level, i, m, h from subroots
  union all
  select level + 1, i // 2, (m + 1) // 2, sha256(string_agg(h, '' order by i)) from tops where m > 1 group by level, i // 2, m),
folds as (
  select row_number() over () as row, tree, 0 as level, i, m, case when hit then tampered else leaf end as h, '' as proof, doc_id, leaf
  from leaves
  union all
  select row, f.tree, f.level + 1, f.i // 2, (f.m + 1) // 2,
         sha256(case when f.i % 2 = 1 then s.h || f.h else f.h || coalesce(s.h, '') end), proof || coalesce(s.h, ''), doc_id, leaf
  from folds f left join nodes s on s.tree = f.tree and s.level = f.level and s.i = xor(f.i, 1) where f.m > 1),
beyond as (
  select f.row, f.doc_id, f.leaf, r.h as subroot, 0 as level, r.i, r.m, f.h, f.proof
  from folds f join subroots r on r.tree = f.tree where f.m = 1
  union all
  select row, doc_id, leaf, subroot, f.level + 1, f.i // 2, (f.m + 1) // 2,
         sha256(case when f.i % 2 = 1 then s.h || f.h else f.h || coalesce(s.h, '') end), proof || coalesce(s.h, '')
  from beyond f left join tops s on s.level = f.level and s.i = xor(f.i, 1) where f.m > 1)
select b.doc_id, b.leaf, b.subroot, t.h as root, sha256(b.proof) as proof_sha256, b.h as folded_root, b.h = t.h as verified
from beyond b join (select h from tops where m = 1) t on true
where b.m = 1
"""
