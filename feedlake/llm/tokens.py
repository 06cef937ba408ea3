"""Token ids of a public tokenizer in a binary file format (see rans.py).

Writing.  Documents are dealt by range of doc_id, so part k's documents come
before part k+1's, and encoded where they lie: a chunk of text that no token
crosses is encoded once per worker and looked up by its hash after that.  Each
document's ids end with ``END_ID``.  A part is cut at document ends into
segments of about ``SEGMENT_TOKENS`` ids; a segment has one frequency table,
which all its blocks share.  A file holds one Parquet row for each segment
(part, first, doc_ids, doc_tokens, payload), since Spark's writers reach any
store; ``payload`` is the segment in the format.

Reading.  Segments are independent; any task decodes any of them, whole or
from a checkpoint (``rans.decode`` with a range).

Edge cases: a null text has no ids of its own, only the end; null doc_ids come
first; rows of equal doc_id are ordered by a hash of the text, then the text;
equal rows are rows of their own; an empty table gives no segments and reads
back as no rows.  Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.llm import rans
from feedlake.llm import words as W

END_ID = 0
SEGMENT_TOKENS = 2_000_000
CACHE_CHUNKS = 1_000_000
SEGMENT = "part int, first long, doc_ids array<long>, doc_tokens array<long>, payload binary"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"

_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True
#: First bytes of code points among which are white space beyond ASCII.
_MAYBE_SPACE = np.zeros(256, dtype=bool)
_MAYBE_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: ASCII white space and controls, which some engines count as such.
_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[:0x21] = True


def _solid(data: np.ndarray) -> np.ndarray:
    """Bytes that end a code point that surely isn't white space."""
    solid = ~_ASCII_SPACE[data]
    solid[1:] &= ~(_CONTINUES[data[1:]] & _MAYBE_SPACE[data[:-1]])
    solid[2:] &= ~(_CONTINUES[data[2:]] & _MAYBE_SPACE[data[:-2]])
    return solid


def chunk_starts(texts: W.Flat) -> np.ndarray:
    """Byte offsets at which byte-level BPE surely begins a new piece.

    Between two code points that aren't white space, a single space begins a
    piece and a single newline is one; no piece crosses these places, and what
    follows is cut the same with or without what came before.
    """
    data, offsets = texts
    n = len(data)
    starts = np.zeros(n + 1, dtype=bool)
    starts[offsets] = True
    edge = starts.copy()
    if n > 2:
        solid = _solid(data)
        opens = ~(_ASCII_SPACE[data] | _MAYBE_SPACE[data])
        inner = np.flatnonzero((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) + 1
        inner = inner[solid[inner - 1] & opens[inner + 1] & ~edge[inner] & ~edge[inner + 1]]
        starts[inner] = True
        starts[inner[data[inner] == 0x0A] + 1] = True
    return np.flatnonzero(starts[:n])


class Encoder:
    """Byte-level BPE over whole texts, with the chunks seen so far."""

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.length = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.length[number] = len(token)  # byte-level: one character for each byte
        self.forget()

    def forget(self) -> None:
        self.hash, self.at = np.empty(0, np.uint64), np.zeros(0, np.int64)
        self.count, self.ids = np.empty(0, np.int32), np.empty(0, np.uint16 if len(self.length) <= 1 << 16 else np.uint32)

    def _learn(self, data: np.ndarray, hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Encode new chunks; those that begin with a space and don't end with one are joined,
        since then each begins a piece."""
        spaced = (data[start] == 0x20) & _solid(data)[end - 1]
        order = np.concatenate([np.flatnonzero(spaced), np.flatnonzero(~spaced)])
        hashes, start, end = hashes[order], start[order], end[order]
        n = int(spaced.sum())
        joined = b"".join(data[a:b].tobytes() for a, b in zip(start[:n].tolist(), end[:n].tolist(), strict=True))
        texts = [joined.decode(), *(data[a:b].tobytes().decode() for a, b in zip(start[n:], end[n:], strict=True))]
        encoded = [np.array(e.ids, dtype=self.ids.dtype)
                   for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        reach = np.cumsum(self.length[encoded[0]])
        first = np.searchsorted(reach, np.cumsum(end[:n] - start[:n]), side="left") + 1
        counts = np.concatenate([np.diff(first, prepend=0) if n else first, [len(e) for e in encoded[1:]]]).astype(np.int32)
        at = len(self.ids) + np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
        self.ids = np.concatenate([self.ids, *encoded])
        merged = np.concatenate([self.hash, hashes])
        order = np.argsort(merged, kind="stable")
        self.hash = merged[order]
        self.at, self.count = np.concatenate([self.at, at])[order], np.concatenate([self.count, counts])[order]

    def encode(self, texts: W.Flat) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by END_ID; ids in each text)."""
        n = len(texts.offsets) - 1
        starts = chunk_starts(texts)
        ends = np.append(starts[1:], len(texts.data))
        distinct, index, inverse = np.unique(W.hash_spans(texts.data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hash) > CACHE_CHUNKS:
            self.forget()
        place = np.searchsorted(self.hash, distinct)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.hash):
            new = self.hash[np.minimum(place, len(self.hash) - 1)] != distinct
        if new.any():
            self._learn(texts.data, distinct[new], starts[index[new]], ends[index[new]])
            place = np.searchsorted(self.hash, distinct)
        place = place[inverse]
        count = self.count[place].astype(np.int64)
        text = np.searchsorted(texts.offsets, starts, side="right") - 1
        per_text = np.bincount(text, weights=count, minlength=n).astype(np.int64) + 1
        out = np.full(int(per_text.sum()), END_ID, dtype=np.uint32)
        before = np.concatenate(([0], np.cumsum(count)[:-1])) if len(count) else np.empty(0, np.int64)
        run = np.arange(int(count.sum()))
        out[run + np.repeat(text, count)] = self.ids[run + np.repeat(self.at[place] - before, count)]
        return out, per_text


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file, loaded once."""
    if (path, special_as_text) not in _encoders:
        _encoders[path, special_as_text] = Encoder(path, special_as_text)
    return _encoders[path, special_as_text]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, special_as_text: bool = False) -> None:
    """Write all ids of ``docs`` (doc_id, text) in ascending doc_id order to ``path``.

    ``tokenizer``: path of a byte-level BPE file, the same on every worker.
    ``special_as_text``: strings of special tokens in a text are ordinary text;
    else they become those tokens, as the library does by itself.
    """
    tie = F.xxhash64("text")
    ordered = (docs.select("doc_id", "text").repartitionByRange("doc_id", tie)
               .sortWithinPartitions("doc_id", tie, "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, first = encoder(tokenizer, special_as_text), TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        doc_ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0

        def segment() -> pa.RecordBatch:
            nonlocal first, held
            joined = np.concatenate(ids)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([pa.concat_arrays(doc_ids).to_pylist()], pa.list_(pa.int64())),
                 pa.array([np.concatenate(counts)], pa.list_(pa.int64())), pa.array([rans.encode(joined)], pa.binary())],
                names=["part", "first", "doc_ids", "doc_tokens", "payload"])
            first += len(joined)
            held = 0
            for kept in (ids, doc_ids, counts):
                kept.clear()
            return row

        for batch in batches:
            for piece in W.slices(batch):
                encoded, per_text = own.encode(W.flat(piece.column("text")))
                ids.append(encoded)
                doc_ids.append(piece.column("doc_id").cast(pa.int64()))
                counts.append(per_text)
                held += len(encoded)
                if held >= SEGMENT_TOKENS:
                    yield segment()
        if held:
            yield segment()

    ordered.mapInArrow(run, SEGMENT).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32: decoded from the files."""
    files = spark.read.schema(SEGMENT).parquet(path)
    totals = files.groupBy("part").agg(F.sum(F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                start = batch.column("start")[row].as_py()
                doc_ids, tokens = (batch.column(c)[row].values for c in ("doc_ids", "doc_tokens"))
                ids = rans.decode(batch.column("payload")[row].as_py()).astype("<u4")
                ends = np.cumsum(tokens.to_numpy())
                if ends[-1] != len(ids):
                    raise ValueError("token segment: its document lengths don't add up to its ids")
                begins = ends - tokens.to_numpy()
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(start + begins), tokens, pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row for each task that wrote, so small enough to send
    return (files.join(F.broadcast(bases), "part").select((F.col("base") + F.col("first")).alias("start"),
                                                          "doc_ids", "doc_tokens", "payload")
            .mapInArrow(run, READ))
