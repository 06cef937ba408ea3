"""Benchmark decontamination with one Aho-Corasick automaton.

Items (test questions and answers) are lower-cased (A-Z) and split into words;
every run of ``window`` words, or a shorter item whole, is a pattern.  The
automaton's letters are words: each pattern is the sequence of its words'
numbers in the items' vocabulary.  A document is split once, its words are
numbered by a sorted array of word hashes (0: not in the vocabulary), and the
automaton reads the runs of numbered words once.  Every match is confirmed on
the bytes, and word offsets are mapped to code points of the original text.

The automaton is built from a checked amount of item text (``BLOCK_BYTES``).
A larger item table is dealt into blocks by hash, one automaton each; the
blocks are applied one after the other to the same rows, each adding its hits,
so nothing is joined and no item is left out.

Edge cases: a null text has no words; an item without words has no window; a
null item_id is named by the empty string; items that share an id count as
one; a repeated document gives one row each; no items: no hits.  Input columns
named n_words, n_hit or hits are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm import words as W

WINDOW = 10
#: Item text that one automaton holds.
BLOCK_BYTES = 1 << 20
SPAN = T.StructType([T.StructField("item", T.StringType())] + [
    T.StructField(n, T.LongType()) for n in ("first_word", "last_word", "start", "end")])
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                       T.StructField("hits", T.ArrayType(SPAN))])
_SPAN_ARROW = pa.list_(pa.struct([("item", pa.string()), *((n, pa.int64()) for n in
                                                           ("first_word", "last_word", "start", "end"))]))


def _normalised(texts: W.Flat) -> W.Flat:
    return W.Flat(W.lower_ascii(texts.data), texts.offsets)


class Automaton:
    """Patterns of a block of items: vocabulary and word-level automaton."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        import ahocorasick

        texts = _normalised(W.flat(pa.array([text for _, text in items], pa.string())))
        words = W.split(texts, W.NON_ALNUM)
        self.vocabulary, number = np.unique(words.hash, return_inverse=True)
        number = (number + 1).tolist()
        data = texts.data.tobytes()
        found: dict[tuple[int, ...], tuple[bytes, set[str]]] = {}
        for i, (item, _) in enumerate(items):
            first, last = int(words.first[i]), int(words.first[i + 1])
            size = min(window, last - first)
            for at in range(first, last - size + 1) if size else ():
                key = tuple(number[at:at + size])
                spelt = b" ".join(data[words.start[j]:words.end[j]] for j in range(at, at + size))
                found.setdefault(key, (spelt, set()))[1].add(item)
        self.shortest = min(map(len, found), default=0)
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, (spelt, names) in found.items():
            self.trie.add_word(key, (len(key), spelt, sorted(names)))
        if found:
            self.trie.make_automaton()

    def matches(self, texts: W.Flat, words: W.Words) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, last word, items) of each occurrence of a pattern."""
        if not self.shortest or not len(words.hash):
            return
        at = np.searchsorted(self.vocabulary, words.hash)
        known = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == words.hash
        edge = np.zeros(len(known) + 1, dtype=bool)
        edge[words.first] = True
        begin = np.flatnonzero(known & (edge[:-1] | ~np.concatenate(([False], known[:-1]))))
        end = np.flatnonzero(known & (edge[1:] | ~np.concatenate((known[1:], [False])))) + 1
        long = end - begin >= self.shortest
        begin, size = begin[long], (end - begin)[long]
        if not len(begin):
            return
        # runs one after the other, each followed by the number 0, which no pattern has
        offset = np.concatenate(([0], np.cumsum(size + 1)))
        numbers = np.zeros(offset[-1], dtype=np.int64)
        place = np.arange(size.sum()) + np.repeat(offset[:-1] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        word = np.arange(size.sum()) + np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        numbers[place] = at[word] + 1
        origin = np.zeros(offset[-1], dtype=np.int64)
        origin[place] = word
        for last, (length, spelt, names) in self.trie.iter(tuple(numbers.tolist())):
            stop = int(origin[last])
            first = stop - length + 1
            if spelt == b" ".join(texts.data[words.start[j]:words.end[j]].tobytes() for j in range(first, stop + 1)):
                yield first, stop, names


_built: dict[str, Automaton] = {}


def _automaton(key: str, items: Broadcast, window: int) -> Automaton:
    """The block's automaton, built once in each worker process."""
    if key not in _built:
        _built[key] = Automaton(items.value, window)
    return _built[key]


def _merged(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Per item, spans that overlap or touch become one."""
    out: list[tuple[str, int, int]] = []
    for item, first, last in sorted(spans):
        if out and out[-1][0] == item and first <= out[-1][2] + 1:
            out[-1] = (item, out[-1][1], max(last, out[-1][2]))
        else:
            out.append((item, first, last))
    return out


def _covered(spans: list[tuple[int, int]]) -> int:
    total, reach = 0, -1
    for first, last in sorted(spans):
        total += max(0, last - max(first, reach + 1) + 1)
        reach = max(reach, last)
    return total


def _scan(docs: DataFrame, items: list[tuple[str, str]], window: int, last_block: bool, keep_text: bool) -> DataFrame:
    own = {f.name for f in RESULT}
    again = "hits" in docs.columns and "n_hit" in docs.columns
    carried = [f for f in docs.schema if f.name not in own and (f.name != "text" or keep_text or not last_block)]
    names, out = [f.name for f in carried], T.StructType([*carried, *RESULT.fields])
    key, sent = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, sent, window)
        for batch in batches:
            for part in W.slices(batch):
                texts = _normalised(W.flat(part.column("text")))
                words = W.split(texts, W.NON_ALNUM)
                hits: dict[int, list[dict]] = {}
                if again:
                    hits = {i: h for i, h in enumerate(part.column("hits").to_pylist()) if h}
                found: dict[int, list[tuple[str, int, int]]] = {}
                for first, last, matched in automaton.matches(texts, words):
                    doc = int(np.searchsorted(words.first, first, side="right")) - 1
                    base = int(words.first[doc])
                    found.setdefault(doc, []).extend((item, first - base, last - base) for item in matched)
                for doc, spans in found.items():
                    base, offset = int(words.first[doc]), int(texts.offsets[doc])
                    chars = W.code_points(texts.data[offset:texts.offsets[doc + 1]])
                    hits[doc] = hits.get(doc, []) + [
                        {"item": item, "first_word": first, "last_word": last,
                         "start": int(chars[words.start[base + first] - offset]),
                         "end": int(chars[words.end[base + last] - offset])}
                        for item, first, last in _merged(spans)]
                n_hit = np.zeros(len(part), np.int64)
                for doc, spans in hits.items():
                    n_hit[doc] = _covered([(h["first_word"], h["last_word"]) for h in spans])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(words.count.astype(np.int64)), pa.array(n_hit),
                     pa.array([hits.get(i, []) for i in range(len(part))], _SPAN_ARROW)],
                    names=[f.name for f in out])

    return docs.mapInArrow(run, out)


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
         keep_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside any occurrence) and hits (spans by item).

    ``items``: item_id, text.
    """
    docs = docs.drop(*(f.name for f in RESULT))
    named = items.filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    total = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // block_bytes))
    for k in range(n_blocks):
        block = named if n_blocks == 1 else named.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k)
        docs = _scan(docs, [tuple(r) for r in block.collect()], window, k == n_blocks - 1, keep_text)
    return docs


#: Windows by list slices, joined as strings.
ORACLE_SQL = r"""
with item_words as (
  select cast(item_id as varchar) as item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null),
windows as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
  from (select item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from item_words where len(w) > 0)),
doc_words as (
  select row_number() over () as row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
doc_windows as (
  select row, n, i, array_to_string(w[i:i + n - 1], ' ') as win
  from (select row, w, n, unnest(range(1, len(w) - n + 2)) as i
        from doc_words, (select distinct n from windows) where len(w) >= n)),
found as (select d.row, d.i, d.n, x.item from doc_windows d join windows x on x.n = d.n and x.win = d.win),
hit as (select row, count(distinct j) as n_hit from (select row, unnest(range(i, i + n)) as j from found) group by row),
named as (
  select row, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct row, item from found) group by row)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (row) left join named using (row)
"""
