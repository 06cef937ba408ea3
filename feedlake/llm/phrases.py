"""Phrase collocations by stripes: each prefix keys a counter of next words.

1. The empty prefix's stripe: words are counted as strings by language.  A word's
   key is a 64-bit hash of both; should two words share one, all is hashed again
   with another seed, so keys stand for words exactly.  Words that are frequent
   enough get numbers, their places in the sorted keys.
2. Stripes.  For a prefix of one, two or three words a task keeps how often each
   word came next.  It hands its stripes on in packed columns of numbers, and
   those of one prefix are merged element by element.  A long stripe is split by
   its next words into SEGMENTS, so that a prefix as frequent as an article is
   many tasks' work.  A phrase counts only if its words do, and longer ones only
   if their pairs do (no count exceeds a part's): the last pass tests that in a
   bitmap of the frequent pairs, whose false hits cost space but change nothing.
3. The merged stripes say all the rest: their entries are the candidates with
   their counts; a prefix's total is its entry in the stripe one word shorter; and
   the largest entries over a phrase's stripe and over those that continue into
   it are the counts that may subsume it.  (A longer phrase further away can't
   subsume it unless one of these does.)

Sorted keys and bitmap lie in the shared folder and are mapped into memory, so
the folder must be mounted (checked).  Shards are set from the number of words,
so a task's stripes stay bounded.

Edge cases: null and empty texts, and pieces without words, count nothing; a
null language is ``und``; ties in score and count are ordered by the phrase's
UTF-8 bytes; repeated rows count as often as they stand; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm import words as W
from feedlake.llm.lm import _mapped, pack, pack_sorted, save, unpack, unpack_sorted
from feedlake.llm.scratch import fresh_path, posix_path, written

MIN_COUNT = 30
SUBSUMED_PERCENT = 80
LONGEST = 4
TOP = 2000
#: Next words' keys are split in so many segments of a stripe.
SEGMENTS = 64
WORDS_PER_SHARD = 4_000_000
FLUSH = 1_000_000
SLICE_BYTES = 4 << 20
#: Words of one file of sorted keys.
FILE_WORDS = 1 << 20
BITS_PER_KEY = 16
PIECE_BITS = 27
U64 = np.uint64

#: ``[.,;:!?\x0A-\x0D]`` end a piece; space and tab only a word.
PIECE_END = W._byte_set((0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x21, 0x21), (0x3F, 0x3F), (0x0A, 0x0D))
WORD_END = PIECE_END | W._byte_set((0x20, 0x20), (0x09, 0x09))
PACKED = "shard int, a binary, b binary, c binary, next binary, n binary"
STRIPE = "prefix array<long>, next array<long>, n array<long>"


class Bitmap(NamedTuple):
    """Files of 2^PIECE_BITS bits at most; a key's place is its highest ``bits`` bits."""

    folder: str
    bits: int

    @property
    def pieces(self) -> int:
        return 1 << max(self.bits - PIECE_BITS, 0)

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> U64(64 - self.bits)
        piece = (place >> U64(PIECE_BITS)).astype(np.int64)
        place = (place & U64((1 << PIECE_BITS) - 1)).astype(np.int64)
        out = np.zeros(len(keys), dtype=bool)
        for p in np.unique(piece).tolist():
            mine = slice(None) if self.pieces == 1 else piece == p
            at = place[mine]
            out[mine] = _mapped(f"{self.folder}/bits-{p}.npy")[at >> 3] >> (at & 7).astype(np.uint8) & 1
        return out


def bitmap(keys: DataFrame) -> Bitmap:
    """Bitmap of ``keys`` (key long), written by one task for each piece."""
    spark = keys.sparkSession
    folder = posix_path(fresh_path(spark, "phrase-bits"))
    os.makedirs(folder)
    out = Bitmap(folder, max(16, (BITS_PER_KEY * keys.count()).bit_length()))

    def piece_file(table: pa.Table) -> pa.Table:
        piece = table.column("piece")[0].as_py()
        own = table.column("key").drop_null().to_numpy().view(U64) >> U64(64 - out.bits)
        at = np.unique(own & U64((1 << PIECE_BITS) - 1)).astype(np.int64)
        bits = np.zeros(1 << min(out.bits, PIECE_BITS), dtype=np.uint8)
        bits[at] = 1
        save(folder, f"bits-{piece}", np.packbits(bits, bitorder="little"))
        return pa.table({"piece": [piece]})

    # a logical shift: keys are unsigned
    piece = F.shiftrightunsigned("key", 64 - (out.bits - PIECE_BITS)) if out.pieces > 1 else F.lit(0).cast("long")
    every = spark.range(out.pieces).select(F.col("id").alias("piece"), F.lit(None).cast("long").alias("key"))
    keys.select(piece.alias("piece"), "key").unionByName(every).groupBy("piece").applyInArrow(
        piece_file, "piece long").agg(F.count("piece")).collect()
    return out


class Numbers(NamedTuple):
    """Files of sorted word keys, by ranges of their highest ``bits`` bits; ``bases``: words before each file."""

    folder: str
    bits: int
    bases: tuple[int, ...]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key from 1, 0 if it has none."""
        out = np.zeros(len(keys), dtype=U64)
        file = (keys >> U64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        for f in np.unique(file).tolist():
            known = _mapped(f"{self.folder}/keys-{f}.npy")
            mine = np.flatnonzero(file == f)
            if len(known):
                at = np.searchsorted(known, keys[mine])
                found = known[np.minimum(at, len(known) - 1)] == keys[mine]
                out[mine[found]] = (at[found] + self.bases[f] + 1).astype(U64)
        return out


def numbered(words: DataFrame) -> tuple[Numbers, DataFrame]:
    """Numbers of ``words`` (lang, word, key, n), and the words with their ``number``."""
    spark = words.sparkSession
    folder = posix_path(fresh_path(spark, "phrase-words"))
    os.makedirs(folder)
    bits = max(0, (words.count() // FILE_WORDS).bit_length())

    def key_file(table: pa.Table) -> pa.Table:
        file = table.column("file")[0].as_py()
        own = table.filter(table.column("key").is_valid())
        keys = own.column("key").to_numpy().view(U64)
        order = np.argsort(keys)
        save(folder, f"keys-{file}", keys[order])
        own = own.take(pa.array(order))
        return own.append_column("place", pa.array(np.arange(len(own))))

    file = F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")
    every = spark.range(1 << bits).select(F.col("id").alias("file"))
    of_file = words.select(file.alias("file"), "lang", "word", "key", "n").unionByName(every, allowMissingColumns=True)
    schema = "file long, lang string, word string, key long, n long"
    placed = written(of_file.groupBy("file").applyInArrow(key_file, f"{schema}, place long"), "phrase-numbers")
    counts = dict(placed.groupBy("file").count().collect())
    bases = tuple(sum(counts.get(i, 0) for i in range(f)) for f in range(1 << bits))
    number = F.element_at(F.array(*(F.lit(x).cast("long") for x in bases)), (F.col("file") + 1).cast("int")) + F.col("place") + 1
    return Numbers(folder, bits, bases), placed.select("lang", "word", "n", number.alias("number"))


class Tokens(NamedTuple):
    own: np.ndarray      # per word, its place in the next three
    words: pa.Array      # distinct (language, word) of a slice
    langs: pa.Array
    keys: np.ndarray
    follows: np.ndarray  # per word, whether the next one stands in the same piece


def tokens(part: pa.RecordBatch, seed: int) -> Tokens:
    import xxhash

    texts = W.flat(part.column("text"))
    data = W.lower_ascii(texts.data)
    words = W.split(W.Flat(data, texts.offsets), WORD_END, hashed=False)
    n = len(words.start)
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(words.end - words.start, out=offsets[1:])
    joined = data[~WORD_END[data]] if len(data) else data
    found = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(joined))).dictionary_encode()
    lang = part.column("lang").cast(pa.string()).fill_null("und").dictionary_encode()
    text = words.text
    size = max(len(found.dictionary), 1)
    code = lang.indices.to_numpy()[text].astype(np.int64) * size + found.indices.to_numpy()
    distinct, own = np.unique(code, return_inverse=True)
    of_lang, of_word = distinct // size, distinct % size
    seeds = [xxhash.xxh3_64_intdigest(x.encode(), seed) for x in lang.dictionary.to_pylist()]
    spelt = found.dictionary.take(pa.array(of_word))
    keys = np.fromiter((xxhash.xxh3_64_intdigest(w, seeds[x]) or 1 for x, w in
                        zip(of_lang.tolist(), spelt.cast(pa.large_binary()).to_pylist(), strict=True)), U64, len(distinct))
    piece = np.cumsum(PIECE_END[data])[words.start] if n else words.start
    follows = np.zeros(n, dtype=bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    return Tokens(own, spelt, lang.dictionary.take(pa.array(of_lang)), keys, follows)


def _words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, limit=SLICE_BYTES):
                t = tokens(part, seed)
                yield pa.RecordBatch.from_arrays(
                    [t.langs, t.words.cast(pa.string()), pa.array(t.keys.view(np.int64)),
                     pa.array(np.bincount(t.own, minlength=len(t.keys)))], names=["lang", "word", "key", "n"])

    return run


def count_words(docs: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, key, n of all words; seed of the keys, which differ from word to word)."""
    seed = 0
    while True:
        counted = docs.select("text", "lang").mapInArrow(_words(seed), "lang string, word string, key long, n long")
        words = written(counted.groupBy("lang", "word", "key").agg(F.sum("n").alias("n")), "phrase-words")
        if words.groupBy("key").count().filter("count > 1").isEmpty():
            return words, seed
        seed += 1


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of two neighbours in the bitmap of pairs."""
    return W.mix(a * U64(0x9E3779B97F4A7C15) + W.mix(b))


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """Where a new tuple begins, in sorted columns."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def merged(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Stripes (prefix columns, next, n) merged element by element, sorted."""
    order = np.lexsort(columns[-2::-1])
    columns = [c[order] for c in columns]
    first = _runs(columns[:-1])
    return [*(c[first] for c in columns[:-1]), np.add.reduceat(columns[-1], first) if len(first) else columns[-1]]


def _counted(own: np.ndarray, number: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    """Stripes of the prefixes of ``length`` words that begin at ``at``; a next word follows each."""
    size = len(number)
    code = own[at]
    for j in range(1, length):
        code = np.unique(code * size + own[at + j], return_inverse=True)[1]
    _, first, n = np.unique(code * size + own[at + length], return_index=True, return_counts=True)
    begin = at[first]
    words = [number[own[begin + j]] if j < length else np.zeros(len(begin), U64) for j in range(3)]
    return [*words, number[own[begin + length]], n.astype(U64)]


def _stripes(seed: int, shards: int, numbers: Numbers, pairs: Bitmap | None):
    """Packed stripes of prefixes of one word, or where the frequent pairs are known, of two and three."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            columns = merged([np.concatenate(c) for c in zip(*held, strict=True)])
            held.clear()
            a, b, c, following, _ = columns
            spread = W.mix(W.mix(W.mix(a) + b) + c + following % U64(SEGMENTS) * U64(0xD6E8FEB86659FD93))
            shard = ((spread >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(1, shards))
            parts = [np.split(x[order], cut) for x in columns]
            has = [s for s in range(shards) if len(parts[0][s])]
            return pa.RecordBatch.from_arrays(
                [pa.array(has, pa.int32()), pa.array([pack_sorted(parts[0][s]) for s in has], pa.binary()),
                 *(pa.array([pack(x[s]) for s in has], pa.binary()) for x in parts[1:])],
                names=["shard", "a", "b", "c", "next", "n"])

        for batch in batches:
            for part in W.slices(batch, limit=SLICE_BYTES):
                t = tokens(part, seed)
                if not len(t.own):
                    continue
                number = numbers.of(t.keys)
                k = number[t.own]
                linked = t.follows.copy()
                linked[:-1] &= (k[1:] > 0) & (k[:-1] > 0)
                at = np.flatnonzero(linked)
                if pairs is None:
                    held.append(_counted(t.own, number, at, 1))
                else:
                    linked[at] = pairs.has(pair(k[at], k[at + 1]))
                    two = linked.copy()
                    two[:-1] &= linked[1:]
                    three = two.copy()
                    three[:-1] &= two[1:]
                    held.append(_counted(t.own, number, np.flatnonzero(two), 2))
                    held.append(_counted(t.own, number, np.flatnonzero(three), 3))
                if sum(len(x[0]) for x in held) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


def _merge(least: int):
    def run(table: pa.Table) -> pa.Table:
        a = [unpack_sorted(x) for x in table.column("a").to_pylist()]
        rest = [[unpack(x) for x in table.column(c).to_pylist()] for c in ("b", "c", "next", "n")]
        columns = merged([np.concatenate(x) for x in (a, *rest)])
        columns = [c[columns[-1] >= U64(least)] for c in columns]
        *prefix, following, n = columns
        first = _runs(prefix)
        rows = []
        cuts = np.append(first, len(n))
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            rows.append(([int(c[begin]) for c in prefix if c[begin]], following[begin:end].tolist(), n[begin:end].tolist()))
        return pa.table([pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in range(3)], names=["prefix", "next", "n"])

    return run


def stripes(docs: DataFrame, numbers: Numbers, seed: int, n_words: int, least: int = MIN_COUNT) -> DataFrame:
    """Segments of the merged stripes: prefix (numbers of 1 to 3 words), next and n of what came ``least`` times."""
    shards = -(-n_words // WORDS_PER_SHARD) or 1
    texts = docs.select("text", "lang")

    def level(pairs: Bitmap | None) -> DataFrame:
        packed = texts.mapInArrow(_stripes(seed, shards, numbers, pairs), PACKED)
        return written(packed.groupBy("shard").applyInArrow(_merge(least), STRIPE), "stripes")

    one = level(None)
    found = one.select(F.col("prefix")[0].alias("a"), F.explode("next").alias("b"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy().view(U64) for c in ("a", "b"))
            yield pa.RecordBatch.from_arrays([pa.array(pair(a, b).view(np.int64))], names=["key"])

    return one.unionByName(level(bitmap(found.mapInArrow(placed, "key long"))))


def collocations(docs: DataFrame, least: int = MIN_COUNT, percent: int = SUBSUMED_PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of ``docs`` (text, lang)."""
    words, seed = count_words(docs)
    n = written(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    numbers, known = numbered(words.filter(F.col("n") >= least))
    held = stripes(docs, numbers, seed, n.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], least)
    candidates = written(held.select("prefix", F.explode(F.arrays_zip("next", "n")).alias("e"))
                         .select(F.concat("prefix", F.array("e.next")).alias("phrase"), F.col("e.n").alias("a")), "candidates")
    totals = known.select(F.array("number").alias("prefix"), F.col("n").alias("total")).unionByName(
        candidates.filter(F.size("phrase") < LONGEST).select(F.col("phrase").alias("prefix"), F.col("a").alias("total")))

    # the longer candidates by one word that hold a phrase: its stripe's largest entry, and of those that end in it
    around = (held.filter("size(prefix) > 1").select(F.col("prefix").alias("phrase"), F.array_max("n").alias("most"))
              .unionByName(candidates.filter("size(phrase) > 2").select(
                  F.expr("slice(phrase, 2, size(phrase) - 1)").alias("phrase"), F.col("a").alias("most")))
              .groupBy("phrase").agg(F.max("most").alias("most")))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    left = candidates.join(around, "phrase", "left").filter(
        F.col("most").isNull() | (wide("most") * 100 < wide("a") * percent)).select("phrase", "a")

    cuts = left.select("phrase", "a", F.explode(F.expr("sequence(1, size(phrase) - 1)")).alias("k"))
    cuts = cuts.select("phrase", "a", "k", F.expr("slice(phrase, 1, k)").alias("head"),
                       F.expr("slice(phrase, k + 1, size(phrase) - k)").alias("tail"))
    cuts = (cuts.join(totals.select(F.col("prefix").alias("head"), F.col("total").alias("l")), "head")
            .join(totals.select(F.col("prefix").alias("tail"), F.col("total").alias("r")), "tail"))
    scored = cuts.withColumn("score", F.expr(
        "(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    best = scored.groupBy("phrase", "a").agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut"))

    places = best.select("phrase", F.posexplode("phrase").alias("at", "number"))
    spelt = (places.join(known.select("number", "word", "lang"), "number")
             .groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"), F.min("lang").alias("lang")))
    rows = best.join(spelt, "phrase").select(
        "lang", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("spelt"), "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "spelt")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", F.col("spelt").alias("phrase"), "a", "l", "r", "n", "score")


#: All phrases of one to four words as strings.
ORACLE_SQL = r"""
with pieces as (
  select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece
  from (select coalesce(lang, 'und') as lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
        from documents)),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
counted as materialized (
  select lang, k, array_to_string(p, ' ') as phrase, any_value(p) as p, count(*) as f
  from (select lang, k, w[i:i + k - 1] as p
        from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
              from worded, (values (1), (2), (3), (4)) lengths(k) where len(w) >= k))
  group by lang, k, phrase),
totals as (select lang, cast(sum(f) as bigint) as n from counted where k = 1 group by lang),
candidate as (select lang, k, phrase, p, f as a from counted where k > 1 and f >= 30),
subsumed as (
  select distinct s.lang, s.phrase
  from (select lang, a, unnest(list_distinct(flatten([[array_to_string(p[i:i + m - 1], ' ') for i in range(1, k - m + 2)]
                                                      for m in range(2, k)]))) as inner_phrase
        from candidate where k > 2) l
  join candidate s on s.lang = l.lang and s.phrase = l.inner_phrase
  where 100 * cast(l.a as hugeint) >= 80 * cast(s.a as hugeint)),
parts as (
  select lang, phrase, a, i as cut, array_to_string(p[1:i], ' ') as head, array_to_string(p[i + 1:k], ' ') as tail
  from (select *, unnest(range(1, k)) as i from candidate c
        where not exists (select 1 from subsumed s where s.lang = c.lang and s.phrase = c.phrase))),
cuts as (
  select c.lang, c.phrase, c.a, cut, h.f as l, t.f as r,
         (2000000 * cast(c.a as hugeint)) // (cast(h.f as hugeint) + t.f) as score
  from parts c join counted h on h.lang = c.lang and h.phrase = c.head
  join counted t on t.lang = c.lang and t.phrase = c.tail),
best as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, n,
       cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000
"""
