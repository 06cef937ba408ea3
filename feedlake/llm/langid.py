"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary (a sentencepiece model file)
that are lower case and hold no ASCII beyond letters, with one piece for each
byte, so every word has a segmentation.  A word's probability in a language is
the sum over all its segmentations of the product of piece probabilities (the
forward algorithm); a text's is the product over its words.

Training is one step of expectation maximisation from equal piece
probabilities: the expected number of uses of each piece in each word, over
all its segmentations, summed by language, mixed with ``UNIFORM`` equal parts.

Words are maximal runs of bytes that are not ASCII other than letters, after
Unicode lower-casing.  Each distinct word of a run of texts is segmented once,
as a whole; those of more than ``LONG_BYTES`` bytes in the log domain.

Edge cases: a null text or one without a letter is ``und`` with score 0, as is
every text where nothing was learned; equal likelihoods give the first language
by code point; rows without language or text teach nothing; repeated rows count
as often as they stand.  At most ``MAX_LANGS`` languages are learned, checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm import words as W

#: Share of each language's probability that all pieces have in equal parts.
UNIFORM = 1e-3
#: Weights are multiplied by this for each byte while summing, against underflow in long words.
PER_BYTE = 1e3
MAX_LANGS = 256
#: Words of more bytes are summed as logarithms, in tables of mixed lengths.
LONG_BYTES = 48
#: Places of long words whose pieces are held at once.
SEGMENT = 256
CACHE_WORDS = 500_000
UNDETERMINED = "und"
#: Elements of one table of partial probabilities.
TABLE = 4_000_000
LETTER_RUN = np.ones(256, dtype=bool)
LETTER_RUN[ord("a"):ord("z") + 1] = False
LETTER_RUN[ord("A"):ord("Z") + 1] = False
LETTER_RUN[0x80:] = False  # separators: ASCII other than letters


class Lattice:
    """Trie of the pieces as byte strings; a leading space stands for the word's start."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {bytes([b]) for b in range(256)}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                text = model.id_to_piece(i).replace("▁", " ")
                inner = text[1:] if text.startswith(" ") else text
                if inner and inner == inner.lower() and all(c > "\x7f" or "a" <= c <= "z" for c in inner):
                    pieces.add(text.encode())
        self.pieces = sorted(pieces)
        used = np.zeros(256, dtype=bool)
        used[np.frombuffer(b"".join(self.pieces), np.uint8)] = True
        self.letter = np.cumsum(used) - 1
        nodes: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for number, piece in enumerate(self.pieces):
            at = 0
            for byte in piece:
                if byte not in nodes[at]:
                    nodes[at][byte] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nodes[at][byte]
            ends[at] = number
        self.dead = int(used.sum())  # a letter that no piece has
        self.child = np.zeros((len(nodes), self.dead + 1), dtype=np.int32)
        for at, following in enumerate(nodes):
            for byte, to in following.items():
                self.child[at, self.letter[byte]] = to
        self.piece = np.array(ends, dtype=np.int32)
        self.longest = max(map(len, self.pieces))

    def spans(self, letters: np.ndarray, first: int = 0, last: int | None = None,
              ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of the pieces in words (rows x bytes) from start ``first`` to ``last``, by start."""
        n = letters.shape[1]
        for i in range(first, n if last is None else last):
            rows, node = np.arange(len(letters)), np.zeros(len(letters), dtype=np.int32)
            for end in range(i + 1, min(n, i + self.longest) + 1):
                node = self.child[node, letters[rows, end - 1]]
                alive = node > 0
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                piece = self.piece[node]
                here = piece >= 0
                if here.any():
                    yield i, end, rows[here], piece[here]

    def forward(self, letters: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Probability mass before each byte and at the end: rows x (bytes + 1) x columns of weight."""
        alpha = np.zeros((len(letters), letters.shape[1] + 1, weight.shape[1]))
        alpha[:, 0] = 1
        for i, end, rows, piece in self.spans(letters):
            alpha[rows, end] += alpha[rows, i] * weight[piece]
        return alpha

    def log_forward(self, letters: np.ndarray, size: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Log probability mass at each row's end (rows x columns of weight), over a window of the longest piece."""
        log, window = np.log(weight), self.longest + 1
        alpha = np.full((window, len(letters), weight.shape[1]), -np.inf)
        alpha[0] = 0
        out = np.empty((len(letters), weight.shape[1]))
        at = 0
        for i, end, rows, piece in self.spans(letters):
            if i > at:  # every byte is a piece, so places come one by one
                alpha[at % window] = -np.inf
                out[size == i] = alpha[i % window][size == i]
                at = i
            to = alpha[end % window]
            to[rows] = np.logaddexp(to[rows], alpha[i % window][rows] + log[piece])
        last = size == at + 1
        out[last] = alpha[(at + 1) % window][last]
        return out

    def log_uses(self, letters: np.ndarray, size: np.ndarray, weight: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, pieces, expected uses) over all segmentations of each row."""
        log, every = np.log(weight), np.arange(len(letters))
        alpha = np.full((len(letters), letters.shape[1] + 1), -np.inf)
        beta = alpha.copy()
        alpha[:, 0] = beta[every, size] = 0
        for i, end, rows, piece in self.spans(letters):
            alpha[rows, end] = np.logaddexp(alpha[rows, end], alpha[rows, i] + log[piece])
        whole = alpha[every, size]
        for first in reversed(range(0, letters.shape[1], SEGMENT)):
            for i, end, rows, piece in reversed(list(self.spans(letters, first, min(first + SEGMENT, letters.shape[1])))):
                rest = log[piece] + beta[rows, end]
                beta[rows, i] = np.logaddexp(beta[rows, i], rest)
                yield rows, piece, np.exp(alpha[rows, i] + rest - whole[rows])


_lattices: dict[str, Lattice] = {}


def lattice(path: str) -> Lattice:
    if path not in _lattices:
        _lattices[path] = Lattice(path)
    return _lattices[path]


class TextWords:
    """Words of a run of texts: hash, text and place of each."""

    def __init__(self, column: pa.Array) -> None:
        texts = W.flat(pc.utf8_lower(column.cast(pa.large_string())))
        words = W.split(texts, LETTER_RUN, hashed=False)
        self.data, self.start, self.end, self.text = texts.data, words.start, words.end, words.text
        self.inner = np.zeros(len(words.start), dtype=bool)  # words are whole
        self.hash = W.hash_spans(self.data, self.start, self.end)

    def tables(self, chosen: np.ndarray, letter: np.ndarray, columns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in chosen, letters) of the chosen words by length, in tables of bounded size."""
        size = self.end[chosen] - self.start[chosen] + 1
        short = np.flatnonzero(size <= LONG_BYTES + 1)
        order = short[np.argsort(size[short], kind="stable")]
        edges = np.flatnonzero(np.diff(size[order], prepend=-1))
        edges = np.append(edges, len(order))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            n = int(size[order[a]])
            step = max(1, TABLE // ((n + 1) * columns))
            for c in range(a, b, step):
                rows = order[c:min(b, c + step)]
                out = np.full((len(rows), n), letter[0x20])
                out[:, 1:] = letter[self.data[self.start[chosen[rows]][:, None] + np.arange(n - 1)]]
                yield rows, out

    def long_tables(self, chosen: np.ndarray, lattice: Lattice, columns: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places in chosen, letters, size) of the long ones among the chosen words, filled up with the dead letter."""
        size = self.end[chosen] - self.start[chosen] + 1
        order = np.flatnonzero(size > LONG_BYTES + 1)
        order = order[np.argsort(size[order], kind="stable")]
        while len(order):
            n = int(size[order[-1]])
            step = max(1, TABLE // max(8 * (n + 1), (lattice.longest + 1) * columns))
            rows, order = order[-step:], order[:-step]
            lens = size[rows] - 1
            row = np.repeat(np.arange(len(rows)), lens)
            place = np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
            out = np.full((len(rows), n), lattice.dead, dtype=np.int16)
            out[:, 0] = lattice.letter[0x20]
            out[row, place + 1] = lattice.letter[self.data[self.start[chosen[rows]][row] + place]]
            yield rows, out, size[rows]


def _expected(path: str, langs: list[str]):
    """Map function: expected uses of each piece by language, over a task's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(path)
        n = len(pieces.pieces)
        weight = np.full((n, 1), 1.0 / n)
        total = np.zeros((len(langs), n))
        place = {lang: i for i, lang in enumerate(langs)}
        for batch in batches:
            for part in W.slices(batch):
                words = TextWords(part.column("text"))
                lang = np.array([place[x] for x in part.column("lang").to_pylist()])
                _, index, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
                counts = np.zeros((len(langs), len(index)))
                for i in range(len(langs)):
                    counts[i] = np.bincount(inverse[lang[words.text] == i], minlength=len(index))
                for rows, letters in words.tables(index, pieces.letter, 2):
                    spans = list(pieces.spans(letters))
                    alpha = np.zeros((len(letters), letters.shape[1] + 1))
                    beta = np.zeros_like(alpha)
                    alpha[:, 0] = beta[:, -1] = 1
                    for i, end, at, piece in spans:
                        alpha[at, end] += alpha[at, i] * weight[piece, 0]
                    for i, end, at, piece in reversed(spans):
                        beta[at, i] += beta[at, end] * weight[piece, 0]
                    for i, end, at, piece in spans:
                        share = alpha[at, i] * weight[piece, 0] * beta[at, end] / alpha[at, -1]
                        for k in range(len(langs)):
                            total[k] += np.bincount(piece, weights=share * counts[k, rows[at]], minlength=n)
                for rows, letters, size in words.long_tables(index, pieces, 1):
                    for at, piece, share in pieces.log_uses(letters, size, weight[:, 0]):
                        for k in range(len(langs)):
                            np.add.at(total[k], piece, share * counts[k, rows[at]])
        for k in range(len(langs)):
            used = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(used), pa.int32()), pa.array(used.astype(np.int32)),
                                              pa.array(total[k, used])], names=["lang", "piece", "uses"])

    return run


class Model:
    def __init__(self, path: str, langs: list[str], weight: np.ndarray) -> None:
        self.path, self.langs = path, langs
        sizes = np.array([len(p) for p in lattice(path).pieces])
        self.weight = weight * PER_BYTE ** sizes[:, None]
        self.hash, self.log = np.empty(0, np.uint64), np.empty((0, len(langs)))

    def word_logs(self, words: TextWords) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of each distinct word by language, place of each word among them)."""
        pieces = lattice(self.path)
        distinct, index, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.hash) > CACHE_WORDS:
            self.hash, self.log = self.hash[:0], self.log[:0]
        at = np.searchsorted(self.hash, distinct)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.hash):
            new = self.hash[np.minimum(at, len(self.hash) - 1)] != distinct
        if new.any():
            chosen = index[new]
            found = np.empty((len(chosen), len(self.langs)))
            for rows, letters in words.tables(chosen, pieces.letter, len(self.langs)):
                found[rows] = np.log(pieces.forward(letters, self.weight)[:, -1]) - letters.shape[1] * np.log(PER_BYTE)
            for rows, letters, size in words.long_tables(chosen, pieces, len(self.langs)):
                found[rows] = pieces.log_forward(letters, size, self.weight) - size[:, None] * np.log(PER_BYTE)
            merged = np.concatenate([self.hash, distinct[new]])
            order = np.argsort(merged, kind="stable")
            self.hash, self.log = merged[order], np.concatenate([self.log, found])[order]
        return self.log[np.searchsorted(self.hash, distinct)], inverse

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, posterior under equal priors) of each text."""
        n = len(column)
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.langs:
            return [UNDETERMINED] * n, np.zeros(n)
        words = TextWords(column)
        logs, inverse = self.word_logs(words)
        total = np.stack([np.bincount(words.text, weights=logs[inverse, k], minlength=n)
                          for k in range(len(self.langs))], axis=1)
        best = np.argmax(total, axis=1)
        posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return ([self.langs[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)],
                np.where(lettered, posterior, 0.0))


def train(docs: DataFrame, path: str) -> Model:
    """Piece probabilities by language from every row of ``docs`` (text, lang) that has both."""
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    langs = sorted(r.lang for r in known.select("lang").distinct().limit(MAX_LANGS + 1).collect())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    uses = np.zeros((len(langs), len(lattice(path).pieces)))
    if langs:
        counted = known.mapInArrow(_expected(path, langs), "lang int, piece int, uses double")
        for row in counted.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect():
            uses[row.lang, row.piece] += row.uses
    own = uses / np.maximum(uses.sum(axis=1, keepdims=True), 1e-300)
    return Model(path, langs, ((1 - UNIFORM) * own + UNIFORM / uses.shape[1]).T.copy())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without text, with lang_pred and score; only the text is looked at."""
    carried = [f for f in docs.schema if f.name not in ("lang_pred", "score", "text")]
    names = [f.name for f in carried]
    out = T.StructType([*carried, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                lang, score = model.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(lang, pa.string()),
                                                  pa.array(score)], names=[f.name for f in out])

    return docs.select(*names, "text").mapInArrow(run, out)
