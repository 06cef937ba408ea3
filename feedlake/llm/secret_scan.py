"""Secret scans: patterns, and character Markov models by log-likelihood ratio.

Three kinds of spans come from patterns (``assign``, ``access``, ``hex``).  The
fourth, ``markov``, comes from two first-order character models over
``ALPHABET``: one of random strings, trained from labelled samples (the values
that the patterns find in all documents, and generated uniform strings of usual
alphabets), one of ordinary identifiers (all other runs of these characters in
all documents, but for the unlabelled: long ones with letters and digits).  A run of ``MIN_RUN`` characters or more that no pattern span
touches is a secret if its log-likelihood ratio reaches ``MIN_RATIO`` in all
and ``MIN_PER_CHAR`` for each character.

Offsets are code points, ends exclusive.  Edge cases: a null text is empty and
has no spans; equal starts are ordered by kind; repeated rows have a result
each; on an empty table nothing but the generated samples is learned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm import words as W

ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
                    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
MIN_RUN = 20
MIN_RATIO = 12.0
MIN_PER_CHAR = 0.5
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
#: Alphabets of the generated random samples.
RANDOM_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", ALPHABET[:62], ALPHABET[:64], ALPHABET[:62] + "-_")
SAMPLES, SAMPLE_LENGTH = 400, 40
STATES = len(ALPHABET) + 1  # 0: before the first character
_STATE = np.zeros(256, dtype=np.int64)
_STATE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, STATES)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the pattern kinds, by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def transitions(data: bytes) -> np.ndarray:
    """Counts of character pairs in the runs of ALPHABET, flat (STATES x STATES)."""
    state = _STATE[np.frombuffer(data, np.uint8)]
    before = np.concatenate(([0], state[:-1])) if len(state) else state
    inside = state > 0
    return np.bincount(before[inside] * STATES + state[inside], minlength=STATES * STATES)


def random_samples() -> list[str]:
    """Labelled random strings: uniform over each alphabet, the same on every call."""
    rng = np.random.default_rng(20_240_101)
    return ["".join(rng.choice(list(alphabet), SAMPLE_LENGTH)) for alphabet in RANDOM_ALPHABETS for _ in range(SAMPLES)]


def _ordinary(run: re.Match) -> str:
    """A long run if it can be labelled ordinary, else nothing."""
    return " " if _DIGIT.search(run[0]) and _LETTER.search(run[0]) else run[0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ordinary, secret = np.zeros((2, STATES * STATES), dtype=np.int64)
    for batch in batches:
        for part in W.slices(batch):
            rest, values = [], []
            for text in part.column("text").to_pylist():
                if not text:
                    continue
                at = 0
                for start, end, _, value in base_spans(text):
                    values.append(value)
                    rest.append(RUN.sub(_ordinary, text[at:start]))
                    at = max(at, end)
                rest.append(RUN.sub(_ordinary, text[at:]))
            ordinary += transitions("\n".join(rest).encode())
            secret += transitions("\n".join(values).encode())
    for label, counts in ((0, ordinary), (1, secret)):
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(used), pa.int32()), pa.array(used.astype(np.int32)),
                                          pa.array(counts[used])], names=["label", "pair", "n"])


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each character pair (random over ordinary), from every text of ``docs``.

    At most 2 x STATES^2 sums come to the driver.
    """
    counts = np.ones((2, STATES * STATES))
    counts[1] += transitions("\n".join(random_samples()).encode())
    for row in docs.select("text").mapInArrow(_count, "label int, pair int, n long").groupBy("label", "pair").agg(
            F.sum("n").alias("n")).collect():
        counts[row.label, row.pair] += row.n
    by_state = counts.reshape(2, STATES, STATES)[:, :, 1:]
    logs = np.log(by_state / by_state.sum(axis=2, keepdims=True))
    return logs[1] - logs[0]


def ratio(run: str, llr: np.ndarray) -> float:
    state = _STATE[np.frombuffer(run.encode(), np.uint8)]
    return float(llr[np.concatenate(([0], state[:-1])), state - 1].sum())


def spans(text: str, llr: np.ndarray) -> list[tuple[int, int, str, float | None]]:
    """All spans (start, end, kind, ratio or None), by start, then kind."""
    base = base_spans(text)
    found: list[tuple[int, int, str, float | None]] = [(s, e, kind, None) for s, e, kind, _ in base]
    for m in RUN.finditer(text):
        if not any(s < m.end() and m.start() < e for s, e, _, _ in base):
            value = ratio(m[0], llr)
            if value >= max(MIN_RATIO, MIN_PER_CHAR * len(m[0])):
                found.append((m.start(), m.end(), "markov", value))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("ratio", T.DoubleType())])
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())]))


def scan(docs: DataFrame, llr: np.ndarray) -> DataFrame:
    """``docs`` without text, with secrets: array of (kind, start, end, ratio)."""
    carried = [f for f in docs.schema if f.name not in ("secrets", "text")]
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                rows = [[{"kind": k, "start": s, "end": e, "ratio": r} for s, e, k, r in spans(text or "", llr)]
                        for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(rows, _SPANS)],
                                                 names=[*names, "secrets"])

    return docs.select(*names, "text").mapInArrow(run, T.StructType([*carried, T.StructField("secrets", T.ArrayType(SPAN))]))
