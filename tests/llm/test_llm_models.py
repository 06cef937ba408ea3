"""Token format and language model against direct computation, with edge rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.llm import lm, rans, tokens
from feedlake.llm import words as W
from feedlake.llm.scratch import fresh_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=900), st.integers(1, 5), st.integers(1, 40), st.integers(1, 9), st.data())
def test_rans_round_trip(ids, lanes, block, every, data):
    ids = np.array(ids, np.uint32) ** 2
    packed = rans.encode(ids, lanes, block * lanes, every)
    assert (rans.decode(packed) == ids).all()
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(ids)), st.integers(0, len(ids)))))
    assert (rans.decode(packed, a, b) == ids[a:b]).all()


def test_rans_size_and_checksums():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.5, 300_000), 50_000).astype(np.uint32)
    packed = rans.encode(ids)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert len(packed) * 8 / len(ids) < 1.1 * -(share * np.log2(share)).sum()
    assert (rans.decode(rans.encode(np.full(70_000, 4_000_000_000, np.uint32))) == 4_000_000_000).all()
    for at in (0, 30, len(packed) // 2, len(packed) - 5):
        broken = bytearray(packed)
        broken[at] ^= 0x55
        with pytest.raises(ValueError):
            rans.decode(bytes(broken))
    with pytest.raises(ValueError):
        rans.decode(b"RTK1")


def test_frequencies():
    for counts in ([1], [1] * 60_000, [10**12, 1, 1], [5, 3, 2]):
        freq = rans.frequencies(np.array(counts), 18)
        assert freq.sum() == 1 << 18 and freq.min() >= 1


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def direct(vocabulary):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary)
    return lambda text: own.encode(text or "", add_special_tokens=False).ids + [0]


ODD = ["", None, " ", "  a  b ", "a\n\nb", "a \n b", "x  y", "x 　y  z", "don't  we'll\tgo", "日本 語\n字", "a <|endoftext|> b", "<|endoftext|>",
       "x<|endoftext|>y <|endoftext|>  z\n<|endoftext|>\nw <|endoftext|><|endoftext|> hi", "<|endoftext|> hi", " a <|endoftext|>",
       "\x1c a \x1f b \x0b c", "end\n", "  a", "a  ", "😀 😀\n😀", "a\x85 b", "word " * 30_000]


@pytest.mark.parametrize("special_as_text", [False, True])
def test_chunks_encode_as_whole_texts(vocabulary, special_as_text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    whole.encode_special_tokens = special_as_text
    direct = lambda text: whole.encode(text or "", add_special_tokens=False).ids + [0]
    rng = random.Random(1)
    alphabet = [" ", "\n", "a", "b", "é", " ", "'s", "1", "!", "　", "\t", "日", "\x0c", "  ", "ll", "\r", " ", " "]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(1500)]
    own = tokens.Encoder(vocabulary, special_as_text)
    for part in (texts, texts[::-1]):  # the second time from what was seen
        ids, counts = own.encode(W.flat(pa.array(part, pa.string())))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [direct(t) for t in part]


def test_token_files(spark, monkeypatch, vocabulary, direct):
    rows = [(i * 7 % 50 - 5, t) for i, t in enumerate(ODD * 3)] + [(None, "no id"), (None, "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int").repartition(4)
    path = fresh_path(spark, "tokens")
    tokens.write_tokens(docs, path, vocabulary)
    got = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    want = Counter((i, zlib.crc32(np.array(direct(t), "<u4").tobytes())) for i, t in rows)
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == want
    empty = fresh_path(spark, "tokens")
    tokens.write_tokens(spark.createDataFrame([], "doc_id long, text string"), empty, vocabulary)
    assert tokens.read_tokens(spark, empty).count() == 0


def words_of(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")] + ["</s>"]


def brute_lm(train):
    uses = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["<s>", *t[:-1]], t))
    contexts, after = Counter(b for _, b in pairs), defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), c in pairs.items():
        after[a][0] += c
        after[a][min(c, 3)] += 1
    histogram = lambda counts: [sum(c == i for c in counts) for i in (1, 2, 3, 4)]
    d, u = lm.discounts(histogram(pairs.values())), lm.discounts(histogram(contexts.values()))
    cut = lambda c, by: max(c - (0, *by)[min(c, 3)], 0)
    rest = sum(u[min(c, 3) - 1] for c in contexts.values()) / max(len(pairs), 1) if pairs else 1.0

    def lower(w):
        return cut(contexts[w], u) / max(len(pairs), 1) + rest / (len(uses) + 1)

    def probability(a, w):
        total, *n = after[a] if a in after else (0, 0, 0, 0)
        return lower(w) if not total else cut(pairs[a, w], d) / total + sum(x * y for x, y in zip(n, d)) / total * lower(w)

    return uses, probability


@pytest.mark.parametrize("case", ["real", "tiny", "none"])
def test_kneser_ney_against_brute_force(spark, base, monkeypatch, case):
    monkeypatch.setattr(lm, "FLUSH", 20_000)
    rows = {"real": [(r.doc_id, r.text) for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect()],
            "tiny": [(0, "a b a b A c"), (1, None), (2, ""), (3, "a " * 700), (4, "new words"), (4, "new words"), (None, "b é")],
            "none": [(1, "a b")]}[case]
    kept = [t for i, t in rows if case != "none" and (i is None or zlib.crc32(str(i).encode()) % 5 != 1)]
    model = lm.train(spark.createDataFrame([(t, "x") for t in kept], "text string, keys string"))
    uses, probability = brute_lm([words_of(t) for t in kept])
    assert model.tokens == sum(uses.values()) and model.words == len(uses)
    got = lm.score(spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double"), model)
    assert sorted(got.columns) == ["base_score", "doc_id", "n_known", "n_tokens", "score"]
    want = Counter()
    for i, t in rows:
        own = words_of(t)
        want[i, len(own), sum(uses[w] > 0 for w in own),
             f"{sum(math.log10((uses[w] + 0.5) / (model.tokens + 0.5 * (len(uses) + 1))) for w in own):.6f}",
             f"{sum(math.log10(probability(a, w)) for a, w in zip(['<s>', *own[:-1]], own)):.6f}"] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, f"{r.base_score + 0:.6f}", f"{r.score + 0:.6f}") for r in got.collect()) == want
    some = random.Random(0).sample(sorted(uses), min(5, len(uses)))
    for a in ["<s>", "@@", *some]:
        assert sum(probability(a, w) for w in uses) + probability(a, "@@") == pytest.approx(1)


def test_packed_integers():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (lm.unpack_sorted(lm.pack_sorted(values)) == values).all() and len(lm.unpack(lm.pack(values[:0]))) == 0
