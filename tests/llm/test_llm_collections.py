"""Phrases, ring shards and the Merkle manifest against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import merkle, phrases, ring
from feedlake.llm.queries import ORACLE, QUERIES, table
from tests_llm_helpers import LOWER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, key string, pos long, word string, arc int"


def odd_documents(spark):
    rows = [(1, "The red fox. the red fox, the red fox!", "en", "s", 5), (2, None, "en", "s", None), (3, "", None, None, 0),
            (4, "the\tred  fox runs\nred fox\rthe red", None, "é", 7), (4, "the\tred  fox runs\nred fox\rthe red", None, "é", 7),
            (5, "a b a b a b a b a b", "de", "s", 1), (None, "a b a b", "de", "s", 1), (6, "B a b a B a", "de", "s", 2),
            (7, ". , ;", "en", "s", 3), (8, "x" * 5000 + " " + "é ö " * 900, "de", "s", (1 << 63) - 1), (9, "a:b a:b a b a", "de", "", 2),
            (9, "other text", "de", "", 2), (-3, "red fox red fox", "en", "s", -1), (10, "solo", "und", "s", 4)]
    return spark.createDataFrame([(*r, 1, "k", 2, "w", 3) for r in rows], SCHEMA)


def oracle(base, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{base}/documents.parquet'")
    return con.execute(ORACLE[name]).fetchall()


# ------------------------------------------------------------------ phrases
def brute_phrases(rows, least, top, percent=80):
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        if any(lang == other and len(q) > len(p) and 100 * b >= percent * a and
               any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (other, q), b in candidates.items()):
            continue
        score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                             for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return {(lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
            for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])}


@pytest.mark.parametrize(("least", "top"), [(2, 2000), (3, 4)])
def test_phrases_of_odd_rows(spark, least, top):
    docs = odd_documents(spark)
    want = brute_phrases([(r.text, r.lang) for r in docs.collect()], least, top)
    assert {tuple(r) for r in phrases.collocations(docs, least=least, top=top).collect()} == want and want
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_phrases_of_documents_equal_brute_force(spark, base):
    docs = table(spark, base, "documents").select("text", "lang")
    want = brute_phrases([tuple(r) for r in docs.collect()], 5, 50)
    got = phrases.collocations(docs.repartition(7), least=5, top=50).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert {tuple(r) for r in QUERIES["op11_phrase_collocations"](spark, base).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()} == set(oracle(base, "op11_phrase_collocations"))


def test_stripes_of_many_shards_and_segments_merge(spark, monkeypatch):
    """A prefix with very many next words, dealt over tasks; totals and entries stay whole."""
    monkeypatch.setattr(phrases, "WORDS_PER_SHARD", 500)
    rows = [(" ".join(f"the w{j % 40}" for j in range(i % 7, 400)), "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    monkeypatch.setattr(phrases, "FILE_WORDS", 10)
    words, seed = phrases.count_words(docs)
    numbers, known = phrases.numbered(words.filter("n >= 30"))
    assert len(numbers.bases) > 1
    held = phrases.stripes(docs, numbers, seed, words.agg(F.sum("n")).first()[0], 30).collect()
    spelt = {r.number: r.word for r in known.collect()}
    assert sorted(spelt) == list(range(1, len(spelt) + 1))
    assert max(Counter(tuple(r.prefix) for r in held).values()) > 10  # segments of one stripe
    got = {tuple(spelt[k] for k in [*r.prefix, x]): n for r in held for x, n in zip(r.next, r.n, strict=True)}
    f = Counter()
    for text, _ in rows:
        w = text.split()
        for k in (2, 3, 4):
            f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    assert got == {p: n for p, n in f.items() if n >= 30}


def test_bitmap_of_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PIECE_BITS", 14)
    keys = [int(x) for x in np.random.default_rng(3).integers(-2**63, 2**63, 20_000)]
    bits = phrases.bitmap(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert bits.pieces > 1 and bits.has(np.array(keys, np.int64).view(np.uint64)).all()
    others = np.random.default_rng(4).integers(-2**63, 2**63, 20_000).view(np.uint64)
    assert bits.has(others).mean() < 0.1


# ------------------------------------------------------------------ ring
def brute_place(spark, rows, shards, virtual, slack):
    """rows: (doc_id, text, point, tie). Arcs' bytes offered shard by shard, in plain Python."""
    nodes = sorted({(r.high, r.arc, r.shard) for r in ring.ring(spark, shards, virtual).collect() if r.turn == 1})
    highs = [n[0] for n in nodes]
    arcs = defaultdict(list)
    for doc_id, text, point, tie in rows:
        arc = int(np.searchsorted(highs, point))
        turn = 0 if arc == len(nodes) else 1
        size = len((text or "").encode()) + 1
        arcs[arc % len(nodes)].append((turn, point, tie, doc_id is not None, doc_id or 0, size))
    for a in arcs.values():
        a.sort()
    total = sum(x[-1] for a in arcs.values() for x in a)
    cap = -(-total * (1000 + slack) // (1000 * shards))
    begin, end, load, went = dict.fromkeys(arcs, 0), {k: sum(x[-1] for x in a) for k, a in arcs.items()}, Counter(), defaultdict(list)
    while any(begin[k] < end[k] for k in arcs):
        before = dict(load)
        for k in sorted(arcs):
            if begin[k] < end[k]:
                for step in range(len(nodes)):
                    shard = nodes[(k + step) % len(nodes)][2]
                    if before.get(shard, 0) < cap:
                        break
                take = min(end[k] - begin[k], cap - load[shard])
                if take:
                    went[k].append((begin[k], begin[k] + take, shard))
                    load[shard] += take
                    begin[k] += take
    out = Counter()
    for k, a in arcs.items():
        at = 0
        for *_, known, doc_id, size in a:
            shard = next(s for b, e, s in went[k] if b <= at < e)
            out[doc_id if known else None, size, shard] += 1
            at += size
    return out, cap


@pytest.mark.parametrize("shards", [3, 8])
def test_ring_places_as_brute_force_does(spark, base, shards):
    docs = table(spark, base, "documents").select("doc_id", "text").unionByName(odd_documents(spark).select("doc_id", "text"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text"), F.xxhash64("doc_id")).collect()]
    want, cap = brute_place(spark, rows, shards, 16, 2)
    got = ring.place(docs.repartition(5), shards, virtual=16).collect()
    assert Counter((r.doc_id, r.size, r.shard) for r in got) == want
    for s in range(shards):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert sum(r.size for r in mine) < cap + max(r.size for r in got)
    texts = Counter((i, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.text_crc32) for r in got) == texts
    assert any(r.shard != r.home for r in got)


def test_ring_is_balanced_keeps_copies_together_and_moves_little(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("one text of a third of all rows"))
        .otherwise(F.concat(F.lit("t"), F.repeat(F.sha2((F.col("id") % 9_000).cast("string"), 256), 2))).alias("text"))
    at = {n: {r.doc_id: r for r in ring.place(docs, n).collect()} for n in (8, 9)}
    for n, placed in at.items():
        bytes_of = Counter()
        for r in placed.values():
            bytes_of[r.shard] += r.size
        assert len(bytes_of) == n and max(bytes_of.values()) <= 1.003 * sum(bytes_of.values()) / n
        assert min(bytes_of.values()) >= 0.98 * sum(bytes_of.values()) / n
    shards_of = defaultdict(set)
    for i, r in at[8].items():
        if i % 3:
            shards_of[i % 9_000].add(r.shard)
    assert sum(len(s) > 1 for s in shards_of.values()) <= 8  # cut arcs only
    moved = sum(at[8][i].shard != at[9][i].shard for i in at[8])
    assert moved < 0.4 * len(at[8])  # dealing by rank would move 8 of 9
    alone = [r for r in at[8].values() if r.home != r.shard]
    assert len(alone) < 0.45 * len(at[8])


def test_ring_is_the_same_again_and_takes_odd_rows(spark):
    docs = odd_documents(spark)
    one, two = (Counter(tuple(r) for r in ring.place(d, 4).drop("slot").collect()) for d in (docs, docs.repartition(9)))
    assert one == two and sum(one.values()) == docs.count()
    assert ring.place(docs.limit(0)).count() == 0


def test_ring_query_columns(spark, base):
    got = QUERIES["op12_ring_shards"](spark, base)
    assert dict(got.dtypes) | {"size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
                               "grown_shard": "int"} == dict(got.dtypes)
    rows = got.collect()
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None} and {r.shard for r in rows} <= set(range(8))


# ------------------------------------------------------------------ manifest
def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def spelt(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def brute_levels(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def brute_manifest(rows):
    """rows: COLUMNS. -> Counter of the query's rows."""
    trees = defaultdict(list)
    for row in rows:
        doc_id, source, lang, n_chars, text = row
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        changed = h(spelt((doc_id, source, lang, n_chars + 1, text))) if hit else None
        trees[lang].append((doc_id, h(spelt(row)), changed))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {k: brute_levels([x[1] for x in sorted(trees[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for k in order}
    top = brute_levels([levels[k][-1][0] for k in order])
    out = Counter()
    for place, lang in enumerate(order):
        for i, (doc_id, leaf, changed) in enumerate(sorted(trees[lang], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            reached, proof = changed or leaf, []
            for tree, at in ((levels[lang], i), (top, place)):
                for level in tree[:-1]:
                    run = level[at // 2 * 2:at // 2 * 2 + 2]
                    proof += run[:at % 2] + run[at % 2 + 1:]
                    run[at % 2] = reached
                    reached, at = h(*run), at // 2
            root = top[-1][0]
            out[doc_id, leaf, levels[lang][-1][0], root, h(*proof), reached, reached == root] += 1
    return out


def test_places_in_the_log_follow_from_subtree_sizes():
    for n in range(1, 70):
        for height in {(n - 1).bit_length(), 7}:
            where, log = {}, []

            def visit(level, number):  # a plain postorder walk
                if number << level >= n:
                    return
                if level:
                    visit(level - 1, 2 * number)
                    visit(level - 1, 2 * number + 1)
                where[level, number] = len(log)
                log.append((level, number))

            visit(height, 0)
            leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
            assert len(merkle.append_log(leaves, height)) == len(log)
            assert all(merkle.place(level, number, n) == at for (level, number), at in where.items())
            levels = [leaves]
            for _ in range(height):
                levels.append([merkle.parent(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
            assert merkle.append_log(leaves, height) == [levels[level][number] for level, number in log]
            for (level, number), at in where.items():  # full siblings stand a subtree's size apart
                if number % 2 and (number + 1) << level <= n:
                    assert where[level, number - 1] == at - (2 ** (level + 1) - 1)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_equals_brute_force(spark, base, bits):
    docs = table(spark, base, "documents").select(*merkle.COLUMNS).unionByName(odd_documents(spark).select(*merkle.COLUMNS))
    want = brute_manifest([tuple(r) for r in docs.collect()])
    got = merkle.proofs(merkle.build(docs.repartition(5), bits), bits).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert Counter(tuple(r) for r in got.collect()) == want
    assert any(not k[-1] for k in want) and any(k[-1] for k in want)


def test_manifest_of_a_few_rows(spark):
    docs = odd_documents(spark)
    one = docs.filter("doc_id = 1")
    got = merkle.proofs(merkle.build(one)).collect()
    assert [(r.leaf, r.subroot, r.root, r.proof_sha256) for r in got] == [(r.leaf, r.leaf, r.leaf, h()) for r in got] and len(got) == 1
    assert merkle.build(docs.limit(0)).root is None and merkle.proofs(merkle.build(docs.limit(0))).count() == 0


def test_manifest_query_equals_its_sql(spark, base):
    got = QUERIES["op13_merkle_manifest"](spark, base)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(oracle(base, "op13_merkle_manifest"))
