"""Joins, mixing, components, signature trees and tool calls against brute force, with edge rows."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedlake.llm import chat, mixing, ngram_join, sigtree
from feedlake.llm.components import components
from tests_llm_helpers import brute_classes, shingles, union_find

def near_copies(seed, groups=8, copies=12, words=60):
    """Groups of edited copies, at and around the threshold."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        source = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 9, 10, 20, words, 4 * words]))]
        for _ in range(copies):
            text = list(source)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = f"x{rng.randrange(9)}"
            rows.append(" ".join(text[:len(text) - rng.choice([0, 0, 1, 2])]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,block,percent", [(1, 64, 90), (2, 3, 90), (3, 2, 80), (4, 5, 70)])
def test_ngram_join_against_all_pairs(spark, monkeypatch, seed, block, percent):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", block)
    monkeypatch.setattr(ngram_join, "WIDE_DOCS", block + 1)
    monkeypatch.setattr(ngram_join, "FLUSH_KEYS", 500)
    rows = near_copies(seed)
    got = {r.doc_id: r for r in ngram_join.classes(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5), percent).collect()}
    want = brute_classes(rows, percent)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingles(t)) for i, t in rows}


def test_ngram_join_edges(spark):
    long = " ".join(f"v{i % 9973}" for i in range(60_000))
    rows = [(9, "a b"), (3, "A B"), (4, "a b c"), (None, "a b"), (5, None), (6, ""), (7, " \n"), (8, long), (2, long + " tail"),
            (11, "one two three four"), (11, "a b"), (12, "one two three four"), (13, "x"), (13, "x"), (14, "b a")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, unit int")
    got = ngram_join.classes(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    out = got.collect()
    assert len(out) == len(rows)
    found = {}
    for r in out:
        found.setdefault(r.doc_id, set()).add(r.component_id)
    # 11 has two texts: one equals 12's, one equals 3's and 9's
    assert found == {9: {3}, 3: {3}, 4: {4}, None: {None}, 5: {5}, 6: {6}, 7: {7}, 8: {2}, 2: {2}, 11: {3}, 12: {3},
                     13: {13}, 14: {14}}
    assert ngram_join.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bands_hold_every_linking_pair():
    for percent in (50, 80, 90, 95):
        bands = ngram_join.Bands(percent, 3000)
        band = lambda n: int(np.searchsorted(bands.bounds, n, side="right")) - 1
        for x in range(1, 2000, 7):
            y = 100 * x // percent
            assert band(y) - band(x) in (0, 1)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_linked_sets_share_a_key(n, percent):
    """Also when their lone tokens are taken out; pairs of any size, edited up to the limit."""
    rng, linked = random.Random(n), 0
    for _ in range(120):
        size = rng.choice([8, 20, 40, 100, 300, 900])
        one = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        two = list(one)
        for _ in range(rng.randrange(size * (100 - percent) // 100 // n + 2)):
            two[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        two = two[:rng.randrange(size * percent // 100, size) + 1]
        sets = ngram_join.Sets(pa.array([" ".join(one), " ".join(two)]), n)
        a, b = (set(x.tolist()) for x in sets.each())
        if a == b or 100 * len(a & b) < percent * len(a | b):
            continue
        linked += 1
        bands = ngram_join.Bands(percent, 2000)
        common = np.isin(sets.token, np.array(list(a & b), np.uint64))
        for lone in (2, 1):  # tokens of one set only may count as rare, or as lone
            magnitude = np.where(common, 2 + sets.token % np.uint64(5), lone)
            key, text = bands.keys(sets, np.ones(2, bool), magnitude)
            assert set(key[text == 0].tolist()) & set(key[text == 1].tolist())
    assert linked > 20


@pytest.mark.parametrize("seed", range(4))
def test_signature_tree_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(30):
        source = rng.integers(0, 1 << 62, rng.integers(1, 120)).astype(np.uint64)
        for _ in range(rng.integers(1, 9)):
            own = source[rng.random(len(source)) > rng.choice([0, 0.03, 0.1])]
            sets.append(np.unique(np.concatenate([own, rng.integers(0, 1 << 62, rng.integers(0, 4)).astype(np.uint64)])))
    sets = [s for s in sets if len(s)]
    as_sets = [set(s.tolist()) for s in sets]
    for percent in (50, 80, 90):
        links = [(i, j) for i, x in enumerate(as_sets) for j, y in enumerate(as_sets[:i])
                 if 100 * len(x & y) >= percent * len(x | y)]
        want = union_find(range(len(sets)), links)
        assert sigtree.classes(sets, percent).tolist() == [want[i] for i in range(len(sets))]


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000, 1000 + i) for i in range(1, 80)]
    links += [(2000 + i, 2001 + i) for i in range(40)] + [(5000, 5000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(
        links + [(None, 1), (2, None)], "a long, b long")).collect()}
    assert got == union_find({x for link in links for x in link}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def mixed_rows(seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randrange(1, 400)), rng.choice(["a", "b", "c", "big", "big", "big", None])) for i in range(300)]
    return rows + [(1000, None, "a"), (1001, "", "b"), (None, "x y z", "c"), (7, "same", "d"), (7, "same", "d"), (8, "one", "é"),
                   (2000, "q " * 70_000, "long")]


@pytest.mark.parametrize("block", [8, 37])
def test_mixing_meets_targets(spark, block):
    rows = mixed_rows()
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, target int")
    out = mixing.mix(docs, block_words=block).collect()
    assert len(out) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(r.source_size == sizes[r.source] for r in out)
    order = sorted(target, key=lambda s: (s is None, (s or "").encode()))
    cap = {s: 3 * sizes[s] for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:  # reshare the excess until none is above
        rest = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        level = rest / sum(weight[s] for s in free)
        above = {s: cap[s] for s in free if level * weight[s] > cap[s]}
        if not above:
            break
        fixed |= above
    want = {s: fixed.get(s, level * weight[s]) for s in order}
    assert target == pytest.approx(want)
    # what the slots of a source take, which is near its target
    n_slots = -(-sum(int(t) for t in target.values()) // block)
    reach = np.cumsum([int(target[s]) * 16 // block for s in order])
    points = (np.arange(n_slots) * 1327217885) % (1 << 31)
    of_slot = np.searchsorted(reach, np.floor(points * (reach[-1] / (1 << 31))), side="right")
    assert taken == {s: min(block * int((of_slot == i).sum()), cap[s]) for i, s in enumerate(order)}
    assert all(abs(taken[s] - target[s]) <= 4 * block for s in order)
    firsts = [r.slot for r in out if r.taken]
    assert all(of_slot[r.slot] == order.index(r.source) for r in out if r.taken) and max(firsts) < n_slots
    assert all((r.slot is None) == (r.taken == 0) for r in out)
    again = mixing.mix(docs.repartition(7), block_words=block).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_mixing_without_rows_or_words(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    empty = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)).collect()
    assert [(r.size, r.taken, r.target) for r in empty] == [(0, 0, 0.0)] * 2


def test_the_schedule_decides(spark, monkeypatch):
    """Other points, other result; points in order give each source the slots of its span."""
    docs = spark.createDataFrame(mixed_rows(), "doc_id long, text string, source string")
    own = sorted(map(repr, mixing.mix(docs, block_words=8).collect()))
    monkeypatch.setattr(mixing, "points", lambda slots: slots.withColumn("point", (F.col("id") * 7919) % (1 << 31)))
    assert sorted(map(repr, mixing.mix(docs, block_words=8).collect())) != own
    monkeypatch.setattr(mixing, "points", lambda slots: slots.withColumn("point", F.lit(0).cast("long")))
    only = {r.source for r in mixing.mix(docs, block_words=8).collect() if r.taken}
    assert only == {"a"}  # all points fall to the first source


def test_blocks_grow_with_the_mix():
    assert mixing.block_length(10**6) == 32 and mixing.block_length(32 << 27) == 32 and mixing.block_length((32 << 27) + 1) == 64
    assert 3 * 10**13 / mixing.block_length(3 * 10**13) <= mixing.MOST_SLOTS


def test_schedule_is_low_discrepancy(spark):
    need = {"=a": 500, "=b": 200, "=c": 3, "=d": 1, "~": 96}
    rows = mixing.schedule(spark.createDataFrame([(k, n * 10) for k, n in need.items()], "skey string, want long"), 10).collect()
    assert sorted(r.slot for r in rows) == list(range(800))
    for k, n in need.items():
        own = sorted((r.slot, r.rank) for r in rows if r.skey == k)
        assert [r for _, r in own] == list(range(len(own))) and abs(len(own) - n) <= 3
        for share in (0.25, 0.5, 0.75):  # any prefix of the schedule holds its share, within a few slots
            prefix = sum(slot < share * 800 for slot, _ in own)
            assert abs(prefix - share * n) <= 4


SCHEMA = json.dumps({"type": "object", "required": ["q"], "properties": {"q": {"type": "string", "minLength": 2},
                                                                        "n": {"type": "integer", "maximum": 5}},
                     "additionalProperties": False})


def formatted(spark, calls, results, schemas=(("f", SCHEMA),)):
    return chat.format_calls(
        spark.createDataFrame(calls, "conv_id long, pos long, call_id string, name string, arguments string, needs array<string>"),
        spark.createDataFrame(results, "conv_id long, pos long, call_id string, content string"),
        spark.createDataFrame(list(schemas), "name string, schema string")).collect()


def test_calls_are_linked_ordered_checked(spark):
    ok = '{"q": "hi", "n": 2.0}'
    calls = [(1, 0, "a", "f", ok, None), (1, 2, "b", "f", '{"n": 9, "z": 1}', ["a"]), (1, 2, "b", "f", '{"n": 9, "z": 1}', ["a"]),
             (1, 9, "a", "f", ok, None), (1, 3, "c", "g", "{}", ["nope"]), (1, 4, "d", "f", "{bad", None),
             (2, 0, "late", "f", ok, ["x"]), (2, 1, "x", "f", ok, None), (3, 0, "p", "f", ok, ["q"]), (3, 1, "q", "f", ok, ["p"]),
             (None, 0, "a", "f", ok, None), (4, 0, None, "f", None, None)]
    results = [(1, 1, "a", "one"), (1, 5, "a", "two"), (1, 6, "zz", "orphan"), (2, 2, "x", "found"), (2, 0, "late", "early"),
               (3, 2, "p", "r"), (3, 3, "q", "s"), (5, 0, None, "?")]
    rows = formatted(spark, calls, results)
    assert len(rows) == len(set(calls[:1] + [c[:5] for c in calls])) - 1 + len(results) or len(rows) == 11 + len(results)
    at = {(r.conv_id, r.kind, r.call_id, r.status): r for r in rows}
    assert at[1, "call", "a", "linked"].json == '{"arguments":{"n":2.0,"q":"hi"},"id":"a","name":"f","type":"call"}'
    assert at[1, "call", "b", "unanswered"].errors == "$.q: missing; $.n: above maximum; $.z: not allowed"
    assert at[1, "call", "c", "unanswered"].errors == "no usable schema; needs unknown call nope"
    assert at[1, "call", "d", "unanswered"].errors == "arguments are not JSON"
    assert at[1, "call", "a", "duplicate"].place > at[1, "call", "a", "linked"].place
    assert at[1, "result", "a", "linked"].json == '{"content":"one","id":"a","type":"result"}'
    assert at[1, "result", "a", "duplicate"] and at[1, "result", "zz", "orphan"] and at[5, "result", None, "orphan"]
    assert at[None, "call", "a", "unanswered"] and at[4, "call", None, "unanswered"].errors == "arguments are not JSON"
    order = [(r.kind, r.call_id) for r in sorted(rows, key=lambda r: (str(r.conv_id), r.place)) if r.conv_id == 2]
    assert order == [("call", "x"), ("result", "x"), ("call", "late"), ("result", "late")]
    assert any(r.cyclic for r in rows if r.conv_id == 3) and not any(r.cyclic for r in rows if r.conv_id != 3)
    for conv in {r.conv_id for r in rows}:
        assert sorted(r.place for r in rows if r.conv_id == conv) == list(range(sum(r.conv_id == conv for r in rows)))
    assert formatted(spark, [], []) == []


def test_order_is_topological_on_random_logs(spark):
    rng = random.Random(2)
    calls, results, needs = [], [], {}
    for conv in range(6):
        ids = [f"k{i}" for i in range(12)]
        spots = rng.sample(range(100), 24)
        for i, k in enumerate(ids):
            needs[conv, k] = rng.sample(ids[:i], min(i, rng.randrange(3)))
            calls.append((conv, spots[2 * i], k, "f", '{"q":"ab"}', needs[conv, k]))
            results.append((conv, spots[2 * i + 1], k, "r"))
    place = {(r.conv_id, r.kind, r.call_id): r.place for r in formatted(spark, calls, results)}
    for (conv, k), wanted in needs.items():
        assert place[conv, "call", k] < place[conv, "result", k]
        assert all(place[conv, "result", u] < place[conv, "call", k] for u in wanted)


def test_check_and_canonical():
    assert chat.check(True, {"type": "integer"}) and not chat.check(3.0, {"type": "integer"})
    assert chat.check([1, "x"], {"items": {"type": "number"}}) == ["$[1]: not number"]
    assert chat.check(1, {"enum": [True]}) and not chat.check(1, {"enum": [1.0]}) and chat.check("b", {"pattern": "^a"})
    assert chat.canonical(chat.parsed('{"b":1,"a":{"d":[1, 2],"c":"é"}}')) == '{"a":{"c":"é","d":[1,2]},"b":1}'
    for bad in ("", "NaN", "[1e999", '"\\ud800"', None):
        with pytest.raises(ValueError):
            chat.parsed(bad)
