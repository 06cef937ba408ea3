"""Quality, decontamination, secrets, licences and languages against brute force, with edge rows."""

import random
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedlake.llm import decontam, langid, license_scan, quality, secret_scan
from feedlake.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.sampled_from([*"ab éß \n\t\x0b|#日 ", "the ", "\n\n", "foo bar "]), max_size=60).map("".join)
EDGE = [(0, "a b c d e f g h i j k l"), (1, None), (2, ""), (3, " \n\t "), (None, "x y"), (4, "word " * 60_000),
        (5, "same line\nsame line\nother"), (5, "same line\nsame line\nother"), (6, "é ß\x0b日本 語"), (7, "\n\n\n")]


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + extra)


def base_counts(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 300 else None
    covered = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 5)} if twice is not None else None
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup,
            len(covered) if covered is not None else None)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_words_and_base_counts(texts):
    flat = W.flat(pa.array(texts, pa.string()))
    words = W.split(flat, W.SPACE)
    assert [flat.data[a:b].tobytes().decode() for a, b in zip(words.start, words.end)] == [
        w for t in texts for w in WORD.findall(t)]
    counts = quality.measure(flat, words)
    assert list(zip(*(counts[f.name].tolist() for f in quality.METRICS))) == [base_counts(t) for t in texts]


def test_equal_words_equal_hashes_and_slices():
    column = pa.array(["x", "foo bar", "bar foo x"])
    words = W.split(W.flat(column.slice(1)), W.SPACE)
    assert words.hash[0] == words.hash[3] and words.hash[1] == words.hash[2] and len(set(words.hash.tolist())) == 3
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "", "b" * 100, "c"])], names=["text"])
    assert [len(s) for s in W.slices(batch, limit=12)] == [3, 1, 1]


def test_quality_against_brute_force(spark):
    rng = random.Random(3)
    good = [f"g{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(good) for _ in range(30))) for i in range(60)]
    rows += [(100 + i, " ".join(f"{rng.choice(good)}###" for _ in range(30))) for i in range(30)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(30)]
                                   + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    model = quality.train(docs, labels)
    held = {r.label_id for r in quality.label_sample(labels).filter("held").collect()}
    raw, trusted = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    bucket = {}
    for i, text in rows:
        bucket[i] = quality.features(W.split(W.flat(pa.array([text])), W.SPACE))[0]
        np.add.at(raw, bucket[i], 1)
        if i < 60 and i not in held:
            np.add.at(trusted, bucket[i], 1)
    want = np.log((trusted + quality.ADDITIVE) / (raw * trusted.sum() / raw.sum() + quality.ADDITIVE))
    assert np.allclose(model.llr, want)
    got = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    for i, _ in rows:
        assert got[i].llr == pytest.approx(want[bucket[i]].mean())
        assert got[i].kept == (not got[i].base_failed and got[i].llr >= model.threshold)
    assert all(got[i].llr > got[100].llr for i in range(60)) and not any(got[100 + i].kept for i in range(30))


def test_quality_edges(spark):
    docs = spark.createDataFrame([(*r, True, "x") for r in EDGE], "doc_id long, text string, kept boolean, label_id string")
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert model.threshold == float("-inf")
    out = quality.judge(docs, model)
    assert out.columns.count("kept") == 1 and "label_id" in out.columns
    rows = out.collect()
    assert len(rows) == len(EDGE)
    got = {r.doc_id: r for r in rows}
    assert got[0].kept and got[1].base_failed and got[2].n_words == 0 and got[4].n_repeat_words == 60_000
    assert got[5].n_dup_lines == 1 and not got[4].kept
    assert quality.judge(frame(spark, []), model).count() == 0


def test_best_cut():
    assert quality.best_cut([(0.5, True, 9), (-1.0, False, 4)]) == pytest.approx((-1 + 1 / 64 + 0.5) / 2)
    assert quality.best_cut([(0.5, True, 9)]) == float("-inf")


BENCH = [("q1", "One two three four five six seven eight nine ten eleven"), ("q2", "short item"), ("q2", "other words here"),
         (None, "null named item"), ("q3", None), ("q4", "..."), ("q5", "one two three four five six seven eight nine ten")]
SOILED = [(0, "x ONE two, three-four five six seven eight nine ten eleven! Short item. end"), (1, "nothing"), (2, None),
          (3, ""), (4, "a short item short item"), (4, "a short item short item"), (None, "other WORDS here"),
          (5, "null named item"), (6, "é日 one two three four five six seven eight nine ten"), (7, "short" + " x" * 50_000 + " item")]


def decon_brute(text, window=10):
    norm = lambda t: [(m.group().translate(LOWER), m.start(), m.end()) for m in
                      re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    words = norm(text)
    hit, items = set(), set()
    for item, t in BENCH:
        own = [w for w, _, _ in norm(t)]
        n = min(window, len(own))
        for k in range(len(own) - n + 1) if n else ():
            for i in range(len(words) - n + 1):
                if [w for w, _, _ in words[i:i + n]] == own[k:k + n]:
                    hit.update(range(i, i + n))
                    items.add(item or "")
    return len(words), len(hit), items, words


LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_decontamination(spark, block_bytes):
    docs = spark.createDataFrame([(*r, 1) for r in SOILED], "doc_id long, text string, n_hit int")
    items = spark.createDataFrame(BENCH, "item_id string, text string")
    out = decontam.find(docs, items, block_bytes=block_bytes).collect()
    assert len(out) == len(SOILED)
    for r in out:
        n, hit, names, words = decon_brute(r.text)
        assert (r.n_words, r.n_hit, {h.item for h in r.hits}) == (n, hit, names)
        for h in r.hits:
            assert (h.start, h.end) == (words[h.first_word][1], words[h.last_word][2])


def test_decontamination_empty_tables(spark):
    none = spark.createDataFrame([], "item_id string, text string")
    assert {r.n_hit for r in decontam.find(frame(spark, SOILED), none).collect()} == {0}
    assert decontam.find(frame(spark, []), spark.createDataFrame(BENCH, "item_id string, text string")).count() == 0


ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)


def base_brute(text):
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))


SECRETISH = st.lists(st.sampled_from(["token", "ToKen", "api_key", "=", ": ", '"', "AKIA", "Z9", "deadbeef", "0123abcd",
                                              " ", "é", "x", "ſecret", "K", "."]), max_size=40).map("".join)


@settings(max_examples=200, deadline=None)
@given(SECRETISH)
def test_secret_base_spans(text):
    assert [s[:3] for s in secret_scan.base_spans(text)] == base_brute(text)


def test_secret_scan(spark, base):
    plain = "ordinary identifiers like internationalization_of_the_application and some_other_function_name here "
    blob = "Zx9Q2mVt7LkP0aWcR8eYbN4sHdJ6uG3f"
    rows = [(0, plain * 50), (1, f"é {blob} end"), (2, None), (3, ""), (4, f"token = {blob}"), (4, f"token = {blob}"),
            (None, "AKIA" + "A1" * 8), (5, plain + "x" * 100_000)]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, secrets string")
    llr = secret_scan.train(docs)
    got = {(r.doc_id): [tuple(s)[:3] for s in r.secrets] for r in secret_scan.scan(docs, llr).collect()}
    assert got[0] == [] and got[2] == [] and got[3] == [] and got[5] == []
    assert got[1] == [("markov", 2, 2 + len(blob))]
    assert got[4] == [("assign", 0, 8 + len(blob))] and got[None] == [("access", 0, 20)]
    held = np.random.default_rng(7)
    secrets = ["".join(held.choice(list(secret_scan.ALPHABET[:64]), 32)) for _ in range(200)]
    texts = spark.read.parquet(f"{base}/documents.parquet").select("text")
    learned = secret_scan.train(texts)
    assert np.mean([bool(secret_scan.spans(s, learned)) for s in secrets]) > 0.98
    spans = [secret_scan.spans(r.text or "", learned) for r in texts.collect()]
    assert sum(s[2] == "markov" for found in spans for s in found) <= 2
    assert secret_scan.scan(frame(spark, []), secret_scan.train(frame(spark, []))).count() == 0


def test_license_scan(spark):
    mit = license_scan.TEMPLATES["MIT"]
    filler = "lorem ipsum dolor sit amet " * 40
    rows = [(0, f"{filler}\n{mit}\n{filler}"), (1, mit.replace("sublicense", "relicense")), (2, None), (3, ""),
            (4, f"{filler} Released under the MIT License. {filler}"), (5, "permission to leave the warranty of copyright"),
            (6, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."), (None, "RELEASED UNDER THE MIT LICENSE"),
            (7, f"{filler * 30}licensed{filler * 30}")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, licenses int")
    got = {r.doc_id: (r.licenses, t) for r, (_, t) in zip(sorted(license_scan.scan(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)),
                                                         sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))}
    names = {k: [(x.license, x.differences) for x in v] for k, (v, _) in got.items()}
    assert names[0] == [("MIT", 0)] and names[1] == [("MIT", 2)]
    assert names[4] == [("MIT-notice", 0)] and names[None] == [("MIT-notice", 0)]
    assert names[6] == [("Apache-2.0-notice", 0), ("MIT-notice", 0)]
    assert names[2] == names[3] == names[5] == names[7] == []
    span, text = got[4][0][0], got[4][1]
    assert text[span.start:span.end] == "Released under the MIT License."
    assert license_scan.scan(frame(spark, [])).count() == 0
    assert all(r.licenses == [] for r in license_scan.scan(docs, {}).collect())


@pytest.mark.parametrize("name", license_scan.TEMPLATES)
def test_license_scan_across_lines(name):
    own = license_scan.Templates(license_scan.TEMPLATES)
    text = license_scan.TEMPLATES[name]
    filler = "\n".join(["lorem ipsum dolor sit amet consectetur"] * 60)
    for width in (*range(72, 80), 20):
        lines = textwrap.wrap(text, width, break_on_hyphens=False, break_long_words=False)
        spaced = [x for i, line in enumerate(lines) for x in ([line, ""] if i % 3 == 2 else [line])]
        forms = [lines, spaced, *([sign + line for line in spaced] for sign in ("# ", " * ", "// ", "; ", "#", "-- "))]
        for form in forms:
            block = "\n".join(form)
            for whole in (block, f"{filler}\n{block}\n{filler}"):
                got = license_scan.find(whole, own)
                assert [(x["license"], x["differences"]) for x in got] == [(name, 0)], whole
                inside = " ".join(filter(None, map(license_scan.plain, whole[got[0]["start"]:got[0]["end"]].split())))
                assert inside == " ".join(own.words[name])


@pytest.mark.parametrize("name,text", [
    ("CC-BY-ND-4.0-short-notice", "These pictures: licensed under CC BY-ND 4.0, see there."),
    ("CC-BY-NC-SA-4.0-notice", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike\n4.0 International License."),
    ("LGPL-2.1-or-later", """This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 *
 * This library is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
 * Lesser General Public License for more details."""),
])
def test_license_scan_names_other_wordings(name, text):
    assert [(x["license"], x["differences"]) for x in license_scan.find(text, license_scan.Templates(license_scan.TEMPLATES))] == [(name, 0)]


def test_license_scan_leaves_no_candidate_out():
    own = license_scan.Templates(license_scan.TEMPLATES)
    names = lambda text: [(x["license"], x["differences"]) for x in license_scan.find(text, own)]
    part = lambda name: " ".join(w for i, w in enumerate(license_scan.TEMPLATES[name].split()) if i % 6 != 5)
    notice = license_scan.TEMPLATES["MIT-notice"]
    for text in (f"{part('MIT')}\n{notice}", " ".join(map(part, ("MIT", "GPL-3.0-or-later", "BSD-2-Clause"))) + f"\n{notice}"):
        assert names(text) == [("MIT-notice", 0)]
        assert names(text + "\n" + license_scan.TEMPLATES["CC-BY-NC-4.0-notice"]) == [("MIT-notice", 0), ("CC-BY-NC-4.0-notice", 0)]
    # a long run of cues, taken apart
    many = [n for _ in range(40) for n in ("MIT-notice", "ISC", "Unlicense", "Apache-2.0")]
    assert names("\n".join(f"{license_scan.TEMPLATES[n]} permission to lorem ipsum" for n in many)) == [(n, 0) for n in many]
    assert names(" ".join(["license permission"] * 20_000)) == []


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations(pieces):
    lat = langid.lattice(pieces)
    weight = np.random.default_rng(0).random((len(lat.pieces), 2)) / 100
    index = {p: i for i, p in enumerate(lat.pieces)}
    model = langid.Model(pieces, ["x", "y"], weight)
    words = langid.TextWords(pa.array(["Hello über " + "a" * 130, "日本 語x1y", None, "", "12"]))
    logs, place = model.word_logs(words)
    for i in range(len(words.start)):
        word = (b"" if words.inner[i] else b" ") + words.data[words.start[i]:words.end[i]].tobytes()
        for k in (0, 1):
            ways = [1.0] + [0.0] * len(word)
            for j in range(1, len(word) + 1):
                ways[j] = sum(ways[s] * weight[index[word[s:j]], k] for s in range(j) if word[s:j] in index)
            assert logs[place[i], k] == pytest.approx(np.log(ways[-1]))


def test_long_words_are_whole(pieces):
    lat = langid.lattice(pieces)
    index = {p: i for i, p in enumerate(lat.pieces)}
    weight = np.random.default_rng(1).random((len(lat.pieces), 2)) / 100
    texts = ["日本語の文" * 40, "κ" * 25, "über" * 30 + " " + "x" * 47, "a" * 48, "b" * 49, "донаудампфшифф" * 30]
    words = langid.TextWords(pa.array(texts))
    assert len(words.start) == len(texts) + 1
    logs, place = langid.Model(pieces, ["x", "y"], weight).word_logs(words)
    flat, uses = -np.log(len(lat.pieces)), np.zeros(len(lat.pieces))
    for i in range(len(words.start)):
        word = b" " + words.data[words.start[i]:words.end[i]].tobytes()
        n = len(word)
        spans = [(s, e, index[word[s:e]]) for e in range(1, n + 1) for s in range(max(0, e - lat.longest), e) if word[s:e] in index]
        ways, ahead, back = np.full((n + 1, 2), -np.inf), np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        ways[0] = ahead[0] = back[n] = 0
        for s, e, piece in spans:
            ways[e] = np.logaddexp(ways[e], ways[s] + np.log(weight[piece]))
            ahead[e] = np.logaddexp(ahead[e], ahead[s] + flat)
        assert logs[place[i]] == pytest.approx(ways[n])
        for s, e, piece in sorted(spans, reverse=True):
            back[s] = np.logaddexp(back[s], flat + back[e])
            uses[piece] += np.exp(ahead[s] + flat + back[e] - ahead[n])
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["x"] * len(texts))], names=["text", "lang"])
    got = np.zeros(len(uses))
    for part in langid._expected(pieces, ["x"])(iter([batch])):
        got[part.column("piece").to_numpy()] += part.column("uses").to_numpy()
    assert got == pytest.approx(uses, rel=1e-6, abs=1e-9)


def test_language_held_out_accuracy_and_edges(spark, base, pieces):
    docs = spark.read.parquet(f"{base}/documents.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    rows = docs.select("doc_id", "text", "lang").collect()
    known = spark.createDataFrame([(r.text, r.lang) for r in rows if not held(r.doc_id)] + [(None, "en"), ("mot", None)],
                                  "text string, lang string")
    model = langid.train(known, pieces)
    assert model.langs == ["de", "en", "es", "fr"]
    assert np.allclose((model.weight / langid.PER_BYTE ** np.array([len(p) for p in langid.lattice(pieces).pieces])[:, None]).sum(axis=0), 1)
    out = {r.doc_id: r for r in langid.identify(docs.withColumnRenamed("n_chars", "score"), model).collect()}
    test = [r for r in rows if held(r.doc_id)]
    assert np.mean([out[r.doc_id].lang_pred == r.lang for r in test]) >= 0.95
    assert all(0 <= r.score <= 1 for r in out.values())
    odd = frame(spark, [(1, None), (2, ""), (3, "12 34 !?"), (4, "日本語" * 3000), (4, "日本語" * 3000), (None, "the")])
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(odd, model).collect()]
    assert [x for x in got if x[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")] and len(got) == 6
    nothing = langid.train(spark.createDataFrame([], "text string, lang string"), pieces)
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}
