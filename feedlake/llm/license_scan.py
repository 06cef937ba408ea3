"""License scans by conditional compression.

A text's candidate blocks are the words within reach (the longest template's
words) of a cue, across line ends; ranges that meet are one.  A block is compressed
alone and with each template as a raw-content zstandard dictionary; templates
are ranked by the bytes that the dictionary saves, then by the share that these
are of the template's own compressed size (which must reach ``MIN_SAVED``), then
by order.  The first whose wording differs from the block's nearest words by no
more than ``MAX_DIFFER`` of the template's words (at least one) is confirmed,
with the exact differences; the block's words before and after it are looked at
again.  A block where none is confirmed, or that is longer than ``WIDE`` reaches,
is taken apart: for each cue and template, the words that the template can reach
from the cue are ranked and confirmed in the same way, best first, where no
better one stands; the words between are looked at again.  Templates with too few
words in common with a block to be confirmed are not compressed; no other
candidate is left out.  Words are compared without case and edge punctuation;
those of punctuation only (comment signs, rules) are left out.

Templates are a parameter (name to text) of bounded number, sent to the tasks.

Edge cases: null and empty texts have no blocks; very long texts are cut to
what a template can reach around each cue, so nothing with a cue is skipped;
repeated rows have a result each; without templates nothing is found.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedlake.llm import words as W
from feedlake.llm.license_texts import TEMPLATES

#: Words of a cue may stand on two lines, with comment signs between them.
CUE = (r"(?i)licen[cs]ed?|copyright|permission|redistribut|warrant|creative[^0-9A-Za-z]+commons|cc[^0-9A-Za-z]+by"
       r"|public[^0-9A-Za-z]+domain|waived")
MIN_SAVED = 0.15
MAX_DIFFER = 0.1
#: Blocks of more reaches are taken apart at once, which costs less.
WIDE = 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "\"'().,;:!?*[]<>#/%=|-"
_CUE = re.compile(CUE, re.ASCII)


def plain(word: str) -> str:
    return word.strip(_EDGE).lower()


class Templates:
    """Template words and zstandard compressors, one for each and one without a dictionary."""

    def __init__(self, templates: dict[str, str]) -> None:
        import zstandard as z

        own = z.ZstdCompressionParameters.from_level(
            9, write_content_size=0, write_checksum=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS)
        self.words = {name: [w for w in map(plain, WORD.findall(text)) if w] for name, text in templates.items()}
        self.alone = z.ZstdCompressor(compression_params=own)
        self.knowing = {name: z.ZstdCompressor(compression_params=own, dict_data=z.ZstdCompressionDict(
            " ".join(words).encode(), dict_type=z.DICT_TYPE_RAWCONTENT)) for name, words in self.words.items() if words}
        self.size = {name: len(self.alone.compress(" ".join(self.words[name]).encode())) for name in self.knowing}
        self.count = {name: Counter(self.words[name]) for name in self.knowing}
        self.most = {name: max(1, MAX_DIFFER * len(self.words[name])) for name in self.knowing}
        self.reach = max(map(len, self.words.values()), default=0)

    def possible(self, words: Counter[str], names: Iterable[str] | None = None) -> list[str]:
        """Templates with enough words in common to be confirmed; differences are at least the words that lack."""
        return [name for name in (self.knowing if names is None else names)
                if sum((self.count[name] - words).values()) <= self.most[name]]

    def ranked(self, words: list[str], names: list[str]) -> list[tuple[int, float, str]]:
        """(bytes saved, their share of the template's size, name) of those with enough, most bytes saved first."""
        if not names:
            return []
        block = " ".join(words).encode()
        alone = len(self.alone.compress(block))
        saved = [(alone - len(self.knowing[name].compress(block)), name) for name in names]
        ranked = sorted(((n, n / self.size[name], name) for n, name in saved), key=lambda s: (-s[0], -s[1]))
        return [r for r in ranked if r[1] >= MIN_SAVED]

    def differences(self, name: str, words: list[str]) -> tuple[int, int, int]:
        """(differing words, first, last + 1): exact alignment of a template with the nearest of ``words``."""
        own = self.words[name]
        blocks = [m for m in SequenceMatcher(None, own, words, autojunk=False).get_matching_blocks() if m.size]
        if not blocks:
            return len(own), 0, 0
        # leave out single far matches at the edges that cost more words than they match
        best = (len(own), 0, 0)
        for i in range(len(blocks)):
            same = 0
            for j in range(i, len(blocks)):
                same += blocks[j].size
                first, last = blocks[i].b, blocks[j].b + blocks[j].size
                best = min(best, ((len(own) - same) + (last - first - same), first, last))
        return best


def _blocks(found: list[re.Match], cues: list[tuple[int, int]], reach: int) -> Iterator[tuple[int, int]]:
    """Ranges of word places around the cues, merged where they meet."""
    at, here = 0, None
    for start, end in cues:
        while at < len(found) and found[at].end() <= start:
            at += 1
        last = at
        while last < len(found) and found[last].start() < end:
            last += 1
        a, b = max(0, at - reach), min(len(found), last + reach)
        if here and a <= here[1]:
            here = (here[0], max(b, here[1]))
        else:
            if here:
                yield here
            here = (a, b)
    if here:
        yield here


def _confirmed(templates: Templates, name: str, words: list[str]) -> tuple[int, int, int] | None:
    differ, first, last = templates.differences(name, words)
    return (differ, first, last) if first < last and differ <= templates.most[name] else None


def _around(templates: Templates, spelt: list[str], cues: list[tuple[int, int]], a: int, b: int) -> list[tuple]:
    """(saved share, name, differences, first, last + 1) in words a to b, from each cue's reach; without overlaps."""
    seen, ranked = set(), []
    names = templates.possible(Counter(spelt[a:b]))
    for start, end in cues if names else ():
        longest = Counter(spelt[max(a, start - templates.reach):min(b, end + templates.reach)])
        for name in templates.possible(longest, names):
            reach = len(templates.words[name]) + int(templates.most[name])
            part = (max(a, start - reach), min(b, end + reach))
            if (name, part) not in seen:
                seen.add((name, part))
                ranked += [(*r, part) for r in templates.ranked(spelt[part[0]:part[1]], [name])]
    out: list[tuple] = []
    for _, saved, name, (first, last) in sorted(ranked, key=lambda r: (-r[0], -r[1], r[3])):
        if hit := _confirmed(templates, name, spelt[first:last]):
            x, y = first + hit[1], first + hit[2]
            if all(y <= o[3] or o[4] <= x for o in out):
                out.append((saved, name, hit[0], x, y))
    return out


def find(text: str, templates: Templates) -> list[dict]:
    """Confirmed licences of a text, by start."""
    out = []
    spans = [m.span() for m in _CUE.finditer(text)]
    words = [w for w in WORD.finditer(text) if plain(w[0])] if spans else []
    spelt = [plain(w[0]) for w in words]
    starts, ends = [w.start() for w in words], [w.end() for w in words]
    cues = [(bisect_right(ends, s), bisect_left(starts, e)) for s, e in spans]
    stack = list(_blocks(words, spans, templates.reach))
    while stack:
        a, b = stack.pop()
        own = [(max(a, s), min(b, e)) for s, e in cues if s < b and a < e]
        if not own:
            continue
        found = []
        if b - a <= WIDE * templates.reach:
            block = spelt[a:b]
            for _, saved, name in templates.ranked(block, templates.possible(Counter(block))):
                if hit := _confirmed(templates, name, block):
                    found = [(saved, name, hit[0], a + hit[1], a + hit[2])]
                    break
        found = sorted(found or _around(templates, spelt, own, a, b), key=lambda f: f[3])
        for saved, name, differ, first, last in found:
            out.append({"license": name, "start": starts[first], "end": ends[last - 1], "saved": saved, "differences": differ})
        if found:
            stack += zip([a, *(f[4] for f in found)], [*(f[3] for f in found), b], strict=True)
    return sorted(out, key=lambda x: (x["start"], x["license"]))


LICENSE = T.StructType([T.StructField("license", T.StringType()), T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()), T.StructField("saved", T.DoubleType()),
                        T.StructField("differences", T.LongType())])
_LICENSES = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("saved", pa.float64()), ("differences", pa.int64())]))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """``docs`` without text, with licenses: array of (license, start, end, saved, differences)."""
    carried = [f for f in docs.schema if f.name not in ("licenses", "text")]
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates(templates)
        for batch in batches:
            for part in W.slices(batch):
                texts = part.column("text")
                cue = pc.fill_null(pc.match_substring_regex(texts, CUE), False).to_pylist()
                rows = [find(texts[i].as_py(), own) if has else [] for i, has in enumerate(cue)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(rows, _LICENSES)],
                                                 names=[*names, "licenses"])

    return docs.select(*names, "text").mapInArrow(
        run, T.StructType([*carried, T.StructField("licenses", T.ArrayType(LICENSE))]))
