"""Plain Python forms shared by the tests."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
_ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, n=3):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def union_find(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def brute_classes(rows, percent=90, n=3):
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y
             and 100 * len(x & y) >= percent * len(x | y)]
    return union_find({i for i, _ in sets}, links)


def decon_words(text):
    return _ALNUM.findall((text or "").translate(LOWER))
