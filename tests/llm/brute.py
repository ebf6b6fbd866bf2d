"""Plain Python versions of the operators, for small inputs."""

import itertools
import re
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


class Groups:
    def __init__(self, keys):
        self.parent = {k: k for k in keys}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def links(sets, threshold):
    """Pairs (i, j), i < j, of non-empty sets with Jaccard similarity >= threshold."""
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in where[x] if j > i).items():
            if n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9:
                yield i, j


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_duplicates(texts, threshold=0.8, n=5):
    """Per text (number of links, smallest position in its class)."""
    sets = [shingles(t, n) for t in texts]
    count, groups = Counter(), Groups(range(len(texts)))
    for i, j in links(sets, threshold):
        count[i] += 1
        count[j] += 1
        groups.link(i, j)
    return [(count[i], groups.find(i)) for i in range(len(texts))]


def windows(texts, items, width=10):
    """Per text (number of words, number hit, item ids hit); items are (id, text)."""
    known = {}
    for ident, text in items:
        w = words(text)
        k = min(width, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            known.setdefault((k, tuple(w[s:s + k])), set()).add(ident)
    sizes = sorted({k for k, _ in known})
    out = []
    for text in texts:
        w, hit, ids = words(text), set(), set()
        for k, s in itertools.chain.from_iterable(((k, s) for s in range(len(w) - k + 1)) for k in sizes):
            if (found := known.get((k, tuple(w[s:s + k])))) is not None:
                hit.update(range(s, s + k))
                ids |= found
        out.append((len(w), len(hit), ids))
    return out


def normal(line):
    return re.sub(r"^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$", "", line).lower()


def dedup_lines(texts, k=8, threshold=0.8):
    """Texts (in row order) with one line of each class: in its first row, there the most frequent, at its first place."""
    count, first = Counter(), {}
    for r, text in enumerate(texts):
        for line in (text or "").split("\n") if text is not None else []:
            if n := normal(line):
                count[n] += 1
                first.setdefault(n, r)
    lines = list(count)
    sets = [{x[i:i + k] for i in range(max(1, len(x) - k + 1))} for x in lines]
    groups = Groups(range(len(lines)))
    for i, j in links(sets, threshold):
        groups.link(i, j)
    classes = {}
    for i, x in enumerate(lines):
        classes.setdefault(groups.find(i), []).append(x)
    return classes, count, first
