"""Plain Python forms of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np


def words(text):
    return (text or "").encode("utf-8").lower().split()


def shingle_sets(rows, n):
    out = []
    for _, text in rows:
        w = words(text)
        runs = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
        out.append(frozenset(runs) if runs else (frozenset([tuple(w)]) if w else frozenset()))
    return out


def components(rows, n, percent):
    """Per row (set size, component), rows of (doc_id, text); links by row, ids least first."""
    sets = shingle_sets(rows, n)
    holders = defaultdict(list)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in holders[x])
        for j, c in both.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return [(len(s), min(least[root(i)], default=None) if s else rows[i][0]) for i, s in enumerate(sets)]


def repeated_spans(rows, least):
    """{row number: [(start, end)]} of words inside passages of ``least`` words that occur twice."""
    cut = [words(t) for _, t in rows]
    seen = Counter(tuple(w[k : k + least]) for w in cut for k in range(len(w) - least + 1))
    out = {}
    for i, w in enumerate(cut):
        hit = np.zeros(len(w) + 2, int)
        for k in range(len(w) - least + 1):
            if seen[tuple(w[k : k + least])] > 1:
                hit[k + 1 : k + 1 + least] = 1
        edges = np.flatnonzero(np.diff(hit))
        if len(edges):
            out[i] = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
    return out


def dedup_lines(rows):
    """Texts after removal of lines that later occurrences of three-line windows cover."""
    first, out = {}, {}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p : p + 3])
            if not "".join(window).strip(" \r\t"):
                continue
            if window in first:
                gone |= {p, p + 1, p + 2}
            else:
                first[window] = (doc_id, p)
        out[doc_id] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def leaks(rows, items, masks, reach, min_words, min_percent):
    cut = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    found = set()
    docs = [(i, cut(t)) for i, t in rows if t]
    for item_id, text in items:
        b = cut(text or "")
        for doc_id, a in docs:
            for m in masks:
                on = [k for k, c in enumerate(m) if c == "1"]
                places = defaultdict(list)
                for q in range(len(b) - len(m) + 1):
                    places[tuple(b[q + k] for k in on)].append(q)
                for p in range(len(a) - len(m) + 1):
                    for q in places.get(tuple(a[p + k] for k in on), ()):
                        low, high = max(-reach, -p, -q), min(len(m) + reach, len(a) - p, len(b) - q)
                        same = sum(a[p + k] == b[q + k] for k in range(low, high))
                        if same >= min_words and same * 100 >= (high - low) * min_percent:
                            found.add((doc_id, item_id))
    return found
