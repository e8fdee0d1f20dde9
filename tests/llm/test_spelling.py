"""Spelling variants against brute force over all pairs, and on odd tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from martkit.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n string, code int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "w", "n", 0) for i, t in rows], SCHEMA)


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def _brute(rows, min_chars, min_count, ratio, damage):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if damage:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % damage == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= min_count}
    form, near = {}, {}
    for w in n:
        others = [o for o in n if _one_edit(w, o)]
        near[w] = len(others)
        top = min(others, key=lambda o: (-n[o], o.encode()), default=None)
        form[w] = top if top is not None and n[top] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), c, near[w], n.get(form[w])) for w, c in n.items())


def _words(rng, letters, size):
    return "".join(rng.choice(letters) for _ in range(size))


@pytest.mark.parametrize("letters,symbols", [("abÀÿ", 8), ("aBcdefgh×é", 3), ("ab", 2)])
def test_variants_equal_brute_force(spark, letters, symbols):
    rng = random.Random(len(letters))
    base = [_words(rng, letters, rng.randint(3, 6)) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(base[: 1 + i % 60]) for _ in range(40))) for i in range(80)]
    rows += [(None, base[0]), (None, base[0]), (7, None), (8, ""), (9, "1 2 _"), (10, " ".join([base[1]] * 500))]
    got = spelling.spelling_variants(_docs(spark, rows), 4, 2, 2, symbols, damage=7)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == _brute(rows, 4, 2, 2, 7)


def test_long_chains_end_at_their_root(spark):
    rows = [(1, " ".join("aaaa" + "b" * k for k in range(9) for _ in range(2**k)))]
    got = {r.word: r.root for r in spelling.spelling_variants(_docs(spark, rows), 4, 1, 2).collect()}
    assert set(got.values()) == {"aaaa" + "b" * 8}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "short words")], [(None, "")]])
def test_tables_without_words_give_no_rows(spark, rows):
    assert spelling.spelling_variants(_docs(spark, rows), min_chars=6).collect() == []


def test_one_reduced_word_holds_many_words(spark):
    """Letters of one symbol: every word of a length shares its reduced word."""
    by_symbol = Counter(zlib.crc32(c.encode()) % 8 for c in spelling.LETTERS)
    symbol = by_symbol.most_common(1)[0][0]
    letters = [c for c in spelling.LETTERS if zlib.crc32(c.encode()) % 8 == symbol and not c.isupper()][:5]
    rng = random.Random(3)
    rows = [(i, " ".join(_words(rng, letters, 4) for _ in range(60))) for i in range(20)]
    got = spelling.spelling_variants(_docs(spark, rows), 4, 1, 1)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == _brute(rows, 4, 1, 1, None)
