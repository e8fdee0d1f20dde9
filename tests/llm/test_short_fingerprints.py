"""Fingerprints against a plain threshold sketch written apart from the operator's numpy form."""

from __future__ import annotations

import random

from martkit.llm import fingerprint
from martkit.llm.tokens import shingle_set
from tests.llm import brute

LIMIT = 2**64 // fingerprint.SCALE


def _tell(text):
    return fingerprint.encode(fingerprint.sketch(text))


def _hash(shingle):
    """Hash of one shingle: of a text that holds nothing else."""
    (h,) = shingle_set(b" ".join(shingle).decode(), len(shingle))
    return int(h)


def _brute(text):
    """The 64-bit hashes below the threshold, shingle by shingle."""
    (shingles,) = brute.shingle_sets([(0, text)], fingerprint.WORDS)
    return {h for s in shingles if (h := _hash(s)) < LIMIT}


def _text(rng, n, tag="w"):
    return " ".join(f"{tag}{rng.randrange(10**6)}" for _ in range(n))


def test_sketch_is_every_hash_below_the_fraction():
    rng = random.Random(8)
    for n in (0, 1, 4, 5, 7, 9, 20, 60, 300, 2000):
        for _ in range(10):
            text = _text(rng, n)
            want = {h >> 24 for h in _brute(text)}
            got = set(fingerprint.decode(_tell(text)).tolist())
            assert got == want or (not want and len(got) == min(n, 1) and min(got, default=2**40) >= 2**40 // fingerprint.SCALE)


def test_likeness_is_that_of_the_sketches():
    rng = random.Random(9)
    for n in (5, 12, 40, 200, 900):
        for _ in range(20):
            words = _text(rng, n).split()
            text, edited = " ".join(words), " ".join(words[: n - n // 3] + _text(rng, n // 3, "e").split())
            x, y = _brute(text), _brute(edited)
            want = len(x & y) / len(x | y) if x & y else 0.0
            if not x and not y:  # the least hashes are equal or not
                want = float(_tell(text) == _tell(edited))
            assert fingerprint.likeness(_tell(text), _tell(edited)) == want
            assert fingerprint.likeness(_tell(text), _tell("other " + text[::-1])) <= 0.01
            if n >= 900:
                assert abs(want - 0.5) < 0.15
    for text in ("", "a", "a b c d e f"):
        assert fingerprint.likeness(_tell(text), _tell(text)) == 1.0 and fingerprint.likeness(_tell(text), _tell("x y z")) == 0.0


def test_merge_and_containment_of_unequal_texts():
    rng = random.Random(10)
    over = fingerprint.WORDS - 1
    for n in (12, 40, 300, 3000):
        words = _text(rng, n).split()
        for at in (over + 2, n // 3 + over, n // 2 + over):
            a, b = _tell(" ".join(words[:at])), _tell(" ".join(words[at - over :]))
            assert fingerprint.merge(a, b) == fingerprint.merge(b, a) == _tell(" ".join(words))
            part = _brute(" ".join(words[:at]))
            assert fingerprint.containment(a, _tell(" ".join(words))) == (1.0 if part or a == _tell(" ".join(words)) else None)
