"""Words and shingles of one text as 64-bit hashes, computed on whole byte arrays.

A word is a run of bytes other than space and ``\\t``..``\\r``; A-Z count as a-z.
The text is lower-cased and cut by vector operations, so the cost is a few
passes over its bytes however many words it has.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_STEP = np.uint64(0xD1342543DE82EF95)
_RUN_BYTES = 1 << 17  # texts hashed at once; their arrays stay in the processor's cache
_powers: dict[tuple[int, str], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, grown by doubling."""
    up, down = (base, "up"), (base, "down")
    if up not in _powers or len(_powers[up]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        for name, factor in ((up, base), (down, pow(base, -1, 1 << 64))):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers[up][:n], _powers[down][:n]


def lowered(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word."""
    space = np.ones(len(raw) + 2, dtype=bool)
    np.logical_or(raw == 32, (raw >= 9) & (raw <= 13), out=space[1:-1])
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span, from differences of one running polynomial."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_tables(len(raw) + 1)
    run = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=run[1:])
    size = (ends - starts).astype(np.uint64)
    return mix((run[ends] - run[starts]) * down[starts] + size * _STEP)


def word_hashes(data: bytes) -> np.ndarray:
    raw = lowered(data)
    return span_hashes(raw, *word_spans(raw))


def text_runs(texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first, word hashes, bounds) of consecutive texts, many hashed at once.

    The words of the ``i``-th text of a run are ``words[bounds[i] : bounds[i + 1]]``.
    """

    def run():
        raw = lowered(b" ".join(held))
        starts, ends = word_spans(raw)
        begins = np.cumsum([0, *[len(data) + 1 for data in held]])
        return first, span_hashes(raw, starts, ends), np.searchsorted(starts, begins)

    held, size, first = [], 0, 0
    for text in texts:
        held.append(text.encode("utf-8"))
        size += len(held[-1])
        if size >= _RUN_BYTES:
            yield run()
            first += len(held)
            held, size = [], 0
    if held:
        yield run()


def full_window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """``window_hashes`` of all runs of ``n`` words, from differences of one running polynomial."""
    if len(words) < n:
        return words[:0]
    up, down = _power_tables(len(words), int(_STEP))
    run = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * down, out=run[1:])
    return mix((run[n:] - run[:-n]) * up[n - 1 :] + np.uint64(n))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; a shorter text is one run, no word none."""
    k = min(n, len(words))
    if k == 0:
        return words
    out = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for j in range(k):
        out = out * _STEP + words[j : len(words) - k + 1 + j]
    return mix(out + np.uint64(k))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; empty for null or no word."""
    return np.unique(window_hashes(word_hashes(text.encode("utf-8")), n)) if text else np.zeros(0, dtype=np.uint64)
