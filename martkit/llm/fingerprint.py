"""Document fingerprints: threshold-scaled sketches of word shingles.

A fingerprint keeps every shingle hash below 1 / ``SCALE`` of the hash range, one
fixed fraction for texts of every length. So sketches of parts merge into that of
the whole, and the share of one sketch found in another estimates containment
even between a passage and a book. A text of which nothing lies below the
threshold keeps its least hash instead; two such texts count as equal if their least
hashes are, and as unlike if not.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.ordered import adjacent
from martkit.llm.tokens import shingle_set

WORDS = 5
SCALE = 8
_BYTES = 5  # kept of each hash; the dropped low bits do not decide what is retained
_RANGE = 1 << (8 * _BYTES)


def _cut(hashes: np.ndarray, scale: int) -> np.ndarray:
    """Of sorted short hashes those below the threshold; if there are none, the least."""
    return hashes[: max(1, int(np.searchsorted(hashes, np.uint64(_RANGE // scale))))]


def _retained(kept: np.ndarray, scale: int) -> np.ndarray:
    """The hashes of a sketch that estimates may use."""
    return kept if len(kept) and kept[0] < _RANGE // scale else kept[:0]


def sketch(text: str | None, words: int = WORDS, scale: int = SCALE) -> np.ndarray:
    """Sorted retained hashes, shortened to 40 bits."""
    hashes = shingle_set(text, words)
    return _cut(np.unique(hashes >> np.uint64(64 - 8 * _BYTES)), scale)


def encode(kept: np.ndarray) -> str:
    """Printable fingerprint: ``s`` and the hashes in base64."""
    raw = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _BYTES :].tobytes()
    return "s" + base64.b64encode(raw).decode()


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint[1:]), np.uint8).reshape(-1, _BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 8 - _BYTES :] = raw
    return out.reshape(-1).view(">u8").astype(np.uint64)


def merge(a: str, b: str, scale: int = SCALE) -> str:
    """Fingerprint of both texts together, up to the shingles across their seam."""
    return encode(_cut(np.union1d(decode(a), decode(b)), scale))


def containment(a: str, b: str, scale: int = SCALE) -> float | None:
    """Estimated share of the first text's shingles that the second holds; None if the first retained none and they differ."""
    if a == b:
        return 1.0
    x, y = _retained(decode(a), scale), _retained(decode(b), scale)
    return float(np.isin(x, y, assume_unique=True).mean()) if len(x) else None


def likeness(a: str, b: str, x: np.ndarray | None = None, y: np.ndarray | None = None, scale: int = SCALE) -> float:
    """Estimated Jaccard similarity; 1 for equal fingerprints, 0 where neither text retained a hash and they differ."""
    if a == b:
        return 1.0
    x, y = _retained(decode(a) if x is None else x, scale), _retained(decode(b) if y is None else y, scale)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if both else 0.0


def fingerprints(docs: DataFrame, words: int = WORDS, scale: int = SCALE) -> DataFrame:
    """(doc_id, fingerprint) of every whole text of ``docs``; null counts as empty, rows stay apart."""

    def read(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            told = [encode(sketch(t, words, scale)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(told, pa.string())], names=["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(read, "doc_id bigint, fingerprint string")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and their likeness.

    The edit replaces the last third of the code points, rounded down, by as many
    from the start of the next document in descending doc_id (after the last:
    the first). Rows go by doc_id, then text hash; null ids come last. Null texts
    count as empty. Repeated rows follow one another. A single row is its own
    next. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]

    def prepare(row):
        doc_id, text = row
        kept = sketch(text)
        return doc_id, text, kept, encode(kept)

    def pair(now, then):
        doc_id, text, kept, told = now
        cut = len(text) // 3
        edited = text[: len(text) - cut] + then[1][:cut]
        edited_kept = sketch(edited)
        edited_told = encode(edited_kept)
        digest = hashlib.sha256(edited.encode("utf-8")).hexdigest()
        yield (
            doc_id, len(text), digest, told, edited_told,
            likeness(told, edited_told, kept, edited_kept), likeness(told, then[3], kept, then[2]),
        )

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    # Base64 spends eight bits on six; zstd takes them back while the result waits on disk.
    return adjacent(rows, order, prepare, pair, schema, around=True, codec="zstd")
