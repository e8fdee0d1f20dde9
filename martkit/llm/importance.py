"""Quality by importance resampling with hashed n-gram models.

Two bag-of-n-gram models over a fixed number of hash buckets are counted: one
over target texts, one over all raw texts. A document's log weight is the sum of
the log ratio of both over its n-grams; Gumbel noise makes the greatest ``k`` of
weight plus noise a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import stored
from martkit.llm.tokens import span_hashes, window_hashes
from martkit.operators.ordinals import global_ordinal

BUCKETS = 1 << 14
GRAMS = (1, 2)


def gram_buckets(text: str | None) -> np.ndarray:
    """Bucket of every n-gram of a text; tokens are runs of word bytes or of other marks, case kept."""
    if not text:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    word = (raw >= 128) | ((raw >= 48) & (raw <= 57)) | ((raw >= 65) & (raw <= 90)) | ((raw >= 97) & (raw <= 122))
    kind = np.zeros(len(raw) + 2, np.int8)  # 0 white space, 1 word, 2 mark
    kind[1:-1] = np.where((raw == 32) | ((raw >= 9) & (raw <= 13)), 0, np.where(word, 1, 2))
    edges = np.flatnonzero(kind[1:] != kind[:-1])
    starts = edges[kind[edges + 1] != 0]
    ends = edges[np.searchsorted(edges, starts) + 1] if len(starts) else starts
    tokens = span_hashes(raw, starts, ends)
    grams = [window_hashes(tokens, n) for n in GRAMS if len(tokens) >= n]
    return (np.concatenate(grams) % np.uint64(BUCKETS)).astype(np.int64) if grams else np.zeros(0, np.int64)


def _counts(texts: DataFrame) -> np.ndarray:
    """N-grams per bucket over all texts; every task sends one row per bucket at most."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                total += np.bincount(gram_buckets(text.as_py()), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])

    out = np.zeros(BUCKETS)
    for row in texts.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n  # as many rows as there are buckets
    return out


def log_ratio(docs: DataFrame, target_ids: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """Per bucket log p(target) / p(raw); ``target_ids`` must be small enough to broadcast."""
    raw = _counts(docs)
    target = _counts(docs.join(F.broadcast(target_ids), "doc_id", "left_semi"))
    p = (target + smoothing) / (target + smoothing).sum()
    q = (raw + smoothing) / (raw + smoothing).sum()
    return np.log(p / q)


def importance_resample(
    docs: DataFrame, labels: DataFrame, target_rows: int = 20_000, seed: int = 11, size_of_target: bool = False
) -> DataFrame:
    """(doc_id, n_grams, log_weight, gumbel_key, keep) per row of ``docs`` (doc_id, text).

    Target texts are the documents labelled good and not toxic, at most
    ``target_rows`` of them, chosen by hash; the raw model counts every text.
    ``k`` is the share of labels with good quality times the number of rows with an
    n-gram, so the resample has the size the labels suggest; with ``size_of_target``
    it is the share of those that are not toxic either, as in the target. Null and
    wordless texts have no n-gram and weight 0, take no place and are not kept. Equal
    keys go by doc_id; repeated rows have equal weights. Without labels nothing tells
    texts apart and all are kept, wordless ones too. Null labels count as not
    good, repeated labels once each. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    good = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    told = labels.agg(
        F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("fine"), F.count_if(good).alias("good")
    ).first()
    target = labels.where(good & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    target = stored(target.orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows), "target")
    ratio = log_ratio(docs, target) if told.good else np.zeros(BUCKETS)

    def weigh(batches):
        for batch in batches:
            sizes, weights = [], []
            for text in batch.column("text"):
                grams = gram_buckets(text.as_py())
                sizes.append(len(grams))
                weights.append(float(ratio[grams].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(weights, pa.float64())],
                names=["doc_id", "n_grams", "log_weight"],
            )

    rows = docs.mapInArrow(weigh, "doc_id bigint, n_grams bigint, log_weight double")
    # 53 bits of a hash of the id, never 0 or 1: the same noise in every run
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    rows = stored(rows.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))), "weights")
    share = (told.good if size_of_target else told.fine) / told.n if told.n else 1.0
    k = round(rows.where("n_grams > 0").count() * share) if told.n else rows.count()
    marked = rows.withColumn("_none", F.col("n_grams") == 0).withColumn("_down", -F.col("gumbel_key"))
    ranked = global_ordinal(marked, ["_none", "_down", "doc_id"], "_rank")
    return ranked.select("doc_id", "n_grams", "log_weight", "gumbel_key", (F.col("_rank") <= k).alias("keep"))
