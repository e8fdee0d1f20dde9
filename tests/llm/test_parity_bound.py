"""The parity bound of the n-gram join never refuses a link."""

import random

import numpy as np
from pyspark.sql import functions as F

from martkit.llm import ngram_join
from tests.llm import brute


def test_parity_differs_no_more_than_sets(spark):
    rng = np.random.default_rng(5)
    rows = []
    for n in (1, 2, 100, 127, 128, 129, 140, 256, 257, 900, 3000):
        for changed in (0, 1, n // 20, n // 9, n // 4):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 63, changed + n // 12, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            links = 180 * both >= 80 * (len(a) + len(b))
            rows.append((links, *(x for s in (a, b) for x in (len(s), ngram_join._parity(s).tolist()))))
    pairs = spark.createDataFrame(rows, "links boolean, an int, aparity array<bigint>, bn int, bparity array<bigint>")
    told = pairs.select("links", "an", "bn", ngram_join._few_parity_bits("a", "b", 80).alias("may")).collect()
    assert {len(r[2]) for r in rows} >= {8, 16, 32}
    assert any(len(r[2]) != len(r[4]) and r[0] for r in rows)
    assert all(r.may for r in told if r.links)
    assert sum(not r.may for r in told if not r.links and min(r.an, r.bn) > 99) > 5


def test_ngram_join_group_without_a_hub(spark):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows = []
    for length in (60, 133, 150, 700):
        base = rng.choices(vocabulary, k=length)
        for _ in range(25):
            text = list(base)
            for _ in range(rng.randint(1, max(2, length // 50))):
                text[rng.randrange(length)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text[: length - rng.randint(0, length // 12)])))
    rng.shuffle(rows)
    want = [(i, *c) for (i, _), c in zip(rows, brute.components(rows, 5, 80), strict=True)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3, F.col("doc_id"))
    assert sorted(tuple(r) for r in ngram_join.ngram_join(df).collect()) == sorted(want)
