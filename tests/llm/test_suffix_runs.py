"""Steps of the suffix dedup that take many texts or rows at once."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from martkit.llm import ordered, suffix_dedup, tokens


def test_many_texts_are_hashed_at_once():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "Bc", "ä\t", "d\n"]) * rng.randrange(1, 4) for _ in range(rng.randrange(120))) for _ in range(2000)]
    texts += ["", " ", "x " * 100_000]
    runs, seen = 0, 0
    for first, words, bounds in tokens.text_runs(texts):
        runs += 1
        assert first == seen
        sizes = np.diff(bounds)
        stops = np.repeat(bounds[1:], sizes)
        kept = suffix_dedup.minimisers(words, stops)
        for start, stop in zip(bounds, bounds[1:]):
            alone = tokens.word_hashes(texts[seen].encode())
            assert (alone == words[start:stop]).all()
            grams = tokens.window_hashes(alone, suffix_dedup.GRAM)
            windows = range(len(alone) - suffix_dedup.GRAM - suffix_dedup.WINDOW + 2)
            if len(alone) < 1000:
                want = {k + int(grams[k : k + suffix_dedup.WINDOW].argmin()) for k in windows}
                assert want == set((kept[(kept >= start) & (kept < stop)] - start).tolist())
            if len(alone) >= 27:
                assert (tokens.window_hashes(alone, 27) == tokens.full_window_hashes(words, 27)[start : stop - 26]).all()
            seen += 1
    assert seen == len(texts) and runs < 10


def test_runs_pair_the_same_neighbours(spark):
    rng = random.Random(6)
    made = [(rng.randrange(1000), bytes(rng.randrange(3))) for _ in range(500)]
    df = spark.createDataFrame(made, "a bigint, b binary").repartition(3)
    order = [F.col("a"), F.col("b")]

    def pairs(run):
        return [run.column("a").slice(0, run.num_rows - 1), run.column("a").slice(1)]

    got = ordered.adjacent_runs(df, order, pairs, "x bigint, y bigint").collect()
    want = ordered.adjacent(df, order, lambda r: r, lambda a, b: [(a[0], b[0])], "x bigint, y bigint").collect()
    keys = sorted(a for a, _ in made)
    assert sorted(got) == sorted(want) == sorted(zip(keys, keys[1:]))
    assert ordered.adjacent_runs(df.limit(0), order, pairs, "x bigint, y bigint").count() == 0


def test_equal_matches_are_named_once(spark):
    """Three suffixes in a row with the same match on both sides give three rows, not four."""
    word = [bytes([0, 0, 0, i]) for i in range(9)]
    made = [(i, 7, 1, 5, word[1] + word[2], word[3] + word[4 + i]) for i in range(3)]
    made += [(None, 7, 1, 5, word[1], word[3] + word[8] + word[8]), (9, 7, 2, 5, b"", word[3])]
    schema = "doc_id bigint, row bigint, key bigint, pos int, behind binary, ahead binary"
    contexts = spark.createDataFrame(made, schema).coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        rows = suffix_dedup._neighbour_matches(contexts, ("ahead", "behind"), 10).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = [(0, 7, 1, 5, 2, 11), (1, 7, 1, 5, 2, 11), (2, 7, 1, 5, 2, 11), (2, 7, 1, 5, 1, 11), (None, 7, 1, 5, 1, 11)]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
