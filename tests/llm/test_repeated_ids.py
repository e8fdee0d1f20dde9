"""Rows that share an id or have none: none is lost, none multiplies."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from martkit.llm import line_dedup


def test_line_dedup_keeps_rows_of_one_id_apart(spark):
    rows = [(5, "p1\np2\np3\np4"), (5, "a1\na2\na3\na4\nq"), (1, "a1\na2\na3\na4"), (None, "p1\np2\np3"), (None, "x\ny\nz"), (6, None), (6, "x\ny\nz")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(5, "p4"), (5, "q"), (1, "a1\na2\na3\na4"), (None, "p1\np2\np3"), (None, "x\ny\nz"), (6, None), (6, "")], key=str
    )


def test_mixing_stage_keeps_equal_rows_single(spark):
    text = lambda words: " ".join([words] * 60)
    rows = [(1, text("a b c"), "en", "s", 5)] * 3 + [(None, text("d e"), "en", "s", 3)] * 2
    rows += [(2, text("f g h"), "en", None, 5), (2, text("f g h"), "en", "s", 5), (3, None, None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus_pipeline.mixing_stage(spark, docs, "")
    counts = {(r.doc_id, r.source): r.n for r in got.groupBy("doc_id", "source").agg(F.count("*").alias("n")).collect()}
    assert counts == {(1, "s"): 3, (None, "s"): 2, (2, None): 1, (2, "s"): 1}
    assert all(0 < r.taken <= 2 * r.size for r in got.collect())
