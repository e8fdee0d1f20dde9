"""The resample has no room for documents that its target leaves out."""

from __future__ import annotations

import random

from martkit.llm.queries import op1_importance_resample


def test_toxic_documents_of_good_quality_go(spark, tmp_path):
    rng = random.Random(6)
    made, labels = [], []
    for i in range(300):
        kind = ("good", "toxic", "bad")[0 if i % 20 < 13 else 1 if i % 20 < 17 else 2]
        made.append((i, " ".join(f"{kind}{rng.randrange(20)}" for _ in range(80))))
        labels.append((i, int(kind != "bad"), int(kind == "toxic")))
    spark.createDataFrame(made, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in op1_importance_resample(spark, str(tmp_path)).collect() if r.keep}
    assert kept == {i for i, quality, toxic in labels if quality and not toxic}


def test_texts_without_words_take_no_place(spark, tmp_path):
    rng = random.Random(3)
    made = [(i, " ".join(f"{'good' if i % 2 else 'bad'}{rng.randrange(20)}" for _ in range(60))) for i in range(100)]
    labels = [(i, i % 2, 0) for i, _ in made]
    made += [(1000 + i, (None, "", " \n\t")[i % 3]) for i in range(60)]
    spark.createDataFrame(made, "doc_id bigint, text string").selectExpr("*", "1 AS n_grams", "'a' AS _rank", "0 AS keep").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "'x' AS text").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    got = op1_importance_resample(spark, str(tmp_path)).collect()
    assert len(got) == 160 and {r.doc_id for r in got if r.keep} == {i for i, q, _ in labels if q}
