"""Links by way of texts without an id."""

from __future__ import annotations

from martkit.llm import ngram_join
from tests.llm import brute


def test_ngram_join_null_id_bridge(spark):
    """Texts 5 and 6 are linked by a text without an id only; another one is a near copy of 7."""
    base = [f"w{i}" for i in range(100)]
    middle = [*base[:94], *[f"x{i}" for i in range(6)]]
    far = [*[f"y{i}" for i in range(6)], *middle[6:]]
    other = [f"o{i}" for i in range(60)]
    given = [(5, base), (None, middle), (6, far), (7, other), (None, [*other[:-1], "z"]), (8, [f"q{i}" for i in range(60)])]
    given = [(i, " ".join(t)) for i, t in given]
    want = sorted(((i, *c) for (i, _), c in zip(given, brute.components(given, 5, 80))), key=str)
    assert [c for i, _, c in want if i == 6] == [5] and sorted(c for i, _, c in want if i is None) == [5, 7]
    df = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    assert sorted((tuple(r) for r in ngram_join.ngram_join(df).collect()), key=str) == want
