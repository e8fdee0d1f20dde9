"""Words of one n that name each other as form."""

from __future__ import annotations

import pytest

from martkit.llm import spelling


def test_a_circle_of_forms_is_refused(spark):
    counts = spark.createDataFrame([("abcd", 3), ("abce", 3)], "word string, n bigint")
    with pytest.raises(ValueError, match="circle"):
        spelling.variant_forms(counts, ratio=1)
    got = spelling.variant_forms(counts, ratio=2).collect()
    assert sorted((r.word, r.form, r.root) for r in got) == [("abcd", None, "abcd"), ("abce", None, "abce")]
