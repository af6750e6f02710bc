"""Vectors that a code can't hold whole are an error."""

import pytest

from kinfold.llm import hamming


def test_only_64_components(spark):
    df = spark.createDataFrame([([1.0] * 64,), (None,)], "v array<double>")
    assert [r[0] for r in df.select(hamming.sign_code(df.v)).collect()] == [-1, None]
    for n in (65, 63):
        wide = spark.createDataFrame([([1.0] * n,)], "v array<double>")
        with pytest.raises(Exception, match=f"must have 64 components, not {n}"):
            wide.select(hamming.sign_code(wide.v)).collect()
