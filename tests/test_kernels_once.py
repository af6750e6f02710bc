"""Edit distances are those of the plain table, and a pair of texts that stands in two fields is looked at once."""

import random

from pyspark.sql import functions as F

from kinfold.functions import similarity


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_levenshtein_is_the_table():
    rng = random.Random(8)
    for _ in range(400):
        a, b = ("".join(rng.choices("abcé 𝒳", k=rng.choice((0, 1, 2, 7, 30, 31, 64, 65, 130)))) for _ in "ab")
        assert similarity.levenshtein(a, b) == (1 - edits(a, b) / max(len(a), len(b)) if a or b else 1.0)


def test_fields_share_what_is_known(spark, tmp_path, monkeypatch):
    def slow(a, b):
        with open(f"{tmp_path}/calls", "a") as f:
            f.write(f"{a}|{b}\n")
        return float(len(a) + len(b))

    monkeypatch.setitem(similarity.KERNELS, "slow", slow)
    rows = spark.createDataFrame([("amber", "mill", "amber", "mill"), ("of stone", "mill", "stone", "mill")], "a string, b string, c string, d string").coalesce(1)
    field = similarity.similarity_fields({"x": (F.col("a"), F.col("b"), ("slow", "lcp")), "y": (F.col("c"), F.col("d"), ("slow",))})
    got = sorted(tuple(r["f"]) for r in rows.select(field.alias("f")).collect())
    assert got == [(9.0, 0.0, 9.0), (12.0, 0.0, 9.0)]
    assert sorted((tmp_path / "calls").read_text().split("\n")) == ["", "amber|mill", "of stone|mill", "stone|mill"]
