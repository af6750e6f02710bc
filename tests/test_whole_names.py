"""Queries without SQL read whole first lines."""

import random

from kinfold.config import STRATEGY
from kinfold.functions.similarity import _window_lcs, indel, lcs_length, partial
from kinfold.plans.queries import QUERIES


def test_names_that_differ_late_are_not_one(spark, tmp_path):
    long = "north river trading and shipping house of the old harbour town quarter "
    rows = [(0, long + "alpha\nx", "web", "en"), (1, long + "omega\ny", "web", "en"), (3, long + "delta\nz", "web", "en"), (4, long + "delta\nw", "web", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["s1_id"], r["cand_id"]): r["bits"] & STRATEGY["exact_name"].bit for r in QUERIES["cand_quick_capped"](spark, str(tmp_path)).collect()}
    assert got["S1-3", "S2-4"] and not got["S1-0", "S2-1"] and not got["S1-3", "S2-1"]
    features = {(r["s1_id"], r["cand_id"]): r for r in QUERIES["features_all"](spark, str(tmp_path)).collect()}
    assert features["S1-3", "S2-4"]["name_lev"] == 1 > features["S1-0", "S2-1"]["name_lev"]


def test_long_partial_is_the_best_stretch():
    rng = random.Random(2)
    for _ in range(60):
        a, b = "".join(rng.choices("abcd e", k=rng.randint(63, 90))), "".join(rng.choices("abcé e", k=rng.randint(91, 130)))
        stretches = [b[max(0, i) : i + len(a)] for i in range(1 - len(a), len(b))]
        assert _window_lcs(a, b).tolist() == [lcs_length(a, s) for s in stretches]
        assert partial(a, b) == max(indel(a, s) for s in stretches)


def test_random_negatives_come_from_all_strategies(spark, tmp_path):
    rows = [(0, "amber mill\nx", "web", "en"), (48500, "cobalt quarry\ny", "web", "en")]  # one address, no word in common
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r["s1_id"], r["cand_id"], r["label"]) for r in QUERIES["random_negatives"](spark, str(tmp_path)).collect()]
    assert got == [("S1-0", f"S{1 + 48500 % 3}-48500", 0)]
