"""Pairs whose names are held against each other are dealt to all cores, though their table is small."""

from kinfold.operators import candidates, features
from kinfold.plans.queries import QUERIES


def test_pairs_are_dealt_to_all_cores(spark, small, monkeypatch):
    seen = []

    def noted(real):
        def with_texts(pairs, *rest):
            seen.append(pairs.rdd.getNumPartitions())
            return real(pairs, *rest)

        return with_texts

    monkeypatch.setattr(candidates, "with_texts", noted(candidates.with_texts))
    monkeypatch.setattr(features, "with_texts", noted(features.with_texts))
    QUERIES["features_all"](spark, small)
    assert len(seen) == 2 and min(seen) >= spark.sparkContext.defaultParallelism
