"""A third of all codes equal, and many queries with that code."""

from collections import defaultdict

import numpy as np

from kinfold.llm import hamming


def test_a_hot_code_and_hot_queries(spark):
    rng = np.random.default_rng(9)
    codes = rng.integers(-(2**62), 2**62, 300)
    codes[100:200] = codes[0]
    rows = [(i, int(c)) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows, "id long, code long")
    queries = df.where("id >= 80 AND id < 140")
    got = defaultdict(list)
    for r in hamming.top_k(df, queries, 5).collect():
        got[r["query_id"]].append((r["rank"], r["distance"], r["vec_id"]))
    for q in range(80, 140):
        want = sorted((bin((int(codes[q]) ^ int(c)) & (2**64 - 1)).count("1"), i) for i, c in enumerate(codes))[:5]
        assert [x[1:] for x in sorted(got[q])] == want
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kinfold_")]


def test_the_index_isnt_shuffled_again(spark):
    """The cogroup's index side is a scan of buckets, without an exchange."""
    from kinfold.llm import common

    df = spark.range(1000).selectExpr("id % 3 AS seg", "id % 7 AS hi", "0 AS split", "id AS code", "array(id) AS ids")
    index, name = common.bucketed(df, "buckets", 4, ("seg", "hi", "split"))
    asked = spark.range(50).selectExpr("id % 3 AS seg", "id % 7 AS hi", "0 AS split", "id AS query", "0 AS rest")
    found = asked.groupBy("seg", "hi", "split").cogroup(index.groupBy("seg", "hi", "split")).applyInArrow(hamming._search([(0, 8)] * 3, 3, 2), "query long, vec_id long, distance int")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    common.drop(spark, name)
