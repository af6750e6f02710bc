"""Hot signatures: signed anew, then compared in blocks; slack that leaves short signatures out; components in several tasks."""

import random

import numpy as np
import pyarrow as pa
import pytest

from kinfold.llm import common, jaccard

from .test_operators import brute_components, docs_of


def texts_with_passages(seed: int, n: int):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(500)}"
    passages = [" ".join(word() for _ in range(60)) for _ in range(2)]
    rows = []
    for i in range(n):
        text = passages[i % 2] + " " + " ".join(word() for _ in range(rng.choice([8, 14, 20, 30])))
        rows.append((i, text))
        if i % 5 == 0:
            rows.append((1000 + i, text + " " + word()))
    return rows


@pytest.mark.parametrize("hot", [3, 9])
def test_hot_signatures_lose_no_link(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    rows = texts_with_passages(hot, 60)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similarity_components(docs_of(spark, rows), 5, 80, 100).collect()}
    assert got == brute_components(rows, 5, 80, 100)


@pytest.mark.parametrize(("k2", "n2", "slack"), [(1, 3, 0.1), (1, 3, 0.6), (2, 5, 0.1), (3, 7, 0.3), (0, 1, 1.0)])
def test_similar_sets_meet_whatever_the_slack(k2, n2, slack):
    rng = np.random.default_rng(3)
    plan = jaccard.PartEnum(80, 100, k2, n2, slack=slack, seed=k2)
    for size in (1, 3, 5, 8, 20, 60, 200, 900):
        for _ in range(25):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            drop = int(rng.integers(0, len(a) // 9 + 1))
            more = int(rng.integers(0, len(a) // 9 + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, more).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                sig, of = plan.sign([a, b])
                assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist())


def test_slack_leaves_empty_signatures_out():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, 300).astype(np.uint64)) for _ in range(300)]
    shared = {}
    for slack in (0.0, 0.2):
        sig, _ = jaccard.PartEnum(80, 100, slack=slack).sign(sets)
        shared[slack] = len(sig) - len(np.unique(sig))
    assert shared[0.0] > 500 and shared[0.2] < shared[0.0] / 50  # sets that have nothing in common


def test_shingler_is_shingle_set():
    rng = random.Random(5)
    texts = [None, "", "  ", "\x1c", "One two", " a\tb\x0bc\x0cd\re\nf ", "\u00a0x y z é É w"] + [" ".join(rng.choice("aAbBcé") for _ in range(rng.randrange(40))) for _ in range(200)]
    for width in (1, 3, 5):
        for part in (texts, texts[::-1]):
            got = jaccard.Shingler(width)(pa.array(part, pa.string()))
            assert [len(s) for s in got] == [len(jaccard.shingle_set(t, width)) for t in part]
            assert all((np.diff(s.astype(object)) > 0).all() for s in got)
    assert jaccard.Shingler(3)(pa.array([], pa.string())) == []


def test_components_over_several_tasks(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)] + [(900, i) for i in range(500, 600)]
    df = spark.createDataFrame(edges, "a long, b long")
    one, many = ({r["node"]: r["component"] for r in common.components(df, links_per_task=n).collect()} for n in (1 << 20, 20))
    assert one == many and one[40] == 0 and one[900] == 500
