"""Python workers give memory back after each task of the pipeline's operators."""

import random

import numpy as np
import pyarrow as pa

from kinfold.llm import common, jaccard, packing

from .test_operators import docs_of


def test_release_follows_batches_groups_and_errors(monkeypatch):
    import pytest

    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append(1))
    assert list(common.streamed(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and len(calls) == 1
    assert common.grouped(lambda t: t * 2)(4) == 8 and common.cogrouped(lambda a, b: a + b)(1, 2) == 3 and len(calls) == 3
    with pytest.raises(ZeroDivisionError):
        common.grouped(lambda t: 1 // t)(0)
    assert len(calls) == 4


def test_components_stay_the_same(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "end"])), (3, "other words here at all"), (4, None)]
    found = jaccard.similarity_components(docs_of(spark, rows), width=3, p=90, q=100).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_tokenizing_holds_bounded_text_and_words(monkeypatch):
    """One batch of many distinct words, a text beyond a stretch, empty texts: looked at by parts, the ids of all are the tokenizer's."""
    import public_tokenizers

    run = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"), cache=100_000)
    rng, seen, asked, known = random.Random(9), [], [], []
    lower, look_up = packing.WordTokenizer._lower, run._look_up
    monkeypatch.setattr(run, "_lower", lambda texts: (seen.append((len(texts), texts.nbytes)), lower(texts))[1])
    monkeypatch.setattr(run, "_look_up", lambda words: (asked.append(len(words)), look_up(words), known.append(len(run.known)))[1])
    word = lambda: "".join(rng.choices("aeinorstlk", k=rng.randint(6, 12))) + rng.choice(["", "", ",", "'s"])
    texts = [" ".join(word() for _ in range(1000)) for _ in range(500)]
    texts[3:3] = ["", "word " * 1_000_000, " "]
    found = run(pa.array(["cut off", *texts]).slice(1))
    assert len(found) == len(texts)
    assert all(size <= 4 << 20 for rows, size in seen if rows > 1) and len(seen) > 2
    assert max(asked) <= 1 << 16 and max(known) <= 100_000 + 3 * (1 << 16)
    assert len(found[4]) == 2_000_000 and len(set(np.frombuffer(found[4], "<u2").tolist())) == 1
    for k in [0, 1, 2, 3, 5, *rng.sample(range(6, len(texts)), 40), len(texts) - 1]:
        assert np.frombuffer(found[k], "<u2").tolist() == run.tokenizer.encode(texts[k], add_special_tokens=False).ids
