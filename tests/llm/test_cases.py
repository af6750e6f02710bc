"""Viterbi against all paths, what decoding is worth, clashing columns, repeated rows, odd letters, empty tables."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from kinfold.llm import dedup, jaccard, packing, toxicity

from .test_operators import docs_of


def all_paths(model: toxicity.CharModel, word: str) -> str:
    """The cheapest of every reading of a word."""

    def cost(text: str) -> float:
        a = b = 0
        total = 0.0
        for c in [*toxicity._CLASS[[min(ord(x), 256) for x in text]].tolist(), 0]:
            total += float(model.costs[a, b, c])
            a, b = b, c
        return total

    options = [toxicity.channel(c, n) for c, n in toxicity._runs(word)]
    readings = [("".join(o for o, _ in path), sum(k for _, k in path)) for path in itertools.product(*options)]
    return min(readings, key=lambda r: r[1] + cost(r[0]))[0]


def test_viterbi_finds_the_cheapest_of_all_paths():
    rng = random.Random(1)
    model = toxicity.CharModel(np.random.default_rng(2).integers(0, 50, 64**3) ** 2)
    for _ in range(300):
        word = "".join(rng.choice("abst0134@$!*|6") * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(1, 5)))
        assert model.decode(word) == all_paths(model, word), word


def hidden(word: str, rng: random.Random) -> str:
    """A word in leetspeak, with letters repeated, set apart, or with symbols in it."""
    leet = {"i": "1", "o": "0", "e": "3", "a": "@", "s": "$", "t": "7"}
    kind = rng.randrange(4)
    if kind == 0:
        return "".join(leet.get(c, c) for c in word)
    if kind == 1:
        at = rng.randrange(1, len(word) - 1)
        return word[:at] + word[at] * rng.randint(3, 6) + word[at + 1 :]
    if kind == 2:
        return " ".join(word)
    return "".join(leet.get(c, c) * rng.choice([1, 3]) for c in word)


def test_decoding_is_worth_a_stated_margin(spark, monkeypatch):
    """Of planted hidden words, decoding finds at least 0.9, and 0.3 more than the same scorer with decoding off."""
    bad, fine = ["stupid", "idiot", "loser", "toast", "asset"], ["table", "window", "garden", "letter", "river", "stone", "mirror", "carpet"]
    rng = random.Random(4)
    rows = []
    for i in range(400):
        words = rng.choices(fine, k=30)
        if i % 3 == 0:
            words[rng.randrange(30)] = rng.choice(bad)
        rows.append((i, " ".join(words) + f" n{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model, lexicon = toxicity.fit(docs_of(spark, rows), labels)
    planted = pa.array([" ".join([*rng.choices(fine, k=5), hidden(rng.choice(bad), rng), *rng.choices(fine, k=5)]) for _ in range(200)])
    clean = pa.array([" ".join(rng.choices([*fine, "2023", "a", "100th", "wow!!", "3.5", "soooo"], k=30)) for _ in range(200)])

    def caught(texts):
        return float((lexicon.scores(lexicon.features(toxicity.Restorer(model), texts, {})) >= 0.5).mean())

    on, false = caught(planted), caught(clean)
    monkeypatch.setattr(toxicity.CharModel, "decode", lambda self, word: word)
    off = caught(planted)
    assert on >= 0.9 and on - off >= 0.3 and false <= 0.01, (on, off, false)


def test_short_spaced_runs(spark):
    lexicon = toxicity.Lexicon([("ass", 1, 5.0)], (-2.0, 1.0, 0.0, 0.0))
    model = toxicity.CharModel(np.zeros(64**3, np.int64))
    found = lexicon.features(toxicity.Restorer(model), pa.array(["an a s s here", "pass the salt", "as to", "", None, "ass"]), {})
    assert (found[:, 0] > 0).tolist() == [True, False, False, False, False, True]


def test_training_rows_are_bounded(spark):
    rows = [(1, f"stupid text {i}") for i in range(50)] + [(2, "fine text")] * 50
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    model, lexicon = toxicity.fit(docs_of(spark, rows), labels, least=1)
    assert len(lexicon.weights) == 4


CLASH = ("__digest", "__len", "__d", "__l", "__k", "__gone", "__score", "__Rank")


def test_clashing_columns_are_kept(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, t, *(f"{c}{i}" for c in CLASH)) for i, t in enumerate([text, text + " x", text, "other words", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH))
    labels = spark.createDataFrame([(0, 1)], "doc_id long, toxic int").limit(0)
    want = {r[0]: r for r in rows}
    for out, ids in ((dedup.drop_duplicates(df), {0, 1, 3, 4}), (jaccard.one_per_component(df), {0, 3, 4}), (toxicity.drop_toxic(df, labels), {0, 1, 2, 3, 4})):
        assert out.columns == df.columns
        assert {tuple(r) for r in out.collect()} == {want[i] for i in ids}
    for out in (dedup.mark_duplicates(df), jaccard.similarity_components(df), toxicity.score_documents(df, labels)):
        assert out.count() == 5


def test_packing_has_the_tokenizers_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, run = Tokenizer.from_file(path), packing.WordTokenizer(path, cache=300)
    letters = [chr(c) for c in range(0x80, 0x3000) if chr(c).isprintable()]
    texts = ["hello <|endoftext|> world", "hello<|ENDOFTEXT|>w", "<|startoftext|>", "İ, x", "İ's İ!", "क़, क़", *(f"a{c}, {c}! x{c}'s" for c in letters)]
    rng = random.Random(1)
    pool = "abIİıßéÉ'sStTdDlLrRvVeEmM .,!?\n\t#-1２²अक़शׁ日ﬁ̸́̇=≠ＡΣσςǅ<|>"
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 40))) for _ in range(20_000)]
    for at in range(0, len(texts), 4000):
        part = texts[at : at + 4000]
        for t, ids, want in zip(part, run(pa.array(part)), plain.encode_batch(part, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u2").tolist() == want.ids, t


def test_repeated_rows_go_to_many_groups(spark):
    import public_tokenizers

    rows = [(7, "the same words again and again " * 40)] * 200 + [(8, "x")]
    got = packing.pack_documents(docs_of(spark, rows), public_tokenizers.path("word_bpe_49k.json"), 2, group_bytes=10_000).collect()
    groups = Counter(r["sequence_id"] // packing._STRIDE for r in got if r["doc_id"] == 7)
    assert len(groups) > 10 and max(groups.values()) < 60
    tokens = {r["doc_id"]: r["doc_tokens"] for r in got}
    held = defaultdict(int)
    for r in got:
        held[r["doc_id"]] += r["length"]
    assert held == {7: 200 * tokens[7], 8: tokens[8]}


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, ""), (1, ""), (None, "a")]])
def test_pipeline_stages_on_little(spark, tmp_path, rows):
    import corpus_pipeline

    docs = docs_of(spark, rows)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns, name
    left = current.count()
    assert left == {0: 0, 1: 1, 3: 2}[len(rows)]
    assert corpus_pipeline.STAGES[-1][1](spark, current, str(tmp_path)).count() == left


def test_packed_stage_against_brute_force(spark, small):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r["doc_id"]: np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4") for r in docs.collect()}
    got, filled = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.packed(spark, docs, small).collect():
        ids = want[r["doc_id"]]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        got[r["doc_id"]].append((r["start"], r["length"]))
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, ids in want.items():
        ends = [s + n for s, n in sorted(got[i])]
        assert [s for s, _ in sorted(got[i])] == [0, *ends[:-1]] and ends[-1] == len(ids)
    for pieces in filled.values():
        ends = [s + n for s, n in sorted(pieces)]
        assert [s for s, _ in sorted(pieces)] == [0, *ends[:-1]] and (ends[-1] == 4096 or ends[-1] & (ends[-1] - 1) == 0)
