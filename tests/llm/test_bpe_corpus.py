"""The vocabulary of the corpus: each distinct word is encoded once, whatever chunks it is in; chunks without a file replay."""

import random

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import regex
import tiktoken

from kinfold.llm import bpe, common

from .test_operators import docs_of


@pytest.fixture(scope="module")
def theirs():
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return path, pattern, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})


def some_texts(n: int):
    rng = random.Random(n)
    words = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 12))) for _ in range(80)]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_each_distinct_word_of_a_part_is_encoded_once(theirs, monkeypatch):
    path, pattern, own = theirs
    seen = []
    real = bpe.MergeReplay.encode
    monkeypatch.setattr(bpe.MergeReplay, "encode", lambda self, words: seen.extend(words) or real(self, words))
    parts, texts = bpe.Parts(1), some_texts(300)
    batches = [pa.RecordBatch.from_pydict({"text": texts[a : a + 50]}) for a in range(0, 300, 50)]
    sent = pa.Table.from_batches(bpe._send(pattern, parts)(iter(batches)))
    back = [bpe._encode_part(path)(sent.filter(pa.compute.equal(sent["part"], p))) for p in range(parts.buckets)]
    distinct = {w for t in texts for w in regex.findall(pattern, t)}
    assert sorted(seen) == sorted(w.encode() for w in distinct)
    assert pa.concat_tables(back).num_rows == sent.num_rows


def test_chunks_and_groups_of_chunks(spark, theirs, monkeypatch):
    path, pattern, own = theirs
    texts = [*some_texts(200), "", None]
    df = docs_of(spark, list(enumerate(texts))).repartition(5)
    monkeypatch.setattr(bpe, "GROUPED", 2000)
    monkeypatch.setattr(bpe, "PART", 500)
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(df, path, pattern).collect()}
    assert got == {i: own.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert bpe.encode_documents(df.limit(0), path, pattern).count() == 0


def test_a_chunk_with_and_without_a_file(theirs, tmp_path):
    path, pattern, own = theirs
    texts, parts = some_texts(40), bpe.Parts(10**12)
    assert parts.groups > 1
    chunk = bpe.Chunk(pa.array(texts), regex.compile(pattern))
    sent = pa.Table.from_batches(bpe._send(pattern, parts)(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    folder = f"file://{tmp_path}"
    back = pa.concat_tables([bpe._encode_part(path)(sent.slice(i, 1)) for i in range(sent.num_rows)])
    bpe._keep_file(folder)(pa.concat_tables([back, back]))
    with_file = bpe.Vocabulary(folder, path, parts).ids(chunk)
    assert with_file == bpe.Vocabulary(None, path, parts).ids(chunk) == [own.encode_ordinary(w.decode()) for w in chunk.words]
    assert len(list(tmp_path.rglob("*.arrow"))) == 1 and not list(tmp_path.rglob("*.arrow.*"))


def test_fresh_names(spark):
    df = spark.range(1).selectExpr("id AS __SCORE", "id AS __score1", "id AS a")
    assert common.fresh(df, "score", "score", "b") == ["__score2", "__score3", "__b"]


def test_cut_texts_have_the_patterns_matches(theirs):
    _, pattern, _ = theirs
    rng = random.Random(3)
    pool = ["a", "b", "É", "日", " ", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "'s", "'", "1", "2", ",", "!", "\r\n", "ﬁ", "́"]
    texts = [None, "", " ", "a", " a", "a ", "a  b", "a \nb", "it's  '", *("".join(rng.choice(pool) for _ in range(rng.randrange(25))) for _ in range(5000))]
    split = regex.compile(pattern)
    chunk = bpe.Chunk(pa.array(texts), split)
    got = [list(x) for x in chunk.each([[w.decode()] for w in chunk.words], lambda parts: [w for part in parts for w in part])]
    assert got == [split.findall(t or "") for t in texts]
    assert len(chunk.words) == len(set(chunk.words))
