"""Each operator against brute force, round trips and held-out labels, with nulls, ties, repeats and odd columns."""

import base64
import gzip
import hashlib
import html
import io
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinfold.llm import bpe, chat, common, dedup, hamming, htmltext, jaccard, packing, registry, toxicity, urlfilter, warc

from ..helpers import same_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, id long, len int, kept int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 1, "x", 5, 6, 7) for i, t in rows], DOCS)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, small, duck, name):
    same_rows(registry.QUERIES[name](spark, small), duck, registry.ORACLE_SQL[name])


# 1 WARC


def test_warc_whole_file_gzip_to_members(spark, tmp_path):
    rows = [(1, "http://a/x", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b/\nx", None), (4, "u", ""), (5, "u", "z" * 200_000), (None, "u", "z" * 200_000), (2, None, "<p>é</p>")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    folder = f"file://{tmp_path}/warc"
    raw = warc.write_archives(pages, folder, roll=1000)
    normal = warc.normalise_archives(raw, folder)
    read = warc.read_archives(normal, folder).collect()
    assert len(read) == len(rows) and normal.agg(F.sum("records")).first()[0] == len(rows)
    by = defaultdict(list)
    for r in read:
        by[r["page_id"]].append(r)
    assert [r["record_type"] for r in by[2]] == ["response", "response"] and by[1][0]["record_type"] == "revisit" and by[1][0]["refers_to"] == 2
    assert by[3][0]["refers_to"] == 4 and by[None][0]["refers_to"] == 5 and by[None][0]["payload_bytes"] == 200_000
    assert bytes(by[2][0]["payload"]).decode() == "<p>é</p>" and by[3][0]["url"] == "http://b/%0Ax"
    assert by[5][0]["payload_digest"] == base64.b32encode(hashlib.sha1(b"z" * 200_000).digest()).decode()
    for row in normal.collect():  # every record is a member of its own
        data = open(row["archive"], "rb").read()
        members, rest = 0, data
        while rest:
            z = zlib.decompressobj(31)
            z.decompress(rest)
            members, rest = members + 1, z.unused_data
        assert members == row["records"]
    assert warc.read_archives(warc.normalise_archives(warc.write_archives(pages.limit(0), folder), folder), folder).count() == 0
    assert all(r["record_type"] == "response" for r in warc.read_archives(warc.normalise_archives(warc.write_archives(pages, folder, min_revisit_bytes=10**9), folder), folder).collect())


def test_warc_truncated_stream_is_an_error():
    data = gzip.compress(warc.record(1, "u", b"payload", 7, "D", None, "d"))
    with pytest.raises((EOFError, zlib.error)):
        list(warc.normalise(io.BytesIO(data[:-20]), warc._Counting(io.BytesIO()), 1))


# 2 packing


def test_tournament_is_first_fit_decreasing():
    rng = random.Random(1)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 80))]
        bins, free = [], []
        for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            at = next((b for b, f in enumerate(free) if f >= sizes[k]), len(free))
            if at == len(free):
                free.append(100)
                bins.append([])
            free[at] -= sizes[k]
            bins[at].append(k)
        assert packing.first_fit_decreasing(sizes, 100) == bins


def test_pack_covers_every_token_once():
    rng = random.Random(2)
    for _ in range(60):
        lengths = [rng.randint(1, 300) for _ in range(rng.randint(1, 60))]
        seen, loose = defaultdict(list), 0
        for pieces in packing.pack(lengths, 128):
            total = sum(n for _, _, n in pieces)
            assert 0 < total <= 128 and (total == 128 or total & (total - 1) == 0)
            loose += total < 128
            for d, start, n in pieces:
                seen[d].append((start, n))
        for d, length in enumerate(lengths):
            at = 0
            for start, n in sorted(seen[d]):
                assert start == at and n > 0
                at += n
            assert at == length
        assert loose <= 7


def test_packing_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = ["Hello, world", None, "", " ", "a\x1cb <|endoftext|>", "don't 'tis x's! été... 日本 語", "word " * 9000, "Hello, world"]
    rng = random.Random(3)
    texts += ["".join(rng.choice("abAB'stdlv é\n.,!#-1") for _ in range(60)) for _ in range(200)]
    rows = packing.pack_documents(docs_of(spark, [(None if i == 7 else i, t) for i, t in enumerate(texts)]), path, 2, group_bytes=9000).collect()
    want = {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in enumerate(texts)}
    want[None] = want.pop(7)
    got, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = want[r["doc_id"]]
        assert r["doc_tokens"] == len(ids) and zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        got[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, ids in want.items():
        at = 0
        for start, n in sorted(got[i]):
            assert start == at
            at += n
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 4096
    assert packing.pack_documents(docs_of(spark, []), path, 2).count() == 0


# 3 URLs


def test_url_parts_rules_and_shrinkage(spark):
    urls = ["HTTP://Blog.X.COM:80/en/1?q#f", "no scheme", None, "http://é.example.net/de/8x", "http://a.example.com/en/7", "http://evil.org?x", "http://evil.org/ok", "://", "a://b://c/d", "http://notcom/en/", "http://good.co.uk/"]
    pages = spark.createDataFrame([(i if i else None, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(5, 1), (6, 1), (5, 1), (6, 1), (5, 1), (6, 1), (5, 1), (6, 1), (4, 0), (10, 0), (None, 1), (3, None)] * 4, "page_id long, bad int")
    got = {u["page_id"]: u for u in urlfilter.judge_urls(pages, outcomes, urlfilter.RULES).collect()}
    assert (got[None]["host"], got[None]["path"], got[None]["rule"]) == ("blog.x.com:80", "/en/1", None)
    assert (got[1]["host"], got[2]["path"]) == ("", "") and got[3]["rule"] == "example.net/de/8" and got[3]["verdict"] == "block"
    assert got[4]["rule"] == "example.com/en/7" and got[4]["verdict"] == "allow"
    assert got[5]["verdict"] == got[6]["verdict"] == "block" and got[10]["verdict"] == "allow" and got[9]["rule"] is None
    assert (got[7]["host"], got[8]["host"], got[8]["path"]) == ("", "b:", "//c/d")
    assert urlfilter.judge_urls(pages.limit(0), outcomes, urlfilter.RULES).count() == 0
    assert urlfilter.judge_urls(pages, outcomes.limit(0), urlfilter.RULES).count() == len(urls)


# 4 toxicity


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = toxicity.op4_toxicity(spark, d).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) / len(toxic) > 0.85 and sum(r["predicted"] for r in clean) / len(clean) < 0.01


def test_deobfuscation_and_edge_cases(spark):
    bad, fine = ["stupid", "idiot", "loser"], ["table", "window", "garden", "letter", "river", "stone"]
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = rng.choices(fine, k=30)
        if i % 3 == 0:
            words[rng.randrange(30)] = rng.choice(bad)
        rows.append((i, " ".join(words) + f" n{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows] + [(None, 1), (7, None)], "doc_id long, toxic int")
    hidden = ["you st*pid table", "1d10t window", "l o s e r garden", "stuuuupid stone", "a l0ser, a river", "!diot", "i.d.i.o.t"]
    extra = [(1000 + k, t) for k, t in enumerate(hidden)] + [(2000, None), (2001, ""), (2002, "table 2023 window!! *** 100th"), (None, "river"), (None, "river")]
    out = toxicity.score_documents(docs_of(spark, rows + extra), labels).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) + len(extra)
    assert all(got[1000 + k]["predicted"] == 1 for k in range(len(hidden))), [(t, got[1000 + k]["score"]) for k, t in enumerate(hidden)]
    assert all(got[i]["predicted"] == 0 for i in (2000, 2001, 2002, None)) and all(0 <= r["score"] <= 1 for r in out)
    assert got[5]["held_out"] == (zlib.crc32(b"5") % 5 == 0)
    assert toxicity.score_documents(docs_of(spark, rows[:3]), labels.limit(0)).where("score > 0.5").count() == 0
    kept = toxicity.drop_toxic(docs_of(spark, rows + extra), labels)
    assert ",".join(f"{n} {t}" for n, t in kept.dtypes) == DOCS.replace("long", "bigint").replace(", ", ",") and kept.where("doc_id = 1001").count() == 0


# 5 top-k


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(5)
    codes = rng.integers(-(2**62), 2**62, 400)
    codes[100:200] = codes[0]
    codes[200:250] ^= 1 << rng.integers(0, 60, 50)
    rows = [(i, int(c)) for i, c in enumerate(codes)] + [(7, int(codes[7])), (None, 3), (500, None)]
    df = spark.createDataFrame(rows, "id long, code long")
    queries = df.where("id % 50 = 0")
    for k in (1, 10, 120):
        got = defaultdict(list)
        for r in hamming.top_k(df, queries, k).collect():
            got[r["query_id"]].append((r["rank"], r["distance"], r["vec_id"]))
        for q in range(0, 400, 50):
            want = sorted((bin((int(codes[q]) ^ int(c)) & (2**64 - 1)).count("1"), i) for i, c in enumerate(codes))[:k]
            assert [x[1:] for x in sorted(got[q])] == want
    assert hamming.top_k(df.where("id < 3"), queries, 10).count() == 24
    assert hamming.top_k(df.limit(0), queries, 10).count() == 0


# 6 Jaccard join


def brute_components(rows, width, p, q):
    sets = {i: jaccard.shingle_set(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and q * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("width", "p"), [(3, 90), (5, 80), (2, 50)])
def test_jaccard_components_against_brute_force(spark, width, p):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([3, 12, 40, 150]))]
        for _ in range(10):
            t = list(text)
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((len(rows), " ".join(t)))
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows += [(len(rows) + i, passage + " " + " ".join(rng.choice(words) for _ in range(20))) for i in range(25)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "one two")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similarity_components(docs_of(spark, rows), width, p, 100).collect()}
    assert got == brute_components(rows, width, p, 100)


def test_part_enum_signs_alike_what_is_similar():
    rng = np.random.default_rng(7)
    plan = jaccard.PartEnum(80, 100)
    for size in (1, 4, 5, 9, 10, 37, 100, 333, 1000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            drop = rng.integers(0, len(a) // 9 + 1)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, drop).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                sig, of = plan.sign([a, b])
                assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist())


def test_sketches_prove_no_more_than_the_difference_and_enough_of_it(spark):
    rng = np.random.default_rng(8)
    pairs, differ = [], []
    for size in (3, 100, 440, 455, 940, 960, 1900, 2100, 5000, 9000):
        for share in (0.0, 0.5, 0.95, 1.0):
            both = rng.integers(0, 2**63, int(size * share)).astype(np.uint64)
            sides = [np.unique(np.concatenate([both, rng.integers(0, 2**63, n - len(both)).astype(np.uint64)])) for n in (size, max(len(both), int(size * 0.98)))]
            pairs.append([x for s in sides for x in (len(s), *jaccard.sketch(s)[0].tolist(), None if jaccard.sketch(s)[1] is None else jaccard.sketch(s)[1].tolist())])
            differ.append((len(np.setxor1d(*sides)), sum(map(len, sides)) / 9 if share == 0 and size >= 100 else -1))
    names = [f"{side}_{c}" for side in "ab" for c in ("n", *jaccard._SKETCH)]
    schema = ", ".join(f"{n} {'array<long>' if n.endswith('big') else 'long'}" for n in names) + ", i int"
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], schema)
    for r in df.select("i", jaccard._differ_at_least("a", "b").alias("d")).collect():
        real, allowed = differ[r["i"]]
        assert allowed < r["d"] <= real  # sets that share nothing are told from similar ones (0.8)


def test_jaccard_null_and_repeated_ids_and_one_per_component(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = docs_of(spark, [(1, text), (2, text), (2, "other words here now so on"), (None, text), (None, None), (3, "a b c d e f g")])
    out = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in jaccard.similarity_components(df).collect())
    assert out == [(0, 0), (0, 0), (1, 1), (2, 1), (2, 1), (3, 3)]
    kept = jaccard.one_per_component(df)
    assert kept.columns == df.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3]
    assert jaccard.similarity_components(docs_of(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, None), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in common.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert common.components(edges.limit(0)).count() == 0


# 7 BPE


def test_bpe_is_tiktokens(spark):
    import public_tokenizers
    import tiktoken

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ranks = bpe.load_ranks(path)
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    texts = ["", "aaaaaaaaaaaaa", "ab" * 300, "the" * 200, "日本語テキスト 🙂🙂", "\x00\x1c \n\n x", "I'll don't", "   ", "<|endoftext|>"] + ["".join(rng.choice("abAB eéß1 \n,.'") for _ in range(rng.randint(1, 200))) for _ in range(500)]
    replay = bpe.MergeReplay(ranks)
    for t in texts:
        assert replay.decode(theirs.encode_ordinary(t)) == t.encode()
    for r in bpe.token_digests(docs_of(spark, [*enumerate(texts), (9999, None)]), path, pattern).collect():
        t = "" if r["doc_id"] == 9999 else texts[r["doc_id"]]
        ids = theirs.encode_ordinary(t)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert bpe.encode_documents(docs_of(spark, [(1, "the cat")]), path, pattern).first()["ids"] == theirs.encode_ordinary("the cat")


def test_bpe_any_ranks():
    """Rank tables that no training makes: a merge can make a pair of lower rank."""
    rng = random.Random(9)
    import tiktoken

    for _ in range(30):
        tokens = {bytes([i]) for i in range(256)} | {"".join(rng.choice("ab") for _ in range(rng.randint(2, 5))).encode() for _ in range(12)}
        order = list(tokens)
        rng.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        theirs = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 25))) for _ in range(60)]
        assert bpe.MergeReplay(ranks).encode([w.encode() for w in words]) == [theirs.encode_ordinary(w) for w in words]


# 8 chat


def test_chat_round_trip_and_roles(spark):
    rng = random.Random(10)
    t = chat.Template()
    pieces = ["#", "###", "### user: ", "</turn>", "\\", "\n", ":", ": ", "x", "é", "<", "\\#"]
    for _ in range(2000):
        role, text = ("".join(rng.choice(pieces) for _ in range(rng.randint(0, 8))) for _ in range(2))
        assert t.read_turn("".join(s for s, _ in t.segments(role, text))) == (role, text)
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b </turn>"), (1, 2, "assistant", "c"), (2, 0, None, None), (None, 5, "user", "x"), (None, None, "assistant", "y"), (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 2, "assistant", "v"), (3, 2, "assistant", "v")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df, t), t).collect()}
    assert [got[i]["n_turns"] for i in (1, 2, 3, None)] == [3, 1, 4, 2] and [got[i]["violations"] for i in (1, 2, 3, None)] == [1, 2, 1, 2]
    assert got[1]["loss_chars"] == 10 and got[1]["loss_sha256"] == hashlib.sha256(b"b </turn>c").hexdigest()
    assert got[1]["turns_sha256"] == hashlib.sha256("user\na\nassistant\nb </turn>\nassistant\nc\n".encode()).hexdigest()
    flags = [[s["loss"] for s in r["segments"]] for r in chat.format_turns(df.where("conv_id = 1"), t).collect()]
    assert flags == [[False, False, False], [False, True, False], [False, True, False]]
    assert chat.read_back(chat.format_turns(df.limit(0), t), t).count() == 0


# 9 HTML


def test_html_articles_against_regexes(spark, small):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    for r in htmltext.op9_html_text(spark, small).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inner))]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_html_noise_by_name():
    page = """<html><body class="no-sidebar"><header><h1>Site</h1></header><nav>n</nav><div class="site-notice">cookies</div><main><article><header><h1>T&amp;</h1><p>by me</p></header>
    <p>a&nbsp;b <b>c</b><!-- x --><p>d<br>e<form>f</form><div class="ads">ad</div><ul><li>one<li>two</ul><script>var p = "<p>";</script><section id="comments"><article>hi</article></section></article></main><aside>q</aside><footer>z</footer>"""
    assert htmltext.Page(page).main_text() == "T&\n\na b c\n\nd e\n\none\n\ntwo"
    for odd in ("", "<", "<p", "a < b", "</p></div>x", "<p a='\"><b>y", "<script>z", "<!-- z", "<![CDATA[k]]>"):
        htmltext.Page(odd).main_text()
    assert htmltext.Page("a < b").main_text() == "a < b"


def test_html_site_style_tree(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(40):
        body = " ".join(word() for _ in range(60))
        rows.append((i, f"http://h.net/{i}", f'<body><div class="x1"><div>Home</div><div>Login here</div></div><div class="x2"><p>{body}</p><p>same line</p></div><div class="x3">All rights</div></body>', "c"))
    rows += [(100, "http://one.net/", '<body><div class="x1">Home</div></body>', "c"), (101, None, None, "c"), (None, "bad", "<p>k</p>", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, paths string")
    got = {r["page_id"]: r["text"] for r in htmltext.main_texts(df).collect()}
    for i in range(40):
        blocks = got[i].split("\n\n")
        assert len(blocks) == 2 and blocks[1] == "same line"
    assert got[100] == "Home" and got[101] == "" and got[None] == "k"
    assert htmltext.main_texts(df.limit(0)).count() == 0


# 10 exact dedup


def test_exact_dedup_edges(spark):
    rows = [(1, "a b"), (2, "ab"), (3, " a  b "), (4, None), (5, ""), (6, "\n"), (None, " a  b "), (7, "c"), (7, "c"), (8, "A b"), (9, "a\u00a0b")]
    got = dedup.mark_duplicates(docs_of(spark, rows)).collect()
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 7}
    assert len(got) == len(rows) and {i: by[i]["keep_id"] for i in (1, 2, 3, None, 4, 5, 6, 8, 9)} == {1: 3, 2: 3, 3: 3, None: 3, 4: 6, 5: 6, 6: 6, 8: 8, 9: 9}
    assert by[1]["group_size"] == 4 and by[1]["text_sha256"] == hashlib.sha256(b"ab").hexdigest()
    assert sorted(r["kept"] for r in got if r["doc_id"] == 7) == [False, True]
    kept = dedup.drop_duplicates(docs_of(spark, rows))
    assert kept.columns == DOCS.replace(",", "").split()[::2] and sorted(r["doc_id"] for r in kept.collect()) == [3, 6, 7, 8, 9]
    assert dedup.mark_duplicates(docs_of(spark, [])).count() == 0


def test_grace_spills_recursively(tmp_path):
    rng = random.Random(12)
    rows = [(f"t{rng.randrange(900)}" * 20, i) for i in range(3000)]
    batches = [pa.RecordBatch.from_pydict({"id": [i for _, i in rows[a : a + 200]], "text": [t for t, _ in rows[a : a + 200]]}) for a in range(0, 3000, 200)]
    out = list(dedup.grace(dedup.collapse(iter(batches)), f"file://{tmp_path}/spill", 8000))
    groups = {d: (n, k) for b in out for d, n, k in zip(b["digest"].to_pylist(), b["group_size"].to_pylist(), b["keep_id"].to_pylist(), strict=True)}
    want = defaultdict(list)
    for t, i in rows:
        want[hashlib.sha256(t.encode()).digest()].append(i)
    assert groups == {d: (len(v), min(v)) for d, v in want.items()}
    assert not list((tmp_path / "spill").iterdir())


def test_content_table_tells_a_collision():
    table = dedup.ContentTable(8)
    table.add(b"d" * 32, "x", 1, 1, 1)
    with pytest.raises(ValueError, match="SHA-256"):
        table.add(b"d" * 32, "y", 1, 1, 2)


# pipeline


def test_pipeline_stages(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(docs, spark.read.parquet(f"{small}/labels.parquet")).collect()}
    current, texts = docs, {r["doc_id"]: r["text"] for r in docs.collect()}
    left = {i: t for i, t in texts.items() if not scored[i]}
    stages = dict(corpus_pipeline.STAGES)
    current = stages["toxicity"](spark, current, small)
    assert {r["doc_id"] for r in current.collect()} == set(left) and current.columns == docs.columns
    groups = defaultdict(list)
    for i, t in left.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i))
    left = {min(g)[1]: texts[min(g)[1]] for g in groups.values()}
    current = stages["exact dedup"](spark, current, small)
    assert {r["doc_id"] for r in current.collect()} == set(left) and current.columns == docs.columns
    components = brute_components(sorted(left.items()), 5, 80, 100)
    left = {i: t for i, t in left.items() if components[i][1] == i}
    current = stages["near duplicates"](spark, current, small)
    assert {r["doc_id"] for r in current.collect()} == set(left) and current.columns == docs.columns
    pieces = corpus_pipeline.run(spark, small).collect()
    assert {r["doc_id"] for r in pieces} == set(left)
