"""Words written with symbols at their edges, or in pieces of any length."""

import random

from kinfold.llm import toxicity


def test_edges_and_pieces(spark):
    bad, fine = ["stupid", "idiot", "loser", "asshat"], ["table", "window", "garden", "letter", "river", "stone"]
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = rng.choices(fine, k=30)
        if i % 3 == 0:
            words[rng.randrange(30)] = rng.choice(bad)
        rows.append((i, " ".join(words) + f" n{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}"))
    hidden = ["$tupid!", "!diot!", "!!$tupid!!", "@$$h@t", "a$$hat!!", "stu.pid", "id-iot table", "st u pid", "river lo ser", "st u p1d", "1d iot"]
    plain = ["table, window!! (garden)", "let-ter sto ne", "a $100 river!", "*** 2023 ***", "los angeles"]
    docs = spark.createDataFrame(rows + [(1000 + k, t) for k, t in enumerate(hidden + plain)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(docs, labels).collect()}
    assert {t: got[1000 + k] for k, t in enumerate(hidden + plain)} == {t: 1 for t in hidden} | {t: 0 for t in plain}


def test_readings_of_one_token_count_once():
    assert toxicity.merged((("stupid",), ("stupidi",)), lambda w: [w[:6]]) == {"stupid": 1}
    assert toxicity.merged((("a", "a"), ("aa",)), lambda w: [w]) == {"a": 2, "aa": 1}
