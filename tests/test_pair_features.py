"""Features of pairs: texts meet pairs once, and what is worked out beside the plan is what the plan's own expressions give."""

import random

from pyspark.sql import functions as F

from kinfold.functions import tfidf
from kinfold.functions.similarity import indel, partial, partials
from kinfold.plans.queries import QUERIES


def test_pairs_meet_texts_once(spark, small):
    """The plan was multiplied by each cosine, so that the driver's memory didn't hold it."""
    plan = QUERIES["features_all"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2 and plan.count("Relation ") == 3


def test_cosines_are_those_of_vectors(spark):
    rng = random.Random(4)
    words = ["amber", "mill", "b", "é", "𝒳y", "नदी", "cobalt", "of", "north river", "a b", "12"]
    texts = sorted({" ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(60)})
    pairs = spark.createDataFrame([(a, b) for a in texts for b in rng.sample(texts, 12)] + [("", texts[0]), ("", "")], "a string, b string")
    all_texts = spark.createDataFrame([(t,) for t in texts], "text string")
    for low, high, least in ((2, 4, 2), (3, 3, 2), (0, 0, 1)):
        grams = tfidf.char_grams(F.col("text"), low, high) if low else F.filter(F.split("text", " "), lambda w: w != "")
        want = {(r["a"], r["b"]): r["c"] for r in tfidf.pair_cosines(pairs, tfidf.vectors(all_texts, grams, least), "a", "b", "c").collect()}
        field = tfidf.cosine_fields({"c": (F.col("a"), F.col("b"), tfidf.gram_counts(all_texts, low, high), low, high)})
        got = {(r["a"], r["b"]): r["c"] for r in pairs.select("a", "b", field.alias("f")).select("a", "b", "f.c").collect()}
        assert want.keys() == got.keys() and max(abs(want[k] - got[k]) for k in want) < 1e-9


def test_partials_together_are_partials_alone():
    rng = random.Random(6)
    pairs = [tuple("".join(rng.choices("abcé 𝒳", k=rng.choice((0, 1, 5, 30, 70, 200)))) for _ in "ab") for _ in range(150)]
    found = partials(pairs)
    assert found == [partial(a, b) for a, b in pairs]
    for (a, b), value in list(zip(pairs, found, strict=True))[:40]:
        a, b = sorted((a, b), key=len)
        sides = [(a, b), (b, a)] if len(a) == len(b) else [(a, b)]
        assert value == (max(indel(x, y[max(0, i) : i + len(x)]) for x, y in sides for i in range(1 - len(x), len(y))) if a else float(not b))


def test_saved_tables_leave_no_shuffles(spark):
    """Shuffle files of what is saved stood on the disk until the query's end."""
    from kinfold.sources.scratch import CLEANUP, saved

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (found.apply(i) for i in range(found.length())) if f.getName().startswith("shuffle_")}

    before, setting = files(), spark.conf.get(CLEANUP)
    out = saved(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "few")
    assert not files() - before and spark.conf.get(CLEANUP) == setting and out.count() == 10
