import pytest
from pyspark.sql import functions as F

from kinfold.config import Settings
from kinfold.operators import decide, models, output, training, validate
from kinfold.sources import discovery, readers, sinks


@pytest.mark.parametrize(("path", "table"), [
    ("/d/train_source1.parquet", "train_source1"), ("/d/train/source2-00000-of-00005.csv", "train_source2"), ("/d/gt.tsv", "train_ground_truth"),
    ("/d/test/source3.txt", "test_source3"), ("/d/train_labels.csv", "train_ground_truth"), ("/d/other.csv", None), ("/d/my_test/test_source1.tsv", "test_source1"),
])
def test_table_of(path, table):
    assert discovery.table_of(path) == table


def test_discover_prefers_parquet_and_skips_hidden():
    files = ["/d/train_source1.csv", "/d/train_source1.parquet", "/d/.train_source2.csv", "/d/__MACOSX/train_source3.csv"]
    assert discovery.discover(files) == {"train_source1": ["/d/train_source1.parquet"]}


def test_read_tables(spark, tmp_path):
    (tmp_path / "train").mkdir()
    (tmp_path / "train" / "source1-00000-of-00002.csv").write_text(' Entity_ID ,business_name,business_address,country,more\n S1-1 ,"A ""B"", c",,US,x\n')
    (tmp_path / "train" / "source1-00001-of-00002.csv").write_text("entity_id,business_name,business_address,country\nS1-2,D,e,\n")
    (tmp_path / "gt.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2;S2-1\nS1-2\t\n")
    tables = readers.read_tables(spark, str(tmp_path))
    rows = {r["entity_id"]: r for r in tables["train_source1"].collect()}
    assert rows["S1-1"]["business_name"] == 'A "B", c' and rows["S1-1"]["business_address"] is None and rows["S1-2"]["country"] is None
    parsed = validate.parse_truth(tables["train_ground_truth"])
    assert {(r["s1_id"], r["cand_id"]) for r in validate.truth_pairs(parsed).collect()} == {("S1-1", "S2-1"), ("S1-1", "S3-2")}
    assert validate.absent_policy(parsed) == "exclude"


def test_missing_column_and_bad_ids(spark):
    with pytest.raises(validate.DataError):
        readers.standardised(spark.createDataFrame([("S1-1",)], "entity_id string"), "train_source1")
    bad = spark.createDataFrame([("S1-1", "a", "b", "c"), ("S1-1", "a", "b", "c"), ("X", "", None, " ")], "entity_id string, business_name string, business_address string, country string")
    with pytest.raises(validate.DataError, match="repeated ids, ids without"):
        validate.check_table(bad, "S1-", "t")


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("S1-2", ""), ("S1-1", "S2-1,S3-2")], "source1_entity_id string, matched_entity_ids string")
    path = str(tmp_path / "out.tsv")
    sinks.write_tsv(df, path)
    assert open(path).read() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-2\nS1-2\t\n"
    assert readers.read_lists(spark, path, ("source1_entity_id", "matched_entity_ids")).count() == 2
    sinks.write_json(spark, {"a": 1}, str(tmp_path / "r.json"))
    sinks.write_markdown(spark, {"T": {"a": 1}}, str(tmp_path / "r.md"))
    assert "| a | 1 |" in (tmp_path / "r.md").read_text()
    kept = readers.materialised(df, str(tmp_path / "m"))
    assert readers.materialised(df.limit(0), str(tmp_path / "m")).count() == kept.count() == 2


def test_output_check(spark):
    own = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    cands = spark.createDataFrame([("S2-1",)], "entity_id string")
    lists = spark.createDataFrame([("S1-1", "S2-1,S2-9"), ("S1-1", ""), ("S1-3", "")], "s1_id string, ids string")
    allowed = spark.createDataFrame([("S1-1", "S2-9")], "s1_id string, cand_id string")
    found = {r["problem"]: r["n"] for r in validate.output_problems(lists, own, cands, allowed).collect()}
    assert found == {"missing": 1, "extra": 1, "repeated": 1, "unknown": 1, "not_candidate": 1}
    with pytest.raises(validate.OutputError):
        validate.check_output(lists, own, cands, allowed)


def test_rules_ties_and_empty(spark):
    pairs = spark.createDataFrame([("S1-1", "S2-1", 0.9), ("S1-1", "S2-2", 0.9), ("S1-1", "S2-3", 0.5)], "s1_id string, cand_id string, p double")
    kept = {r["cand_id"] for r in decide.apply_rule(pairs, 0.4, 0.8, 1).where("pred").collect()}
    assert kept == {"S2-1"}
    assert decide.apply_rule(pairs.limit(0), 0.5).count() == 0
    assert len(decide.weight_grid(3)) == 67 and all(abs(sum(w) - 1) < 1e-9 for w in decide.weight_grid(3))
    lists = {r["source1_entity_id"]: r["matched_entity_ids"] for r in output.id_lists(spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string"), pairs).collect()}
    assert lists == {"S1-1": "S2-1,S2-2,S2-3", "S1-2": ""}


def test_roles_share_no_record_and_settings(spark, monkeypatch):
    ids = spark.range(2000).select(F.concat(F.lit("S1-"), "id").alias("s1_id"))
    roles = training.split(ids.union(ids), 0.2, 0.1, 42).collect()
    assert len(roles) == 2000 and abs(sum(r["role"] == "val" for r in roles) / 2000 - 0.2) < 0.04
    monkeypatch.setenv("KINFOLD_SEED", "7")
    assert Settings().seed == 7 and '"seed": 7' in Settings().to_json()


def test_models_and_calibration(spark):
    rows = spark.range(400).select(F.concat(F.lit("S1-"), F.col("id") % 40).alias("s1_id"), F.concat(F.lit("S2-"), "id").alias("cand_id"), (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5).cast("double").alias("y"), (F.col("id") % 7 > 3).cast("int").alias("label"))
    fitted = models.fit(rows, ["x", "y"], names=("lr", "rf"), trees=5)
    scored = models.predict(rows, fitted, ["x", "y"], ["s1_id", "cand_id", "label"])
    assert all((r["p_rf"] > 0.5) == bool(r["label"]) for r in scored.collect())
    assert models.importances(fitted, ["x", "y"])["rf"][0][0] == "x"
    for kind in ("platt", "isotonic"):
        out = models.Calibrator(kind).fit(scored, "p_lr").apply(scored, "p_lr")
        assert all(0 <= r["p_lr"] <= 1 for r in out.collect())
