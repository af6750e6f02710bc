"""The whole pipeline on a small invented dataset."""

import json
import random

import pytest

from kinfold import cli
from kinfold.operators.ensemble import refit_rounds
from kinfold.operators.validate import OutputError
from kinfold.sources import discovery, readers


def test_all_stages(spark, tmp_path):
    rng = random.Random(1)
    syllables = "ka lo mi ren tas vo zu bel dor fin".split()
    data = tmp_path / "data"
    data.mkdir()
    for split in ("train", "test"):
        sources, truth = {1: [], 2: [], 3: []}, []
        for i in range(60):
            name = "".join(rng.choices(syllables, k=3)).title() + " " + "".join(rng.choices(syllables, k=3)).title()
            street = f"{rng.randint(1, 99)} {''.join(rng.choices(syllables, k=2))} Rd {rng.randint(10000, 99999)}"
            sources[1].append((f"S1-{i}", f"{name} Ltd", street, "US"))
            ids = []
            for s in (2, 3):
                if rng.random() < 0.7:
                    sources[s].append((f"S{s}-{i}", f"{name} Limited", street.upper(), "USA"))
                    ids.append(f"S{s}-{i}")
                sources[s].append((f"S{s}-{1000 + i}", f"{name.split()[0]} {''.join(rng.choices(syllables, k=3))} Inc", f"{rng.randint(1, 99)} other rd {rng.randint(10000, 99999)}", "US"))
            truth.append((f"S1-{i}", ",".join(ids)))
        for s, rows in sources.items():
            (data / f"{split}_source{s}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(r) + "\n" for r in rows))
        if split == "train":
            (data / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join("\t".join(r) + "\n" for r in truth))
        last = dict(truth)
    art, out = tmp_path / "art", tmp_path / "out"
    cli.main(["--data-dir", str(data), "--artifacts-dir", str(art), "--output-dir", str(out), "--rounds", "3", "--trees", "5"])
    got = {r["source1_entity_id"]: r["matched_entity_ids"] for r in readers.read_lists(spark, str(out / "matches.tsv"), ("source1_entity_id", "matched_entity_ids")).collect()}
    assert set(got) == set(last) and sum(got[i] == ids for i, ids in last.items()) >= 50
    assert json.loads((art / "reports" / "evaluation.json").read_text())["f05"] > 0.8
    assert json.loads((art / "reports" / "blocking_train.json").read_text())["recall"]["all"] > 0.9
    assert (art / "reports" / "profile.md").read_text().startswith("## ")
    found = json.loads((art / "reports" / "profile.json").read_text())
    assert found["countries_only_in_test"]["countries"] == [] and found["train_source1"]["top_name_tokens"][0] == ["ltd", 60]
    # Refitted on all roles where no calibration was chosen, for at least as many rounds as watching the inner role gave.
    if json.loads((art / "reports" / "choice.json").read_text())["calibration"] == "none":
        refit = json.loads((art / "reports" / "refit.json").read_text())
        assert 0 < refit["train_share"] < 1 and all(n >= 10 for n in refit["rounds"].values())
    ask = ["--data-dir", str(data), "--artifacts-dir", str(art), "--output-dir", str(out), "--validator"]
    good, bad = tmp_path / "good.py", tmp_path / "bad.py"
    good.write_text("import sys, os; assert os.path.exists(sys.argv[2]) and os.path.exists(sys.argv[6] + '/test_source1.tsv')")
    bad.write_text("raise SystemExit('no')")
    cli.main([*ask, str(good), "--stage", "submission"])
    with pytest.raises(OutputError, match="no"):
        cli.main([*ask, str(bad), "--stage", "submission"])
    cli.main([*ask[:-1], "--stage", "report"])
    models = json.loads((art / "reports" / "models.json").read_text())
    assert models["rf_all"]["f05"] > 0.7 and "importance_gbt_deep" in models and "lr_source3" in models


def test_data_root(spark, tmp_path, monkeypatch):
    (tmp_path / "data").mkdir()
    assert discovery.data_root(spark, str(tmp_path)) == str(tmp_path)
    monkeypatch.setenv("KINFOLD_DATA_DIR", str(tmp_path / "data"))
    assert discovery.data_root(spark) == str(tmp_path / "data")
    with pytest.raises(FileNotFoundError):
        discovery.data_root(spark, str(tmp_path / "none"))


def test_refit_rounds():
    assert (refit_rounds(100, 0.5), refit_rounds(100, 0.9), refit_rounds(1, 1.0)) == (130, 105, 10)
