"""Command line: python -m kinfold.cli --stage all --data-dir D --artifacts-dir A --output-dir O."""

from __future__ import annotations

import argparse
import dataclasses
import json
import subprocess
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .functions.text import normalized_entities
from .operators import candidates, decide, ensemble, evaluate, features, models, output, profile, training, validate
from .sources import readers, sinks
from .sources.discovery import data_root

STAGES = ("eda", "preprocess", "blocking", "train", "evaluate", "inference", "submission")
#: Stages that only run when they are named.
MORE_STAGES = ("report",)
MODELS = ("lr", "gbt_wide", "gbt_deep", "rf")


class Run:
    """One run's folders and settings; a stage reads what the stages before it wrote."""

    def __init__(self, spark: SparkSession, data: str, artifacts: str, out: str, settings: Settings, force: bool = False, rounds: int = 60, trees: int = 200, validator: str | None = None) -> None:
        self.spark, self.data, self.art, self.out = spark, data, artifacts, out
        self.settings, self.force, self.rounds, self.trees, self.validator = settings, force, rounds, trees, validator
        self._tables: dict[str, DataFrame] | None = None

    @property
    def tables(self) -> dict[str, DataFrame]:
        if self._tables is None:
            self._tables = {t: readers.materialised(df, f"{self.art}/raw/{t}", self.force) for t, df in readers.read_tables(self.spark, self.data).items()}
        return self._tables

    def entities(self, split: str) -> DataFrame:
        parts = [self.tables[f"{split}_source{i}"] for i in (1, 2, 3)]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def truth(self) -> DataFrame:
        return validate.truth_pairs(validate.parse_truth(self.tables["train_ground_truth"]))

    def normalized(self, split: str) -> DataFrame:
        return readers.materialised(normalized_entities(self.entities(split)), f"{self.art}/normalized/{split}", self.force)

    def pairs(self, split: str) -> DataFrame:
        return readers.materialised(candidates.generate(self.normalized(split), self.settings.blocking), f"{self.art}/pairs/{split}", self.force)

    def features(self, split: str) -> DataFrame:
        records, others = candidates.sides(self.normalized(split))
        return readers.materialised(features.compute(self.pairs(split), records, others), f"{self.art}/features/{split}", self.force)

    def splits(self) -> list[str]:
        return [s for s in ("train", "test") if f"{s}_source1" in self.tables]

    def report_json(self, name: str, content: dict) -> None:
        sinks.write_json(self.spark, content, f"{self.art}/reports/{name}.json")

    def eda(self) -> None:
        found = {}
        for split in self.splits():
            for i in (1, 2, 3):
                table = self.tables[f"{split}_source{i}"]
                validate.check_table(table, f"S{i}-", f"{split}_source{i}")
                one = lambda q, t=table: profile.run(self.spark, t, q).first().asDict()
                rows = lambda df: [list(r) for r in df.collect()]  # noqa: E731  each of a few rows: top lists, classes, samples
                found[f"{split}_source{i}"] = one(profile.COUNTS) | one(profile.DUPLICATES) | one(profile.TEXT) | {
                    "countries": rows(profile.run(self.spark, table, profile.CATEGORIES)),
                    "top_name_tokens": rows(profile.run(self.spark, table, profile.TOP_TOKENS)),
                    "top_address_tokens": rows(profile.run(self.spark, table, profile.TOP_ADDRESS_TOKENS)),
                    "scripts": rows(profile.scripts(table)), "samples": rows(profile.examples(table)),
                }
        if self.splits() == ["train", "test"]:
            new = profile.only_in(self.entities("test"), self.entities("train"))
            found["countries_only_in_test"] = {"countries": sorted(r["country"] for r in new.where("country IS NOT NULL").collect())}
        if "train_ground_truth" in self.tables:
            parsed = validate.parse_truth(self.tables["train_ground_truth"])
            found["ground_truth"] = profile.truth_shape(parsed).first().asDict() | {"matches": [list(r) for r in profile.truth_histogram(parsed).orderBy("matches").collect()]}
        self.report_json("profile", found)
        sinks.write_markdown(self.spark, found, f"{self.art}/reports/profile.md")

    def preprocess(self) -> None:
        for split in self.splits():
            self.normalized(split)

    def blocking(self) -> None:
        for split in self.splits():
            records, others = candidates.sides(self.normalized(split))
            found = candidates.sizes(records, others, self.pairs(split)).first().asDict()
            if split == "train":
                found["recall"] = {r["scope"]: r["recall"] for r in candidates.recall(self.pairs(split), self.truth()).collect()}
            self.report_json(f"blocking_{split}", found)

    def labelled(self) -> DataFrame:
        parsed = validate.parse_truth(self.tables["train_ground_truth"])
        own = self.tables["train_source1"].select("entity_id")
        named = parsed if validate.absent_policy(parsed, self.settings.absent) == "exclude" else own.select(F.col("entity_id").alias("s1_id"))
        return training.choose(own, named, self.settings.max_train, self.settings.seed)

    def sets(self) -> DataFrame:
        rows = self.features("train").join(self.labelled().select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
        return readers.materialised(training.build(rows, self.truth(), self.settings), f"{self.art}/sets", self.force)

    def train(self) -> None:
        sets = self.sets()
        fitted = models.fit(sets.where("role = 'train'"), features.FEATURES, MODELS, self.settings.forest_rows, self.rounds, self.trees, sets.where("role = 'inner'"))
        for name, model in fitted.items():
            sinks.save_model(model, f"{self.art}/models/{name}")
        self.report_json("importances", models.importances(fitted, features.FEATURES))

    def models(self, names: tuple[str, ...] = MODELS, kind: str = "") -> dict:
        return {n: sinks.load_model(f"{self.art}/models/{kind}{n}") for n in names}

    def final_models(self, names: tuple[str, ...]) -> dict:
        """Models fitted anew on all roles, boosting for longer as there are more rows."""
        sets = self.sets()
        train, rest = sets.where("role = 'train'"), sets.where("role <> 'train'")
        thinned = training.sample_negatives(rest, self.settings.hard_negatives, self.settings.random_negatives, self.settings.seed)
        full = train.unionByName(thinned, allowMissingColumns=True)
        share = train.count() / max(1, full.count())
        rounds = {n: ensemble.refit_rounds(best, share) for n, best in models.rounds_of(self.models()).items()}
        fitted = models.fit(full, features.FEATURES, names, self.settings.forest_rows, rounds, self.trees)
        for name, model in fitted.items():
            sinks.save_model(model, f"{self.art}/models/final/{name}")
        self.report_json("refit", {"rounds": rounds, "train_share": share})
        return fitted

    def evaluate(self) -> None:
        keep = ["s1_id", "cand_id", "source", "label", "role", "name_tset"]
        scored = readers.materialised(models.predict(self.sets().where("role <> 'train'"), self.models(), features.FEATURES, keep), f"{self.art}/scored", True)
        columns = [f"p_{m}" for m in MODELS if m != "lr"]
        held = training.split(self.labelled().select(F.col("entity_id").alias("s1_id")), self.settings.validation, self.settings.inner, self.settings.seed).where("role = 'val'")
        truth = self.truth().join(held, "s1_id", "left_semi")
        validation, inner = scored.where("role = 'val'"), scored.where("role = 'inner'")
        choice = ensemble.select(validation, inner, columns, truth.count(), self.settings)
        self.report_json("choice", choice.to_dict())
        p = decide.combined(columns, tuple(choice.weights[c.removeprefix("p_")] for c in columns))
        rows = ensemble.calibrated(validation, inner, columns, choice.calibration).withColumn("p", p)
        decided = decide.apply_rule(rows, choice.threshold, choice.ratio, choice.limit)
        wrong = evaluate.errors(decided, truth)
        buckets = evaluate.error_buckets(wrong, decided.select("s1_id", "cand_id", F.col("name_tset").alias("sim")))
        self.report_json("evaluation", evaluate.evaluate(decided, truth, held).first().asDict() | {"errors": [r.asDict() for r in buckets.collect()]})
        sinks.write_tsv(wrong, f"{self.art}/reports/errors.tsv")

    def choice(self) -> dict:
        return json.loads("\n".join(r["value"] for r in self.spark.read.text(f"{self.art}/reports/choice.json", wholetext=True).collect()))

    def inference(self) -> None:
        choice = self.choice()
        columns = [f"p_{m}" for m in choice["weights"]]
        names = tuple(choice["weights"])
        fitted = self.final_models(names) if choice["calibration"] == "none" else self.models(names)
        rows = models.predict(self.features("test"), fitted, features.FEATURES, ["s1_id", "cand_id", "source"])
        inner = self.spark.read.parquet(f"{self.art}/scored").where("role = 'inner'")
        rows = ensemble.calibrated(rows, inner, columns, choice["calibration"]).withColumn("p", decide.combined(columns, tuple(choice["weights"].values())))
        readers.materialised(decide.apply_rule(rows, choice["threshold"], choice["ratio"], choice["limit"]), f"{self.art}/decided", True)

    def submission(self) -> None:
        own = self.tables["test_source1"].select("entity_id")
        decided = self.spark.read.parquet(f"{self.art}/decided")
        matched, all_ = output.id_lists(own, decided.where("pred")), output.id_lists(own, decided, "candidate_entity_ids")
        others = self.tables["test_source2"].unionByName(self.tables["test_source3"]).select("entity_id")
        validate.check_output(matched.select(F.col("source1_entity_id").alias("s1_id"), F.col("matched_entity_ids").alias("ids")), own, others, decided)
        sinks.write_tsv(matched, f"{self.out}/matches.tsv")
        sinks.write_tsv(all_, f"{self.out}/candidates.tsv")
        if self.validator:
            self.validate_outside()

    def validate_outside(self) -> None:
        """Run an external validator over the two lists; the test tables are written for it as TSV. OutputError if it fails."""
        for t in ("test_source1", "test_source2", "test_source3"):
            sinks.write_tsv(self.tables[t], f"{self.art}/export/{t}.tsv")
        command = [sys.executable, self.validator, "--matching", f"{self.out}/matches.tsv", "--candidate", f"{self.out}/candidates.tsv", "--test-dir", f"{self.art}/export"]
        done = subprocess.run(command, capture_output=True, text=True, check=False)
        if done.returncode:
            raise validate.OutputError(f"the external validator failed: {done.stderr.strip() or done.stdout.strip()}")

    def report(self) -> None:
        """Each model at its best threshold on the validation role, over all candidates and by source, with importances."""
        scored = self.spark.read.parquet(f"{self.art}/scored").where("role = 'val'")
        held = training.split(self.labelled().select(F.col("entity_id").alias("s1_id")), self.settings.validation, self.settings.inner, self.settings.seed).where("role = 'val'")
        truth = self.truth().join(held, "s1_id", "left_semi").withColumn("source", candidates.source_of(F.col("cand_id")))
        found = {}
        for scope, which in (("all", F.lit(True)), ("source2", F.col("source") == 2), ("source3", F.col("source") == 3)):
            total = truth.where(which).count()
            for name in MODELS:
                rows = scored.where(which).withColumn("p", F.col(f"p_{name}"))
                best = decide.best_rule(decide.rule_table(rows, total, self.settings.thresholds, (0.0,), (0,))).first()
                found[f"{name}_{scope}"] = {k: best[k] for k in ("threshold", "precision", "recall", "f05", "tp", "fp")} if best else {}
        for name, top in models.importances(self.models(), features.FEATURES).items():
            found[f"importance_{name}"] = dict(top)
        self.report_json("models", found)
        sinks.write_markdown(self.spark, found, f"{self.art}/reports/models.md")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kinfold", description=__doc__)
    parser.add_argument("--stage", choices=(*STAGES, *MORE_STAGES, "all"), default="all")
    parser.add_argument("--data-dir", help="else KINFOLD_DATA_DIR, else ./data or ./dataset")
    for name in ("artifacts-dir", "output-dir"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--validator", help="a script that is run over the finished lists")
    parser.add_argument("--seed", type=int)
    parser.add_argument("--max-train", type=int)
    parser.add_argument("--forest-rows", type=int)
    parser.add_argument("--rounds", type=int, default=60)
    parser.add_argument("--trees", type=int, default=200)
    parser.add_argument("--force", action="store_true")
    a = parser.parse_args(argv)
    given = {k: v for k, v in {"seed": a.seed, "max_train": a.max_train, "forest_rows": a.forest_rows}.items() if v is not None}
    spark = SparkSession.builder.appName("kinfold").getOrCreate()
    run = Run(spark, data_root(spark, a.data_dir), a.artifacts_dir, a.output_dir, dataclasses.replace(Settings(), **given), a.force, a.rounds, a.trees, a.validator)
    for stage in STAGES if a.stage == "all" else (a.stage,):
        getattr(run, stage)()


if __name__ == "__main__":
    main()
