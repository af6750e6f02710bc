"""Choosing calibration, weights and rule together, and how long to refit."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..sources.scratch import saved
from . import decide
from .models import Calibrator


@dataclass(frozen=True)
class Choice:
    """``weights`` by model, ``calibration`` kind, and the rule's threshold, ratio and limit, with its F0.5."""

    weights: dict[str, float]
    calibration: str
    threshold: float
    ratio: float
    limit: int
    f05: float

    def to_dict(self) -> dict:
        return asdict(self)


def calibrated(rows: DataFrame, inner: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """``rows`` with each probability calibrated on ``inner``."""
    for c in columns:
        rows = Calibrator(kind).fit(inner, c).apply(rows, c) if kind != "none" else rows
    return rows


def select(validation: DataFrame, inner: DataFrame, columns: list[str], total_true: int, settings: Settings) -> Choice:
    """The best calibration (kept only for a gain above ``calibration_gain``), weights and rule on ``validation``.

    Both tables: s1_id, cand_id, label and the probability ``columns``.
    """
    kinds = ("none", "platt", "isotonic") if settings.calibration == "auto" else (settings.calibration,)
    best: Choice | None = None
    for kind in kinds:
        rows = saved(calibrated(validation, inner, columns, kind), f"calibrated-{kind}")
        top = decide.search_weights(rows, columns, total_true, settings.thresholds).orderBy(F.desc("f05"), "grid").first()
        if top is None:
            continue
        weights = tuple(top["weights"])
        scored = rows.withColumn("p", decide.combined(columns, weights))
        rule = decide.best_rule(decide.rule_table(scored, total_true, settings.thresholds, settings.ratios, settings.limits)).first()
        found = Choice({c.removeprefix("p_"): w for c, w in zip(columns, weights, strict=True)}, kind, rule["threshold"], rule["ratio"], rule["top"], rule["f05"])
        if best is None or found.f05 > best.f05 + settings.calibration_gain:
            best = found
    if best is None:
        raise ValueError("no pair reaches the lowest threshold")
    return best


def refit_rounds(best: int, share: float) -> int:
    """Boosting rounds for a fit on all rows, when ``best`` were right on a share of them."""
    return max(10, round(best * min(1.3, math.sqrt(1 / share))))
