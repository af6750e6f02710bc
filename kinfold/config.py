"""Settings of the linkage pipeline; ``KINFOLD_<NAME>`` in the environment overrides a plain one."""

from __future__ import annotations

import dataclasses
import json
import os
from dataclasses import dataclass, field


def _setting(name: str, default):
    """A field whose default the environment may override, read when an object is made."""

    def made():
        text = os.environ.get(f"KINFOLD_{name.upper()}")
        if text is None:
            return default
        if isinstance(default, bool):
            return text.strip().lower() in ("1", "true", "yes", "on")
        if text.strip().lower() in ("none", "null", ""):
            return None
        return text if default is None or isinstance(default, str) else type(default)(text)

    return field(default_factory=made)


@dataclass(frozen=True)
class Strategy:
    """A blocking strategy: its bit, weight, the largest block, whether by country, and rarest keys a record asks with."""

    name: str
    bit: int
    weight: float
    cap: int
    scoped: bool
    rarest: int | None = None
    rarest_ceiling: bool = True


# Strategies in order of their bits.
STRATEGIES = (
    Strategy("exact_name", 1, 6.0, 5000, False),
    Strategy("exact_core", 2, 5.0, 5000, False),
    Strategy("name_signature", 4, 4.0, 5000, True),
    Strategy("name_token", 8, 1.0, 1000, True, 3),
    Strategy("char_ngram", 16, 0.6, 600, True, 4),
    Strategy("addr_token", 32, 0.5, 600, True, 3),
    Strategy("postal_name", 64, 3.0, 1500, True),
    Strategy("postal_building", 128, 2.0, 1500, True),
    Strategy("token_postal", 256, 2.0, 1500, True, 3, False),
    Strategy("addr_signature", 512, 3.0, 1500, True),
)
FUZZY_BIT, FUZZY_WEIGHT = 1024, 2.0
# Weights of the quick score's terms, and the blocking score that counts in full.
QUICK_WEIGHTS = {"name_set": 0.35, "name_ratio": 0.15, "address_set": 0.20, "address_ratio": 0.10, "postal": 0.10, "building": 0.05, "score": 0.05}
QUICK_FULL_SCORE = 60
STRATEGY = {s.name: s for s in STRATEGIES}


@dataclass(frozen=True)
class Blocking:
    enabled: tuple[str, ...] = tuple(s.name for s in STRATEGIES if s.name != "char_ngram")
    keep_first: int = _setting("keep_first", 200)
    keep: int = _setting("keep", 25)
    fuzzy: bool = _setting("fuzzy", False)
    fuzzy_below: int = 3
    fuzzy_retrieve: int = 40
    fuzzy_keep: int = 8
    fuzzy_least: float = 0.35
    fuzzy_max_df: int = 20_000
    wildcard_scope: bool = False


@dataclass(frozen=True)
class Settings:
    seed: int = _setting("seed", 42)
    validation: float = _setting("validation", 0.2)
    inner: float = 0.1
    max_train: int = _setting("max_train", 100_000)
    absent: str = _setting("absent", "auto")
    hard_negatives: int = 20
    random_negatives: int = 5
    forest_rows: int = _setting("forest_rows", 300_000)
    calibration: str = "auto"
    calibration_gain: float = 0.001
    thresholds: tuple[float, ...] = (*(round(0.1 + 0.05 * i, 2) for i in range(18)), 0.97, 0.99)
    ratios: tuple[float, ...] = (0.0, 0.5, 0.7, 0.85)
    limits: tuple[int, ...] = (0, 3, 10)
    postal: str = r"\b\d{5,6}\b"
    blocking: Blocking = field(default_factory=Blocking)

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), indent=2)
