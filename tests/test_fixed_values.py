"""Values that the SQL shares with the library, held against literals."""

import pytest

from kinfold.config import QUICK_WEIGHTS, STRATEGIES, Blocking, Settings
from kinfold.functions.words import ADDRESS_WORDS, COUNTRY_NAMES, LEGAL_WORDS, NAME_WORDS
from kinfold.operators.decide import weight_grid


def test_strategies():
    assert [(s.name, s.bit, s.weight, s.cap, s.scoped, s.rarest) for s in STRATEGIES] == [
        ("exact_name", 1, 6.0, 5000, False, None), ("exact_core", 2, 5.0, 5000, False, None), ("name_signature", 4, 4.0, 5000, True, None),
        ("name_token", 8, 1.0, 1000, True, 3), ("char_ngram", 16, 0.6, 600, True, 4), ("addr_token", 32, 0.5, 600, True, 3),
        ("postal_name", 64, 3.0, 1500, True, None), ("postal_building", 128, 2.0, 1500, True, None), ("token_postal", 256, 2.0, 1500, True, 3),
        ("addr_signature", 512, 3.0, 1500, True, None),
    ]
    assert len(Blocking().enabled) == 9 and "char_ngram" not in Blocking().enabled
    assert (Blocking().keep_first, Blocking().keep, Blocking().fuzzy) == (200, 25, False)


def test_settings_and_grids():
    s = Settings()
    assert s.thresholds == (0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.97, 0.99)
    assert s.ratios == (0.0, 0.5, 0.7, 0.85) and s.limits == (0, 3, 10)
    grid = weight_grid(3)
    assert len(grid) == 67 and grid[0] == (1 / 3,) * 3 and (0.8, 0.2, 0.0) in grid and all(sum(g) == pytest.approx(1) for g in grid)
    assert sum(QUICK_WEIGHTS.values()) == pytest.approx(1)


def test_words():
    assert (NAME_WORDS["pvt"], NAME_WORDS["&"], NAME_WORDS["intl"], ADDRESS_WORDS["ps"]) == ("private", "and", "international", "police station")
    assert {"limited", "llc", "gmbh"} <= set(LEGAL_WORDS) and COUNTRY_NAMES["usa"] == COUNTRY_NAMES["united states"]
