from hypothesis import given
from hypothesis import strategies as st

from kinfold.functions.similarity import KERNELS, indel, jaro, jaro_winkler, lcs_length, levenshtein, partial, token_set, token_sort

WORDS = st.text("abc é", max_size=14)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(WORDS, WORDS)
def test_bounds_symmetry_and_lcs(a, b):
    assert lcs_length(a, b) == lcs(a, b)
    for name, f in KERNELS.items():
        assert abs(f(a, b) - f(b, a)) < 1e-12, name
        assert f(a, b) >= 0 and (name == "lcp" or f(a, b) <= 1 + 1e-12)


@given(WORDS, WORDS)
def test_partial_is_the_best_stretch(a, b):
    if len(a) > len(b):
        a, b = b, a
    sides = [(a, b), (b, a)] if len(a) == len(b) else [(a, b)]
    best = max((indel(x, y[max(0, i) : i + len(x)]) for x, y in sides for i in range(1 - len(x), len(y))), default=float(not b)) if a else float(not b)
    assert abs(partial(a, b) - best) < 1e-12


def test_known_values():
    assert round(jaro("martha", "marhta"), 4) == 0.9444 and round(jaro_winkler("martha", "marhta"), 4) == 0.9611
    assert levenshtein("kitten", "sitting") == 1 - 3 / 7
    assert token_sort("b a", "a b") == 1 and token_set("a b", "a b c") == 1 and token_set("", "a") == 0
    assert round(token_set("x y a", "x y b"), 4) == round(2 * 4 / 10, 4)
