"""Pairwise string similarities, all from 0 to 1.

Edit distance has a Spark expression (``levenshtein_similarity``). The others have none: they are plain
functions of two strings, run over Arrow batches by ``similarities``, which computes each distinct pair of a
batch once and returns all of them in one struct, one crossing to Python for a field.

Two empty strings are equal (1) for ``indel``, ``jaro``, ``partial`` and edit distance; an empty
side makes ``token_set`` 0.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def _met(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _trimmed(a: str, b: str) -> tuple[str, str, int]:
    """The longer text, the shorter one, both without what they begin and end with in common, and the length of that."""
    if len(a) < len(b):
        a, b = b, a
    head = _met(a, b)
    a, b = a[head:], b[head:]
    tail = _met(a[::-1], b[::-1]) if a and b and a[-1] == b[-1] else 0
    return (a[:-tail], b[:-tail], head + tail) if tail else (a, b, head)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@lru_cache(maxsize=64)
def _places(text: str) -> dict[str, int]:
    """For each character an integer with a bit for each place where it stands."""
    found: dict[str, int] = {}
    if len(text) < 64:
        for i, c in enumerate(text):
            found[c] = found.get(c, 0) | 1 << i
        return found
    codes = _codes(text)
    for c in set(text):
        found[c] = int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little")
    return found


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by bit-parallel rows: one big integer has a bit for each place of the longer text."""
    a, b, shared = _trimmed(a, b)
    if not b:
        return shared
    places = _places(a)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        mask = places.get(c)
        if mask is not None:
            hit = row & mask
            row = ((row + hit) | (row ^ hit)) & full
    return shared + len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 2 * lcs_length(a, b) / total if total else 1.0


def levenshtein(a: str, b: str) -> float:
    """Edit similarity, by bit-parallel rows (Myers): a bit says where a row of the table rises, another where it falls. No integer is negative, as those take Python longer."""
    longest = max(len(a), len(b))
    a, b, _ = _trimmed(a, b)
    if not b:
        return 1 - len(a) / longest if longest else 1.0
    places = _places(a)
    full = (1 << len(a)) - 1
    wide = full << 1 | 1
    up, down = full, 0
    for c in b:
        same = places.get(c, 0) | down
        same = ((((same & up) + up) ^ up) | same) & full
        rise = (down | (full ^ (up | same))) << 1 | 1
        down, up = rise & same, ((up & same) << 1 | (wide ^ (rise | same))) & full
    return 1 - (len(b) + up.bit_count() - down.bit_count()) / longest


@lru_cache(maxsize=512)
def _ranked(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters, their places in order of characters, and there a number of each character and how often it stood before."""
    codes = _codes(text)
    order = np.argsort(codes, kind="stable")
    by = codes[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], by[1:] != by[:-1])))
    before = np.arange(len(by)) - np.repeat(first, np.diff(first, append=len(by)))
    return codes, order, by << 32 | before


def _jaro_at_once(a: str, b: str, reach: int) -> tuple[int, int] | None:
    """Matches and moved ones where the k-th of a character meets the k-th; None if one of these lies out of reach."""
    x, at_x, keys_x = _ranked(a)
    y, at_y, keys_y = _ranked(b)
    found = np.minimum(np.searchsorted(keys_y, keys_x), len(y) - 1)
    met = keys_y[found] == keys_x
    left, right = at_x[met], at_y[found[met]]
    if len(left) and np.abs(left - right).max() > reach:
        return None
    return len(left), int(np.count_nonzero(x[np.sort(left)] != y[np.sort(right)])) // 2


@lru_cache(maxsize=4)
def jaro(a: str, b: str) -> float:
    if not a or not b or a == b:
        return float(a == b)
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    if len(a) + len(b) >= 128 and (at_once := _jaro_at_once(a, b, reach)):
        m, moved = at_once
        return (m / len(a) + m / len(b) + (m - moved) / m) / 3 if m else 0.0
    taken = [False] * len(b)
    found = []
    # Places of a character that aren't taken, in order; those a window has left behind drop out for good.
    places: dict[str, deque[int]] = {}
    for j, y in enumerate(b):
        places.setdefault(y, deque()).append(j)
    for i, x in enumerate(a):
        free = places.get(x)
        while free and free[0] < i - reach:
            free.popleft()
        if free and free[0] <= i + reach:
            taken[free.popleft()] = True
            found.append(x)
    m = len(found)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(found, (y for y, t in zip(b, taken, strict=True) if t), strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def common_prefix(a: str, b: str) -> int:
    return _met(a, b)


def jaro_winkler(a: str, b: str, weight: float = 0.1, above: float = 0.7) -> float:
    base = jaro(a, b)
    return base + min(4, common_prefix(a, b)) * weight * (1 - base) if base > above else base


def prefix_similarity(a: str, b: str) -> float:
    longest = max(len(a), len(b))
    return common_prefix(a, b) / longest if longest else 1.0


@lru_cache(maxsize=512)
def _sorted_words(text: str) -> str:
    return " ".join(sorted(text.split()))


@lru_cache(maxsize=512)
def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


def token_sort(a: str, b: str) -> float:
    return indel(_sorted_words(a), _sorted_words(b))


@lru_cache(maxsize=4)
def token_set(a: str, b: str) -> float:
    """The best of the two sides' differences held against each other and against what both share."""
    x, y = _words(a), _words(b)
    if not x or not y:
        return 0.0
    both, left, right = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 1.0
    shared = sum(map(len, both)) + max(0, len(both) - 1)
    gap = bool(shared)
    with_left, with_right = shared + (gap + len(left) if left else 0), shared + (gap + len(right) if right else 0)
    best = 2 * (shared + gap + lcs_length(left, right)) / (with_left + with_right)
    if shared:
        best = max(best, 2 * shared / (shared + with_left), 2 * shared / (shared + with_right))
    return best


@lru_cache(maxsize=512)
def _blank_split(text: str) -> frozenset[str]:
    """Words between blanks, as Spark's token lists have them."""
    return frozenset(w for w in text.split(" ") if w)


def partial(a: str, b: str) -> float:
    """``indel`` of the shorter string and the best stretch of the longer one, no longer than it."""
    return partials([(a, b)])[0]


#: Of texts that are combed together: characters of both sides, and what the longer ones may differ by. Pieces of longer texts have so many
#: characters at least, and so many times those of the shorter text.
COMBED, WIDER, PIECE, TIMES = 1 << 17, 1.5, 512, 4


def partials(pairs: list[tuple[str, str]]) -> list[float]:
    """``partial`` of each pair; texts of like lengths are combed together, long ones in pieces that hold every stretch."""
    out = [0.0] * len(pairs)
    todo: list[tuple[int, str, str, bool, bool]] = []  # the pair, a text, a piece, and whether that is the first and the last one
    for i, (a, b) in enumerate(pairs):
        if len(a) > len(b):
            a, b = b, a
        if not a:
            out[i] = float(not b)
        elif a in b:
            out[i] = 1.0
        else:
            size = max(PIECE, TIMES * len(a))
            starts = range(0, max(1, len(b) - len(a)), size - len(a)) if len(b) > size else (0,)
            todo += [(i, a, b[s : s + size] if len(starts) > 1 else b, s == 0, s == starts[-1]) for s in starts]
            if len(a) == len(b):
                todo.append((i, b, a, True, True))
    todo.sort(key=lambda t: (len(t[1]).bit_length(), len(t[2])))
    k = 0
    while k < len(todo):
        own, most, end = len(todo[k][1]).bit_length(), WIDER * len(todo[k][2]) + 16, k + 1
        while end < len(todo) and len(todo[end][1]).bit_length() == own and len(todo[end][2]) <= most and (end - k + 1) * ((1 << own) + len(todo[end][2])) <= COMBED:
            end += 1
        block = todo[k:end]
        found, total = _combed([t[1] for t in block], [t[2] for t in block])
        sizes, longs = (np.array([len(t[j]) for t in block])[:, None] for j in (1, 2))
        begins, ends = (np.array([t[j] for t in block])[:, None] for j in (3, 4))
        at = np.arange(found.shape[1])[None, :] - sizes + 1
        counts = (at < longs) & (begins | (at >= 0)) & (ends | (at + sizes <= longs))
        best = np.where(counts, 2 * found / (sizes + total), 0.0).max(axis=1)
        for (i, *_), value in zip(block, best.tolist(), strict=True):
            out[i] = max(out[i], value)
        k = end
    return out


def _window_lcs(a: str, b: str) -> np.ndarray:
    """``lcs_length`` of ``a`` and each stretch of ``b`` of its length, or a shorter one at an end of ``b``."""
    return _combed([a], [b])[0][0, : len(a) + len(b) - 1]


def _combed(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``_window_lcs`` for each pair, and the stretches' lengths, by combing strands (semi-local alignment).

    A strand enters at each character of ``a`` and ``b``; two swap where characters are equal or they have
    crossed before. A stretch's subsequence lacks one for each strand that enters and leaves inside it.
    Cells of an antidiagonal don't depend on each other, nor do pairs. Shorter texts are filled up with
    characters that equal nothing.
    """
    n, m, k = max(map(len, left)), max(map(len, right)), len(left)
    codes = [(_codes(a), _codes(b)) for a, b in zip(left, right, strict=True)]
    text = np.uint16 if max(max(a.max(), b.max()) for a, b in codes) < (1 << 16) - 2 else np.uint32
    kind = np.int16 if n + m < 1 << 15 else np.int32
    x, y = np.zeros((n, k), text), np.ones((m, k), text)
    for i, (a, b) in enumerate(codes):
        x[n - len(a) :, i], y[: len(b), i] = a[::-1] + 2, b + 2
    across, down = np.repeat(np.arange(n, dtype=kind)[:, None], k, 1), np.repeat(np.arange(n, n + m, dtype=kind)[:, None], k, 1)
    most = min(n, m)
    swap, crossed, change = np.empty((most, k), bool), np.empty((most, k), bool), np.empty((most, k), kind)
    for d in range(n + m - 1):
        first, end = max(0, d - n + 1), min(m, d + 1)
        own = slice(n - 1 - d + first, n - 1 - d + end)
        h, v = across[own], down[first:end]
        s, c, t = swap[: end - first], crossed[: end - first], change[: end - first]
        np.equal(x[own], y[first:end], out=s)
        np.greater(h, v, out=c)
        s |= c
        np.bitwise_xor(h, v, out=t)
        t *= s
        h ^= t
        v ^= t
    sizes, longs = (np.array([len(p[j]) for p in codes]) for j in (0, 1))
    leaves, pair = np.nonzero((down >= n) & (np.arange(m)[:, None] < longs))
    enters = down[leaves, pair].astype(np.int64) - n
    inside = enters > leaves - sizes[pair]
    leaves, pair, enters = leaves[inside], pair[inside], enters[inside]
    wide = n + m
    steps = np.bincount(pair * wide + leaves, minlength=k * wide) - np.bincount(pair * wide + enters + sizes[pair], minlength=k * wide)
    at = np.arange(wide)[None, :] - sizes[:, None] + 1
    total = np.maximum(np.minimum(at + sizes[:, None], longs[:, None]) - np.maximum(at, 0), 0)
    return total - np.cumsum(steps.reshape(k, wide), axis=1), total


KERNELS: dict[str, Callable[[str, str], float]] = {
    "lev": levenshtein, "ratio": indel, "jaro": jaro, "jw": jaro_winkler, "tsort": token_sort, "tset": token_set,
    "partial": partial, "prefix": prefix_similarity, "lcp": lambda a, b: float(common_prefix(a, b)),
}
#: Numbers of distinct words: of both, of either side.
COUNTS: dict[str, Callable[[str, str], float]] = {
    "shared": lambda a, b: float(len(_blank_split(a) & _blank_split(b))),
    "left": lambda a, b: float(len(_blank_split(a))),
    "right": lambda a, b: float(len(_blank_split(b))),
}


def similarity_fields(fields: dict[str, tuple[Column, Column, tuple[str, ...]]]) -> Column:
    """A struct of ``<field>_<kernel>`` for all fields (two columns and kernels each), in one crossing to Python.

    Nulls count as empty strings. A distinct pair of texts of a batch is looked at once by a kernel, in whichever fields it stands.
    """
    plans = [[(KERNELS | COUNTS)[k] for k in kernels] for _, _, kernels in fields.values()]
    names = [f"{field}_{k}" for field, (_, _, kernels) in fields.items() for k in kernels]

    @F.pandas_udf(StructType([StructField(n, DoubleType()) for n in names]))
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            out, asked = [], {}
            earlier: list[tuple[dict[tuple[str, str], int], list, np.ndarray]] = []
            for i, kernels in enumerate(plans):
                known: dict[tuple[str, str], int] = {}
                at = [known.setdefault(pair, len(known)) for pair in zip(columns[2 * i], columns[2 * i + 1], strict=True)]
                found = np.empty((len(known), len(kernels)))
                for j, pair in enumerate(known):
                    there = {k: v for pairs, ks, values in earlier if pair in pairs for k, v in zip(ks, values[pairs[pair]].tolist(), strict=True)}
                    found[j] = [0.0 if k is partial else there[k] if k in there else k(*pair) for k in kernels]
                earlier.append((known, kernels, found))
                if partial in kernels:
                    asked[i] = known
                out.append((found, at))
            together = {pair: 0.0 for known in asked.values() for pair in known}
            together = dict(zip(together, partials(list(together)), strict=True))
            for i, known in asked.items():
                out[i][0][:, plans[i].index(partial)] = [together[pair] for pair in known]
            out = [found[at] for found, at in out]
            yield pd.DataFrame(np.concatenate(out, axis=1), columns=names)

    return run(*(F.coalesce(c, F.lit("")) for a, b, _ in fields.values() for c in (a, b)))


def similarities(a: Column, b: Column, *names: str) -> Column:
    """A struct of the named kernels; nulls count as empty strings."""
    found = similarity_fields({"k": (a, b, names)})
    return F.struct(*(found[f"k_{n}"].alias(n) for n in names))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)
