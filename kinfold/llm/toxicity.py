"""Toxicity by a noisy channel: restore obfuscated words, then score the restored text.

1. A character language model (trigrams over 64 classes, interpolated) is counted over every
   text of the corpus; tasks add their counts up before they are shuffled, and the model is
   a table of at most 64^3 numbers.
2. A word that looks written around a filter (digits or symbols among letters, a letter three
   times running, single letters set apart) becomes a lattice: each run of a symbol may stand for one of
   several letters, for one or two of them, or for nothing, at a channel cost. Viterbi finds
   the cheapest path under the language model.
   Arrow splits a batch's texts; each distinct token is read once, whatever its number.
3. From labelled rows, word beginnings that tell toxic from clean are chosen; copies of one
   document count once. A logistic regression over a text's hits gives the score.

The classifier is fitted on at most ``max_train`` labelled rows, chosen by hash; the language
model and the scores cover every row and whole texts.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: What a symbol written among letters may stand for ("" is nothing).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou",
}
_SEPARATORS = re.compile(r"[.,;:\-_/~·'’]+")
_EDGE = "!$*.,;:?%#&()[]{}<>\"'’`´-_~+=|/\\·¡¿«»…"
_PLAIN_EDGE = "".join(c for c in _EDGE if c not in LEET)
_RUN3 = re.compile(r"(.)\1\1")
_TRIPLE = "|".join(chr(c) * 3 for c in (*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100)))
_RUN2 = re.compile(r"(.)\1+")
_SYMBOL = re.compile("[" + re.escape("".join(LEET)) + "]")
#: What a piece of a word can end in.
_OPEN_END = r"[\pL\pN" + re.escape("".join(c for c in LEET if not c.isdigit())) + "]$"
#: Lengths of word beginnings, and how often a text must hold one at least.
LENGTHS, TIMES = range(3, 10), (1, 2, 3, 4)
_CLASSES = 64
_BOUNDARY, _OTHER = 0, 63


def _class_table() -> np.ndarray:
    """Classes of code points below 256: a-z, then the letters of Latin-1, lower-case; others are a boundary."""
    table, n = np.zeros(257, np.uint8), 1
    for code in [*range(97, 123), *range(0xDF, 0x100)]:
        if code != 0xF7:
            table[code], n = n, n + 1
    for c in LEET:
        if ord(c) < 256:
            table[ord(c)] = _OTHER
    table[256] = _OTHER
    return table


_CLASS = _class_table()


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return _CLASS[np.minimum(codes, 256)]


def trigram_counts(texts: Iterator[str]) -> np.ndarray:
    """Counts of class trigrams, words standing between boundaries."""
    counts = np.zeros(_CLASSES**3, np.int64)
    for text in texts:
        c = np.concatenate([np.zeros(2, np.uint8), classes_of(text), np.zeros(1, np.uint8)]).astype(np.int32)
        counts += np.bincount(c[:-2] << 12 | c[1:-1] << 6 | c[2:], minlength=_CLASSES**3)
    return counts


class CharModel:
    """Interpolated trigram model; ``cost(a, b, c)`` is -log P(c | a, b)."""

    def __init__(self, counts: np.ndarray) -> None:
        tri = counts.reshape(_CLASSES, _CLASSES, _CLASSES).astype(float)
        bi = tri.sum(axis=0)
        uni = bi.sum(axis=0)
        p1 = (uni + 0.5) / (uni.sum() + 0.5 * _CLASSES)
        p2 = (bi + 8 * p1) / (bi.sum(axis=1, keepdims=True) + 8)
        p3 = (tri + 8 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 8)
        self.costs = (-np.log(p3)).astype(np.float32)

    def decode(self, word: str) -> str:
        """The cheapest reading of a word's lattice."""
        costs = self.costs
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(_BOUNDARY, _BOUNDARY): (0.0, None)}
        for c, n in _runs(word):
            options = channel(c, n)
            nxt: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in states.items():
                for out, own in options:
                    x, y, total, trail = a, b, cost + own, path
                    for letter in out:
                        z = int(_CLASS[min(ord(letter), 256)])
                        total += float(costs[x, y, z])
                        x, y, trail = y, z, (trail, letter)
                    if (x, y) not in nxt or total < nxt[x, y][0]:
                        nxt[x, y] = (total, trail)
            states = nxt
        best = min(((cost + float(costs[a, b, _BOUNDARY]), path) for (a, b), (cost, path) in states.items()), key=lambda s: s[0])[1]
        letters = []
        while best is not None:
            best, letter = best
            letters.append(letter)
        return "".join(reversed(letters))


def channel(c: str, n: int) -> list[tuple[str, float]]:
    """What a run of ``n`` symbols ``c`` may stand for, and the cost of each."""
    letters = LEET.get(c, "")
    options = [(letter, 1.0) for letter in letters]
    if not letters or c.isdigit():
        options.append((c, 0.0 if not letters else 6.0))
    else:
        options.append(("", 7.0))
    if n > 1:
        options = [(o, k + (0.5 if n > 2 else 3.0)) for o, k in options] + [(o * 2, k + (1.5 if n > 2 else 0.0)) for o, k in options if o]
    return options


def _runs(word: str) -> Iterator[tuple[str, int]]:
    at = 0
    while at < len(word):
        end = at + 1
        while end < len(word) and word[end] == word[at]:
            end += 1
        yield word[at], end - at
        at = end


class Restorer:
    """Readings of tokens, and of letters set apart."""

    def __init__(self, model: CharModel) -> None:
        self.model = model

    def token(self, token: str) -> tuple[tuple[str, ...], ...]:
        """The token's readings, each of one word or more; which of them counts, the stems decide."""
        if token.isalpha() and not _RUN3.search(token):
            return ((token,),)
        core, full = token.strip(_EDGE), token.strip(_PLAIN_EDGE)
        texts = [core or full]
        if core and full != core:
            at = full.index(core)
            lead, tail = ("".join(c for c in edge if c in LEET) for edge in (full[:at], full[at + len(core) :]))
            # Only a word's beginning can be a stem: symbols behind a long one don't change it.
            tail = "" if core.isalpha() and len(core) >= LENGTHS[-1] else tail
            # Symbols before the word: any number of their runs may be marks, the others letters.
            texts += [lead[k:] + core + tail for k in range(len(lead)) if not k or lead[k] != lead[k - 1]]
            texts.append(core + tail)
        out = []
        for text in dict.fromkeys(texts):
            pieces = [p for p in _SEPARATORS.split(text) if p]
            joined = ["".join(pieces)]
            if not (len(pieces) >= 3 and all(len(p) == 1 for p in pieces)):
                out.append(self._read(pieces))
            if len(pieces) > 1:
                out.append(self._read(joined))
        return tuple(dict.fromkeys(r for r in out if r))

    def _read(self, pieces: list[str]) -> tuple[str, ...]:
        out = []
        for piece in pieces:
            if piece.isalpha() and not _RUN3.search(piece):
                out.append(piece)
            elif any(c.isalpha() for c in piece) or (len(piece) > 2 and len(set(piece)) > 1 and not piece.isdigit() and all(c in LEET for c in piece)):
                out.append(self.model.decode(piece))
        return tuple(out)

    def spaced(self, tokens: Tokens) -> Iterator[tuple[int, str]]:
        """(text's number, restored run) of single letters and symbols that blanks set apart."""
        for at, run in tokens.single_runs():
            run = "".join(c for c in run if c.isalpha() or c in LEET)
            if len(set(run)) > 1 and len(run) > 2:
                yield at, self.model.decode(run)


class Tokens:
    """The lower-case tokens of a batch of texts: distinct ``words``, the ``codes`` of all, and where each text begins and ends."""

    def __init__(self, texts: pa.Array) -> None:
        lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        numbered = lists.flatten().dictionary_encode()
        self.distinct: pa.Array = numbered.dictionary
        self.words: list[str] = self.distinct.to_pylist()
        codes, offsets = numbered.indices.to_numpy(), lists.offsets.to_numpy()
        bounds = (offsets - offsets[0]).astype(np.int64)
        if "" in self.words:  # what stands before leading and after trailing blanks
            real = codes != self.words.index("")
            bounds = np.r_[0, np.cumsum(real)][bounds]
            codes = codes[real]
        self.codes, self.bounds = codes, bounds

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """The number of the text that each place is in."""
        return np.searchsorted(self.bounds, at, "right") - 1

    def linked(self) -> np.ndarray:
        """Whether the token after a place is in the same text."""
        out = np.ones(len(self.codes), bool)
        ends = self.bounds[1:]
        out[ends[ends > 0] - 1] = False
        return out

    def single_runs(self) -> Iterator[tuple[int, str]]:
        """(text's number, letters) of three or more tokens of one character in a row."""
        single = np.fromiter((len(w) == 1 for w in self.words), bool, len(self.words))[self.codes]
        both = np.flatnonzero(single[:-1] & single[1:] & self.linked()[:-1])
        if not len(both):
            return
        cuts = np.flatnonzero(np.diff(both) > 1) + 1
        for part in np.split(both, cuts):
            if len(part) > 1:
                yield int(self.text_of(part[:1])[0]), "".join(self.words[c] for c in self.codes[part[0] : part[-1] + 2].tolist())

    def plain(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct words without marks at their edges, and which of them are letters, none three times running: those read as they are."""
        bare = pc.utf8_trim(self.distinct, characters=_PLAIN_EDGE)
        return bare, pc.and_not(pc.utf8_is_alpha(bare), pc.match_substring_regex(bare, _TRIPLE)).to_numpy(zero_copy_only=False)


def beginnings(word: str) -> list[str]:
    """A word's beginnings of three to nine letters; a shorter word itself."""
    return [word[:k] for k in LENGTHS if k <= len(word)] or [word]


def merged(readings: tuple[tuple[str, ...], ...], stems_of) -> Counter:
    """How often each stem is in a token: as often as in the reading that has it most."""
    out: Counter = Counter()
    for words in readings:
        out |= Counter(b for word in words for b in stems_of(word))
    return out


def _letter(letter: str) -> str:
    """A regular expression of a letter or a symbol that may stand for it."""
    return "[" + re.escape(letter + "".join(c for c, letters in LEET.items() if letter in letters)) + "]"


#: Letters and symbols that may be one another as one letter (a star has none: it may be any vowel).
_FOLD = str.maketrans({c: letters[0] for c, letters in LEET.items() if c != "*"} | {"l": "i", "£": "i", "b": "g", "8": "g"})


class Lexicon:
    """Signs of toxic texts: a word beginning, how often it must be there, and its log odds.

    Stems in ``closed`` aren't looked for in words split by blanks, as usual words make them there.
    """

    #: Tokens whose stems are kept, and those whose pieces are.
    CACHE = 200_000

    def __init__(self, signs: list[tuple[str, int, float]], weights: tuple[float, ...], closed: frozenset[str] = frozenset()) -> None:
        self.signs, self.weights = signs, weights
        self.stems = {stem for stem, _, _ in signs}
        self.split = [(s.translate(_FOLD), s, re.compile(r"(?<![^\W\d_])" + r"\s*".join(map(_letter, s)))) for s in sorted(self.stems - closed)]
        # Plain words that may have a stem, letters doubled or not.
        self.maybe = "^(?:" + "|".join("".join(re.escape(c) + "+" for c in stem) for stem in sorted(self.stems)) + ")" if self.stems else None
        # Which pieces of split stems a token may be; 64 bits for all (stem, letters so far), so that some share one.
        self.heads: dict[str, int] = {}
        self.middles: dict[str, int] = {}
        self.tails: dict[str, int] = {}
        state = itertools.count()
        for folded, _, _ in self.split:
            for k in range(1, len(folded)):
                bit = 1 << next(state) % 64
                self.heads[folded[:k]] = self.heads.get(folded[:k], 0) | bit
                self.tails[folded[k:]] = self.tails.get(folded[k:], 0) | bit
                for end in range(k + 1, len(folded)):
                    self.middles[folded[k:end]] = self.middles.get(folded[k:end], 0) | bit
        self.longest = max((len(f) for f, _, _ in self.split), default=0)

    def leads(self, token: str) -> int:
        """Bits of the states that a token's end may lead to."""
        if "*" in token:  # any vowel
            return (1 << 64) - 1
        folded, heads = token.translate(_FOLD), 0
        for at in (0,) if token.isalpha() else (i for i in range(max(0, len(folded) - self.longest), len(folded)) if i == 0 or not token[i - 1].isalpha()):
            heads |= self.heads.get(folded[at:], 0)
        return heads

    def follows(self, token: str) -> int:
        """Bits of the states that a token's beginning may go on from."""
        if "*" in token:
            return (1 << 64) - 1
        folded = token.translate(_FOLD)
        out = self.middles.get(folded, 0)
        for k in range(1, min(len(folded), self.longest) + 1):
            out |= self.tails.get(folded[:k], 0)
        return out

    def across(self, tokens: Tokens) -> Iterator[tuple[int, str]]:
        """(text's number, stem) for each word's beginning that is a stem with blanks inside it."""
        codes, words = tokens.codes, tokens.words
        if not self.split or len(codes) < 2:
            return
        # Plain words are a head whole or not at all; of others only Python knows.
        folded = pc.utf8_ltrim(tokens.distinct, characters=_PLAIN_EDGE)
        alpha = pc.utf8_is_alpha(folded).to_numpy(zero_copy_only=False)
        for letter in ("l", "b"):
            folded = pc.replace_substring(folded, letter, letter.translate(_FOLD))
        known = pc.is_in(folded, pa.array(list(self.heads))).to_numpy(zero_copy_only=False)
        open_end = pc.match_substring_regex(tokens.distinct, _OPEN_END).to_numpy(zero_copy_only=False)
        maybe = np.flatnonzero(known | (~alpha & open_end))
        heads = np.zeros(len(words), np.uint64)
        heads[maybe] = np.fromiter((self.leads(words[i]) for i in maybe.tolist()), np.uint64, len(maybe))
        at = np.flatnonzero((heads[codes[:-1]] > 0) & tokens.linked()[:-1])
        after, which = np.unique(codes[at + 1], return_inverse=True)
        goes_on = np.fromiter((self.follows(words[i]) for i in after.tolist()), np.uint64, len(after))
        at = at[(heads[codes[at]] & goes_on[which]) != 0]
        for place, text in zip(at.tolist(), tokens.text_of(at).tolist(), strict=True):
            here = [words[c] for c in codes[place : min(place + self.longest, int(tokens.bounds[text + 1]))].tolist()]
            squeezed, joined = "".join(here).translate(_FOLD), " ".join(here)
            for folded_stem, stem, pattern in self.split:
                if ("*" in squeezed or folded_stem in squeezed) and any(m.start() < len(here[0]) < m.end() for m in pattern.finditer(joined)):
                    yield text, stem

    def features(self, restorer: Restorer, texts: pa.Array, known: dict[str, tuple]) -> np.ndarray:
        """For each text: largest log odds of the signs found, their sum, and log of how often stems stand in it."""
        out, found = np.zeros((len(texts), 3)), defaultdict(Counter)
        tokens = Tokens(texts)
        if not self.stems or not len(tokens.codes):
            return out
        if len(known) > self.CACHE:
            known.clear()
        bare, plain = tokens.plain()
        look = np.flatnonzero(~plain | pc.match_substring_regex(bare, self.maybe).to_numpy(zero_copy_only=False))
        held: dict[int, tuple] = {}
        for code in look.tolist():
            word = tokens.words[code]
            have = known.get(word)
            if have is None:
                have = known[word] = tuple(merged(restorer.token(word), lambda w: self._stems(restorer.model, w)).items())
            if have:
                held[code] = have
        hit = np.zeros(len(tokens.words), bool)
        hit[list(held)] = True
        at = np.flatnonzero(hit[tokens.codes])
        for text, code in zip(tokens.text_of(at).tolist(), tokens.codes[at].tolist(), strict=True):
            for stem, times in held[code]:
                found[text][stem] += times
        for text, run in restorer.spaced(tokens):
            found[text].update(s for s in self.stems if (s in run if len(run) > 3 else run.startswith(s)))
        for text, stem in self.across(tokens):
            found[text][stem] += 1
        for text, counts in found.items():
            odds = [(w, counts[s]) for s, times, w in self.signs if counts[s] >= times]
            out[text] = max((w for w, _ in odds), default=0.0), sum(w for w, _ in odds), math.log1p(sum(n for _, n in odds))
        return out

    def _stems(self, model: CharModel, word: str) -> tuple[str, ...]:
        hits = tuple(b for b in beginnings(word) if b in self.stems)
        if hits:
            return hits
        # A doubled letter: the lattice decides only where the single letter would make a hit.
        short = _RUN2.sub(r"\1", word)
        if short != word and any(b in self.stems for b in beginnings(short)):
            return tuple(b for b in beginnings(model.decode(word)) if b in self.stems)
        return ()

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ np.array(self.weights[1:]), -30, 30)))


def least_shingle(text: str) -> int:
    """The least hash of a text's three-word shingles: near copies mostly agree on it."""
    words = text.lower().split()
    return min((xxhash.xxh3_64_intdigest(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0) >> 1


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Newton's method with a small ridge; constant term first."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * len(x) * np.r_[0, w[1:]]
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * len(x) * np.diag(np.r_[1e-9, np.ones(len(w) - 1)])
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def log_odds(toxic: int, clean: int, toxic_docs: int, clean_docs: int) -> float:
    return math.log((toxic + 0.5) / (toxic_docs + 1)) - math.log((clean + 0.5) / (clean_docs + 1))


def choose_signs(found: list[tuple[str, int, int, int]], toxic_docs: int, clean_docs: int, least: int, odds: float) -> list[tuple[str, int, float]]:
    """From (stem, times, toxic, clean): signs of ``least`` toxic documents or more, at least ``odds`` (log) likelier there.

    The largest count times log odds comes first (ties: the longer stem, then by spelling, then the fewer
    times); after it, other signs of the same stem, of what it begins with and of what begins with it are left out.
    """
    fit = [(-toxic * w, -len(stem), stem, times, w) for stem, times, toxic, clean in found if toxic >= least and (w := log_odds(toxic, clean, toxic_docs, clean_docs)) >= odds]
    chosen: list[tuple[str, int, float]] = []
    begun: set[str] = set()  # every beginning of a chosen stem
    stems: set[str] = set()
    for _, _, stem, times, w in sorted(fit):
        if stem not in begun and not any(stem[:k] in stems for k in range(1, len(stem))):
            chosen.append((stem, times, w))
            stems.add(stem)
            begun.update(stem[:k] for k in range(1, len(stem) + 1))
    return chosen


def fit_char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """The character model of every text; counts are added up in each task, then by trigram.

    Null texts count for nothing, repeated rows once each; of an empty table every trigram is as likely. Only the text is read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CLASSES**3, np.int64)
        for (texts,) in common.columns_of(batches, "text"):
            total += trigram_counts(["\n".join(t for t in texts if t)])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(common.streamed(count), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(_CLASSES**3, np.int64)
    counts[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return CharModel(counts)


_SIGN = pa.schema([("stem", pa.string()), ("times", pa.int32()), ("doc", pa.int64()), ("clean", pa.int64())])


def _signs_of(restorer: Restorer, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Word beginnings and how often texts have them at least: a row for each toxic text and sign, clean texts added up.

    Copies of a toxic text share their least shingle's hash, and so count once.
    """
    texts, labels = batch.column("text"), batch.column("label").to_pylist()
    tokens = Tokens(texts)
    bare, plain = tokens.plain()
    numbers: dict[str, int] = {}
    ids: list[int] = []
    times: list[int] = []
    sizes = np.zeros(len(tokens.words), np.int64)

    def hold(found: dict[str, int]) -> int:
        ids.extend(numbers.setdefault(b, len(numbers)) for b in found)
        times.extend(found.values())
        return len(found)

    for code, (word, core, as_is) in enumerate(zip(tokens.words, bare.to_pylist(), plain.tolist(), strict=True)):
        sizes[code] = hold(dict.fromkeys(beginnings(core), 1) if as_is else merged(restorer.token(word), beginnings))
    apart = defaultdict(list)
    for k, run in restorer.spaced(tokens):
        apart[k].append(beginnings(run))
    flat, weight, starts = np.array(ids, np.int64), np.array(times, np.int64), np.cumsum(sizes) - sizes
    toxic: list[tuple[list[int], np.ndarray, int]] = []
    clean: list[tuple[np.ndarray, np.ndarray]] = []
    for k, (a, b) in enumerate(itertools.pairwise(tokens.bounds.tolist())):
        codes, n = np.unique(tokens.codes[a:b], return_counts=True)
        each = sizes[codes]
        ends = np.cumsum(each)
        where = np.repeat(starts[codes] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)
        more = [numbers.setdefault(x, len(numbers)) for run in apart[k] for x in run]
        own = np.concatenate([flat[where], np.array(more, np.int64)])
        stems, at = np.unique(own, return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([weight[where] * np.repeat(n, each), np.ones(len(more))]), minlength=len(stems)) if len(stems) else np.zeros(0)
        if labels[k]:
            toxic.append((stems.tolist(), counts, least_shingle(texts[k].as_py() or "")))
        else:
            clean.append((stems, counts))
    names, rows = list(numbers), []
    for stems, counts, key in toxic:
        rows += [(names[b], t, key, 0) for b, n in zip(stems, counts.tolist(), strict=True) for t in TIMES if t <= n]
    if clean:
        stems, counts = (np.concatenate(x) for x in zip(*clean, strict=True))
        for t in TIMES:
            total = np.bincount(stems[counts >= t], minlength=len(names))
            rows += [(names[b], t, None, int(total[b])) for b in np.flatnonzero(total).tolist()]
    return common.batch_of(_SIGN, *zip(*rows, strict=True)) if rows else common.batch_of(_SIGN, [], [], [], [])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = 20_000, least: int = 5, share: float = 0.01, odds: float = 3.0) -> tuple[CharModel, Lexicon]:
    """Character model over all ``docs``; lexicon and weights from at most ``max_train`` labelled rows.

    ``labels`` must hold only rows to learn from; null labels and ids are left out, null texts are empty; an id's
    repeated rows are one example. Without
    both kinds of labels the score is the toxic share of them (0 without any).
    """
    spark = docs.sparkSession
    model = fit_char_model(docs, text_col)
    train = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    train = train.orderBy(F.xxhash64("id"), "id").limit(max_train)
    # At most max_train rows of 16 bytes are broadcast.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(common.saved(train, "train")), "id")
    # An id's repeated rows are one example, the text with the least hash, so the sample is bounded in rows, too.
    texts = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    texts = common.saved(texts, "train-texts").repartition(max(8, spark.sparkContext.defaultParallelism))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            yield _signs_of(restorer, batch)

    kinds = {r["label"]: r["n"] for r in texts.select("id", "label").distinct().groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sum(n for k, n in kinds.items() if k), kinds.get(0, 0)
    if not n_toxic or not n_clean:
        rate = n_toxic / max(1, n_toxic + n_clean)
        return model, Lexicon([], (math.log((rate + 1e-9) / (1 - rate + 1e-9)), 0.0, 0.0, 0.0))
    counted = texts.mapInArrow(common.streamed(features), "stem string, times int, doc long, clean long").groupBy("stem", "times").agg(F.count_distinct("doc").alias("toxic"), F.sum("clean").alias("clean"))
    # Signs that can't be chosen are left out before they are sent; the sample bounds the others.
    least = max(least, math.ceil(share * n_toxic))
    held = counted.where((F.col("toxic") >= least) & (F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1)) >= odds - 0.01)).collect()
    signs = choose_signs([(r["stem"], r["times"], r["toxic"], r["clean"]) for r in held], n_toxic, n_clean, least, odds)

    blanks = {(r["stem"], r["label"] > 0): r["n"] for r in texts.mapInArrow(common.streamed(_across(Lexicon(signs, ()))), "stem string, label int").groupBy("stem", "label").agg(F.count("*").alias("n")).collect()}
    clean_of = {stem: n for (stem, toxic), n in blanks.items() if not toxic}
    closed = frozenset(s for s, n in clean_of.items() if log_odds(blanks.get((s, True), 0), n, n_toxic, n_clean) < odds)

    rows = texts.mapInArrow(common.streamed(_features(model, Lexicon(signs, (), closed))), "label int, most double, total double, times double").toPandas()
    return model, Lexicon(signs, fit_logistic(rows[["most", "total", "times"]].to_numpy(float), (rows["label"] > 0).to_numpy(float)), closed)


def _across(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, labels = Tokens(batch.column("text")), batch.column("label").to_pylist()
            rows = sorted(set(lexicon.across(tokens)))
            yield pa.RecordBatch.from_arrays([pa.array([s for _, s in rows], pa.string()), pa.array([labels[k] for k, _ in rows], pa.int32())], names=["stem", "label"])

    return run


def _features(model: CharModel, lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, known = Restorer(model), {}
        for batch in batches:
            found = lexicon.features(restorer, batch.column("text"), known)
            yield pa.RecordBatch.from_arrays([batch.column("label"), *(pa.array(np.ascontiguousarray(found[:, i])) for i in range(3))], names=["label", "most", "total", "times"])

    return run


def add_scores(docs: DataFrame, model: CharModel, lexicon: Lexicon, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole text.

    Null text counts as empty; repeated rows give a row each, an empty table none. ``score_col`` must not be a column
    of ``docs`` (an error otherwise); its other columns stay as they are.
    """
    if score_col.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs has a column {score_col} already")
    names, schema = docs.columns, docs.select("*", F.lit(0.0).alias(score_col)).schema
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, known = Restorer(model), {}
        for batch in batches:
            scores = lexicon.scores(lexicon.features(restorer, batch.column(at).cast(pa.string()), known))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(common.streamed(run), schema)


def learnable(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: crc32 of the id as text isn't divisible by five."""
    return labels.where(F.crc32(F.col(id_col).cast("string")) % 5 != 0)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null text counts as empty; a null id is held out of nothing (held_out is null). Repeated
    rows give a row each; an empty table gives no rows. Only id and text are read, the id not for the score.
    """
    common.tune(docs.sparkSession)
    model, lexicon = fit(docs, learnable(labels, id_col), id_col, text_col)
    scored = add_scores(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), model, lexicon)
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with its own columns only.

    Null text counts as empty, null ids and repeated rows are scored like others; columns of any name are
    kept as they are; an empty table gives no rows.
    """
    common.tune(docs.sparkSession)
    model, lexicon = fit(docs, learnable(labels, id_col), id_col, text_col)
    (name,) = common.fresh(docs, "score")
    return add_scores(docs, model, lexicon, text_col, name).where(F.col(name) < threshold).select(*docs.columns)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from ``labels``. Nulls, repeats and empty tables: see ``score_documents``."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
