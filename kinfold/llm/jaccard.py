"""Exact Jaccard self-join over word shingles with PartEnum signatures.

Sets are dealt to size bands. Two sets whose Jaccard similarity reaches p/q differ, within a
band of largest size r, in at most k = 2r(q-p)/(q+p) elements. The shingle domain is
partitioned n1 = f + t ways, f = k//(k2+1), so in t partitions at least they differ in at most k2 elements
each; every partition is partitioned n2 ways again, and one signature is made for each way to leave k2 of the n2
parts out. Similar sets of a band agree on a signature in t partitions; sets near the upper end of a band
also sign in the next one.

Signatures of few elements are shared by chance (of none: by everything). Of the t signatures that two similar
sets agree on, one in each of t partitions, the largest holds more elements than those of any t-1 partitions of either
set need; so each set leaves out the signatures below the t-th least of its partitions' shortest ones, on its own, and
the pair still meets.

1. Each Arrow batch signs its distinct sets. Within a batch, a signature goes to the shuffle
   once, whoever shares it; the others are passed beside it to arbitrary tasks, so a signature
   shared by a third of all rows arrives as one entry per batch.
2. What several documents share becomes a table (sig, doc, next): in each signature the documents form
   a chain in an order of its own, and neighbours are compared (as many pairs as entries).
   Similar documents share many signatures and so meet many partners.
3. A pair is first held against what parity sketches prove about its difference (popcount of
   their xor is at most the difference; the more shingles a set has, the more bits); the others
   are verified on complete shingles. Links make components.
4. In the signatures that still join different components, pairs between those components are
   held against sizes and sketches and verified alike, where at most ``HOT`` documents share the signature. Pairs
   inside one component are left out, so no component is missed.
5. The documents of hotter signatures are signed anew, under another seed and with longer signatures, which fewer
   share, and go through 2 to 4 again. Each such plan is complete by itself, so two similar documents that met in a
   hot signature only meet there. What is hot in the last plan still is dealt to blocks of ``HOT`` documents, and a
   task holds two blocks against each other, so that no task's work grows with a signature's sharers.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SET = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), *((f"s{i}", pa.int64()) for i in range(16)), ("big", pa.list_(pa.int64()))])
_SKETCH = [*(f"s{i}" for i in range(16)), "big"]
_SET_DDL = "doc_id long, n_shingles long, set_hash binary, " + ", ".join(f"s{i} long" for i in range(16)) + ", big array<long>"
_SIGNED = pa.schema([("bucket", pa.int64()), ("direct", pa.bool_()), ("sigs", pa.binary()), ("docs", pa.binary()), ("more", pa.binary())])
_SHARED = pa.schema([("sig", pa.int64()), ("doc", pa.int64()), ("next", pa.int64())])
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_U = np.uint64
#: Elements of the sets that are signed at once: bounds a worker's memory.
SIGNED_ELEMENTS = 400_000
#: Documents of one signature that are compared with each other at most; k2 and n2 of the plans, each for what is hot in the one before.
HOT, LEVELS = 4096, ((1, 3), (2, 5), (3, 7))


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased runs of anything but ASCII white space."""
    return (text or "").encode().translate(_LOWER).split()


def shingle_set(text: str | None, width: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width)), strict=False))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with good avalanche."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Shingler:
    """Texts to sorted distinct 64-bit shingle hashes; Arrow splits, each distinct word of a call is hashed once."""

    def __init__(self, width: int) -> None:
        self.width = width

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """``texts``: an Arrow array of strings, null ones empty."""
        width = self.width
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        numbered = lists.flatten().dictionary_encode()
        words = numbered.dictionary.cast(pa.binary()).to_pylist()
        codes, offsets = numbered.indices.to_numpy(), lists.offsets.to_numpy()
        bounds = (offsets - offsets[0]).astype(np.int64)
        if b"" in words:  # what stands before leading and after trailing white space
            real = codes != words.index(b"")
            bounds = np.r_[0, np.cumsum(real)][bounds]
            codes = codes[real]
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))[codes]
        sizes = np.diff(bounds)
        n = max(0, len(h) - width + 1)
        acc = np.zeros(n, _U)
        for i in range(width):
            acc += h[i : i + n]
            acc += _U(i + 1)
            acc = mix(acc)
        inside = np.repeat(bounds[1:], sizes)[:n] - np.arange(n) >= width  # a shingle doesn't leave its text
        acc = acc[inside]
        ends = np.cumsum(np.maximum(sizes - width + 1, 0))
        cuts = [0, *ends.tolist()]
        out = []
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            if b > a:
                part = acc[a:b]
                part.sort()
                out.append(part[np.r_[True, part[1:] != part[:-1]]])
            elif size := int(sizes[k]):
                whole = h[bounds[k] : bounds[k + 1]]
                out.append(np.array([xxhash.xxh3_64_intdigest(whole.tobytes(), seed=size)], _U))
            else:
                out.append(np.empty(0, _U))
        return out


class PartEnum:
    """Signatures for Jaccard similarity p/q; ``k2``, ``n2`` as in the module's text; ``ratio`` of a band's ends.

    ``slack``: partitions beyond those needed, as a share of them; the more, the fewer short signatures.
    """

    def __init__(self, p: int, q: int, k2: int = 1, n2: int = 3, ratio: float = 1.25, slack: float = 0.1, seed: int = 0) -> None:
        if not (0 < p <= q and 0 <= k2 < n2 and ratio > 1 and slack >= 0):
            raise ValueError("0 < p <= q, 0 <= k2 < n2, ratio > 1 and slack >= 0 are needed")
        self.p, self.q, self.k2, self.n2, self.seed = p, q, k2, n2, _U(seed)
        low = [1]
        while low[-1] < 1 << 40:
            low.append(max(low[-1], int(low[-1] * ratio)) + 1)
        self.low = np.array(low, np.int64)
        high = self.low[1:] - 1
        self.k = 2 * high * (q - p) // (q + p)
        spoilt = self.k // (k2 + 1)
        self.t = 1 + (slack * spoilt).astype(np.int64)
        self.n1 = spoilt + self.t
        self.drops = list(itertools.combinations(range(n2), k2))

    def sign(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(signature, number of the set) of all signatures of non-empty sets."""
        sizes = np.array([len(s) for s in sets], np.int64)
        band = np.searchsorted(self.low, sizes, "right") - 1
        sigs, owners = [], []
        ahead = 0
        while True:  # a set's own band, then those above that it can reach
            who = np.flatnonzero((sizes > 0) & ((ahead == 0) | (self.q * sizes >= self.p * self.low[np.minimum(band + ahead, len(self.low) - 1)])))
            if not len(who):
                break
            # A set that reaches further than the next band does so at low similarity thresholds only.
            for whole in (True, False):
                part = who[(self.k[band[who] + ahead] == 0) == whole]
                if len(part):
                    s, o = self._sign([sets[i] for i in part], band[part] + ahead, whole)
                    sigs.append(s)
                    owners.append(part[o])
            ahead += 1
        if not sigs:
            return np.empty(0, _U), np.empty(0, np.int64)
        return np.concatenate(sigs), np.concatenate(owners)

    def _sign(self, sets: list[np.ndarray], band: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        h = np.concatenate(sets)
        sizes = np.array([len(s) for s in sets], np.int64)
        if self.seed:
            h = mix(h + _U(int(self.seed) * 0x9E3779B97F4A7C15 % 2**64))
        n1, n2 = (np.ones(len(sets), np.int64), 1) if whole else (self.n1[band], self.n2)
        base = np.cumsum(n1) - n1
        cell = (h >> _U(33)).astype(np.int64) % np.repeat(n1, sizes)
        cell += np.repeat(base, sizes)
        cell *= n2
        cell += (mix(h) & _U(0xFFFFFFFF)).astype(np.int64) % n2
        cells = int(n1.sum()) * n2
        parts = np.zeros(cells, _U)
        np.add.at(parts, cell, mix(h + _U(0x9E3779B97F4A7C15)))
        parts = parts.reshape(-1, n2)
        owner = np.repeat(np.arange(len(sets)), n1)
        tag = np.repeat(band, n1).astype(_U) << _U(40) | (np.arange(len(owner)) - np.repeat(base, n1)).astype(_U) << _U(8)
        tag = mix(tag ^ self.seed << _U(56)) if self.seed else tag
        if whole:
            return mix(parts[:, 0] ^ mix(tag)), owner
        total = parts.sum(axis=1, dtype=_U)
        held = np.bincount(cell, minlength=cells).astype(np.int32).reshape(-1, n2)
        size = np.stack([held.sum(axis=1) - held[:, list(drop)].sum(axis=1) for drop in self.drops], axis=1)
        shortest = size.min(axis=1)
        least = shortest[np.lexsort((shortest, owner))][base + self.t[band] - 1]  # the t-th of each set's partitions
        keep = size >= least[owner][:, None]
        sigs = [mix((total - parts[:, list(drop)].sum(axis=1, dtype=_U)) ^ mix(tag + _U(j + 1)))[keep[:, j]] for j, drop in enumerate(self.drops)]
        return np.concatenate(sigs), np.concatenate([owner[keep[:, j]] for j in range(len(self.drops))])


#: Bits of a sketch in columns, and the set size up to which they are used; larger sets have an array besides.
_BITS = ((256, 450), (512, 950), (1024, 2000))


def sketch(elements: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Parities of the elements by hash class: sixteen 64-bit integers, and for large sets an array of more.

    Class counts are powers of two and classes are remainders, so xor of its halves makes a sketch half as long.
    """
    classes = (elements * _U(0x9E3779B97F4A7C15) >> _U(32)).astype(np.int64)

    def parities(bits: int) -> np.ndarray:
        return np.packbits(np.bincount(classes & (bits - 1), minlength=bits).astype(np.uint8) & 1).view(np.int64)

    n = len(elements)
    out = np.zeros(16, np.int64)
    columns = parities(next((bits for bits, most in _BITS if n <= most), _BITS[-1][0]))
    out[: len(columns)] = columns
    if n <= _BITS[-1][1]:
        return out, None
    bits = 4096
    while bits < 0.6 * n:
        bits *= 4
    return out, parities(bits)


def _class(n: Column) -> Column:
    return F.when(n <= _BITS[0][1], 0).when(n <= _BITS[1][1], 1).otherwise(2)


def _differ_at_least(a: str, b: str) -> Column:
    """What the sketches prove of the size of a pair's difference."""

    def ones(parts: list[Column]) -> Column:
        return sum((F.bit_count(x) for x in parts), F.lit(0))

    x = [F.col(f"{a}_s{i}").bitwiseXOR(F.col(f"{b}_s{i}")) for i in range(16)]
    half = [x[i].bitwiseXOR(x[i + 8]) for i in range(8)]
    quarter = [half[i].bitwiseXOR(half[i + 4]) for i in range(4)]
    ca, cb = _class(F.col(f"{a}_n")), _class(F.col(f"{b}_n"))
    big = F.size(f"{a}_big") == F.size(f"{b}_big")
    more = F.aggregate(F.zip_with(f"{a}_big", f"{b}_big", lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int")), F.lit(0), lambda s, v: s + v)
    return F.when(F.col(f"{a}_big").isNotNull() & F.col(f"{b}_big").isNotNull() & big, more).when(ca == cb, ones(x)).when((ca > 0) & (cb > 0), ones(half)).otherwise(ones(quarter))


def _set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sets = shingler(batch.column("text"))
            sketches = [sketch(s) for s in sets]
            columns = np.array([c for c, _ in sketches], np.int64).reshape(-1, 16)
            yield common.batch_of(_SET, batch.column("id"), [len(s) for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], *(pa.array(np.ascontiguousarray(columns[:, i])) for i in range(16)), [big for _, big in sketches])

    return run


def _chained(sig: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by signature, in an order of each signature's own; where a signature begins."""
    order = np.lexsort((mix(doc.view(_U) ^ sig), sig))
    sig, doc = sig[order], doc[order]
    return sig, doc, np.r_[True, sig[1:] != sig[:-1]]


def _signed(width: int, plan: PartEnum, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sets: list[np.ndarray] = []
            owners: list[int] = []
            seen: set[bytes] = set()
            for doc_id, s in zip(batch.column("id").to_pylist(), shingler(batch.column("text")), strict=True):
                if doc_id is not None and len(s) and (key := xxhash.xxh3_128_digest(s.tobytes())) not in seen:
                    seen.add(key)
                    sets.append(s)
                    owners.append(doc_id)
            ends = np.cumsum([len(x) for x in sets])
            at = 0
            while at < len(sets):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SIGNED_ELEMENTS, "right")))
                sig, of = plan.sign(sets[at:to])
                sig, doc, lead = _chained(sig, np.array(owners[at:to], np.int64)[of])
                at = to
                many = np.r_[~lead[1:], False]  # the next entry has the same signature
                rest = np.flatnonzero(~lead)
                yield from _direct_rows(sig[rest], doc[rest], doc[rest - 1], buckets)
                yield from _bucket_rows(sig[lead], doc[lead], many[lead], buckets)

    return run


def _planes(x: np.ndarray, width: int = 8) -> bytes:
    """The low ``width`` bytes of 64-bit integers, all first bytes first: planes of zeros take no room once compressed."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _whole(planes: bytes, dtype: type, width: int = 8) -> np.ndarray:
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view(dtype).reshape(-1)


_LOW48 = _U((1 << 48) - 1)


def _bucket_of(sig: np.ndarray, buckets: int) -> np.ndarray:
    return (sig >> _U(32)) % _U(buckets)


def _named(sig: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """A signature's name after the shuffle: of its bucket and its low 48 bits."""
    return mix((sig & _LOW48) ^ mix(bucket.astype(_U) + _U(1)))


def _direct_rows(sig: np.ndarray, doc: np.ndarray, nxt: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of a batch's own groups, in stretches to any bucket."""
    cuts = range(0, len(sig), 1 << 14)
    rows = [(int(sig[c] >> _U(7)) % buckets, True, *(_planes(x[c : c + (1 << 14)]) for x in (sig, doc, nxt))) for c in cuts]
    if rows:
        yield common.batch_of(_SIGNED, *zip(*rows, strict=True))


def _bucket_rows(sig: np.ndarray, doc: np.ndarray, shared: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """One entry of each signature, by bucket; of a signature the bucket and the low 48 bits are told apart."""
    bucket = _bucket_of(sig, buckets).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, sig, doc, shared = bucket[order], sig[order], doc[order], shared[order]
    cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)] if len(bucket) else []
    rows = [(int(bucket[c]), False, _planes(sig[c:d], 6), _planes(doc[c:d]), np.packbits(shared[c:d]).tobytes()) for c, d in itertools.pairwise(cuts)]
    if rows:
        yield common.batch_of(_SIGNED, *zip(*rows, strict=True))


def _meet(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """One bucket's entries to (sig, doc, next) of the signatures that several documents share."""
        bucket = np.array([table.column("bucket")[0].as_py()], np.int64)
        out: list[tuple] = []
        sigs, docs, shared = [], [], []
        for direct, s, d, m in zip(*(table.column(n).to_pylist() for n in ("direct", "sigs", "docs", "more")), strict=True):
            d = _whole(d, np.int64)
            if direct:
                s = _whole(s, _U)
                out.append((_named(s, _bucket_of(s, buckets)), d, _whole(m, np.int64), np.zeros(len(s), bool)))
            else:
                s = _named(_whole(s, _U, 6), bucket)
                sigs.append(s)
                docs.append(d)
                shared.append(np.unpackbits(np.frombuffer(m, np.uint8), count=len(s)).astype(bool))
        if sigs:
            sig, doc, many = np.concatenate(sigs), np.concatenate(docs), np.concatenate(shared)
            order = np.lexsort((mix(doc.view(_U) ^ sig), sig))
            sig, doc, many = sig[order], doc[order], many[order]
            same = sig[1:] == sig[:-1]
            follows = np.r_[False, same]
            keep = many | np.r_[same, False] | follows
            out.append((sig[keep], doc[keep], np.r_[doc[:1], doc[:-1]][keep], ~follows[keep]))
        sig, doc, nxt, none = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table([pa.array(sig.view(np.int64)), pa.array(doc), pa.array(nxt, mask=none)], schema=_SHARED)

    return run


def _verify(width: int, p: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sides = [batch.column(c).dictionary_encode() for c in ("ta", "tb")]
            (sa, ka), (sb, kb) = ((shingler(x.dictionary), x.indices.to_pylist()) for x in sides)
            keep = []
            for x, y in zip(ka, kb, strict=True):
                common_size = len(np.intersect1d(sa[x], sb[y], assume_unique=True))
                keep.append(common_size > 0 and q * common_size >= p * (len(sa[x]) + len(sb[y]) - common_size))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


#: Pairs held against each other at once, and pairs of which repeats are told before they are.
_BLOCK, _PAIRS = 1 << 15, 1 << 19
#: Entries of one family of signatures that one task takes.
FAMILY = 1 << 14


def _meet_openly(p: int, q: int):
    """The pairs of each signature's documents, of different components, that sizes and sketches leave possible.

    ``entries``: sig, doc, comp; ``known``: each document's sketch, once.
    """

    def run(entries: pa.Table, known: pa.Table) -> pa.Table:
        doc = known.column("own_doc").to_numpy()
        order = np.argsort(doc, kind="stable")
        known = known.take(pa.array(order))
        doc, n, single = doc[order], known.column("n").to_numpy(), np.array(known.column("single").to_pylist(), bool)
        columns = np.stack([known.column(f"s{i}").to_numpy() for i in range(16)], axis=1).view(_U)
        bigs = [None if x is None else np.array(x, np.int64).view(_U) for x in known.column("big").to_pylist()]
        level = np.searchsorted([most for _, most in _BITS[:2]], n, "left")
        sig, at = entries.column("sig").to_numpy(), np.searchsorted(doc, entries.column("doc").to_numpy())
        comp = np.zeros(len(doc), np.int64)
        comp[at] = entries.column("comp").to_numpy()
        found: set[int] = set()

        def hold(pairs: np.ndarray) -> None:
            x, y = pairs // len(doc), pairs % len(doc)
            both = single[x] & single[y]
            # The same bounds as _differ_at_least's.
            whole = columns[x] ^ columns[y]
            half = whole[:, :8] ^ whole[:, 8:]
            quarter = half[:, :4] ^ half[:, 4:]
            ones = [np.bitwise_count(w).sum(axis=1, dtype=np.int64) for w in (whole, half, quarter)]
            differ = np.where(level[x] == level[y], ones[0], np.where((level[x] > 0) & (level[y] > 0), ones[1], ones[2]))
            for k in np.flatnonzero(both & (level[x] == 2) & (level[y] == 2)).tolist():
                u, v = bigs[x[k]], bigs[y[k]]
                if u is not None and v is not None and len(u) == len(v):
                    differ[k] = int(np.bitwise_count(u ^ v).sum())
            found.update(pairs[~both | ((p + q) * differ <= (q - p) * (n[x] + n[y]))].tolist())

        gathered: list[np.ndarray] = []

        def flush() -> None:
            pairs = np.unique(np.concatenate(gathered)) if gathered else np.empty(0, np.int64)
            gathered.clear()
            for a in range(0, len(pairs), _BLOCK):
                hold(pairs[a : a + _BLOCK])

        by_sig = np.argsort(sig, kind="stable")
        starts = np.flatnonzero(np.r_[True, sig[by_sig][1:] != sig[by_sig][:-1]]) if len(sig) else []
        held = 0
        for lo, hi in itertools.pairwise([*(starts.tolist() if len(sig) else []), len(sig)]):
            who = np.sort(at[by_sig[lo:hi]])
            step = max(1, _PAIRS // (hi - lo))
            for a in range(0, hi - lo, step):
                i, j = np.nonzero(np.arange(a, min(a + step, hi - lo))[:, None] < np.arange(hi - lo)[None])
                x, y = who[i + a], who[j]
                ok = (comp[x] != comp[y]) & (x != y) & (~(single[x] & single[y]) | (q * np.minimum(n[x], n[y]) >= p * np.maximum(n[x], n[y])))
                gathered.append(x[ok].astype(np.int64) * len(doc) + y[ok])
                held += len(gathered[-1])
                if held > _PAIRS:
                    flush()
                    held = 0
        flush()
        pairs = np.fromiter(found, np.int64, len(found))
        return pa.table([pa.array(doc[pairs // max(1, len(doc))]), pa.array(doc[pairs % max(1, len(doc))])], schema=_PAIR)

    return run


def similarity_components(docs: DataFrame, width: int = 5, p: int = 80, q: int = 100, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 6 << 20) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable over pairs of similarity >= p/q).

    A document's set is its distinct ``width``-word shingles; with fewer words, the whole
    sequence. Null and blank texts have the empty set and link with nothing; so do rows with a
    null id, whose component_id is null. Rows that repeat an id are one node, linked by any of
    their texts, and each gives a row. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    common.tune(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    buckets = max(8, -(-common.text_bytes(docs, text_col) // bucket_bytes))

    sets = common.saved(texts.mapInArrow(common.streamed(_set_rows(width)), _SET_DDL), "sets")
    # Saved, so that the join with it has exchanges of its own and a hot set can be split.
    lowest = common.saved(sets.where("set_hash IS NOT NULL").groupBy("set_hash").agg(F.min("doc_id").alias("rep")), "lowest")
    members = sets.where("set_hash IS NOT NULL").join(lowest, "set_hash").select("doc_id", "n_shingles", "rep")
    named = sets.where("doc_id IS NOT NULL AND set_hash IS NOT NULL").join(lowest, "set_hash")
    # One row per id: the least of its classes, and what its sketch proves (nothing where an id has several sets).
    nodes = common.saved(named.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("top"), F.min("n_shingles").alias("n"), (F.min("set_hash") == F.max("set_hash")).alias("single"), F.count("*").alias("copies"), *(F.min(c).alias(c) for c in _SKETCH)), "nodes")
    again = members.join(nodes.where("rep <> top").select("doc_id", F.col("rep").alias("low")), "doc_id").where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    links = [common.saved(again.distinct(), "links")]
    common.remove_saved(lowest)

    # A text that an id repeats is verified once. Mostly no id is in two rows, and all texts are as they are.
    repeated = nodes.where("copies > 1").select(F.col("doc_id").alias("id"))
    held = texts if repeated.isEmpty() else texts.join(repeated, "id", "left_anti").union(texts.join(repeated, "id", "left_semi").distinct())

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("doc_id").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("n", "single", *_SKETCH)))

    def possible(a: str, b: str) -> Column:
        """False where sizes or sketches prove that a pair isn't similar."""
        na, nb = F.col(f"{a}_n"), F.col(f"{b}_n")
        return ~(F.col(f"{a}_single") & F.col(f"{b}_single")) | ((q * F.least(na, nb) >= p * F.greatest(na, nb)) & ((p + q) * _differ_at_least(a, b) <= (q - p) * (na + nb)))

    def verified(pairs: DataFrame) -> DataFrame:
        """Links (between least ids of equal sets) of the saved pairs (a, b)."""
        # The filter holds for all pairs; with it Spark may prune texts by a Bloom filter of the pairs before they are shuffled.
        rows = pairs.where("a <> b").join(held.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(held.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        found = rows.select("a", "b", "ta", "tb").mapInArrow(common.streamed(_verify(width, p, q)), "a long, b long")
        found = found.join(nodes.select(F.col("doc_id").alias("a"), F.col("rep").alias("ra")), "a").join(nodes.select(F.col("doc_id").alias("b"), F.col("rep").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        return common.saved_in_small_batches(found.distinct(), "links")

    def grouped() -> DataFrame:
        return common.saved(common.components(functools.reduce(DataFrame.union, links)), "groups")

    def component_of(groups: DataFrame) -> DataFrame:
        return nodes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(F.col("doc_id").alias("doc"), F.coalesce("component", "rep").alias("comp"))

    todo = texts
    for number, (k2, n2) in enumerate(LEVELS):
        signed = todo.mapInArrow(common.streamed(_signed(width, PartEnum(p, q, k2, n2, seed=number), buckets)), "bucket long, direct boolean, sigs binary, docs binary, more binary")
        shared = common.saved(signed.groupBy("bucket").applyInArrow(common.grouped(_meet(buckets)), "sig long, doc long, next long"), "shared")
        chain = shared.where("next IS NOT NULL AND doc <> next").select(F.least("doc", "next").alias("a"), F.greatest("doc", "next").alias("b")).distinct()
        first = common.saved(chain.join(side("a"), "a").join(side("b"), "b").where(possible("a", "b")).select("a", "b"), "chained")
        links.append(verified(first))
        groups = grouped()

        # Pairs that share a signature but neither a component nor, yet, a comparison.
        entries = shared.select("sig", "doc").join(component_of(groups), "doc")
        open_sigs = entries.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("sharers")).where("lo <> hi").select("sig", "sharers", "lo")
        open_sigs = common.saved(open_sigs, "open-signatures")
        # Signatures with one least component mostly have the same documents: together, their pairs are told to be the same.
        families = open_sigs.groupBy("lo").agg(F.ceil(F.sum("sharers") / FAMILY).alias("shares"))
        family = F.pmod(F.xxhash64("lo", F.pmod(F.xxhash64("sig"), F.col("shares"))), F.lit(8 * buckets))
        left = common.saved(entries.join(open_sigs.join(families, "lo").select("sig", "sharers", family.alias("part")), "sig").select("sig", "doc", "comp", "sharers", "part"), "open")
        common.remove_saved(shared, open_sigs)
        last = number == len(LEVELS) - 1
        # A signature of up to HOT sharers is one block; with more, each two of its blocks are a group.
        blocks = F.ceil(F.col("sharers") / HOT).cast("int")
        own = F.pmod(F.xxhash64("doc", "sig"), blocks).cast("int")
        two = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")))
        place = F.when(blocks > 1, F.pmod(F.xxhash64("sig", "two"), F.lit(8 * buckets))).otherwise(F.col("part"))
        cool = (left if last else left.where(F.col("sharers") <= HOT)).withColumn("two", F.explode(two)).select(place.alias("part"), F.xxhash64("sig", "two").alias("sig"), "doc", "comp")
        known = cool.select(F.col("part").alias("own_part"), F.col("doc").alias("own_doc")).distinct()
        known = known.join(nodes.select(F.col("doc_id").alias("own_doc"), "n", "single", *_SKETCH), "own_doc")
        met = cool.groupBy("part").cogroup(known.groupBy("own_part")).applyInArrow(common.cogrouped(_meet_openly(p, q)), "a long, b long").distinct()
        pairs = common.saved(met.join(first, ["a", "b"], "left_anti"), "rest")
        if not pairs.isEmpty():
            links.append(verified(pairs))
            common.remove_saved(groups)
            groups = grouped()
        hot = left.where(F.col("sharers") > HOT).select(F.col("doc").alias("id"))
        common.remove_saved(first, pairs)
        if last or hot.isEmpty():
            break
        common.remove_saved(groups)
        todo = texts.join(hot.distinct(), "id", "left_semi")

    final = nodes.select("doc_id", "rep").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    return sets.select("doc_id", "n_shingles").join(final, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_component(docs: DataFrame, width: int = 5, p: int = 80, q: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the least id of their component; rows with a null id stay.

    Rows that repeat an id are one document: all its rows stay or all go. Null and blank texts link with nothing
    and stay; other columns are kept as they are, whatever their names; an empty table gives no rows.
    """
    (gone_id,) = common.fresh(docs, "gone")
    gone = similarity_components(docs, width, p, q, id_col, text_col).where("doc_id IS NOT NULL AND component_id <> doc_id").select(F.col("doc_id").alias(gone_id)).distinct()
    return docs.join(gone, F.col(id_col) == F.col(gone_id), "left_anti").select(*docs.columns)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.9. Nulls, blank texts, repeats and empty tables: see ``similarity_components``."""
    return similarity_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, p=90, q=100)


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * x >= 90 * (na.n + nb.n - x)
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""
