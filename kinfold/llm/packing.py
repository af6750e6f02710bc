"""Packing token ids into fixed sequences: first-fit decreasing in randomised groups.

Documents are tokenised once, where they are read. Their ids then travel, two bytes each,
to a random group of bounded size (``group_bytes`` of text on average; a row that is repeated goes to another
group each time, so that copies don't meet in one). In a group, full
sequences are cut from long documents first; the remainders are packed by first-fit
decreasing, the first bin with room being found by a tournament tree over the bins' free
capacities. Last, the emptiest bins are cut up to close the gaps of the others, so that at
most one sequence of a group isn't full; that one is cut at powers of two, which need no
padding.
"""

from __future__ import annotations

import itertools
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_IDS = pa.schema([("grp", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])
_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Marks that the tokenizer keeps apart from letters before them.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Sequences that one group may number.
_STRIDE = 1 << 32


class Tournament:
    """A complete binary tree whose leaves are bins' free capacities and whose inner nodes hold the larger child."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.tree = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """The leftmost bin with room for ``size``; its room shrinks by that."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        tree[at] -= size
        found = at - self.leaves
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; every size is 1 to ``capacity``."""
    tournament = Tournament(len(sizes), capacity)
    bins: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = tournament.first_fit(sizes[k])
        if at == len(bins):
            bins.append([])
        bins[at].append(k)
    return bins


def pack(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces; every token of every document is in one piece."""
    sequences = [[(d, at, capacity)] for d, n in enumerate(lengths) for at in range(0, n - n % capacity, capacity)]
    rest = [(d, n - n % capacity, n % capacity) for d, n in enumerate(lengths) if n % capacity]
    bins = [[rest[k] for k in items] for items in first_fit_decreasing([p[2] for p in rest], capacity)]
    fill = [sum(p[2] for p in b) for b in bins]
    sequences += [b for b, f in zip(bins, fill, strict=True) if f == capacity]
    gaps = sorted(((f, b) for f, b in zip(fill, bins, strict=True) if f < capacity), key=lambda x: -x[0])
    first, last = 0, len(gaps) - 1
    while first < last:  # the emptiest bin gives to the fullest
        f, b = gaps[first]
        g, donor = gaps[last]
        while f < capacity and donor:
            d, start, n = donor.pop()
            take = min(n, capacity - f)
            b.append((d, start, take))
            if take < n:
                donor.append((d, start + take, n - take))
            f, g = f + take, g - take
        gaps[first], gaps[last] = (f, b), (g, donor)
        if f == capacity:
            sequences.append(b)
            first += 1
        if not donor:
            last -= 1
    if first == last and gaps[first][1]:
        sequences += _powers_of_two(gaps[first][1])
    return sequences


def _powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut one partly filled sequence into sequences whose lengths are the powers of two in its length."""
    total, out = sum(p[2] for p in pieces), []
    pieces = pieces[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        if not total >> bit & 1:
            continue
        room, cut = 1 << bit, []
        while room:
            d, start, n = pieces.pop()
            take = min(n, room)
            cut.append((d, start, take))
            room -= take
            if take < n:
                pieces.append((d, start + take, n - take))
        out.append(cut)
    return out


class WordTokenizer:
    """Little-endian 16-bit ids of whole texts.

    The tokenizer drops white space and treats what stands between it alone, so texts are split
    and their words numbered by Arrow, each distinct word is looked up once for a stretch of texts, and ids
    are gathered by NumPy. Stretches are of ``TEXT`` bytes, or a longer text; their distinct words are looked up ``DISTINCT`` at a time,
    and the letters and marks kept are forgotten where there are more than ``cache`` before that.
    """

    #: Words encoded, ids gathered, bytes of text split, and distinct words looked up, at once.
    WORDS, IDS, TEXT, DISTINCT = 16_384, 1 << 20, 4 << 20, 1 << 16

    def __init__(self, path: str, cache: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Texts with these, in any case, are for the tokenizer alone: special tokens, and what Arrow takes for white space and it doesn't.
        self.whole = "|".join(["[\x1c-\x1f]", *(f"(?i:{x})" for x in special)])
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known, self.cache = {"": b""}, cache

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """``texts``: an Arrow array of strings without nulls."""
        ends = np.r_[0, np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)]
        found: list[bytes] = []
        while (at := len(found)) < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + self.TEXT, "right")) - 1)
            found += self._stretch(texts.slice(at, to - at))
        return found

    def _stretch(self, texts: pa.Array) -> list[bytes]:
        lists = pc.utf8_split_whitespace(self._lower(texts))
        numbered = lists.flatten().dictionary_encode()
        codes, distinct = numbered.indices.to_numpy(), numbered.dictionary
        words: list[bytes] = []
        for at in range(0, len(distinct), self.DISTINCT):
            words += self._look_up(distinct.slice(at, self.DISTINCT).to_pylist())
        sizes = np.fromiter(map(len, words), np.int32, len(words)) // 2
        ids, starts = np.frombuffer(b"".join(words), "<u2"), (np.cumsum(sizes) - sizes).astype(np.int32)
        each = sizes[codes]
        ends = np.r_[0, np.cumsum(each, dtype=np.int64)]
        offsets = lists.offsets.to_numpy()
        bounds = ends[offsets - offsets[0]]
        found: list[bytes] = []
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + self.IDS, "right")) - 1)
            part = slice(offsets[at] - offsets[0], offsets[to] - offsets[0])
            shift = (starts[codes[part]] - (ends[part] - bounds[at])).astype(np.int32)
            out = ids[np.repeat(shift, each[part]) + np.arange(bounds[to] - bounds[at], dtype=np.int32)].tobytes()
            cuts = (2 * (bounds[at : to + 1] - bounds[at])).tolist()
            found += [out[a:b] for a, b in itertools.pairwise(cuts)]
            at = to
        for k in np.flatnonzero(pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False)):
            found[k] = self._ids(self.tokenizer.encode(texts[int(k)].as_py(), add_special_tokens=False))
        return found

    @staticmethod
    def _lower(texts: pa.Array) -> pa.Array:
        """Lower case where every library agrees on it; the tokenizer lower-cases what is left."""
        return pc.if_else(pc.match_substring_regex(texts, "[^\x00-\u012f]"), texts, pc.utf8_lower(texts))

    @staticmethod
    def _ids(encoding) -> bytes:
        return np.asarray(encoding.ids, "<u2").tobytes()

    def _look_up(self, words: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > self.cache:
            known.clear()
            known[""] = b""
        found = [known.get(w) for w in words]
        parts: list[tuple[int, str, str]] = []  # a new word's place, its letters and the marks after them
        letters: set[str] = set()
        other: set[str] = set()
        for k, w in enumerate(words):
            if found[k] is None:
                core = w.rstrip(_MARKS)
                if core.isalpha() and (core.isascii() or unicodedata.normalize("NFC", core).lower()[-1].isalpha()):
                    letters.add(core)
                else:
                    core = w
                    other.add(w)
                parts.append((k, core, w[len(core) :]))
        other.update(marks for _, _, marks in parts)
        other.difference_update(known)
        fresh = list(letters.difference(known))
        for at in range(0, len(fresh), self.WORDS):
            self._learn_letters(fresh[at : at + self.WORDS])
        rest = list(other)
        for at in range(0, len(rest), self.WORDS):
            self._learn(rest[at : at + self.WORDS])
        for k, core, marks in parts:  # kept are letters and marks, not what they make together
            found[k] = known[core] + known[marks]
        return found

    def _learn_letters(self, words: list[str]) -> None:
        """Words of letters alone: each ends where a token says that it ends a word."""
        ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u2")
        cuts = (2 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(cuts) != len(words):
            self._learn(words)
            return
        blob = ids.tobytes()
        self.known.update(zip(words, (blob[a:b] for a, b in zip([0, *cuts], cuts, strict=False)), strict=True))

    def _learn(self, words: list[str]) -> None:
        """Any words, told apart by their offsets."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.fromiter((o[0] for o in found.offsets), np.int64, len(found.ids))
        blob, at = self._ids(found), 0
        for word, cut in zip(words, (2 * np.searchsorted(starts, ends)).tolist(), strict=True):
            self.known[word] = blob[at:cut]
            at = cut


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = 8 << 20, seed: int = 17) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer``: path of a tokenizer file of at most 65,536 ids; ``end_id`` ends each
    document. Null texts are empty: such a document is its end id. Special tokens written out in a text become
    their ids, as the tokenizer has it. Repeated rows are
    documents of their own; null ids stay null. ``group_bytes`` of text fill a group on
    average, whatever the corpus' size, so a task's memory doesn't grow. An empty table gives
    no rows. Other columns are not read.
    """
    common.tune(docs.sparkSession)
    groups = max(1, -(-common.text_bytes(docs, text_col) // group_bytes))
    end = np.asarray([end_id], "<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, task, times = WordTokenizer(tokenizer), TaskContext.get().partitionId(), {}
        for batch in common.larger(batches, 4 * common.BATCH_ROWS, WordTokenizer.TEXT):
            blobs, grp = [x + end for x in run(pc.fill_null(batch.column("text"), ""))], []
            for doc_id, blob in zip(batch.column("id").to_pylist(), blobs, strict=True):
                key = xxhash.xxh3_64_intdigest(blob, seed=(doc_id or 0) & (1 << 63) - 1)
                times[key] = n = times.get(key, 0) + 1  # the same numbers in whatever order a task's rows come
                grp.append(xxhash.xxh3_64_intdigest(b"%d %d %d %d" % (seed, key, task, n)) % groups)
            yield common.batch_of(_IDS, grp, batch.column("id"), blobs)

    def pack_group(table: pa.Table) -> pa.Table:
        grp, ids = table.column("grp")[0].as_py(), table.column("doc_id").to_pylist()
        blobs = table.column("ids").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, blobs[k]))
        lengths = [len(blobs[k]) // 2 for k in order]
        rows: list[tuple] = []
        for s, pieces in enumerate(pack(lengths, capacity)):
            offset = 0
            for d, start, n in pieces:
                k = order[d]
                crc = zlib.crc32(np.frombuffer(blobs[k], "<u2", n, 2 * start).astype("<u4").tobytes())
                rows.append((ids[k], start, n, crc, lengths[d], grp * _STRIDE + s, offset))
                offset += n
        return pa.Table.from_batches([common.batch_of(_PIECE, *zip(*rows, strict=True))], schema=_PIECE)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(common.streamed(encode), "grp long, doc_id long, ids binary").groupBy("grp").applyInArrow(common.grouped(pack_group), _PIECE_DDL)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096. Nulls, repeats and empty tables: see ``pack_documents``."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
