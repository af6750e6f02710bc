"""Byte-level BPE by corpus-level merge replay.

1. Every chunk of texts (an Arrow batch) sends its distinct words (matches of the split pattern) to parts by their hash.
2. A part has all chunks' words of its hashes; each distinct one is encoded once. The words are numbered. An inverted index maps
   each token pair to the word positions where it stands. Merges are replayed in rank order: the
   lowest pair in the index is merged wherever it stands, and only the pairs with the merged token's
   neighbours change.
3. The ids go back to the chunks, in the order of the words sent, and become a file each in the shared folder. No task and not the
   driver ever holds the corpus' vocabulary.
4. Each chunk's texts are split again and find their words' ids in its file. A chunk is known by its content; one that has no file
   (its rows came in other batches than before) replays merges over its own words, with the same result.

Only distinct words travel, texts don't. A word in every chunk arrives once a chunk; parts are split by groups of chunks
beyond ``GROUPED`` bytes of text, so that a part's size doesn't grow with the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
#: Bytes of text to a part of the vocabulary, and those beyond which chunks are dealt to groups with parts of their own.
PART, GROUPED = 32 << 20, 24 << 30
_SENT = pa.schema([("part", pa.int64()), ("chunk", pa.binary()), ("words", pa.binary())])
_BACK = pa.schema([("chunk", pa.binary()), ("part", pa.int64()), ("ids", pa.binary())])
_FILE = pa.schema([("part", pa.int64()), ("ids", pa.binary())])
_OUT_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token, a space, its rank, a line each."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs: dict[int, int] = {}  # rank of a pair of ids, -1 if it doesn't merge

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 where they don't merge; each distinct pair is looked up once."""
        keys, at = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)
        known, tokens, out = self.pairs, self.tokens, []
        for key in keys.tolist():
            found = known.get(key)
            if found is None:
                found = known[key] = self.ranks.get(tokens[key >> 32] + tokens[key & 0xFFFFFFFF], -1)
            out.append(found)
        return np.array(out, np.int32)[at]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct words. A word that is a token is that token.

        A pass merges the lowest rank in the index at the leftmost place of every word that holds it; a word's
        other places wait, as the merge may have made a pair of lower rank there.
        """
        out: list[list[int] | None] = [[r] if (r := self.ranks.get(w)) is not None else ([] if not w else None) for w in words]
        todo = [k for k, found in enumerate(out) if found is None]
        if not todo:
            return out
        if len(self.pairs) > 300_000:
            self.pairs.clear()
        sizes = np.fromiter((len(words[k]) for k in todo), np.int64, len(todo))
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        ids = self.single[np.frombuffer(b"".join(words[k] for k in todo), np.uint8)]
        word_of = np.repeat(np.arange(len(todo), dtype=np.int32), sizes)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1], before[ends - sizes] = -1, -1
        rank_at = np.full(n, -1, np.int32)
        at = np.flatnonzero(after >= 0).astype(np.int32)
        index: dict[int, list[np.ndarray]] = {}  # rank of a pair -> where it begins
        heap: list[int] = []

        def file(at: np.ndarray, found: np.ndarray) -> None:
            rank_at[at] = found
            held = found >= 0
            at, found = at[held], found[held]
            if len(at) > 1:
                order = np.argsort(found, kind="stable")
                at, found = at[order], found[order]
                cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
                parts = zip(found[np.r_[0, cuts]].tolist(), np.split(at, cuts), strict=True) if len(cuts) else ((int(found[0]), at),)
            else:
                parts = ((int(r), at) for r in found)
            for r, part in parts:
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        file(at, self._ranks(ids[at], ids[at + 1]))
        while heap:
            lowest = heapq.heappop(heap)
            parts = index.pop(lowest)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[rank_at[at] == lowest]  # elsewhere a neighbour's merge has taken one of the two
            if not len(at):
                continue
            at.sort()
            owner = word_of[at]
            again = np.r_[False, owner[1:] == owner[:-1]]
            if again.any():
                index[lowest] = [at[again]]
                heapq.heappush(heap, lowest)
                at = at[~again]
            right = after[at]
            following, leading = after[right], before[at]
            ids[at], after[at], rank_at[at], rank_at[right] = lowest, following, -1, -1
            has = following >= 0
            before[following[has]] = at[has]
            left = leading[leading >= 0]
            starts = np.concatenate([at[has], left])
            if len(starts):
                file(starts, self._ranks(ids[starts], ids[after[starts]]))
        alive = np.zeros(n, bool)
        at = (ends - sizes).astype(np.int32)
        while len(at):
            alive[at] = True
            at = after[at]
            at = at[at >= 0]
        kept, owners = ids[alive].tolist(), word_of[alive]
        cuts = np.r_[0, np.cumsum(np.bincount(owners, minlength=len(todo)))].tolist()
        for j, k in enumerate(todo):
            out[k] = kept[cuts[j] : cuts[j + 1]]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Numbering(dict):
    """Words to numbers in order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


@lru_cache(maxsize=1)
def _replay(path: str) -> MergeReplay:
    """One table for a worker, however many groups it works on."""
    return MergeReplay(load_ranks(path))


class Parts:
    """Which part of the vocabulary a chunk's word belongs to; ``text_bytes`` of the whole corpus."""

    def __init__(self, text_bytes: int) -> None:
        self.groups = max(1, -(-text_bytes // GROUPED))
        self.buckets = max(8, -(-text_bytes // (PART * self.groups)))

    def of(self, chunk: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(words' numbers in order of their parts, their parts)."""
        first = int.from_bytes(chunk[:6], "big") % self.groups * self.buckets
        parts = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(self.buckets)
        order = np.argsort(parts, kind="stable")
        return order, parts[order].astype(np.int64) + first


class Chunk:
    """The distinct words of some texts, where each text has them, and the name that the texts' content gives them.

    A blank between two characters that aren't white space ends a match of the pattern and begins the next one. So texts are cut
    there by Arrow, and the pattern is only matched against the distinct pieces, all in one text; texts with other blanks are matched whole.
    """

    def __init__(self, texts: pa.Array, pattern) -> None:
        texts, name = pc.fill_null(texts, ""), xxhash.xxh3_128()
        for data in texts.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist():
            name.update(b"%d " % len(data))
            name.update(data)
        lists = pc.split_pattern(texts, " ")
        numbered = lists.flatten().dictionary_encode()
        pieces, codes, offsets = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy(), lists.offsets.to_numpy()
        bounds = (offsets - offsets[0]).astype(np.int64)
        bare = pc.utf8_trim_whitespace(numbered.dictionary)
        odd = pc.or_(pc.not_equal(bare, numbered.dictionary), pc.equal(bare, "")).to_numpy(zero_copy_only=False)[codes]
        odd_before = np.r_[0, np.cumsum(odd)]
        whole = odd_before[bounds[1:]] > odd_before[bounds[:-1]]
        inner = np.repeat(~whole, np.diff(bounds))
        inner[bounds[:-1]] = False  # every text has a first piece
        used = np.zeros(len(pieces), bool)
        used[codes[inner]] = True
        self.bounds, self.whole, self.codes = bounds.tolist(), whole.tolist(), codes.tolist()
        numbers, find = _Numbering(), pattern.findall
        number = numbers.__getitem__
        #: Words of each piece after a blank; of each text that is matched whole, else of its first piece.
        places = np.flatnonzero(used).tolist()
        held = [" " + pieces[i] for i in places]
        matches = find("".join(held))
        ends = np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
        cuts = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, held), np.int64, len(held))), "right").tolist()
        words = list(map(number, matches))
        self.pieces: list[list[int]] = [[]] * len(pieces)
        for i, a, b in zip(places, [0, *cuts], cuts, strict=False):
            self.pieces[i] = words[a:b]
        self.starts = [list(map(number, find(texts[k].as_py() if w else pieces[self.codes[at]]))) for k, (w, at) in enumerate(zip(self.whole, self.bounds, strict=False))]
        self.words, self.name = [w.encode("utf-8", "replace") for w in numbers], name.digest()

    def each(self, of_words: list, joined) -> Iterator:
        """For each text, its words' values: ``joined`` joins those of a piece first, then a text's."""
        pieces = [joined([of_words[w] for w in x]) if len(x) != 1 else of_words[x[0]] for x in self.pieces]
        for k, (a, b) in enumerate(itertools.pairwise(self.bounds)):
            start = joined([of_words[w] for w in self.starts[k]])
            yield start if self.whole[k] else joined([start, *[pieces[c] for c in self.codes[a + 1 : b]]])


def _pieces(lengths: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(lengths, dtype=np.int64)]


def _packed(items: list[bytes]) -> bytes:
    """A count, lengths and bytes of some items."""
    return len(items).to_bytes(4, "little") + np.fromiter(map(len, items), "<u4", len(items)).tobytes() + b"".join(items)


def _unpacked(blob: bytes) -> list[bytes]:
    n = int.from_bytes(blob[:4], "little")
    cuts = (_pieces(np.frombuffer(blob, "<u4", n, 4)) + 4 + 4 * n).tolist()
    return [blob[a:b] for a, b in itertools.pairwise(cuts)]


def _packed_ids(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """The ids of words, each ``sizes`` of them from ``starts`` on in ``flat``: a count, sizes and ids."""
    ends = np.cumsum(sizes)
    where = np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    return len(sizes).to_bytes(4, "little") + sizes.astype("<u4").tobytes() + flat[where].astype("<u4").tobytes()


def _unpacked_ids(blob: bytes) -> list[list[int]]:
    n = int.from_bytes(blob[:4], "little")
    cuts, ids = _pieces(np.frombuffer(blob, "<u4", n, 4)).tolist(), np.frombuffer(blob, "<u4", -1, 4 + 4 * n).tolist()
    return [ids[a:b] for a, b in itertools.pairwise(cuts)]


def _send(pattern: str, parts: Parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        for batch in batches:
            chunk = Chunk(batch.column("text"), split)
            order, part = parts.of(chunk.name, chunk.words)
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist() if len(part) else []
            rows = [(int(part[a]), chunk.name, _packed([chunk.words[i] for i in order[a:b].tolist()])) for a, b in itertools.pairwise([*cuts, len(part)])]
            if rows:
                yield common.batch_of(_SENT, *zip(*rows, strict=True))

    return run


def _encode_part(ranks_path: str):
    def run(table: pa.Table) -> pa.Table:
        """One part's words of all chunks: each distinct word is encoded once, each chunk gets its own back in its order."""
        numbers, rows = _Numbering(), []
        for blob in table.column("words").to_pylist():
            rows.append(np.fromiter(map(numbers.__getitem__, _unpacked(blob)), np.int64))
        found = _replay(ranks_path).encode(list(numbers))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        return pa.table([table.column("chunk").combine_chunks(), table.column("part").combine_chunks(), pa.array([_packed_ids(flat, starts[r], sizes[r]) for r in rows], pa.binary())], schema=_BACK)

    return run


def _file_of(folder: str, chunk: bytes) -> str:
    name = chunk.hex()
    return f"{folder}/{name[:2]}/{name}.arrow"


def _keep_file(folder: str):
    def run(table: pa.Table) -> pa.Table:
        """One chunk's ids as a file; it appears at once and whole, so a lost or repeated attempt does no harm."""
        chunk = table.column("chunk")[0].as_py()
        rows = {p: ids for p, ids in zip(table.column("part").to_pylist(), table.column("ids").to_pylist(), strict=True)}
        fs, path = pafs.FileSystem.from_uri(_file_of(folder, chunk))
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        own = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as sink, pa.ipc.new_stream(sink, _FILE, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_batch(common.batch_of(_FILE, list(rows), list(rows.values())))
        fs.move(own, path)
        return pa.table([pa.array([chunk], pa.binary())], names=["chunk"])

    return run


class Vocabulary:
    """Ids of a chunk's words, from its file; without one, by a replay over them."""

    def __init__(self, folder: str | None, ranks_path: str, parts: Parts) -> None:
        self.folder, self.path, self.parts = folder, ranks_path, parts

    def ids(self, chunk: Chunk) -> list[list[int]]:
        if self.folder is not None and chunk.words:
            fs, path = pafs.FileSystem.from_uri(_file_of(self.folder, chunk.name))
            if fs.get_file_info(path).type == pafs.FileType.File:
                with fs.open_input_stream(path) as source, pa.ipc.open_stream(source) as reader:
                    table = reader.read_all()
                held = dict(zip(table.column("part").to_pylist(), table.column("ids").to_pylist(), strict=True))
                order, part = self.parts.of(chunk.name, chunk.words)
                out: list[list[int]] = [[]] * len(order)
                found = itertools.chain.from_iterable(_unpacked_ids(held[p]) for p in dict.fromkeys(part.tolist()))
                for i, ids in zip(order.tolist(), found, strict=True):
                    out[i] = ids
                return out
        return _replay(self.path).encode(chunk.words)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids. Null and empty texts have no ids; rows keep their number; an empty table gives none."""

    def whole(chunk: Chunk, ids: list[list[int]], doc_ids: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(list(chunk.each(ids, lambda x: list(itertools.chain.from_iterable(x)))), pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _mapped(docs, ranks_path, pattern, id_col, text_col, "doc_id long, ids array<int>", lambda _: whole)


def token_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the bytes that the ids decode to).

    Null text counts as empty, whose digests are those of nothing. Null ids and repeated rows give rows like
    others; an empty table gives none. Other columns are not read.
    """

    def digests(replay: MergeReplay):
        decimal = [str(i) for i in range(len(replay.tokens))]

        def run(chunk: Chunk, ids: list[list[int]], doc_ids: pa.Array) -> pa.RecordBatch:
            texts, back = [" ".join([decimal[i] for i in word]) for word in ids], [replay.decode(word) for word in ids]
            counts, shas = [], []
            for text in chunk.each(texts, " ".join):
                counts.append(text.count(" ") + 1 if text else 0)
                shas.append(hashlib.sha256(text.encode()).hexdigest())
            return common.batch_of(_OUT, doc_ids, counts, shas, [hashlib.sha256(x).hexdigest() for x in chunk.each(back, b"".join)])

        return run

    return _mapped(docs, ranks_path, pattern, id_col, text_col, _OUT_DDL, digests)


def _mapped(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, schema: str, made) -> DataFrame:
    spark = docs.sparkSession
    common.tune(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts, folder = Parts(common.text_bytes(docs, text_col)), common.scratch(spark, "word-ids")
    # The id is sent along, so that batches are cut as they will be again.
    sent = rows.mapInArrow(_send(pattern, parts), "part long, chunk binary, words binary")
    back = sent.groupBy("part").applyInArrow(_encode_part(ranks_path), "chunk binary, part long, ids binary")
    common.remove_saved(common.saved(back.groupBy("chunk").applyInArrow(_keep_file(folder), "chunk binary"), "chunks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, vocabulary, make = regex.compile(pattern), Vocabulary(folder, ranks_path, parts), made(_replay(ranks_path))
        for batch in batches:
            chunk = Chunk(batch.column("text"), split)
            yield make(chunk, vocabulary.ids(chunk), batch.column("id"))

    return rows.mapInArrow(run, schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents. Nulls, repeats and empty tables: see ``token_digests``."""
    import public_tokenizers

    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
