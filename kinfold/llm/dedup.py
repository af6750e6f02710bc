"""Exact deduplication by Grace hash partitioning over complete content.

``content_groups`` groups rows whose texts are equal once white space is deleted:

1. Every Arrow batch is collapsed first (one text per distinct content, with the copies'
   count and the best row), so a text that a third of all rows share reaches the shuffle
   once per batch rather than once per row.
2. The collapsed rows are hash-partitioned by digest. Each task fills an open-addressing
   table that compares complete contents. When the table outgrows its memory it is spilled,
   with the rest of the rows, to 16 files in the shared folder by the next four bits of the
   digest, and each file is treated alike. Equal contents fold into one entry, so what has
   to be split is always distinct contents, which the digest separates.

Rows find their group's result by digest; two different contents with one SHA-256 are an
error, never a merge.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

_BLANKS = re.compile(common.BLANKS)
_PARTIAL = pa.schema([("digest", pa.binary()), ("content", pa.large_string()), ("copies", pa.int64()), ("best_len", pa.int64()), ("best_id", pa.int64())])
_PARTIAL_DDL = "digest binary, content string, copies long, best_len long, best_id long"
_GROUP = pa.schema([("digest", pa.binary()), ("group_size", pa.int64()), ("keep_len", pa.int64()), ("keep_id", pa.int64())])
_GROUP_DDL = "digest binary, group_size long, keep_len long, keep_id long"
FANOUT = 16


def _rank(length: int, doc_id: int | None) -> tuple:
    """Larger is better: most code points, then least id, null ids last."""
    return (length, doc_id is not None, -(doc_id or 0))


class ContentTable:
    """Open addressing with linear probing; an entry is found by its digest's bits and told by its whole content."""

    def __init__(self, slots: int = 1024) -> None:
        self.slots: list[int] = [-1] * slots
        self.entries: list[list] = []
        self.bytes = 0

    def _slot(self, digest: bytes, content: str) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "big") & mask
        while (k := self.slots[at]) >= 0:
            entry = self.entries[k]
            if entry[1] == content:
                return at
            if entry[0] == digest:
                raise ValueError("two different contents have one SHA-256")
            at = (at + 1) & mask
        return at

    def add(self, digest: bytes, content: str, copies: int, length: int, doc_id: int | None) -> None:
        at = self._slot(digest, content)
        k = self.slots[at]
        if k >= 0:
            entry = self.entries[k]
            entry[2] += copies
            if _rank(length, doc_id) > _rank(entry[3], entry[4]):
                entry[3:] = [length, doc_id]
            return
        self.slots[at] = len(self.entries)
        self.entries.append([digest, content, copies, length, doc_id])
        self.bytes += 200 + len(content) * (1 if content.isascii() else 2)
        if len(self.entries) * 2 > len(self.slots):
            old, self.slots = self.entries, [-1] * (4 * len(self.slots))
            for k, entry in enumerate(old):
                self.slots[self._slot(entry[0], entry[1])] = k


def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to one partial row for each distinct content of a batch."""
    for ids, texts in common.columns_of(batches, "id", "text"):
        table = ContentTable()
        for doc_id, text in zip(ids, texts, strict=True):
            content = _BLANKS.sub("", text or "")
            table.add(hashlib.sha256(content.encode()).digest(), content, 1, len(text or ""), doc_id)
        yield common.batch_of(_PARTIAL, *zip(*table.entries, strict=True)) if table.entries else common.batch_of(_PARTIAL, [], [], [], [], [])


def grace(batches: Iterator[pa.RecordBatch], folder: str, memory: int, level: int = 0) -> Iterator[pa.RecordBatch]:
    """Fold partial rows by complete content; spill to FANOUT files in ``folder`` beyond ``memory`` bytes."""
    table, spill = ContentTable(), None
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in _PARTIAL.names), strict=True):
            table.add(*row)
        if table.bytes > memory and len(table.entries) > 1 and level < 64:
            spill = spill or Spill(folder, level)
            spill.write(table.entries)
            table = ContentTable()
    if spill is None:
        for at in range(0, len(table.entries), common.BATCH_ROWS):
            part = table.entries[at : at + common.BATCH_ROWS]
            yield common.batch_of(_GROUP, [e[0] for e in part], [e[2] for e in part], [e[3] for e in part], [e[4] for e in part])
        return
    spill.write(table.entries)
    del table
    for file in spill.close():
        yield from grace(spill.read(file), folder, memory, level + 1)
        spill.fs.delete_file(file)


class Spill:
    """FANOUT Arrow files, dealt by the digest's ``level``-th four bits."""

    def __init__(self, folder: str, level: int) -> None:
        self.fs, path = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(path, recursive=True)
        self.level, self.base, self.open = level, f"{path}/{level}-{uuid.uuid4().hex}", {}

    def write(self, entries: list[list]) -> None:
        dealt: dict[int, list] = {}
        for e in entries:
            dealt.setdefault(e[0][self.level // 2] >> (4 * (self.level % 2)) & 15, []).append(e)
        for k, rows in dealt.items():
            if k not in self.open:
                sink = self.fs.open_output_stream(f"{self.base}-{k}")
                self.open[k] = (sink, pa.ipc.new_stream(sink, _PARTIAL, options=pa.ipc.IpcWriteOptions(compression="lz4")))
            self.open[k][1].write_batch(common.batch_of(_PARTIAL, *zip(*rows, strict=True)))

    def close(self) -> list[str]:
        for sink, writer in self.open.values():
            writer.close()
            sink.close()
        return [f"{self.base}-{k}" for k in self.open]

    def read(self, file: str) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_stream(file) as source, pa.ipc.open_stream(source) as reader:
            yield from reader


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = 96 << 20) -> DataFrame:
    """One row per distinct content: (digest binary, group_size, keep_len, keep_id).

    ``memory``: bytes that one task's table may hold before it spills. Null text counts as
    empty, empty texts are equal to each other; of equal texts the one with most code points,
    then the least id, is kept, null ids last; an empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    common.tune(spark)
    root = common.scratch(spark, "grace")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = f"{root}/{uuid.uuid4().hex}"  # a lost or repeated attempt never meets another's files
        yield from grace(batches, folder, memory)
        fs, path = pafs.FileSystem.from_uri(folder)
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            fs.delete_dir(path)

    partial = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(common.streamed(collapse), _PARTIAL_DDL)
    return partial.repartition("digest").mapInArrow(common.streamed(fold), _GROUP_DDL)


def _normalised(text_col: str):
    return F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), common.BLANKS, "")


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Repeated rows (same id, equal content, same length) are kept once. See ``content_groups``
    for nulls and ties; other columns of ``docs`` are not read.
    """
    groups = content_groups(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(_normalised(text_col), 256)).alias("digest"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("len"))
    joined = rows.join(groups, "digest")
    best = common.same(F.col("doc_id").cast("long"), F.col("keep_id")) & (F.col("len") == F.col("keep_len"))
    rows = joined.select("doc_id", "keep_id", "group_size", best.alias("best"), "len", F.lower(F.hex("digest")).alias("text_sha256"))
    # By other keys than the join's: its exchange stays free to split a hot digest.
    first = F.row_number().over(W.partitionBy("doc_id", "text_sha256", "len").orderBy(F.lit(1))) == 1
    return rows.select("doc_id", "keep_id", "group_size", (F.col("best") & first).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with its own columns only, whatever their names.

    Nulls, ties, repeated rows and empty tables are as in ``mark_duplicates``.

    The text moves through one shuffle, by digest; a group's other copies are dropped in the
    join itself, so a hot group ends there.
    """
    digest, length, d, n, k = common.fresh(docs, "digest", "len", "d", "l", "k")
    groups = content_groups(docs, id_col, text_col).select(F.col("digest").alias(d), F.col("keep_len").alias(n), F.col("keep_id").alias(k))
    tagged = docs.withColumns({digest: F.unhex(F.sha2(_normalised(text_col), 256)), length: F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")})
    hit = tagged.join(groups, (F.col(digest) == F.col(d)) & (F.col(length) == F.col(n)) & common.same(F.col(id_col).cast("long"), F.col(k)), "inner")
    return hit.dropDuplicates([id_col, digest]).select(*docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, dropped ones too. Nulls, ties, repeats and empty tables: see ``mark_duplicates``."""
    return mark_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
  FROM documents
), r AS (
  SELECT doc_id, n,
         first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY n) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM r
"""
