"""What the corpus operators share: scratch tables, Arrow plumbing and connected components."""

from __future__ import annotations

import ctypes
import itertools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch handed to a Python worker, and bytes of one that a worker puts out: bounds what it holds.
BATCH_ROWS, BATCH_BYTES = 2048, 16 << 20

#: The white space that the text contracts name.
BLANKS = r"[\x20\x09-\x0D]"


def tune(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session; let small join sides prune large ones."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Bloom filters (of at most 8 MB) before shuffled joins with small selective sides, whatever the other side's size.
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "64MB")


def saved_in_small_batches(df: DataFrame, name: str, rows: int = 128) -> DataFrame:
    """``saved`` with Arrow batches of few rows: for rows that hold whole texts twice."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        return saved(df, name)
    finally:
        tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="kinfold-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def bucketed(df: DataFrame, name: str, buckets: int, key: tuple[str, ...]) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, bucketed by ``key``, and the table's name: groupings by that key don't shuffle it again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    table = "kinfold_" + path.rpartition("/")[2].replace("-", "_")
    df.write.bucketBy(buckets, *key).option("path", path).saveAsTable(table)
    return spark.table(table), table


def drop(spark: SparkSession, table: str) -> None:
    """Forget a bucketed table and delete its files."""
    files = spark.table(table).inputFiles()
    spark.sql(f"DROP TABLE {table}")
    if files:
        remove(spark, files[0].rpartition("/")[0])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def remove_saved(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df._saved_at)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` doesn't hold, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        found = next(x for x in (f"__{name}{i or ''}" for i in itertools.count()) if x.lower() not in taken)
        taken.add(found.lower())
        out.append(found)
    return out


def release() -> None:
    """Give free memory back to the system: a Python worker waits for its next task beside others, and allocators keep what they once had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def streamed(run: Callable) -> Callable:
    """A function over a task's batches that leaves no free memory with its worker."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return of


def grouped(run: Callable) -> Callable:
    """``streamed`` for a function of a group."""

    def of(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release()

    return of


def cogrouped(run: Callable) -> Callable:
    """``streamed`` for a function of two tables' groups."""

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            release()

    return of


def columns_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """Each batch's columns as Python lists."""
    for batch in batches:
        yield tuple(batch.column(name).to_pylist() for name in names)


def larger(batches: Iterable[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``rows`` rows or ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """The UTF-8 bytes of a column."""
    return df.agg(F.sum(F.octet_length(column).cast("long")).alias("n")).first()["n"] or 0


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


#: Links that one task joins up.
LINKS = 1 << 20
_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, least node reachable over this task's links), every node once."""
    held = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    u, v = (np.concatenate(x) for x in zip(*held, strict=True))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    for at in range(0, len(nodes), 1 << 16):
        yield batch_of(_LINK, pa.array(nodes[at : at + (1 << 16)]), pa.array(nodes[root[at : at + (1 << 16)]]))


def components(edges: DataFrame, a: str = "a", b: str = "b", links_per_task: int = LINKS) -> DataFrame:
    """Connected components of undirected edges: (node, component), component the least node reachable.

    Each task joins up ``links_per_task`` links; if that takes one task, it is done. Else what the tasks found is a smaller graph, for
    alternating large-star and small-star rounds, each a shuffle by node with map-side
    minima; a round ends in a table of the shared folder, so lost executors cost one
    round. The star centre's own list is never gathered: only minima are aggregated.
    Edges with a null end are ignored; no edges give no rows.
    """
    e = saved(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(),
        "links",
    )
    tasks = -(-e.count() // links_per_task)
    if tasks <= 1:
        return e.coalesce(1).mapInArrow(streamed(_joined_up), "u long, v long").select(F.col("u").alias("node"), F.col("v").alias("component"))
    met = saved(e.repartition(tasks, "u").mapInArrow(streamed(_joined_up), "u long, v long").where("u <> v").distinct(), "links")
    remove_saved(e)
    e = met
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.where("u <> v").distinct(), "large-star")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        small = small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        nxt = saved(small.distinct(), "small-star")
        done = _signature(nxt) == _signature(e)
        remove_saved(large, e)
        e = nxt
        if done:
            break
    lowest = e.groupBy("u").agg(F.min("v").alias("v"))
    return lowest.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _signature(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
