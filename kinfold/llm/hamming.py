"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into m segments. Codes within distance m(r + 1) - 1 of a query differ from it by at
most r bits in some segment. So a query looks up, segment by segment, all values at radius r =
0, 1, 2, ... and stops when its k-th best verified distance is at most m(r + 1) - 1: nothing
unseen can be nearer or as near. Radii grow only for queries that are still open.

The index lies in groups by segment and the high bits of the segment's value; a group of more than
``GROUP`` codes is split by hash. It is laid out once, in a table bucketed by group; each radius shuffles only what is
asked and reads the buckets where they lie. Equal queries are one query until the end. A query goes to the groups whose high bits are within the radius, where the
rest of the radius is spent on the low bits, and only its k best come back: look-ups and candidates
never leave the group. Equal codes are one entry of the index with their k least ids (more can't be in any
answer), so a code that a third of all rows share is looked up like any other.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

#: Codes that one group of the index holds at most, but for chance.
GROUP = 1 << 16
_FOUND = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("distance", pa.int32())])


def sign_code(vector: Column, bits: int = 64) -> Column:
    """Bit i of a 64-bit code: whether component i is above zero. Null vectors have a null code; other lengths are an error."""
    wrong = F.raise_error(F.concat(F.lit(f"a vector must have {bits} components, not "), F.size(vector).cast("string"))).cast("long")
    return F.when(vector.isNotNull() & (F.size(vector) != bits), wrong).when(vector.isNotNull(), F.aggregate(
        F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x)))


def segments(bits: int, rows: int) -> list[tuple[int, int]]:
    """(offset, width) of the segments: about log2(rows) bits each, 8 to 22, so that a look-up meets few codes."""
    width = min(22, max(8, round(math.log2(max(2, rows)))))
    m = max(1, round(bits / width))
    cuts = [round(i * bits / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(cuts)]


def masks(width: int, radius: int) -> list[int]:
    """All values of ``width`` bits with ``radius`` ones."""
    return [sum(1 << i for i in at) for at in itertools.combinations(range(width), radius)]


def _segment(code: Column, offset: int, width: int) -> Column:
    return F.shiftrightunsigned(code, offset).bitwiseAND(F.lit((1 << width) - 1))


class Group:
    """Codes of one group in order of their segment's low bits, with the place where each value begins."""

    def __init__(self, codes: np.ndarray, ids: list[list[int]], offset: int, low: int) -> None:
        values = (codes.view(np.uint64) >> np.uint64(offset) & np.uint64((1 << low) - 1)).astype(np.int64)
        order = np.argsort(values, kind="stable")
        self.codes, self.ids, self.offset, self.low = codes[order].view(np.uint64), [ids[i] for i in order], offset, low
        self.starts = np.searchsorted(values[order], np.arange((1 << low) + 1))
        self.first = np.array([i[0] for i in self.ids], np.int64)

    def nearest(self, query: int, flips: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (distance, id) of codes whose low bits are the query's with one of ``flips``."""
        q = np.int64(query).view(np.uint64)
        at = int(q >> np.uint64(self.offset) & np.uint64((1 << self.low) - 1)) ^ flips
        begin, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(size)
        if not len(ends) or not ends[-1]:
            return []
        where = np.repeat(begin - (ends - size), size) + np.arange(ends[-1])
        distance = np.bitwise_count(self.codes[where] ^ q).astype(np.int64)
        if len(where) > k:  # codes in order of distance, then least id: the k best ids are among k codes
            best = np.lexsort((self.first[where], distance))[:k]
            where, distance = where[best], distance[best]
        return sorted((d, i) for w, d in zip(where.tolist(), distance.tolist(), strict=True) for i in self.ids[w])[:k]


def _search(cut: list[tuple[int, int]], high: int, k: int):
    def run(asked: pa.Table, index: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asked.num_rows and index.num_rows:
            offset, width = cut[asked.column("seg")[0].as_py()]
            low = width - min(high, width)
            group = Group(index.column("code").to_numpy(), index.column("ids").to_pylist(), offset, low)
            flips = {r: np.array(masks(low, r), np.int64) for r in set(asked.column("rest").to_pylist()) if r <= low}
            for query, rest in zip(*(asked.column(c).to_pylist() for c in ("query", "rest")), strict=True):
                if rest in flips:
                    out += [(query, i, d) for d, i in group.nearest(query, flips[rest], k)]
        return pa.Table.from_batches([common.batch_of(_FOUND, *zip(*out, strict=True))] if out else [], schema=_FOUND)

    return run


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, bits: int = 64) -> DataFrame:
    """One row per query and neighbour: query_id, rank (from 1), vec_id, distance.

    ``codes`` and ``queries``: id and code (64-bit). Nearest by Hamming distance, then least id; a query that
    is a row itself finds itself. Null ids and codes are left out. Repeated rows of an id with one code count once,
    with several as its several codes. Fewer than k rows: all. Empty tables give no rows.
    """
    codes = codes.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    nearest = F.row_number().over(W.partitionBy("code").orderBy("id"))
    held = common.saved(codes.withColumn("n", nearest).where(F.col("n") <= k).groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    count = held.count()
    cut = segments(bits, count)
    high = max(3, math.ceil(math.log2(max(1, 2 * count / GROUP))))

    def head(code: Column, offset: int, width: int) -> Column:
        return _segment(code, offset + width - min(high, width), min(high, width))

    parts = F.array(*(F.struct(F.lit(i).alias("seg"), head(F.col("code"), o, w).alias("hi")) for i, (o, w) in enumerate(cut)))
    placed = held.select("code", "ids", F.explode(parts).alias("part")).select("part.seg", "part.hi", "code", "ids")
    splits = placed.groupBy("seg", "hi").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("splits"))
    key = ("seg", "hi", "split")
    index = placed.join(splits, ["seg", "hi"]).withColumn("split", F.pmod(F.xxhash64("code"), F.col("splits")).cast("int")).select(*key, "code", "ids")
    buckets = max(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count * len(cut) // (GROUP * 8)))
    index, name = common.bucketed(index.repartition(buckets, *key), "segments", buckets, key)
    splits = common.saved(index.groupBy("seg", "hi").agg((F.max("split") + 1).alias("splits")), "splits")
    wanted = common.saved(queries.where("id IS NOT NULL AND code IS NOT NULL").select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct(), "queries")
    open_ = common.saved(wanted.select("query").distinct(), "open")

    best, done = None, []
    by = W.partitionBy("query").orderBy("distance", "vec_id")
    for radius in range(max(w for _, w in cut) + 1):
        near = F.array(*(
            F.struct(F.lit(i).alias("seg"), head(F.col("query"), o, w).bitwiseXOR(F.lit(m)).alias("hi"), F.lit(radius - m.bit_count()).alias("rest"))
            for i, (o, w) in enumerate(cut) for r in range(min(radius, high, w) + 1) for m in masks(min(high, w), r)
        ))
        asked = open_.select("query", F.explode(near).alias("p")).select("query", "p.*").join(splits, ["seg", "hi"])
        asked = asked.withColumn("split", F.explode(F.sequence(F.lit(0), F.col("splits") - 1))).drop("splits")
        found = asked.groupBy(*key).cogroup(index.groupBy(*key)).applyInArrow(_search(cut, high, k), "query long, vec_id long, distance int")
        if best is not None:
            found = found.union(best.select(*found.columns))
        top = common.saved(found.distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k), "nearest")
        reach = len(cut) * (radius + 1) - 1
        closed = top.groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("far")).where((F.col("n") >= k) & (F.col("far") <= reach)).select("query")
        done.append(top.join(closed, "query"))
        best = top.join(closed, "query", "left_anti")
        open_ = common.saved(open_.join(closed, "query", "left_anti"), "open")
        if open_.isEmpty():
            break
    else:
        done.append(best)  # fewer than k rows in all
    result = done[0]
    for part in done[1:]:
        result = result.union(part.select(*result.columns))
    common.drop(codes.sparkSession, name)
    result = wanted.join(result, "query")
    return result.select("query_id", F.col("rank").cast("long").alias("rank"), "vec_id", F.col("distance").cast("long").alias("distance"))


def op5_topk_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every vector whose id is divisible by 100, against all vectors; k = 10."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code"))
    vectors = common.saved(vectors, "sign-codes")
    return top_k(vectors, vectors.where("id % 100 = 0"), k=10)


OP5_SQL = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
q AS (SELECT vec_id AS query_id, bits AS query FROM c WHERE vec_id % 100 = 0),
d AS (SELECT query_id, vec_id, list_sum(list_transform(range(1, 65), lambda i: (query[i] <> bits[i])::INT))::BIGINT AS distance FROM q, c),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""
