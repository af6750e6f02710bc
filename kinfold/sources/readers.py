"""Readers of source tables and ground truth; everything is text."""

from __future__ import annotations

from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import columns_named
from .discovery import discover, list_files

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]


def required(table: str) -> list[str]:
    return TRUTH_COLUMNS if table.endswith("ground_truth") else SOURCE_COLUMNS


def read_delimited(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Text columns of a file with a header; doubled quotes, empty is null, and a line of another length is an error."""
    with_header = spark.read.options(header=True, sep=separator, quote='"', escape='"', nullValue="", multiLine=True, mode="FAILFAST")
    return with_header.csv(path, inferSchema=False, enforceSchema=False)


def read_file(spark: SparkSession, path: str) -> DataFrame:
    kind = PurePosixPath(path).suffix.lower()
    return spark.read.parquet(path) if kind == ".parquet" else read_delimited(spark, path, "," if kind == ".csv" else "\t")


def standardised(df: DataFrame, table: str) -> DataFrame:
    """The required columns only, as text with trimmed ids; a list of ids is joined by commas."""
    out = []
    for name, c, kind in columns_named(df, required(table), table):
        if kind.startswith("array"):
            c = F.array_join(F.transform(c, lambda x: F.trim(x.cast("string"))), ",")
        c = c.cast("string")
        out.append((F.trim(c) if name.endswith("entity_id") else c).alias(name))
    return df.select(*out)


def read_table(spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
    """All files of a table. Parquet files are one scan that reads the required columns."""
    if all(p.endswith(".parquet") for p in paths):
        return standardised(spark.read.option("mergeSchema", True).parquet(*paths), table)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (standardised(read_file(spark, p), table) for p in paths))


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: read_table(spark, t, paths) for t, paths in discover(list_files(spark, root)).items()}


def materialised(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """``df`` as zstd Parquet at ``path``, written only if no finished copy is there."""
    spark = df.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if force or not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def read_lists(spark: SparkSession, path: str, header: tuple[str, str]) -> DataFrame:
    """A two-column TSV read strictly: its header, two fields a line and no repeated key, else ValueError."""
    lines = spark.read.text(path).where(F.col("value") != F.lit("\t".join(header)))
    parts = F.split("value", "\t")
    rows = lines.select(F.get(parts, F.lit(0)).alias(header[0]), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias(header[1]), F.size(parts).alias("n"))
    first = spark.read.text(path).limit(1).first()
    if first is None or first["value"] != "\t".join(header):
        raise ValueError(f"{path}: the header isn't {header}")
    bad = rows.agg(F.count_if(F.col("n") != 2).alias("fields"), (F.count("*") - F.count_distinct(header[0])).alias("repeats")).first()
    if bad["fields"] or bad["repeats"]:
        raise ValueError(f"{path}: {bad['fields']} lines without two fields, {bad['repeats']} repeated keys")
    return rows.drop("n")
