"""Writers: Parquet, one-file TSV, JSON and Markdown reports, models."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    """zstd Parquet; with ``by``, rows of one key are in one part."""
    (df.repartition(by) if by else df).write.mode("overwrite").option("compression", "zstd").parquet(path)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_tsv(df: DataFrame, path: str) -> None:
    """One unquoted UTF-8 file with a header, in order of the first column; empty texts stay empty.

    Parts are written in order by as many tasks as it takes; putting them behind one another is left to the file system.
    """
    spark, names = df.sparkSession, df.columns
    lines = df.orderBy(names[0]).select(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names)).alias("value"))
    folder = f"{path}.parts"
    lines.write.mode("overwrite").text(folder)
    target, fs = _fs(spark, path)
    parts = sorted(s.getPath().toString() for s in fs.listStatus(_fs(spark, folder)[0]) if s.getPath().getName().startswith("part-"))
    out = fs.create(target, True)
    out.write(bytearray(("\t".join(names) + "\n").encode()))
    for part in parts:
        source = fs.open(_fs(spark, part)[0])
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
        source.close()
    out.close()
    fs.delete(_fs(spark, folder)[0], True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    target, fs = _fs(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_json(spark: SparkSession, report: Mapping, path: str) -> None:
    _write_text(spark, path, json.dumps(report, indent=2, default=str, ensure_ascii=False) + "\n")


def write_markdown(spark: SparkSession, sections: Mapping[str, Mapping], path: str) -> None:
    """A heading and a table of names and values for each section."""
    lines: list[str] = []
    for title, values in sections.items():
        lines += [f"## {title}", "", "| Name | Value |", "|---|---|", *(f"| {k} | {v} |" for k, v in values.items()), ""]
    _write_text(spark, path, "\n".join(lines))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
