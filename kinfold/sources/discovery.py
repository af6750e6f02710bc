"""Which files are which table."""

from __future__ import annotations

import os
import re
from pathlib import PurePosixPath

from pyspark.sql import SparkSession

SPLITS = ("train", "test")
SOURCES = ("source1", "source2", "source3")
TABLES = (*(f"train_{s}" for s in SOURCES), "train_ground_truth", *(f"test_{s}" for s in SOURCES))
#: Where data are looked for at last.
FOLDERS = ("data", "dataset")
FORMATS = (".parquet", ".tsv", ".csv", ".txt")
#: Other names of the ground truth.
TRUTH_NAMES = ("ground_truth", "groundtruth", "gt", "labels")


_FILE = re.compile(rf"(?:({'|'.join(SPLITS)})[-_])?({'|'.join(SOURCES)}|{'|'.join(n.replace('_', '[-_]') for n in TRUTH_NAMES)})(?:[-_]\d{{5}}[-_]of[-_]\d{{5}})?\.[a-z]+")
_FOLDER = re.compile(rf"(?:.*_)?({'|'.join(SPLITS)})(?:_.*)?")


def table_of(path: str) -> str | None:
    """The table that a file holds: its split is in its own name, or in the nearest folder that names one; a
    ground truth without any is that of training. Shard numbers don't count."""
    *folders, file = path.lower().split("/")
    named = _FILE.fullmatch(file)
    if not named:
        return None
    kind = named[2] if named[2] in SOURCES else "ground_truth"
    splits = [named[1], *(m[1] for m in map(_FOLDER.fullmatch, reversed(folders)) if m), "train"]
    if kind == "ground_truth":
        splits = [named[1], "train"]
    elif len(splits) == 2 and not named[1]:
        return None
    table = f"{next(filter(None, splits))}_{kind}"
    return table if table in TABLES else None


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def data_root(spark: SparkSession, given: str | None = None) -> str:
    """The folder of the data: the one given, else KINFOLD_DATA_DIR, else the first of FOLDERS that is there."""
    for path in (given, os.environ.get("KINFOLD_DATA_DIR")):
        if path:
            if not exists(spark, path):
                raise FileNotFoundError(f"no data folder {path}")
            return path
    for path in FOLDERS:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"name a data folder: KINFOLD_DATA_DIR is unset and there is none of {', '.join(FOLDERS)}")


def list_files(spark: SparkSession, root: str) -> list[str]:
    """All files below ``root``, by Hadoop's file system, so that any store will do."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, it = [], fs.listFiles(path, True)
    while it.hasNext():
        found.append(it.next().getPath().toString())
    return sorted(found)


def discover(files: list[str]) -> dict[str, list[str]]:
    """Files by table; hidden ones are skipped, and where a table has Parquet files its others are."""
    tables: dict[str, list[str]] = {}
    for file in sorted(files):
        p = PurePosixPath(file)
        if p.suffix.lower() not in FORMATS or any(x.startswith((".", "_")) for x in (p.name, *p.parts[-2:-1])) or "__MACOSX" in p.parts:
            continue
        if name := table_of(file):
            tables.setdefault(name, []).append(file)
    return {t: [f for f in fs if f.endswith(".parquet")] or fs for t, fs in tables.items()}
