"""Finding files, and reading lines of JSON."""

from __future__ import annotations

import os
import re

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON files that describe a dataset and hold no data.
DESCRIPTIONS = ("dataset_info.json", "dataset_dict.json")
_VERSION = re.compile(r"\d+\.\d+\.\d+")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address (file, hdfs, s3, gs) and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def listed(path: str, recursive: bool = False) -> list[tuple[str, bool]]:
    """(address, whether it is a folder) of what lies in a folder, by name; none for a missing one."""
    where, inner = file_system(path)
    found = where.get_file_info(fs.FileSelector(inner, allow_not_found=True, recursive=recursive))
    at = lambda f: path.rstrip("/") + f.path[len(inner.rstrip("/")) :]
    return sorted((at(f), f.type == fs.FileType.Directory) for f in found)


def _kind(path: str) -> fs.FileType:
    where, inner = file_system(path)
    return where.get_file_info(inner).type


def find_json(path: str) -> str:
    """The file itself, or the first JSON file below a folder, by name; no hidden ones, no descriptions."""
    if path.endswith(".json") and _kind(path) == fs.FileType.File:
        return path
    below = [(p, p[len(path.rstrip("/")) :].strip("/").split("/")) for p, folder in listed(path, recursive=True) if not folder]
    found = [p for p, parts in below if parts[-1].endswith(".json") and parts[-1] not in DESCRIPTIONS and not any(x.startswith(".") for x in parts)]
    if not found:
        raise FileNotFoundError(f"no JSON file below {path}")
    return found[0]


def version_dir(base: str) -> str:
    """The folder with dataset_info.json: the base, else its highest x.y.z child that has one."""
    if _kind(base) != fs.FileType.Directory:
        raise FileNotFoundError(f"no folder {base}")
    described = lambda d: _kind(f"{d}/dataset_info.json") == fs.FileType.File
    if described(base):
        return base
    versions = [p for p, folder in listed(base) if folder and _VERSION.fullmatch(p.rsplit("/", 1)[-1])]
    if not versions:
        raise FileNotFoundError(f"no version folder such as 1.0.0 in {base}")
    for v in sorted(versions, key=lambda v: tuple(map(int, v.rsplit("/", 1)[-1].split("."))), reverse=True):
        if described(v):
            return v
    raise FileNotFoundError(f"no version folder of {base} has dataset_info.json")


def data_files(base: str, *suffixes: str) -> list[str]:
    """Files of a folder by suffix, one suffix after the other, each by name."""
    names = [p for p, folder in listed(base) if not folder]
    return [p for s in suffixes for p in names if p.endswith(s)]


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped, a broken one fails."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def count_lines(spark: SparkSession, path: str) -> int:
    """All lines, blank ones too."""
    return spark.read.text(path).count()


def finished_ids(spark: SparkSession, path: str, key: str = "episode_id") -> DataFrame:
    """Distinct keys of an earlier output; broken lines are ignored, a missing output has none."""
    schema = T.StructType([T.StructField(key, T.StringType())])
    if _kind(path) == fs.FileType.NotFound:
        return spark.createDataFrame([], schema)
    rows = spark.read.text(path).select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("row"))
    return rows.select(f"row.{key}").where(F.col(key).isNotNull()).distinct()


def read_documents(spark: SparkSession, path: str, schema: T.DataType | str) -> DataFrame:
    """Whole files as one JSON document each: path, doc (NULL for a broken one)."""
    options = {"allowSingleQuotes": "false", "allowNumericLeadingZeros": "false"}
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.from_json("value", schema, options).alias("doc"))
