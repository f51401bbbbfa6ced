"""Opening single files inside tasks, wherever Spark's paths point."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# URI schemes Spark's file systems use and the name pyarrow has for the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "file": "file"}


def locate(path: str):
    """The pyarrow file system and the path on it for a path as Spark prints it."""
    from pyarrow import fs

    match = re.match(r"^([a-z0-9]+):/+(.*)$", path)
    if not match:
        return fs.LocalFileSystem(), path
    scheme = SCHEMES.get(match.group(1), match.group(1))
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + match.group(2)
    return fs.FileSystem.from_uri(f"{scheme}://{match.group(2)}")


def literal(path: str) -> str:
    """The path with what Spark's readers would take for a pattern escaped."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def open_input(path: str):
    system, name = locate(path)
    return system.open_input_file(name)


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """(path, size, mtime) of every file below ``path``. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    )


def plain_path(col: Column) -> Column:
    """Scheme and authority removed and %-escapes undone: ``_metadata`` and ``binaryFile`` paths compare equal."""
    bare = F.regexp_replace(F.regexp_replace(col, r"^file:/+", "/"), r"^[a-z0-9]+://[^/]*", "")
    return F.coalesce(F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))), bare)
