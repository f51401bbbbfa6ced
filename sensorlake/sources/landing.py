"""What lies in the landing area, and what a notification points at (A2-A5)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.sources.files import list_files, literal, plain_path

# Fixed value: the shape of a file notification.
NOTIFICATION = (
    "struct<Records: array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>>"
)


def scan_landing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, rel, size, mtime) of the files below ``path`` whose names match ``glob`` (A2)."""
    base = F.length(F.concat(F.rtrim(plain_path(F.lit(path)), F.lit("/")), F.lit("/")))
    files = list_files(spark, path, glob)
    return files.withColumn("rel", F.substr(plain_path(F.col("path")), base + 1)).select("path", "rel", "size", "mtime")


def landing_manifest(files: DataFrame, layout: str = "tree", prefix: str = "raw/", keep: Sequence[str] = ()) -> DataFrame:
    """(key, path, size, mtime, n_collisions), one row per landing key, and what to ``keep`` of a file (A3).

    ``tree`` keeps the folders. ``flat`` keeps the file name alone: the last writer (then the last
    path) holds the key and ``n_collisions`` counts the files it hides. The winner is a maximum, so
    a file name shared by very many folders is combined before the shuffle.
    """
    if layout == "tree":
        name = F.col("rel")
    elif layout == "flat":
        name = F.regexp_extract("rel", r"([^/]*)$", 1)
    else:
        raise ValueError(f"layout: {layout}")
    # Steps up are taken out of the name, so that no key leaves the landing area.
    inside = F.array_join(F.array_remove(F.split(name, "/", -1), ".."), "/")
    keyed = files.withColumn("key", F.concat(F.lit(prefix), inside))
    last = F.max(F.struct("mtime", "path", "size", *keep)).alias("last")
    return keyed.groupBy("key").agg(last, (F.count(F.lit(1)) - 1).alias("n_collisions")).select(
        "key", "last.path", "last.size", "last.mtime", "n_collisions", *[f"last.{c}" for c in keep]
    )


def filter_objects(df: DataFrame, prefix: str = "", suffix: str = "", key: str = "key") -> DataFrame:
    """Objects by the start and the end of their key (A4)."""
    return df.where(F.startswith(F.col(key), F.lit(prefix)) & F.endswith(F.col(key), F.lit(suffix)))


def notified_objects(notifications: DataFrame, body: str = "body") -> DataFrame:
    """(bucket, key) named by notification records, each once."""
    record = F.explode(F.from_json(F.col(body), NOTIFICATION)["Records"]).alias("r")
    return notifications.select(record).select(
        F.col("r.s3.bucket.name").alias("bucket"), F.col("r.s3.object.key").alias("key")
    ).distinct()


def scan_notified(
    spark: SparkSession,
    notifications: DataFrame,
    reader: Callable[[list[str]], DataFrame],
    root: str,
    body: str = "body",
    suffix: str = "",
) -> DataFrame:
    """Read only the files the notifications name, as ``root``/bucket/key (A5).

    The names are the reader's file list, which Spark holds on the driver for any scan. Where no
    name matches, the result is empty, with the columns that the reader finds below ``root``.
    """
    named = filter_objects(notified_objects(notifications, body), suffix=suffix)
    paths = named.select(F.concat_ws("/", F.lit(root.rstrip("/")), "bucket", "key").alias("path"))
    listed = sorted(literal(r.path) for r in paths.toLocalIterator())
    return reader(listed) if listed else reader([root]).limit(0)
