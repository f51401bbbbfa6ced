"""Catalog tables, processed Parquet, and the stage and processed sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sensorlake.session import pin
from sensorlake.sources.batches import BATCH, BatchLog, batch_path, new_batch, read_batches, rest_of, write_batch


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog."""
    return spark.table(name)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Processed Parquet (A9). A known schema saves opening a file footer to find it."""
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def write_stage(df: DataFrame, path: str, source_col: str = "source_file") -> str:
    """Stage rows as one committed batch, replacing the sources present in ``df`` and no others (A16); returns the batch.

    A task reads blocks of a source and writes its rows where it stands: no shuffle, and a source that holds most of the
    data is written by all the tasks that read it. There is one folder per run, however many sources ever came.
    """
    spark, log, batch = df.sparkSession, BatchLog(df.sparkSession, path), new_batch()
    (live,) = log.live("rows")
    write_batch(df, path, batch)
    written = read_batches(spark, path, [batch], df.schema)
    sources = pin(written.select(F.col(source_col).alias("source_file")).distinct())
    held = log.sources(live)
    touched = [r[0] for r in held.join(sources, "source_file", "left_semi").select(BATCH).distinct().collect()]
    if touched:
        # Only these batches are written again, less the sources that are replaced.
        old = spark.read.option("mergeSchema", "true").parquet(*[batch_path(path, b) for b in touched])
        gone = sources.withColumnRenamed("source_file", "__gone")
        write_batch(old.join(gone, F.col(source_col) == F.col("__gone"), "left_anti"), path, batch)
    kept = rest_of(held.where(F.col(BATCH).isin(touched)).select("source_file", "mtime"), sources)
    log.put_sources(batch, rows=sources.withColumn("mtime", F.lit(None).cast("timestamp")).unionByName(kept))
    log.commit(batch, {"rows": (list(dict.fromkeys([*df.columns, *[c for b in touched for c in live[b]]])), touched)})
    return batch


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None, part: str = "rows") -> DataFrame:
    """All that is staged and committed; a known ``schema`` (of the rows written) saves looking it up. The stage of a flow is its
    part ``stage``."""
    (live,) = BatchLog(spark, path).live(part)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(*[batch_path(path, b) for b in live])
    return read_batches(spark, path, live, schema)


def write_processed(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Processed Parquet."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode: {mode}")
    writer = df.write.mode(mode)
    if mode == "overwrite":
        # The whole target is replaced, whatever the session does for partitions.
        writer = writer.option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def register_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """External Parquet table over files that exist already (A18). A table of that name stays, and
    sees the files that are there now."""
    columns = ""
    if schema is not None:
        columns = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ")"
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING PARQUET {parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Any SQL over catalog tables; a DataFrame may be passed in and named as ``{name}``."""
    return spark.sql(text, **views)
