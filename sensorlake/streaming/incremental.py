"""Runs that handle only files no earlier run has seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T


def run_incremental(
    spark: SparkSession,
    src: str,
    transform: Callable[[DataFrame], DataFrame],
    dst: str,
    checkpoint: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str = "*",
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Process the new files below ``src`` into Parquet at ``dst``, then return all of ``dst``.

    The checkpoint is the bookmark: it holds the paths handled so far. A run works through what is
    there in batches of at most ``max_files`` files and ends. Each batch reaches the sink's log
    once, so a run that dies half-way and is started again adds nothing twice.
    """
    stream = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .options(**options)
    )
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    out = transform(stream.load(src))
    query = (
        out.writeStream.format("parquet")
        .option("path", dst)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(dst)
