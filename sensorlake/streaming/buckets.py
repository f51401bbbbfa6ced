"""Time windows over files as they land."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators.aggregates import statistic


def windowed(
    stream: DataFrame, ts: str, by: Sequence[str], size: str, aggs: Mapping[str, tuple], slide: str | None = None, lateness: str = "1 hour"
) -> DataFrame:
    """Aggregates per key and tumbling or sliding window.

    Rows more than ``lateness`` behind the newest time seen are dropped and their windows' state is
    let go. Rows are combined before the shuffle, so a busy key costs one row per window and task.
    """
    timed = stream.withColumn("__at", F.col(ts).cast("timestamp")).withWatermark("__at", lateness)
    window = F.window("__at", size, slide) if slide else F.window("__at", size)
    stats = timed.groupBy(*by, window.alias("__w")).agg(*[statistic(c, fn, *rest).alias(out) for out, (c, fn, *rest) in aggs.items()])
    return stats.select(
        *by, F.col("__w.start").cast("timestamp_ntz").alias("start"), F.col("__w.end").cast("timestamp_ntz").alias("end"), *aggs
    )


def run_to_table(spark: SparkSession, out: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Work through what has landed into Parquet; closed windows only, each once."""
    query = (
        out.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)
