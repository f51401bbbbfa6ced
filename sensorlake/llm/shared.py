"""Helpers of the operators: tables, kept steps, words in Python tasks, and the rows a model may learn from."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Shuffle files go once the step that made them is written, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Of rows that hold megabytes, the Parquet writer gathers 100 before it looks at their size, and its reader takes a row group at a time:
# with these options a group of them ends by its bytes.
LARGE_ROWS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
BATCH_BYTES, SCAN_ROWS = 8 << 20, 256


def _written(df: DataFrame, label: str, options: dict | None = None) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    spark.conf.set(CLEANUP, "true")
    path = scratch_dir(spark, label)
    df.write.options(**options or {}).parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path), path


def kept(df: DataFrame, label: str, options: dict | None = None) -> DataFrame:
    """Write a step to the shared scratch folder and read it again: it is computed once, and outlives lost executors."""
    return _written(df, label, options)[0]


def bounded_batches(spark: SparkSession) -> None:
    """From now on an Arrow batch to Python ends by its bytes, not at 64 MB (a plan takes the setting when it runs, so it stays)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def few_rows_scanned(spark: SparkSession) -> Iterator[None]:
    """Inside, scans take few rows at once, as each may be a whole text."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), SCAN_ROWS)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Steps of a job in the shared scratch folder, each removed once what needs it has been written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame, label: str, *done: DataFrame | None, options: dict | None = None) -> DataFrame:
        """``kept``; then the steps ``done`` go."""
        out, path = _written(df, label, options)
        self.paths[id(out)] = out, path
        self.drop(*done)
        return out

    def drop(self, *done: DataFrame | None) -> None:
        for df in done:
            _, path = self.paths.pop(id(df), (None, None))
            if path is not None:
                where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def clear(self) -> None:
        self.drop(*[df for df, _ in self.paths.values()])


FILTER_BITS = 1 << 25  # at most 4 MB, whatever the number of values


def perhaps_among(values: DataFrame, column: str) -> Callable[[Column], Column]:
    """A condition that holds for every value of ``values`` and for few others: a bit per hash, made by executors. It spares other
    rows a shuffle; an exact join decides on those that pass. A null is never among the values."""
    spark = values.sparkSession
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    bits = values.filter(F.col(column).isNotNull()).select(place.alias("at"))
    words = bits.groupBy(F.shiftright("at", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("bits"))
    found = words.toArrow()
    filled = np.zeros(FILTER_BITS // 32, np.uint32)
    filled[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    shared = spark.sparkContext.broadcast(filled)

    def passes(at: pd.Series) -> pd.Series:
        n = at.to_numpy()
        return pd.Series((shared.value[n >> 5] >> (n & 31).astype(np.uint32)) & np.uint32(1) == 1)

    test = F.pandas_udf(passes, "boolean")
    return lambda value: value.isNotNull() & test(F.pmod(F.xxhash64(value), F.lit(FILTER_BITS)))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls in the fold of the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def bounded_sample(rows: DataFrame, by: str, limit: int, key: list[str]) -> DataFrame:
    """At most ``limit`` rows per value of ``by``, the same ones on every run; Spark limits before the shuffle as well."""
    from pyspark.sql import Window

    order = [F.xxhash64(*key), *key]
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_rank") <= limit).drop("_rank")
