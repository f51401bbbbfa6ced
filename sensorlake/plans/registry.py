"""Queries by name, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = Query(run, oracle)
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sensors(spark: SparkSession, sf: str) -> DataFrame:
    """The sensor view over the events table."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("activity"),
        F.col("value").alias("accel_x"),
        F.get_json_object("props", "$.k").cast("double").alias("accel_y"),
        (F.col("event_id") % 100).cast("double").alias("accel_z"),
    )


SENSORS = """(SELECT CAST(user_id AS VARCHAR) AS id, ts AS "timestamp", event_type AS activity, value AS accel_x,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS accel_y, CAST(event_id % 100 AS DOUBLE) AS accel_z
  FROM events) AS s"""


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded, since sums of doubles depend on the order they are added in."""
    return F.round(c, digits)
