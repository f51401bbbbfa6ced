"""Regular time steps and gaps between them (C120-C123)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sensorlake.operators.aggregates import on_keys, statistic
from sensorlake.operators.runs import Runs
from sensorlake.operators.windows import micros


def step(every: str) -> Column:
    """An interval such as ``15 minutes`` as a value."""
    return F.make_dt_interval(secs=F.lit(pd.Timedelta(every).total_seconds()))


def bucket(ts: str, every: str) -> Column:
    """Start of the step a time falls in, steps counted from 1970."""
    return F.window(ts, every)["start"]


# Steps of a stretch of the grid; no row ever holds more of them.
STRETCH = 65_536


def spine(df: DataFrame, ts: str, every: str, by: Sequence[str]) -> DataFrame:
    """Every step from the first to the last of each group.

    Made in two levels: first the stretches of the grid, dealt out over the tasks by group and number, then the steps of each. So
    neither a row nor a task holds the grid of a long group.
    """
    width = int(pd.Timedelta(every).total_seconds() * 1_000_000)
    kind = df.schema[ts].dataType.simpleString()
    time = F.col(ts).cast("timestamp_ntz") if kind == "date" else F.col(ts)
    ends = df.groupBy(*by).agg(F.min(time).alias("__lo"), F.max(time).alias("__hi"))
    steps = F.floor((micros(ends, "__hi") - micros(ends, "__lo")) / width).cast("long")
    stretches = ends.withColumn("__steps", steps).select(*by, "__lo", "__steps", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("__steps") / STRETCH))).alias("__nth"))
    tasks = df.sparkSession.sparkContext.defaultParallelism * 4
    dealt = stretches.repartition(tasks, *by, "__nth")
    first = F.col("__nth") * STRETCH
    last = F.least(first + (STRETCH - 1), F.col("__steps"))
    at = F.explode(F.sequence(first, last)).alias("__at")
    # Microseconds are counted from the first step, whole, so no step drifts.
    grid = dealt.select(*by, "__lo", at)
    moved = F.col("__at") * width
    days, rest = F.floor(moved / 86_400_000_000).cast("int"), F.pmod(moved, F.lit(86_400_000_000))
    shift = F.make_dt_interval(days=days, secs=(rest / 1_000_000).cast("decimal(18,6)"))
    return grid.select(*by, (F.col("__lo") + shift).cast(kind).alias(ts))


def resample(df: DataFrame, ts: str, every: str, by: Sequence[str], aggs: Mapping[str, tuple], fill: str | None = None, **kw) -> DataFrame:
    """Aggregates per group and step, steps without rows included (C120).

    Rows are combined before the shuffle; what follows is one row per group and step. ``fill`` is
    ``forward``, ``backward`` or None, which leaves empty steps NULL.
    """
    binned = df.withColumn("__step", bucket(ts, every)).groupBy(*by, F.col("__step").alias(ts))
    stats = binned.agg(*[statistic(c, fn, *rest).alias(out) for out, (c, fn, *rest) in aggs.items()])
    whole = on_keys(spine(stats, ts, every, by), stats, [*by, ts])
    return _filled(whole, list(aggs), ts, by, fill, **kw)


def as_freq(df: DataFrame, ts: str, every: str, by: Sequence[str], fill: str | None = None, **kw) -> DataFrame:
    """Rows at regular times from each group's first, others left out (C121)."""
    columns = [c for c in df.columns if c not in (*by, ts)]
    whole = on_keys(spine(df, ts, every, by), df, [*by, ts])
    return _filled(whole, columns, ts, by, fill, **kw)


def _filled(df: DataFrame, columns: Sequence[str], ts: str, by: Sequence[str], fill: str | None, **kw) -> DataFrame:
    if fill is None:
        return df
    runs = Runs(df, by, [ts], **kw)
    for c in columns:
        runs = runs.fill(c, c, backward=fill == "backward")
    return runs.rows()


def interpolate(df: DataFrame, col: str, ts: str, by: Sequence[str], order: Sequence[str] = (), out: str | None = None, **kw) -> DataFrame:
    """NULLs on the straight line, in time, between their neighbours (C122).

    After the last value it is repeated; before the first one NULL stays.
    """
    out = out or col
    rows = df.withColumn("__t", micros(df, ts))
    rows = rows.withColumn("__known", F.when(F.col(col).isNotNull(), F.struct(F.col("__t").alias("t"), F.col(col).alias("v"))))
    runs = Runs(rows, by, [ts, *order], **kw).fill("__known", "__prev").fill("__known", "__next", backward=True)
    prev, after = F.col("__prev"), F.col("__next")
    share = (F.col("__t") - prev["t"]) / (after["t"] - prev["t"])
    line = F.when(after.isNull() | (after["t"] == prev["t"]), prev["v"]).otherwise(prev["v"] + (after["v"] - prev["v"]) * share)
    done = runs.rows().withColumn(out, F.when(F.col(col).isNotNull(), F.col(col)).otherwise(F.when(prev.isNotNull(), line)))
    return done.drop("__t", "__known", "__prev", "__next")


def between_times(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """Rows by time of day, both ends included; past midnight where ``lo`` > ``hi`` (C123)."""
    clock = F.date_format(ts, "HH:mm:ss.SSSSSS")
    lo, hi = [t + "00:00:00.000000"[len(t) :] for t in (lo, hi)]
    inside = (clock >= lo) & (clock <= hi) if lo <= hi else (clock >= lo) | (clock <= hi)
    return df.where(inside)


def at_time(df: DataFrame, ts: str, at: str) -> DataFrame:
    """Rows at one time of day (C123)."""
    return between_times(df, ts, at, at)


def truncate(df: DataFrame, ts: str, before: str | None = None, after: str | None = None) -> DataFrame:
    """Rows from ``before`` to ``after``, both included (C123); plain bounds, so they reach the scan."""
    kind = df.schema[ts].dataType.simpleString()
    if before is not None:
        df = df.where(F.col(ts) >= F.lit(before).cast(kind))
    if after is not None:
        df = df.where(F.col(ts) <= F.lit(after).cast(kind))
    return df
