"""Joins (C33-C44) and the join of points with intervals.

Spark chooses broadcast, sort-merge or hash by size. Adaptive execution splits a hot key of either
side, which it can do for every type but the full join, so that one is put together from two.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sensorlake.operators.runs import Runs

TYPES = ("inner", "left", "right", "full", "left_semi", "left_anti", "right_semi", "right_anti")


def _suffixed(left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Columns both sides have (other than keys) get the side's suffix."""
    both = (set(left.columns) & set(right.columns)) - set(keys)
    names = [left.withColumnsRenamed({c: c + suffixes[0] for c in both}), right.withColumnsRenamed({c: c + suffixes[1] for c in both})]
    clash = (set(names[0].columns) & set(names[1].columns)) - set(keys)
    if clash:
        raise ValueError(f"columns still collide: {sorted(clash)}")
    return names[0], names[1]


def join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", suffixes: tuple[str, str] = ("", "_r")) -> DataFrame:
    """Equi-join of any type; keys appear once (C33-C38). NULL keys match nothing."""
    on = list(on)
    if how not in TYPES:
        raise ValueError(f"how: {how}")
    if how.startswith("right_"):
        return right.join(left, on, how.replace("right", "left"))
    if how in ("left_semi", "left_anti"):
        return left.join(right, on, how)
    left, right = _suffixed(left, right, on, suffixes)
    if how != "full":
        return left.join(right, on, how)
    matched = left.join(right, on, "left")
    return matched.unionByName(right.join(left, on, "left_anti"), allowMissingColumns=True)


def as_width(tolerance: str | float | int | None) -> Column | None:
    if isinstance(tolerance, str):
        return F.make_dt_interval(secs=F.lit(pd.Timedelta(tolerance).total_seconds()))
    return None if tolerance is None else F.lit(tolerance)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    direction: str = "backward",
    tolerance: str | float | int | None = None,
    suffix: str = "_r",
    keep_time: str | None = None,
    **kw,
) -> DataFrame:
    """Each left row with the right row of the same ``by`` closest in ``on``.

    ``backward`` looks for the last right time at or before the left one, ``forward`` for the first
    at or after, ``nearest`` for either (the earlier if both are as near), none further away than
    ``tolerance`` (a number, or an interval such as ``10 minutes``). Of right rows with equal times
    the one with the greatest remaining columns counts.

    Both sides are stacked and put in time order once; the last right row is carried forward. A
    ``by`` that holds much of the data is cut along time.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"direction: {direction}")
    by = list(by)
    values = [c for c in right.columns if c not in (*by, on)]
    names = {c: c + suffix if c in left.columns else c for c in values}
    facts = F.struct(F.col(on).alias("__time"), *[F.col(c).alias(names[c]) for c in values])
    l = left.select(*by, F.col(on).alias("__on"), F.struct(*left.columns).alias("__left"))
    r = right.where(F.col(on).isNotNull()).select(*by, F.col(on).alias("__on"), facts.alias("__right"))
    # Right rows stand before left rows of the same time when looking back, after them when ahead.
    side = F.when(F.col("__left").isNull(), F.lit(2 if direction == "forward" else 0)).otherwise(1)
    stacked = l.unionByName(r, allowMissingColumns=True).withColumn("__side", side)
    runs = Runs(stacked, by, ["__on", "__side", "__right"], **kw)
    runs = runs.fill("__right", "__found", backward=direction == "forward")
    if direction == "nearest":
        runs = runs.fill("__right", "__next", backward=True)
    rows = runs.rows().where(F.col("__left").isNotNull())
    width = as_width(tolerance)

    def near(found: str) -> Column:
        c = F.col(found)
        gap_ok = F.lit(True)
        if width is not None:
            gap_ok = (c["__time"] >= F.col("__on") - width) & (c["__time"] <= F.col("__on") + width)
        # NULL keys match nothing, here as in any join.
        matched = gap_ok & F.col("__on").isNotNull()
        for k in by:
            matched = matched & F.col(k).isNotNull()
        return F.when(matched, c)

    found = near("__found")
    if direction == "nearest":
        ahead = near("__next")
        nearer = (ahead["__time"] - F.col("__on")) < (F.col("__on") - found["__time"])
        found = F.when(found.isNull() | (ahead.isNotNull() & nearer), ahead).otherwise(found)
    rows = rows.withColumn("__found", found)
    time = [F.col("__found.__time").alias(keep_time)] if keep_time else []
    return rows.select("__left.*", *[F.col(f"__found.`{names[c]}`").alias(names[c]) for c in values], *time)


def ordered_merge(left: DataFrame, right: DataFrame, on: str, by: Sequence[str] = (), fill: str | None = None, **kw) -> DataFrame:
    """Full join in the order of ``on``, gaps filled forward per ``by`` on request."""
    merged = join(left, right, [*by, on], "full")
    if fill is None:
        return merged
    if fill != "forward":
        raise ValueError(f"fill: {fill}")
    columns = [c for c in merged.columns if c not in (*by, on)]
    runs = Runs(merged, by, [on], **kw)
    for c in columns:
        runs = runs.fill(c, c)
    return runs.rows().select(*merged.columns)


def combine_first(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """All keys of both; left values, and where they are NULL or absent right ones."""
    on = list(on)
    columns = list(dict.fromkeys([*left.columns, *right.columns]))
    l = left.withColumnsRenamed({c: f"__l_{c}" for c in left.columns if c not in on})
    r = right.withColumnsRenamed({c: f"__r_{c}" for c in right.columns if c not in on})
    both = join(l, r, on, "full")
    return both.select(*[F.col(c) if c in on else _either(c, left, right) for c in columns])


def _either(c: str, left: DataFrame, right: DataFrame) -> Column:
    sides = [F.col(f"__{s}_{c}") for s, d in (("l", left), ("r", right)) if c in d.columns]
    return F.coalesce(*sides).alias(c)


def update(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows with the right values that are not NULL put over them."""
    on = list(on)
    fresh = [c for c in right.columns if c not in on and c in left.columns]
    r = right.select(*on, *[F.col(c).alias(f"__r_{c}") for c in fresh])
    both = left.join(r, on, "left")
    return both.select(*[F.coalesce(f"__r_{c}", c).alias(c) if c in fresh else F.col(c) for c in left.columns])


def compare(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys whose rows differ, with both values of every column that differs.

    ``status`` is ``left_only``, ``right_only`` or ``differs``; a column is NULL on both sides
    where it agrees.
    """
    on = list(on)
    columns = [c for c in left.columns if c not in on and c in right.columns]
    l = left.select(*on, *[F.col(c).alias(f"{c}_left") for c in columns], F.lit(True).alias("__l"))
    r = right.select(*on, *[F.col(c).alias(f"{c}_right") for c in columns], F.lit(True).alias("__r"))
    both = join(l, r, on, "full")
    differs = F.lit(False)
    out = []
    for c in columns:
        a, b = F.col(f"{c}_left"), F.col(f"{c}_right")
        other = ~a.eqNullSafe(b)
        differs = differs | other
        out += [F.when(other, a).alias(f"{c}_left"), F.when(other, b).alias(f"{c}_right")]
    status = F.when(F.col("__r").isNull(), "left_only").when(F.col("__l").isNull(), "right_only").otherwise("differs")
    return both.where(differs | F.col("__l").isNull() | F.col("__r").isNull()).select(*on, status.alias("status"), *out)


def range_join(points: DataFrame, intervals: DataFrame, point: str, lo: str, hi: str, width: float, how: str = "inner") -> DataFrame:
    """Points with the intervals [lo, hi) they fall in.

    Both sides meet on ``floor(value / width)``: a point has one cell, an interval the cells it
    crosses, so choose ``width`` near the usual interval length (seconds, for times). A crowded
    cell is split by adaptive execution like any hot key; no pair outside a shared cell is formed.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how: {how}")

    def cell(df: DataFrame, c: Column, name: str) -> Column:
        kind = df.schema[name].dataType.typeName()
        number = c.cast("timestamp").cast("double") if kind.startswith("timestamp") else c.cast("double")
        return F.floor(number / width)

    p = points.withColumn("__cell", cell(points, F.col(point), point))
    cells = F.sequence(cell(intervals, F.col(lo), lo), cell(intervals, F.col(hi), hi))
    i = intervals.where(F.col(lo) < F.col(hi)).withColumn("__icell", F.explode(cells))
    cond = (F.col("__cell") == F.col("__icell")) & (F.col(point) >= F.col(lo)) & (F.col(point) < F.col(hi))
    return p.join(i, cond, how).drop("__cell", "__icell")
