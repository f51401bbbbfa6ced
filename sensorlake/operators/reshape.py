"""Reshaping, encoding and binning."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from sensorlake.operators.aggregates import quantiles, values_of


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "variable", value: str = "value") -> DataFrame:
    """Columns to rows (C90, C92 stack)."""
    return df.unpivot(list(ids), list(values), var, value)


def unstack(df: DataFrame, ids: Sequence[str], var: str, value: str, names: Sequence[Any]) -> DataFrame:
    """Rows to columns for listed names (C92); the inverse of ``melt``."""
    return df.groupBy(*ids).pivot(var, list(names)).agg(F.max(value))


def wide_to_long(df: DataFrame, stubs: Sequence[str], ids: Sequence[str], var: str, sep: str = "") -> DataFrame:
    """Columns ``stub<sep>suffix`` to one row per suffix with a column per stub.

    Numeric suffixes come out as integers. The rows are made where they stand, without a shuffle.
    """
    suffixes: dict[str, None] = {}
    for stub in stubs:
        for c in df.columns:
            if c.startswith(stub + sep) and c not in ids and len(c) > len(stub + sep):
                suffixes[c[len(stub + sep) :]] = None
    numeric = all(s.isdigit() for s in suffixes)
    types = {s: next(df.schema[s + sep + x].dataType for x in suffixes if s + sep + x in df.columns) for s in stubs}
    used = {s + sep + x for s in stubs for x in suffixes}
    rest = [c for c in df.columns if c not in used and c not in ids]
    items = [
        F.struct(
            F.lit(int(x) if numeric else x).alias(var),
            *[(F.col(s + sep + x) if s + sep + x in df.columns else F.lit(None).cast(types[s])).alias(s) for s in stubs],
        )
        for x in suffixes
    ]
    return df.select(*ids, *rest, F.inline(F.array(*items)))


def grouped_reshape(df: DataFrame, groups: dict[str, Sequence[str]], ids: Sequence[str]) -> DataFrame:
    """Lists of columns, each list becoming one column, position by position."""
    length = {len(v) for v in groups.values()}
    if len(length) != 1:
        raise ValueError("all groups need as many columns")
    items = [F.struct(*[F.col(cols[i]).alias(name) for name, cols in groups.items()]) for i in range(length.pop())]
    return df.select(*ids, F.inline(F.array(*items)))


def explode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """One row per element; an empty or NULL list gives one NULL row."""
    return df.withColumn(out or col, F.explode_outer(col))


def one_hot(df: DataFrame, col: str, categories: Sequence[Any] | None = None, prefix: str | None = None, drop_first: bool = False) -> DataFrame:
    """A 0/1 column per category (C94). Without ``categories`` they are looked up: they are schema."""
    if categories is None:
        categories = values_of(df, col)
    chosen = list(categories)[1 if drop_first else 0 :]
    name = prefix if prefix is not None else col
    return df.select(
        *[c for c in df.columns if c != col],
        *[F.coalesce((F.col(col) == v).cast("int"), F.lit(0)).alias(f"{name}_{v}") for v in chosen],
    )


def one_hot_decode(df: DataFrame, columns: dict[str, Any], out: str) -> DataFrame:
    """Back from 0/1 columns to the category (C94); none set gives NULL."""
    value = F.coalesce(*[F.when(F.col(c) == 1, F.lit(v)) for c, v in columns.items()])
    return df.withColumn(out, value).drop(*columns)


def _numbers(edges: Sequence[float]) -> list[str]:
    """Edges as text, with as many digits as it takes to tell them apart."""
    for digits in range(6, 18):
        out = [f"{x:.{digits}g}" if x == x and abs(x) < 1e6 else repr(x) for x in edges]
        if len(set(out)) == len(set(edges)):
            break
    return out


def cut(
    c: Column | str, edges: Sequence[float], right: bool = True, labels: Sequence[Any] | None = None, include_lowest: bool = False
) -> Column:
    """The bin a value falls in (C95): (a, b] by default, [a, b) with ``right=False``; else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    names = _numbers(edges)
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        above = (c >= a) if not right or (include_lowest and i == 0) else (c > a)
        below = (c <= b) if right else (c < b)
        text = f"({names[i]}, {names[i + 1]}]" if right else f"[{names[i]}, {names[i + 1]})"
        label = F.lit(labels[i] if labels is not None else text)
        out = F.when(above & below, label) if out is None else out.when(above & below, label)
    return out


def equal_width_edges(df: DataFrame, col: str, bins: int, right: bool = True) -> list[float]:
    """Edges of ``bins`` equal bins over the range, the outer one moved out by 0.1 %."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo == hi:
        spread = 0.001 * abs(lo) if lo else 0.001
        lo, hi = lo - spread, hi + spread
        return [lo + (hi - lo) * i / bins for i in range(bins + 1)]
    edges = [lo + (hi - lo) * i / bins for i in range(bins)] + [hi]
    spread = 0.001 * (hi - lo)
    if right:
        edges[0] -= spread
    else:
        edges[-1] += spread
    return edges


def qcut(df: DataFrame, col: str, q: int | Sequence[float], out: str = "bin", labels: Sequence[Any] | None = None, **kw) -> DataFrame:
    """Bins with equal shares of the values, by exact quantiles (C96); labels default to 0, 1, ..."""
    points = [i / q for i in range(q + 1)] if isinstance(q, int) else list(q)
    edges = quantiles(df.select(F.col(col).cast("double").alias(col)), [], col, {f"q{i}": p for i, p in enumerate(points)}, **kw).first()
    unique = sorted(set(edges))
    if len(unique) != len(points):
        raise ValueError(f"bin edges are not unique: {list(edges)}")
    names = list(labels) if labels is not None else list(range(len(points) - 1))
    return df.withColumn(out, cut(col, unique, labels=names, include_lowest=True))


def row_hash(df: DataFrame, cols: Sequence[str], out: str = "hash") -> DataFrame:
    """A 64-bit hash of the listed columns."""
    return df.withColumn(out, F.xxhash64(*cols))
