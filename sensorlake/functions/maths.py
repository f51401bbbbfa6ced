"""Number functions on columns (C112-C114)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sensorlake.operators.aggregates import on_keys, quantiles
from sensorlake.operators.rows import clip


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Function names and Spark's functions for them.
FUNCTIONS = {
    "sin": F.sin, "cos": F.cos, "tan": F.tan, "arcsin": F.asin, "arccos": F.acos, "arctan": F.atan,
    "sinh": F.sinh, "cosh": F.cosh, "tanh": F.tanh, "arcsinh": F.asinh, "arccosh": F.acosh, "arctanh": F.atanh,
    "exp": F.exp, "expm1": F.expm1, "log": F.ln, "log10": F.log10, "log1p": F.log1p, "sqrt": F.sqrt,
    "abs": F.abs, "floor": F.floor, "ceil": F.ceil,
}


def apply(name: str, c: Column | str) -> Column:
    """An elementary function by name (C112)."""
    return FUNCTIONS[name](_c(c))


def arctan2(y: Column | str, x: Column | str) -> Column:
    return F.atan2(_c(y), _c(x))


def round_digits(c: Column | str, digits: int = 0, half: str = "even") -> Column:
    """Rounded to digits, halves to the even neighbour or away from zero (``up``) (C113)."""
    return F.bround(_c(c), digits) if half == "even" else F.round(_c(c), digits)


def round_multiple(c: Column | str, multiple: float, half: str = "even") -> Column:
    """Rounded to a multiple (C113)."""
    return round_digits(_c(c) / multiple, 0, half) * multiple


def winsorize(df: DataFrame, col: str, lower: float, upper: float, keys: Sequence[str] = (), out: str | None = None, **kw) -> DataFrame:
    """Values outside two exact quantiles of the group moved to them (C114)."""
    bounds = quantiles(df, keys, col, {"__lo": lower, "__hi": 1 - upper}, "nearest", **kw)
    return on_keys(df, bounds, keys).withColumn(out or col, clip(col, F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")
