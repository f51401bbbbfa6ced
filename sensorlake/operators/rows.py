"""Projections, filters, casts and missing values."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorlake.operators.runs import Runs


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def project(df: DataFrame, exprs: Mapping[str, Column | str]) -> DataFrame:
    """Named expressions, as columns or as text."""
    return df.select(*[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in exprs.items()])


def where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows for which the condition is true; NULL is not true."""
    return df.where(condition)


def evaluate(df: DataFrame, assignment: str) -> DataFrame:
    """``name = expression`` as text (C20)."""
    name, expr = assignment.split("=", 1)
    return df.withColumn(name.strip(), F.expr(expr))


def modulo(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor (C21); whole numbers stay whole, so large ones are exact. NULL by zero."""
    rest = F.try_mod(a, b)
    return F.when((rest != 0) & ((rest < 0) != (b < 0)), rest + b).otherwise(rest)


def floor_divide(a: Column, b: Column) -> Column:
    """Quotient rounded down (C21); whole numbers are divided as such, so large ones are exact. NULL by zero."""
    x, y = a.try_cast("bigint"), F.nullif(b.try_cast("bigint"), F.lit(0))
    whole = F.call_function("div", x, y) - F.when((x % y != 0) & ((x < 0) != (y < 0)), 1).otherwise(0)
    return F.when((x == a) & (y == b), whole).otherwise(F.floor(F.try_divide(a, b)))


def safe_cast(c: Column | str, kind: str, errors: str = "raise") -> Column:
    """A cast that raises on values that do not fit, or with ``null`` drops them."""
    return _col(c).cast(kind) if errors == "raise" else _col(c).try_cast(kind)


def to_numeric(c: Column | str, errors: str = "raise") -> Column:
    """Text to double: ``raise`` on other text, or ``coerce`` it to NULL."""
    c = F.trim(_col(c))
    return c.cast("double") if errors == "raise" else c.try_cast("double")


def is_missing(c: Column | str, nan: bool = True) -> Column:
    """NULL or, for floating point, NaN."""
    c = _col(c)
    return c.isNull() | F.isnan(c) if nan else c.isNull()


def fill_null(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Per column a constant, or a column, in place of NULL."""
    return df.withColumns({n: F.coalesce(F.col(n), v if isinstance(v, Column) else F.lit(v)) for n, v in values.items()})


def drop_nulls(df: DataFrame, how: str = "any", thresh: int | None = None, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL in any (all) of the columns, or with ``thresh`` values."""
    return df.na.drop(how=how, thresh=thresh, subset=list(subset) if subset else None)


def replace_values(c: Column | str, mapping: Mapping[Any, Any], regex: bool = False) -> Column:
    """Values (or, with ``regex``, patterns in text) replaced, in the order given."""
    c = _col(c)
    if regex:
        for pattern, value in mapping.items():
            c = F.regexp_replace(c, pattern, value)
        return c
    out = None
    for old, new in mapping.items():
        hit = c.isNull() if old is None else c == old
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return c if out is None else out.otherwise(c)


def is_in(df: DataFrame, col: str, values: Sequence[Any] | DataFrame) -> DataFrame:
    """Rows whose value is in a list, or in the first column of a table of any size."""
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(values.columns[0]).alias("__wanted")).distinct()
        return df.join(wanted, F.col(col) == F.col("__wanted"), "left_semi")
    return df.where(F.col(col).isin(*values))


def clip(c: Column | str, lo: Any = None, hi: Any = None) -> Column:
    """Values below ``lo`` raised to it, above ``hi`` lowered; NULL stays."""
    out = value = _col(c)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(value.isNotNull(), out)


def between(c: Column | str, lo: Any, hi: Any, inclusive: str = "both") -> Column:
    """In a range, with either, neither or one end included."""
    c = _col(c)
    left = c >= lo if inclusive in ("both", "left") else c > lo
    right = c <= hi if inclusive in ("both", "right") else c < hi
    return left & right


def case_when(cases: Sequence[tuple[Column, Any]], otherwise: Any = None) -> Column:
    """The value of the first true condition."""
    out = None
    for cond, value in cases:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(otherwise)


# Groups of types that can be selected by name.
TYPE_GROUPS = {
    "number": (T.NumericType,),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
    "string": (T.StringType,),
    "boolean": (T.BooleanType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def select_columns(df: DataFrame, types: Sequence[str] | None = None, regex: str | None = None) -> DataFrame:
    """Columns by type group or by a pattern found in the name."""
    names = df.columns
    if types is not None:
        wanted = tuple(t for group in types for t in TYPE_GROUPS[group])
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]
    if regex is not None:
        names = [n for n in names if re.search(regex, n)]
    return df.select(*[F.col(f"`{n}`") for n in names])


def assign(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def add_affix(df: DataFrame, prefix: str = "", suffix: str = "") -> DataFrame:
    return df.toDF(*[f"{prefix}{c}{suffix}" for c in df.columns])


def take(df: DataFrame, positions: Sequence[int] | DataFrame, order: Sequence[str], out: str = "position", **kw) -> DataFrame:
    """Rows by position (from 0) in a stated order; a position asked for twice comes twice."""
    if not isinstance(positions, DataFrame):
        positions = df.sparkSession.createDataFrame([(p,) for p in positions], "position long")
    numbered = Runs(df, (), order, **kw).row_number(out).rows().withColumn(out, F.col(out) - 1)
    wanted = positions.select(F.col(positions.columns[0]).alias("__at"))
    return numbered.join(wanted, F.col(out) == F.col("__at")).drop("__at")


def index_of(df: DataFrame, col: str, value: Any, order: Sequence[str], out: str = "index", **kw) -> DataFrame:
    """Position of the first row with the value, -1 if there is none."""
    numbered = Runs(df, (), order, **kw).row_number("__at").rows()
    first = F.min(F.when(F.col(col) == value, F.col("__at") - 1))
    return numbered.agg(F.coalesce(first, F.lit(-1)).alias(out))
