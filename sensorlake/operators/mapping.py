"""Projection by mapping, timestamps, field selection and names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

Mapping = Sequence[tuple[str, str, str, str]]


def _path(name: str) -> str:
    """Quote every step of a dotted path, so names with blanks or keywords resolve."""
    return ".".join(f"`{step}`" for step in name.replace("`", "").split("."))


def source_column(df: DataFrame, name: str) -> Column:
    """A top-level column of that exact name, else the nested field the dots lead to."""
    return F.col(f"`{name}`") if name in df.columns else F.col(_path(name))


def to_ts(col: Column | str, fmt: str | None = None, ntz: bool = True) -> Column:
    """String to timestamp; text that does not parse becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    if fmt is None:
        return c.try_cast("timestamp_ntz" if ntz else "timestamp")
    parsed = F.try_to_timestamp(c, F.lit(fmt))
    return parsed.cast("timestamp_ntz") if ntz else parsed


def mapped_column(raw: Column, src_type: str, dst_type: str, fmt: str | None = None) -> Column:
    """Read ``raw`` as the staged type, then as the target type; failures are NULL."""
    typed = raw.try_cast(src_type)
    if dst_type in ("timestamp", "timestamp_ntz"):
        return to_ts(typed, fmt, ntz=dst_type == "timestamp_ntz")
    return typed if dst_type == src_type else typed.try_cast(dst_type)


def apply_mapping(
    df: DataFrame,
    mapping: Mapping,
    on_error: str = "null",
    formats: dict[str, str] | None = None,
) -> DataFrame:
    """Rename, cast and keep the mapped fields in one projection.

    A value that is present and does not cast is an error. ``on_error`` says what follows:
    ``null`` leaves NULL, ``fail`` raises, ``quarantine`` adds ``_errors``, the array of target
    names that failed (see ``quality.quarantine``).
    """
    formats = formats or {}
    out, errors = [], []
    raws = [source_column(df, src) for src, *_ in mapping]
    actual = [f.dataType.simpleString() for f in df.select(*[raw.alias(str(i)) for i, raw in enumerate(raws)]).schema]
    for (_, src_type, dst, dst_type), raw, kind in zip(mapping, raws, actual):
        # A time that is one already does not go through text.
        is_time = kind == dst_type and kind.startswith("timestamp")
        value = raw if is_time else mapped_column(raw, src_type, dst_type, formats.get(dst))
        if on_error == "fail":
            message = F.concat(F.lit(f"cannot read {dst} as {dst_type}: "), raw.cast("string"))
            value = F.when(raw.isNotNull() & value.isNull(), F.raise_error(message).cast(dst_type)).otherwise(value)
        elif on_error == "quarantine":
            errors.append(F.when(raw.isNotNull() & value.isNull(), F.lit(dst)))
        elif on_error != "null":
            raise ValueError(f"on_error: {on_error}")
        out.append(value.alias(dst))
    if on_error == "quarantine":
        out.append(F.array_compact(F.array(*errors)).alias("_errors"))
    return df.select(*out)


def select_fields(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Keep the named fields, in the order given."""
    return df.select(*[source_column(df, p).alias(p.split(".")[-1]) for p in paths])


def snake_case(name: str) -> str:
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    return re.sub(r"[^0-9a-zA-Z]+", "_", words).strip("_").lower()


def normalize_columns(df: DataFrame, on_collision: str = "fail") -> DataFrame:
    """Snake-case every column name; two that meet either fail or are numbered."""
    taken: set[str] = set()
    names = []
    for column in df.columns:
        name = base = snake_case(column) or "column"
        n = 0
        while name in taken:
            if on_collision != "suffix":
                raise ValueError(f"columns collide after normalising: {column!r} -> {name!r}")
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        names.append(name)
    return df.toDF(*names)


def stage_key(col: Column | str) -> Column:
    """Landing key to stage key: leading ``raw/`` and trailing ``.csv`` only."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.regexp_replace(c, r"^raw/", "stage/"), r"\.csv$", ".parquet")
