"""Many small groups, handed to Python tasks in batches.

Handing groups over one by one costs about a millisecond each, more than the work on a small group. Here Spark puts the rows of a group
one after the other and marks the first; a task reads batches and cuts them at the marks. A group is still seen whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

FIRST = "__first"
BLANK = "__blank_"


def marked(df: DataFrame, by: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The rows group by group, each in ``order``; ``__first`` is true on the first row of a group."""
    window = Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_first() for c in (order or by)])
    return df.withColumn(FIRST, F.row_number().over(window) == 1)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Tables of whole groups and where in them each begins and ends."""

    def of(parts: list[pa.RecordBatch]) -> tuple[pa.Table, list[tuple[int, int]]]:
        table = pa.Table.from_batches(parts).combine_chunks()
        begins = np.flatnonzero(table[FIRST].to_numpy()).tolist()
        return table.drop_columns([FIRST]), list(zip(begins, [*begins[1:], table.num_rows]))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        begins = np.flatnonzero(batch.column(FIRST).to_numpy(zero_copy_only=False))
        # The last group of a batch may go on in the next.
        cut = int(begins[-1]) if len(begins) else 0
        if cut:
            yield of([*held, batch.slice(0, cut)])
            held = []
        elif len(begins) and held:
            yield of(held)
            held = []
        if batch.num_rows:
            held.append(batch.slice(cut))
    if held:
        yield of(held)


def tables_in_batches(df: DataFrame, by: Sequence[str], fn: Callable[[pa.Table], pa.Table], schema: str | T.StructType) -> DataFrame:
    """``fn`` once per group, from Arrow table to Arrow table: tens of microseconds for a small group."""
    result = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, ends in whole_groups(batches):
            made = [fn(table.slice(a, b - a)).select(arrow.names) for a, b in ends]
            yield from pa.concat_tables(made, promote_options="permissive").cast(arrow).combine_chunks().to_batches(max_chunksize=10_000)

    return marked(df, by).mapInArrow(run, result)


# Types whose values look the same to pandas, whatever else is in their batch; of whole numbers and booleans NULLs are told apart.
WEAK = (T.IntegralType, T.BooleanType)
PLAIN = (*WEAK, T.FloatType, T.DoubleType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def plain(df: DataFrame) -> bool:
    return all(isinstance(f.dataType, PLAIN) for f in df.schema)


def apply_in_batches(df: DataFrame, by: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """``fn`` once per group, of columns that are ``plain``. A group looks as it would alone: a NULL in another one changes no type."""
    result = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    weak = {f.name: T.BooleanType() == f.dataType for f in df.schema if isinstance(f.dataType, WEAK) and f.nullable}
    blanks = {BLANK + c: F.col(f"`{c}`").isNull() for c in weak}
    filled = {c: F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(df.schema[c].dataType)) for c in weak}
    rows = marked(df, by).withColumns(blanks | filled)

    def restored(group: pd.DataFrame, c: str, blank: np.ndarray) -> pd.Series:
        if weak[c]:
            return group[c].astype(object).mask(blank, None)
        return group[c].astype(np.float64).mask(blank)

    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[list[pd.DataFrame]]:
        def cut(parts: list[pd.DataFrame]) -> list[pd.DataFrame]:
            table = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
            begins = np.flatnonzero(table.pop(FIRST).to_numpy()).tolist()
            blank = {c: table.pop(BLANK + c).to_numpy() for c in weak}
            blank = {c: b for c, b in blank.items() if b.any()}
            out = []
            for a, b in zip(begins, [*begins[1:], len(table)]):
                group = table.iloc[a:b].reset_index(drop=True)
                for c, places in blank.items():
                    if places[a:b].any():
                        group[c] = restored(group, c, places[a:b])
                out.append(group)
            return out

        held: list[pd.DataFrame] = []
        for batch in batches:
            begins = np.flatnonzero(batch[FIRST].to_numpy())
            at = int(begins[-1]) if len(begins) else 0
            if len(begins) and (held or at):
                yield cut([*held, batch.iloc[:at]] if at else held)
                held = []
            if len(batch):
                held.append(batch.iloc[at:])
        if held:
            yield cut(held)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in groups(batches):
            alike: list[pd.DataFrame] = []
            for group in some:
                made = fn(group)
                if isinstance(made, pd.DataFrame) and made.empty and not len(made.columns):
                    continue
                if isinstance(made, pd.DataFrame) and len(made.columns) != len(result):
                    raise ValueError(f"columns {list(made.columns)} of a group for {result.names}")
                # Only frames of the same types are put together: no value changes its type on the way.
                if alike and not (isinstance(made, pd.DataFrame) and made.columns.equals(alike[0].columns) and made.dtypes.equals(alike[0].dtypes)):
                    yield pd.concat(alike, ignore_index=True)
                    alike = []
                if not isinstance(made, pd.DataFrame):
                    raise TypeError(f"a function of a group returns a DataFrame, not {type(made).__name__}")
                alike.append(made)
            if alike:
                yield pd.concat(alike, ignore_index=True)

    return rows.mapInPandas(run, result)
