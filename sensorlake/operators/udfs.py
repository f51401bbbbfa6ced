"""User functions: registration and group-wise application (C124-C128)."""

from __future__ import annotations

import inspect
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pyspark.sql.pandas.types import to_arrow_schema

from sensorlake.operators.groups import apply_in_batches, plain, tables_in_batches
from sensorlake.operators.runs import Runs


def register(spark: SparkSession, name: str, fn: Callable, kind: str = "scalar", returns: str | T.DataType = "double"):
    """Make ``fn`` callable from SQL (C124-C126).

    ``scalar`` takes and returns pandas Series; ``agg`` takes Series, a whole group in one worker, and returns
    a number (``group_aggregate`` is for groups of any size); ``table`` is a class with an ``eval`` that yields rows of the type ``returns``.
    """
    if kind == "table":
        made = F.udtf(fn, returnType=returns)
        spark.udtf.register(name, made)
        return made
    if kind == "scalar":
        # The types say how Spark hands over the columns.
        def call(*cols: pd.Series) -> pd.Series:
            return fn(*cols)
    elif kind == "agg":
        def call(*cols: pd.Series) -> float:
            return fn(*cols)
    else:
        raise ValueError(f"kind: {kind}")
    call.__annotations__ = {"cols": pd.Series, "return": pd.Series if kind == "scalar" else float}
    made = F.pandas_udf(call, returnType=returns)
    spark.udf.register(name, made)
    return made


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """``fn`` over batches of rows, in place (C127)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


def group_apply(df: DataFrame, by: Sequence[str], fn: Callable, schema: str | T.StructType) -> DataFrame:
    """``fn`` once per group (C127).

    A function from DataFrame to DataFrame sees its group whole, so it is for groups known to fit a
    task; small groups reach the task many at a time (see ``groups``). One annotated ``Iterator[pd.DataFrame] -> Iterator[pd.DataFrame]`` is given the group in
    batches and needs no more memory than a batch. One annotated ``pa.Table -> pa.Table`` is the fastest for
    very many small groups: pandas takes a millisecond to make and change a frame. Where parts of a group can be worked on alone,
    use ``group_combine``.
    """
    if by and _takes(fn, pa.Table):
        return tables_in_batches(df, by, fn, schema)
    # Functions of (key, group) or of batches, and nested columns, go the way Spark has for them.
    if by and plain(df) and (_takes(fn, pd.DataFrame) or _takes(fn, inspect.Parameter.empty)):
        return apply_in_batches(df, by, fn, schema)
    return df.groupBy(*by).applyInPandas(fn, schema)


def _takes(fn: Callable, kind: type) -> bool:
    """Whether the function has one parameter, annotated like this."""
    asked = [p.annotation for p in inspect.signature(fn).parameters.values()]
    return len(asked) == 1 and (asked[0] is kind or asked[0] in (f"pa.{kind.__name__}", f"pd.{kind.__name__}"))


def group_combine(
    df: DataFrame,
    by: Sequence[str],
    part: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
) -> DataFrame:
    """Group-wise work in two steps (C125, C127): ``part`` turns rows of a group in one batch into a
    row of ``schema`` (``by`` first), ``merge`` any number of such rows into one.

    ``part`` runs before the shuffle and the rows are merged on the way, so no group is ever in one
    place, however large.
    """
    by = list(by)

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            new = pd.concat([part(g) for _, g in batch.groupby(by, dropna=False)])
            held = new if held is None else pd.concat([held, new])
            if len(held) > 2 * held.groupby(by, dropna=False).ngroups or len(held) > 100_000:
                held = pd.concat([merge(g) for _, g in held.groupby(by, dropna=False)])
            if len(held) > 100_000:
                yield held
                held = None
        if held is not None:
            yield held

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = merge(batch if held is None else pd.concat([held, batch]))
        yield held

    finish.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return df.mapInPandas(shrink, schema).groupBy(*by).applyInPandas(finish, schema)


class Aggregate:
    """An aggregate of the user in three steps (C125), for groups of any size.

    ``partial`` makes a state, a dict of plain values as ``state`` declares, from an Arrow table of some of a group's rows;
    ``merge`` makes one state of two, in any order; ``finish`` makes the result, of type ``returns``, from the last state.
    """

    def __init__(self, partial: Callable, merge: Callable, finish: Callable, state: str, returns: str = "double"):
        self.partial, self.merge, self.finish, self.state, self.returns = partial, merge, finish, state, returns

    def fold(self, states: Iterable[dict]) -> dict:
        return reduce(self.merge, states)

    def check(self, table: pa.Table) -> None:
        """Raises unless the parts of ``table`` give one result however they are merged."""
        cuts = sorted({0, table.num_rows // 3, 2 * table.num_rows // 3, table.num_rows})
        parts = [self.partial(table.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])]
        if len(parts) < 3:
            return
        a, b, c = parts
        m = self.merge
        ways = [m(m(a, b), c), m(a, m(b, c)), m(m(c, a), b), m(c, m(b, a)), self.partial(table)]
        first, *others = [self.finish(w) for w in ways]
        if not all(_alike(first, x) for x in others):
            raise ValueError(f"merge depends on how a group is cut: {first} and {others}")


def _alike(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) or (a != a and b != b)
    if isinstance(a, (list, tuple)) and isinstance(b, (list, tuple)):
        return len(a) == len(b) and all(map(_alike, a, b))
    return a == b


def group_aggregate(df: DataFrame, by: Sequence[str], cols: Sequence[str], aggs: dict[str, Aggregate], salts: int = 64, held: int = 100_000) -> DataFrame:
    """(by, ``{out: Aggregate}``) over ``cols`` (C125).

    Tasks make partial states of the rows where they lie, one per group and batch, merged in the task. The states of a group are merged
    by ``salts`` tasks and then by one: a group with all rows of the table is worked on by every task that reads it.
    Every task first checks on rows of its own that merging does not depend on the cuts.
    """
    by, cols = list(by), list(cols)
    keys = [df.schema[c] for c in by]
    state = T.StructType([T.StructField(out, T.StructType.fromDDL(a.state)) for out, a in aggs.items()])
    arrow = pa.schema([to_arrow_schema(T.StructType([f])).field(0) for f in (*keys, *state.fields)])
    fields = T.StructType([*keys, *state.fields])

    def table_of(groups: dict[tuple, dict[str, dict]]) -> pa.RecordBatch:
        rows = [dict(zip(by, key)) | states for key, states in groups.items()]
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, dict[str, dict]] = {}
        checked = False
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if not checked and batch.num_rows >= 3:
                for a in aggs.values():
                    a.check(table.select(cols).slice(0, 3000))
                checked = True
            places = table.select(by).append_column("__i", pa.array(range(table.num_rows)))
            for group in places.group_by(by).aggregate([("__i", "list")]).to_pylist():
                key = tuple(group[c] for c in by)
                part = table.select(cols).take(pa.array(group["__i_list"]))
                new = {out: a.partial(part) for out, a in aggs.items()}
                old = found.get(key)
                found[key] = new if old is None else {out: a.merge(old[out], new[out]) for out, a in aggs.items()}
            if len(found) > held:
                yield table_of(found)
                found = {}
        if found:
            yield table_of(found)

    def merged(table: pa.Table) -> pa.Table:
        states = table.to_pylist()
        key = tuple(states[0][c] for c in by)
        return pa.Table.from_batches([table_of({key: {out: a.fold(s[out] for s in states) for out, a in aggs.items()}})])

    def finished(table: pa.Table) -> pa.Table:
        row = merged(table).to_pylist()[0]
        out = {c: row[c] for c in by} | {name: a.finish(row[name]) for name, a in aggs.items()}
        return pa.Table.from_pylist([out], schema=results)

    result = T.StructType([*keys, *[T.StructField(out, T._parse_datatype_string(a.returns)) for out, a in aggs.items()]])
    results = to_arrow_schema(result)
    states = df.select(*by, *[c for c in cols if c not in by]).mapInArrow(partial, fields)
    salted = states.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    halves = salted.groupBy(*by, "__salt").applyInArrow(lambda t: merged(t.drop(["__salt"])), fields)
    return halves.groupBy(*by).applyInArrow(lambda t: finished(t), result)


def group_transform(df: DataFrame, by: Sequence[str], out: str, agg: Column) -> DataFrame:
    """An aggregate of its group on every row (C127), joined back so that a large group stays spread."""
    from sensorlake.operators.aggregates import on_keys

    return on_keys(df, df.groupBy(*by).agg(agg.alias(out)), by)


def pipe(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Functions from DataFrame to DataFrame, one after the other (C127)."""
    for step in steps:
        df = df.transform(step)
    return df


def rolling_apply(
    df: DataFrame,
    col: str,
    fn: Callable[[pd.Series], float],
    by: Sequence[str],
    order: Sequence[str],
    rows: int,
    min_periods: int | None = None,
    out: str = "rolling_apply",
    **kw,
) -> DataFrame:
    """A function of the last ``rows`` values (C128)."""

    def call(values: pd.Series) -> float:
        return float(fn(values))

    call.__annotations__ = {"values": pd.Series, "return": float}
    stat = F.pandas_udf(call, "double")
    least = rows if min_periods is None else min_periods

    def exprs(w: Window) -> dict[str, Column]:
        return {"__seen": F.count(col).over(w), "__value": stat(col).over(w)}

    # Spark does not mix Python and built-in functions in one window, so they are two columns.
    done = Runs(df, by, order, **kw).rolling(rows, [col], exprs).rows()
    return done.withColumn(out, F.when(F.col("__seen") >= least, F.col("__value"))).drop("__seen", "__value")


def expanding_apply(
    df: DataFrame, col: str, fn: Callable[[pd.Series], float], by: Sequence[str], order: Sequence[str], out: str = "expanding_apply"
) -> DataFrame:
    """A function of all values so far (C128): the work of a group grows with its square."""

    def call(values: pd.Series) -> float:
        return float(fn(values))

    call.__annotations__ = {"values": pd.Series, "return": float}
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.pandas_udf(call, "double")(col).over(w))
