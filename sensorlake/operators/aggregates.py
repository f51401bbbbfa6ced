"""Aggregation.

Aggregates are Spark's own, combined before the shuffle. Exact quantiles, ranks and modes first
count equal values, then work on the distinct values in order, cut into runs where a group is
large: no task ever holds the values of a whole group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorlake.operators.runs import Runs, same
from sensorlake.operators.windows import value_ranks
from sensorlake.session import pin


def ordering(order: Sequence[str]) -> Column:
    return F.struct(*order) if len(order) > 1 else F.col(order[0])


def statistic(col: str | None, fn: str, opts: Mapping[str, Any] = {}) -> Column:
    """The aggregate ``fn`` of ``col``; NULLs are skipped unless ``skip_nulls`` is off.

    ``min_count`` non-NULL values are needed for a result (C60). ``first``, ``last``, ``open`` and
    ``close`` need ``order``; ``argmin`` and ``argmax`` need ``of``, the column to report.
    """
    c = F.col(col) if col else F.lit(1)
    order = ordering(opts["order"]) if "order" in opts else None
    ddof = opts.get("ddof", 0)
    there = c.isNotNull() & ~F.isnan(c.cast("double")) if opts.get("float") else c.isNotNull()

    def moment(pop: Column, samp: Column) -> Column:
        return pop if ddof == 0 else samp

    table = {
        "count": lambda: F.count(c),
        "count_null": lambda: F.count_if(c.isNull()),
        "count_all": lambda: F.count(F.lit(1)),
        "size": lambda: F.count(F.lit(1)),
        "sum": lambda: F.sum(c),
        "product": lambda: F.product(c),
        "mean": lambda: F.avg(c),
        "min": lambda: F.min(c),
        "max": lambda: F.max(c),
        "first": lambda: F.min_by(c, F.when(c.isNotNull(), order)),
        "last": lambda: F.max_by(c, F.when(c.isNotNull(), order)),
        "any": lambda: F.bool_or(c),
        "all": lambda: F.bool_and(c),
        "var": lambda: moment(F.var_pop(c), F.var_samp(c)),
        "std": lambda: moment(F.stddev_pop(c), F.stddev_samp(c)),
        "sem": lambda: F.stddev_samp(c) / F.sqrt(F.count(c)),
        "skew": lambda: F.skewness(c),
        "kurt": lambda: F.kurtosis(c),
        "approx_quantile": lambda: F.percentile_approx(c, F.lit(opts.get("q", 0.5)), F.lit(opts.get("accuracy", 10_000))),
        "nunique": lambda: F.count_distinct(c),
        "approx_nunique": lambda: F.approx_count_distinct(c),
        "argmin": lambda: F.min_by(F.col(opts["of"]), F.when(there, F.struct(c, F.col(opts["of"])))),
        # Of equal greatest values the smallest ``of`` counts, as for the least ones.
        "argmax": lambda: F.max_by(F.col(opts["of"]), F.when(there, F.struct(c, -_number(opts["of"], opts.get("of_time"))))),
    }
    if fn not in table:
        raise ValueError(f"aggregate: {fn}")
    agg = table[fn]()
    if not opts.get("skip_nulls", True):
        agg = F.when(F.count_if(c.isNull()) == 0, agg)
    if opts.get("min_count"):
        agg = F.when(F.count(c) >= opts["min_count"], agg)
    return agg


def _number(col: str, time: bool | None) -> Column:
    return F.unix_micros(F.col(col).cast("timestamp")) if time else F.col(col)


EXACT = ("quantile", "median")
# A sketch is off by at most one row in so many.
ACCURACY = 10_000
NUMBERS = ("byte", "short", "integer", "long", "float", "double")
TIMES, FLOATS = ("date", "timestamp", "timestamp_ntz"), ("float", "double")


def aggregate(df: DataFrame, keys: Sequence[str], spec: Mapping[str, tuple]) -> DataFrame:
    """``{out: (col, fn, opts)}`` per group, or over the whole table without keys."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    late: dict[str, tuple[str, str]] = {}
    for out, (c, fn, *rest) in list(spec.items()):
        if fn in ("argmin", "argmax"):
            opts = {**rest[0], "float": kinds.get(c) in FLOATS, "of_time": kinds.get(rest[0]["of"]) in TIMES}
            spec = {**spec, out: (c, fn, opts)}
            if fn == "argmax" and kinds.get(opts["of"]) in ("string", "binary", "boolean"):
                late[out] = (c, opts["of"])
    names, spec = list(spec), {out: how for out, how in spec.items() if out not in late}
    plain = [statistic(c, fn, *rest).alias(out) for out, (c, fn, *rest) in spec.items() if fn not in EXACT]
    done = df.groupBy(*keys).agg(*(plain or [F.count(F.lit(1)).alias("__rows")]))
    exact: dict[str, dict[str, tuple[float, str]]] = {}
    for out, (col, fn, *rest) in spec.items():
        if fn in EXACT:
            opts = rest[0] if rest else {}
            exact.setdefault(col, {})[out] = (0.5 if fn == "median" else opts.get("q", 0.5), opts.get("interpolation", "linear"))
    for col, qs in exact.items():
        done = on_keys(done, quantiles(df, keys, col, qs), keys)
    for out, (c, of) in late.items():
        # What has no opposite: first the smallest of each value, then that of the greatest value.
        there = F.col(c).isNotNull() & ~F.isnan(c) if kinds[c] in FLOATS else F.col(c).isNotNull()
        each = df.where(there).groupBy(*keys, F.col(c).alias("__c")).agg(F.min(of).alias("__of"))
        done = on_keys(done, each.groupBy(*keys).agg(F.max_by("__of", "__c").alias(out)), keys)
    return done.select(*keys, *names)


def on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two results that each have one row per key (NULL keys included)."""
    if not keys:
        return left.join(F.broadcast(right))  # one row each
    renamed = right.withColumnsRenamed({k: f"__r{i}" for i, k in enumerate(keys)})
    cond = same([F.col(k) for k in keys], [F.col(f"__r{i}") for i in range(len(keys))])
    return left.join(renamed, cond, "left").drop(*[f"__r{i}" for i in range(len(keys))])


def quantiles(
    df: DataFrame, keys: Sequence[str], col: str, qs: Mapping[str, float | tuple[float, str]], interpolation: str = "linear", **kw
) -> DataFrame:
    """Exact quantiles per group (C55), as ``{out: q}`` or ``{out: (q, interpolation)}``.

    Interpolation is linear, lower, higher, nearest or midpoint.
    """
    keys = list(keys)
    if not keys and df.schema[col].dataType.typeName() in NUMBERS:
        return bracketed_quantiles(df, {col: F.col(col)}, qs, interpolation, **kw).drop("column")
    return _counted_quantiles(df, keys, col, qs, interpolation, **kw)


def _counted_quantiles(df: DataFrame, keys: Sequence[str], col: str, qs: Mapping[str, float | tuple[float, str]], interpolation: str, **kw) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    runs = Runs(counts, keys, ["__v"], within=df, **kw).cumulative("__n", "sum", "__upto")
    placed = runs.total(F.sum("__n"), ["__n"], "__total").rows()
    out = []
    for name, how in qs.items():
        q, kind = how if isinstance(how, tuple) else (how, interpolation)
        spot = F.lit(q) * (F.col("__total") - 1)
        out.append(_between(spot, F.col("__upto") - F.col("__n"), F.col("__upto"), F.col("__v"), kind).alias(name))
    return placed.groupBy(*keys).agg(*out)


def mode(df: DataFrame, keys: Sequence[str], col: str, n: int = 1) -> DataFrame:
    """The ``n`` most frequent values per group with their counts; ties go to the smaller."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("count"))
    best = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("count"), F.asc(col)))
    return counts.withColumn("place", best).where(F.col("place") <= n)


def ohlc(df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str]) -> DataFrame:
    """First, highest, lowest and last value per group."""
    return aggregate(
        df,
        keys,
        {"open": (col, "first", {"order": order}), "high": (col, "max"), "low": (col, "min"), "close": (col, "last", {"order": order})},
    )


def value_counts(df: DataFrame, col: str, normalize: bool = False, drop_nulls: bool = True) -> DataFrame:
    """Rows per value."""
    counts = (df.where(F.col(col).isNotNull()) if drop_nulls else df).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return counts
    total = counts.agg(F.sum("count").alias("__total"))
    return counts.join(F.broadcast(total)).select(col, (F.col("count") / F.col("__total")).alias("proportion"))


def long_form(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    return df.select(*[F.col(c).cast(kind) for c in cols]).unpivot([], list(cols), "column", "value")


def bracketed_quantiles(
    df: DataFrame, values: Mapping[str, Column], qs: Mapping[str, float | tuple[float, str]], interpolation: str = "linear", **kw
) -> DataFrame:
    """Exact quantiles of several columns over the whole table (C55, C63): (column, the quantiles), a row per column.

    A sketch of each column brackets every quantile between two values that are a few ten-thousandths of the rows apart. A second
    scan counts what is below each bracket, a third hands on only what lies inside, counted by value: nothing else is shuffled. A
    bracket that misses its rank, which the sketch's bound rules out, is worked out without one.
    """
    names, slack = list(values), 1.5 / ACCURACY
    wanted = [how if isinstance(how, tuple) else (how, interpolation) for how in qs.values()]
    edges = F.array(*[F.lit(min(max(q + way * slack, 0.0), 1.0)) for q, _ in wanted for way in (-1, 1)])
    sketch = [F.struct(F.count(c).alias("n"), F.percentile_approx(c, edges, F.lit(ACCURACY)).alias("at")).alias(f"c{i}") for i, c in enumerate(values.values())]
    found = df.agg(*sketch).first()
    inside, below, brackets = [], [], []
    for i, c in enumerate(values.values()):
        n, at = found[f"c{i}"]
        for j, (q, _) in enumerate(wanted if n else ()):
            # At the ends a bracket is open: the sketch's least value need not be the least.
            lo = at[2 * j] if q > slack else None
            hi = at[2 * j + 1] if q < 1 - slack else None
            held = c.isNotNull()
            if lo is not None:
                held = held & (c >= F.lit(lo))
            if hi is not None:
                held = held & (c <= F.lit(hi))
            inside.append(F.when(held, F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), c.alias("v"))))
            below.append(F.count_if(c < F.lit(lo)) if lo is not None else F.count_if(F.lit(False)))
            brackets.append((i, j, n))
    spark = df.sparkSession
    if not brackets:
        kind = df.select(next(iter(values.values())).alias("v")).schema["v"].dataType
        empty = [F.lit(None).cast("double" if how[1] in ("linear", "midpoint") else kind).alias(out) for out, how in zip(qs, wanted)]
        return spark.createDataFrame([(n,) for n in names], "column string").select("column", *empty)
    # Counted by a scan of its own: a count taken on the way would run double when a lost task is run again.
    under = list(df.agg(*[b.alias(f"b{k}") for k, b in enumerate(below)]).first())
    kept = df.select(F.explode(F.array_compact(F.array(*inside))).alias("r")).groupBy("r.i", "r.j", "r.v").agg(F.count(F.lit(1)).alias("n"))
    kept = pin(kept)
    held = {(r["i"], r["j"]): r["n"] for r in kept.groupBy("i", "j").agg(F.sum("n").alias("n")).collect()}
    missed = set()
    targets = []
    for (i, j, n), low in zip(brackets, under):
        spot = wanted[j][0] * (n - 1)
        if not (low <= math.floor(spot) and math.ceil(spot) < low + held.get((i, j), 0)):
            missed.add(i)
        targets.append((i, j, spot, low))
    runs = Runs(kept, ["i", "j"], ["v"], **kw).cumulative("n", "sum", "__upto").rows()
    spots = spark.createDataFrame([t for t in targets if t[0] not in missed], "ti int, tj int, spot double, under long")
    rows = runs.join(F.broadcast(spots), (F.col("i") == F.col("ti")) & (F.col("j") == F.col("tj")))
    start, end = F.col("under") + F.col("__upto") - F.col("n"), F.col("under") + F.col("__upto")
    made = [_between(F.when(F.col("j") == j, F.col("spot")), start, end, F.col("v"), kind).alias(out) for j, (out, (_, kind)) in enumerate(zip(qs, wanted))]
    done = rows.groupBy("i").agg(*made)
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    out = done.select(label.alias("column"), *qs)
    for i in sorted(missed):
        out = out.unionByName(_counted_quantiles(df.select(values[names[i]].alias("v")), [], "v", dict(zip(qs, wanted)), interpolation).withColumn("column", F.lit(names[i])))
    blank = [n for i, n in enumerate(names) if not found[f"c{i}"][0]]
    if blank:
        out = out.unionByName(spark.createDataFrame([(n,) for n in blank], "column string"), allowMissingColumns=True)
    return out


def _between(spot: Column, start: Column, end: Column, value: Column, kind: str) -> Column:
    """The value at a place between two ranks, from values that hold the ranks [start, end)."""
    low, high = F.floor(spot), F.ceil(spot)
    lo = F.max(F.when((start <= low) & (low < end), value))
    hi = F.max(F.when((start <= high) & (high < end), value))
    part, at = F.max(spot - low), F.max(low)
    found = {
        "linear": lo + (hi - lo) * part,
        "lower": lo,
        "higher": hi,
        "midpoint": (lo + hi) / 2,
        # Half-way goes to the even position.
        "nearest": F.when((part < 0.5) | ((part == 0.5) & (at % 2 == 0)), lo).otherwise(hi),
    }[kind]
    # Equal neighbours need no arithmetic, so that infinities stay.
    return F.when(lo == hi, lo).otherwise(found)


def _wide(df: DataFrame, values: Mapping[str, Column], stats: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """(column, statistics) from one aggregate over all columns side by side."""
    made = [F.struct(F.lit(name).alias("column"), *[f(c).alias(out) for out, f in stats.items()]) for name, c in values.items()]
    return df.agg(F.array(*made).alias("all")).select(F.inline("all"))


def describe(df: DataFrame, cols: Sequence[str], percentiles: Sequence[float] = (0.25, 0.5, 0.75), **kw) -> DataFrame:
    """Count, mean, std, min, percentiles and max of numeric columns, one row per column."""
    values = {c: F.col(c).cast("double") for c in cols}
    stats = _wide(df, values, {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    return on_keys(stats, bracketed_quantiles(df, values, _percent_names(percentiles), **kw), ["column"])


def _percent_names(percentiles: Sequence[float]) -> dict[str, float]:
    return {f"p{100 * p:g}".replace(".", "_"): p for p in percentiles}


def describe_categories(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, distinct values, the most frequent value and its count."""
    counts = long_form(df, cols, "string").where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    top = F.min(F.struct((-F.col("n")).alias("minus"), "value")).alias("top")
    return counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), top).select(
        "column", "count", "unique", F.col("top.value").alias("top"), (-F.col("top.minus")).alias("freq")
    )


def describe_times(df: DataFrame, cols: Sequence[str], percentiles: Sequence[float] = (0.25, 0.5, 0.75), **kw) -> DataFrame:
    """Count, mean, min, percentiles and max of timestamps, to the microsecond."""
    from sensorlake.operators.windows import micros

    values = {c: micros(df, c) for c in cols}
    # A mean of microseconds needs more digits than a double sum keeps.
    stats = _wide(df, values, {"count": F.count, "mean": lambda c: F.avg(c.cast("decimal(20,0)")), "min": F.min, "max": F.max})
    names = _percent_names(percentiles)
    done = on_keys(stats, bracketed_quantiles(df, values, names, **kw), ["column"])

    def as_time(c: str) -> Column:
        return F.timestamp_micros(F.round(F.col(c)).cast("long")).cast("timestamp_ntz").alias(c)

    return done.select("column", "count", *[as_time(c) for c in ("mean", "min", *names, "max")])


def correlate(df: DataFrame, a: str, b: str, method: str = "pearson", keys: Sequence[str] = (), **kw) -> DataFrame:
    """Pearson or Spearman correlation, or sample covariance, of pairs without NULL."""
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    if method == "spearman":
        ranks = [value_ranks(pairs, c, keys, {out: ("average", False)}, **kw) for c, out in ((a, "__a"), (b, "__b"))]
        pairs = on_keys(on_keys(pairs, ranks[0], [*keys, a]), ranks[1], [*keys, b])
        a, b = "__a", "__b"
    # NULL, not an error, where one side does not vary.
    pearson = F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(a) * F.var_pop(b)))
    stat = F.covar_samp(a, b) if method == "covariance" else pearson
    return pairs.groupBy(*keys).agg(stat.alias(method))


def pivot_wider(
    df: DataFrame, keys: Sequence[str], name_col: str, value_col: str, names: Sequence[Any], unexpected: str = "ignore"
) -> DataFrame:
    """One column per listed name (C65). A name that repeats in a group is an error; an unlisted
    name is ignored or an error."""
    aggs = []
    for name in names:
        hit = F.when(F.col(name_col) == name, F.col(value_col))
        n = F.count_if((F.col(name_col) == name) & F.col(value_col).isNotNull())
        aggs.append(F.when(n > 1, F.raise_error(F.lit(f"more than one value for {name}"))).otherwise(F.max(hit)).alias(str(name)))
    wide = df
    if unexpected == "error":
        unknown = F.raise_error(F.concat(F.lit("unexpected name: "), F.col(name_col).cast("string"))).cast("boolean")
        wide = df.where(F.when(~F.col(name_col).isin(*names), unknown).otherwise(F.lit(True)))
    return wide.groupBy(*keys).agg(*aggs)


# Column values that become columns: beyond this many they are data, not schema.
MAX_COLUMNS = 10_000


def values_of(df: DataFrame, col: str) -> list[Any]:
    """The distinct values of a column, in order, to name columns by."""
    found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_COLUMNS + 1).collect()
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"{col} has more than {MAX_COLUMNS} values; list those wanted")
    return sorted(r[0] for r in found)


def pivot_table(
    df: DataFrame, index: Sequence[str], column: str, value: str, fn: str = "mean", names: Sequence[Any] | None = None
) -> DataFrame:
    """Aggregate of ``value`` for every index and column value (C66). Without ``names`` the column
    values are looked up first; they become the schema."""
    if names is None:
        names = values_of(df, column)
    return df.groupBy(*index).pivot(column, list(names)).agg(statistic(value, fn))


def crosstab(df: DataFrame, a: str, b: str, margins: bool = False, names: Sequence[Any] | None = None) -> DataFrame:
    """Counts of two columns against each other, with totals as ``All`` on request."""
    if names is None:
        names = values_of(df, b)
    counts = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    label = F.col(a).cast("string").alias(a)
    if margins:
        # Totals are taken over the counts, not over the rows again.
        both = counts.rollup(a).agg(
            *[F.sum(F.when(F.col(b) == v, F.col("n")).otherwise(0)).alias(str(v)) for v in names],
            F.sum("n").alias("All"),
            F.grouping(a).alias("__whole"),
        )
        return both.select(F.when(F.col("__whole") == 1, F.lit("All")).otherwise(F.col(a).cast("string")).alias(a), *[f"`{v}`" for v in names], "All")
    wide = counts.groupBy(a).agg(*[F.sum(F.when(F.col(b) == v, F.col("n")).otherwise(0)).alias(str(v)) for v in names])
    return wide.select(label, *[f"`{v}`" for v in names])


def group_filter(df: DataFrame, keys: Sequence[str], keep: Column) -> DataFrame:
    """Rows of the groups for which the aggregate ``keep`` is true."""
    chosen = df.groupBy(*keys).agg(keep.alias("__keep")).where("__keep")
    renamed = chosen.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)])
    return df.join(renamed, same([F.col(k) for k in keys], [F.col(f"__r{i}") for i in range(len(keys))]), "left_semi")


def row_min(*cols: str) -> Column:
    """Smallest of several columns; NULLs are skipped."""
    return F.least(*cols)


def row_max(*cols: str) -> Column:
    return F.greatest(*cols)
