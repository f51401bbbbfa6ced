"""Window operators over ordered groups.

All take ``by`` (may be empty) and ``order``, a total order inside a group, and work through
``Runs``, so a group that holds much of the data is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sensorlake.operators import runs as runs_module
from sensorlake.operators.decay import exponential
from sensorlake.operators.growing import growing
from sensorlake.operators.runs import RUN, Runs, same
from sensorlake.operators.sliding import fits, sliding


def cumulative(df: DataFrame, col: str, fn: str, by: Sequence[str], order: Sequence[str], out: str | None = None, **kw) -> DataFrame:
    """Running sum, product, min, max or count."""
    return Runs(df, by, order, **kw).cumulative(col, fn, out or f"cum_{fn}").rows()


def shift(df: DataFrame, col: str, n: int, by: Sequence[str], order: Sequence[str], out: str | None = None, **kw) -> DataFrame:
    """Value ``n`` rows back, or ahead for ``n`` < 0."""
    return Runs(df, by, order, **kw).shift(col, n, out or f"{col}_shift").rows()


def difference(df: DataFrame, col: str, by: Sequence[str], order: Sequence[str], n: int = 1, out: str = "diff", **kw) -> DataFrame:
    """Change against the value ``n`` rows back."""
    rows = Runs(df, by, order, **kw).shift(col, n, "__was").rows()
    return rows.withColumn(out, F.col(col) - F.col("__was")).drop("__was")


def pct_change(df: DataFrame, col: str, by: Sequence[str], order: Sequence[str], n: int = 1, out: str = "pct_change", **kw) -> DataFrame:
    """Relative change against the value ``n`` rows back."""
    rows = Runs(df, by, order, **kw).shift(col, n, "__was").rows()
    return rows.withColumn(out, F.try_divide(F.col(col), F.col("__was")) - 1).drop("__was")


def rank(
    df: DataFrame,
    col: str,
    by: Sequence[str] = (),
    method: str = "average",
    order: Sequence[str] = (),
    pct: bool = False,
    descending: bool = False,
    out: str = "rank",
    **kw,
) -> DataFrame:
    """Rank of ``col`` inside its group; NULL ranks NULL.

    ``first`` numbers the rows by (value, ``order``). The other methods depend on the value alone
    and come from ``value_ranks``, joined back.
    """
    by = list(by)
    if method != "first":
        return _join_back(df, value_ranks(df, col, by, {out: (method, pct)}, descending, **kw), [*by, col])
    # Rows without a value are numbered too, behind the others, and then lose their number.
    behind = df.withColumn("__none", F.col(col).isNull() if not descending else F.col(col).isNotNull())
    runs = Runs(behind, by, ["__none", col, *order], descending=descending, **kw).row_number(out)
    ranked = runs.rows().drop("__none").withColumn(out, F.when(F.col(col).isNotNull(), F.col(out).cast("double")))
    if not pct:
        return ranked
    totals = df.groupBy(*by).agg(F.count(col).cast("double").alias("__total"))
    return _join_back(ranked, totals, by).withColumn(out, F.col(out) / F.col("__total")).drop("__total")


def value_ranks(
    df: DataFrame, col: str, by: Sequence[str], outs: Mapping[str, tuple[str, bool]], descending: bool = False, **kw
) -> DataFrame:
    """(by, col, ranks): ranks as ``{out: (method, pct)}`` for every distinct value of a group.

    Equal values are counted before the shuffle, so a value that very many rows share costs no more
    than any other.
    """
    by = list(by)
    values = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("__n"))
    runs = Runs(values, by, [col], descending=descending, within=df, **kw).cumulative("__n", "sum", "__upto").row_number("__dense")
    if any(pct for _, pct in outs.values()):
        runs = runs.total(F.sum("__n"), ["__n"], "__rows").total(F.count("__n"), ["__n"], "__values")
    ranked = runs.rows()
    ranks = {
        "min": F.col("__upto") - F.col("__n") + 1,
        "max": F.col("__upto"),
        "average": F.col("__upto") - (F.col("__n") - 1) / 2,
        "dense": F.col("__dense"),
    }

    def value(method: str, pct: bool) -> Column:
        c = ranks[method].cast("double")
        return c / F.col("__values" if method == "dense" else "__rows") if pct else c

    return ranked.select(*by, col, *[value(*how).alias(out) for out, how in outs.items()])


def _join_back(df: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key back onto the rows. Adaptive execution splits a hot key of the row side."""
    if not keys:
        return df.join(F.broadcast(per_key))  # a single row
    renamed = per_key.withColumnsRenamed({k: f"__j{i}" for i, k in enumerate(keys)})
    cond = same([F.col(k) for k in keys], [F.col(f"__j{i}") for i in range(len(keys))])
    return df.join(renamed, cond, "left").drop(*[f"__j{i}" for i in range(len(keys))])


def row_number(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "n", **kw) -> DataFrame:
    """Position in the group, from 0."""
    rows = Runs(df, by, order, **kw).row_number(out).rows()
    return rows.withColumn(out, F.col(out) - 1)


def group_number(df: DataFrame, by: Sequence[str], out: str = "group", **kw) -> DataFrame:
    """Number of the group in key order, from 0 (C73). Only the distinct keys are ordered."""
    keys = Runs(df.select(*by).distinct(), (), by, **kw).row_number(out).rows()
    return _join_back(df, keys.withColumn(out, F.col(out) - 1), by)


def fill(df: DataFrame, col: str, by: Sequence[str], order: Sequence[str], direction: str = "forward", out: str | None = None, **kw) -> DataFrame:
    """NULLs replaced by the previous (``forward``) or next value of the group."""
    if direction not in ("forward", "backward"):
        raise ValueError(f"direction: {direction}")
    return Runs(df, by, order, **kw).fill(col, out or col, backward=direction == "backward").rows()


def nth(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The ``n``-th row of each group, from 0; negative counts from the end.

    The bound on the row number lets Spark drop the rest before the shuffle.
    """
    at = n + 1 if n >= 0 else -n
    ranked = df.withColumn("__at", F.row_number().over(_plain(by, order, n < 0))).where(F.col("__at") <= at)
    return ranked.where(F.col("__at") == at).drop("__at")


def head(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows of each group."""
    return df.withColumn("__at", F.row_number().over(_plain(by, order, False))).where(F.col("__at") <= n).drop("__at")


def tail(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows of each group."""
    return df.withColumn("__at", F.row_number().over(_plain(by, order, True))).where(F.col("__at") <= n).drop("__at")


def _plain(by: Sequence[str], order: Sequence[str], descending: bool) -> Window:
    keys = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    return Window.partitionBy(*by).orderBy(*keys)


# Statistics Spark evaluates over any bounded frame.
def frame_statistic(fn: str, col: str, q: float = 0.5) -> Callable[[Window], Column]:
    c = F.col(col)
    n = F.count(c)

    def rank_now(w: Window) -> Column:
        # Average rank of the last value among those of the frame.
        values = F.collect_list(c).over(w)
        below = F.size(F.filter(values, lambda x: x < c))
        ties = F.size(F.filter(values, lambda x: x == c))
        return F.when(c.isNotNull(), below + (ties + 1) / 2)

    def at_least(k: int, expr: Callable[[Window], Column]) -> Callable[[Window], Column]:
        return lambda w: F.when(n.over(w) >= k, expr(w))

    def skew(w: Window) -> Column:
        m = n.over(w).cast("double")
        return F.sqrt(m * (m - 1)) / (m - 2) * F.skewness(c).over(w)

    def kurt(w: Window) -> Column:
        m = n.over(w).cast("double")
        return (m - 1) / ((m - 2) * (m - 3)) * ((m + 1) * F.kurtosis(c).over(w) + 6)

    table = {
        "count": lambda w: n.over(w),
        "sum": lambda w: F.sum(c).over(w),
        "mean": lambda w: F.avg(c).over(w),
        "min": lambda w: F.min(c).over(w),
        "max": lambda w: F.max(c).over(w),
        "var": at_least(2, lambda w: F.var_samp(c).over(w)),
        "std": at_least(2, lambda w: F.stddev_samp(c).over(w)),
        # Divided by n - 1 under the root: the fixed form of this statistic for frames.
        "sem": at_least(2, lambda w: F.stddev_samp(c).over(w) / F.sqrt(n.over(w) - 1)),
        "skew": at_least(3, skew),
        "kurt": at_least(4, kurt),
        "median": lambda w: F.percentile(c, F.lit(0.5)).over(w),
        "quantile": lambda w: F.percentile(c, F.lit(q)).over(w),
        "rank": rank_now,
    }
    return table[fn]


def rolling(
    df: DataFrame,
    col: str,
    fn: str | Mapping[str, str],
    by: Sequence[str],
    order: Sequence[str],
    rows: int | None = None,
    period: str | None = None,
    min_periods: int | None = None,
    forward: bool = False,
    q: float = 0.5,
    out: str | None = None,
    **kw,
) -> DataFrame:
    """A statistic, or several as ``{out: fn}``, over the last ``rows`` rows or ``period`` of time.

    Fewer than ``min_periods`` values (default: ``rows``, or 1 for a period) give NULL. A period,
    written as an interval such as ``1 hour``, covers (here - period, here]; rows with equal times
    see each other. ``forward`` looks at this row and those after it.
    """
    fns = {out or f"rolling_{fn}": fn} if isinstance(fn, str) else dict(fn)

    def exprs(w: Window) -> dict[str, Column]:
        columns = {}
        for name, f in fns.items():
            # A count is asked of rows, anything else of values.
            least = min_periods if min_periods is not None else (0 if f == "count" else rows or 1)
            seen = F.count(F.lit(1)) if f == "count" else F.count(col)
            columns[name] = F.when(seen.over(w) >= least, frame_statistic(f, col, q)(w))
        return columns

    if rows is not None:
        runs = Runs(df, by, order, **kw)
        if forward:
            return runs.reversed().rolling(rows, [col], exprs).rows()
        return runs.rolling(rows, [col], exprs).rows()
    if forward:
        raise ValueError("forward needs rows")
    time = order[0]
    width = int(pd.Timedelta(period).total_seconds() * 1_000_000)
    later = F.col(time) + F.make_dt_interval(secs=F.lit(width / 1_000_000))
    if not fits(df, col, fns):
        # Medians and quantiles are not put together from parts: rows go to every run within the period.
        return Runs(df, by, [time], **kw).rolling_range(width, micros(df, time), [col], exprs, later).rows()
    kw.setdefault("rows_per_run", min(runs_module.ROWS_PER_RUN, 1_000_000))
    # Rows with equal times have equal windows and stay together.
    runs = Runs(df, by, [time], **kw)
    plain = runs.with_df(runs.df.where(F.col(RUN).isNull()) if runs.split else runs.df)
    whole = plain.rolling_range(width, micros(df, time), [col], exprs, later, place=False)
    if not runs.split:
        return whole.rows()
    least = {name: min_periods if min_periods is not None else (0 if f == "count" else 1) for name, f in fns.items()}
    results = T.StructType([whole.df.schema[name] for name in fns])
    cut = sliding(runs, col, fns, width, micros(df, time), later, least, results)
    return runs.with_df(whole.df.unionByName(cut)).rows()


def micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970; a timestamp without zone counts as it reads."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        day = F.unix_date(c.cast("date")).cast("long") * 86_400
        second = F.hour(c) * 3600 + F.minute(c) * 60
        return (day + second) * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.unix_micros(c)


# -- expanding ---------------------------------------------------------------------------------


def _power_sums(n: Column, mean: Column, var: Column, skew: Column, kurt: Column, about: Column) -> list[Column]:
    """n and the sums of (x - about)^k, k = 1..4, from Spark's own stable moments."""
    n, d = n.cast("double"), mean - about
    m2 = var * n
    m3 = F.coalesce(skew, F.lit(0.0)) * var * F.sqrt(var) * n
    m4 = F.when(m2 > 0, (kurt + 3) * var * var * n).otherwise(0.0)
    return [
        n,
        n * d,
        m2 + n * d * d,
        m3 + 3 * d * m2 + n * d * d * d,
        m4 + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d,
    ]


def _statistic(fn: str, n: Column, s: list[Column], at: Column) -> Column:
    """Mean, var, std, sem, skew or kurt from n and sums of powers about ``at``."""
    n = F.when(n > 0, n)
    m = s[0] / n
    m2 = F.greatest(s[1] - n * m * m, F.lit(0.0))
    var = F.when(n >= 2, m2 / (n - 1))
    m3 = s[2] - 3 * m * s[1] + 2 * n * m * m * m
    m4 = s[3] - 4 * m * s[2] + 6 * m * m * s[1] - 3 * n * m * m * m * m
    p2 = m2 / n
    return {
        "mean": at + m,
        "var": var,
        "std": F.sqrt(var),
        "sem": F.sqrt(var / (n - 1)),
        "skew": F.when((n >= 3) & (p2 > 0), F.sqrt(n * (n - 1)) / (n - 2) * (m3 / n) / F.pow(p2, F.lit(1.5))),
        "kurt": F.when((n >= 4) & (p2 > 0), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * ((m4 / n) / (p2 * p2) - 3) + 6)),
    }[fn]


def expanding(
    df: DataFrame,
    col: str,
    fn: str | Mapping[str, str],
    by: Sequence[str],
    order: Sequence[str],
    other: str | None = None,
    q: float = 0.5,
    min_periods: int = 1,
    out: str | None = None,
    **kw,
) -> DataFrame:
    """A statistic, or several as ``{out: fn}``, over all rows of the group up to this one.

    Counts, sums, extremes and moments (and ``cov``/``corr`` with ``other``) merge across cut runs;
    median, quantile and rank go by run and bucket of values (see ``growing``).
    """
    fns = {out or f"expanding_{fn}": fn} if isinstance(fn, str) else dict(fn)
    runs = Runs(df, by, order, **kw)
    if any(f != "count" for f in fns.values()):
        runs = runs.cumulative(col, "count", "__n")
    enough = F.col("__n") >= min_periods
    moments = {name: f for name, f in fns.items() if f in ("mean", "var", "std", "sem", "skew", "kurt")}
    if moments:
        runs = _expanding_moments(runs, col, moments, min_periods)
    for name, f in fns.items():
        if f == "count":
            runs = runs.cumulative(col, "count", name).row_number("__at")
            runs = runs.with_df(runs.df.withColumn(name, F.when(F.col("__at") >= min_periods, F.col(name))).drop("__at"))
        elif f in ("sum", "min", "max"):
            runs = runs.cumulative(col, f, name, blank=False)
            runs = runs.with_df(runs.df.withColumn(name, F.when(enough, F.col(name))))
        elif f in ("cov", "corr"):
            runs = _expanding_pair(runs, col, other, f, min_periods, name)
    rows = runs.rows().drop("__n")
    kinds = {"median": ("quantile", 0.5), "quantile": ("quantile", q), "rank": ("rank", q)}
    ordered = {name: kinds[f] for name, f in fns.items() if f in kinds}
    if not ordered:
        return rows
    # These work on Arrow tables in Python workers, so runs are shorter.
    kw.setdefault("rows_per_run", min(runs_module.ROWS_PER_RUN, 1_000_000))
    return growing(rows, col, ordered, by, order, min_periods, **kw)


def _expanding_moments(runs: Runs, col: str, fns: Mapping[str, str], min_periods: int) -> Runs:
    x = F.col(col).cast("double")
    w = runs.so_far()
    plain = {name: F.when(F.col("__n") >= min_periods, frame_statistic(f, col)(w)) for name, f in fns.items()}
    if not runs.split:
        return runs.with_df(runs.df.withColumns(plain))
    names = [f"__s{i}" for i in range(5)]
    # Sums of powers are taken about a value near the data: the mean of the group's first run.
    parts = [F.count(x).alias("__a"), F.avg(x).alias("__x"), F.var_pop(x).alias("__b"), F.skewness(x).alias("__c"), F.kurtosis(x).alias("__d")]
    stats = runs._source([col]).where(F.col(RUN).isNotNull()).groupBy(*runs.by, RUN).agg(*parts)
    run_order = runs._run_order()
    first = F.first("__x", ignorenulls=True).over(run_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    stats = stats.withColumn("__about", first)
    sums = _power_sums(F.col("__a"), F.col("__x"), F.col("__b"), F.col("__c"), F.col("__d"), F.col("__about"))
    before = run_order.rowsBetween(Window.unboundedPreceding, -1)
    carry = stats.withColumns(dict(zip(names, sums))).select(
        *runs.by, RUN, "__about", *[F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(c) for c in names]
    )
    rows = runs.attach(runs.df.withColumns({f"__p{i}": c for i, c in enumerate(plain.values())}), carry)
    about = F.coalesce(F.col("__about"), F.lit(0.0))
    here = [F.count(x), F.avg(x), F.var_pop(x), F.skewness(x), F.kurtosis(x)]
    local = _power_sums(*[c.over(w) for c in here], about)
    rows = rows.withColumns({f"__l{i}": F.coalesce(c, F.lit(0.0)) for i, c in enumerate(local)})
    total = [F.col(f"__l{i}") + F.coalesce(F.col(f"__s{i}"), F.lit(0.0)) for i in range(5)]
    # A group that was not cut keeps Spark's own statistic.
    cut = {name: F.when(F.col("__n") >= min_periods, _statistic(f, total[0], total[1:], about)) for name, f in fns.items()}
    rows = rows.withColumns({name: F.when(F.col(RUN).isNull(), F.col(f"__p{i}")).otherwise(c) for i, (name, c) in enumerate(cut.items())})
    return runs.with_df(rows.drop("__about", *names, *[f"__l{i}" for i in range(5)], *[f"__p{i}" for i in range(len(fns))]))


def _expanding_pair(runs: Runs, a: str, b: str, fn: str, min_periods: int, out: str) -> Runs:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    w = runs.so_far()
    here = [F.count(x), F.avg(x), F.avg(y), F.var_pop(x), F.var_pop(y), F.covar_pop(x, y)]
    if not runs.split:
        n = F.count(x).over(w)
        spread = F.sqrt(F.var_pop(x).over(w) * F.var_pop(y).over(w))
        stat = F.covar_samp(x, y).over(w) if fn == "cov" else F.try_divide(F.covar_pop(x, y).over(w), spread)
        return runs.with_df(runs.df.withColumn(out, F.when((n >= min_periods) & (n >= 2), stat)))
    # n and sums about the means of the group's first run: x, y, xx, yy, xy.
    columns = ["__n0", "__mx", "__my", "__vx", "__vy", "__vxy"]
    stats = runs._source([a, b]).where(F.col(RUN).isNotNull()).groupBy(*runs.by, RUN).agg(*[c.alias(n) for c, n in zip(here, columns)])
    order = runs._run_order()
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stats = stats.withColumns({f"__a{c}": F.first(f"__m{c}", ignorenulls=True).over(whole) for c in "xy"})
    names = [f"__t{i}" for i in range(6)]

    def sums(n: Column, mx: Column, my: Column, vx: Column, vy: Column, vxy: Column) -> list[Column]:
        n, dx, dy = n.cast("double"), mx - F.col("__ax"), my - F.col("__ay")
        parts = [n, n * dx, n * dy, n * (vx + dx * dx), n * (vy + dy * dy), n * (vxy + dx * dy)]
        return [F.coalesce(p, F.lit(0.0)) for p in parts]

    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumns(dict(zip(names, sums(*[F.col(c) for c in columns]))))
    carry = stats.select(*runs.by, RUN, "__ax", "__ay", *[F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(c) for c in names])
    rows = runs.attach(runs.df, carry).withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("__ax", "__ay", *names)})
    local = sums(*[c.over(w) for c in here])
    rows = rows.withColumns({f"__q{i}": F.col(c) + part for i, (c, part) in enumerate(zip(names, local))})
    n, sx, sy, sxx, syy, sxy = [F.col(f"__q{i}") for i in range(6)]
    cxy, cxx, cyy = sxy - sx * sy / n, sxx - sx * sx / n, syy - sy * sy / n
    stat = cxy / (n - 1) if fn == "cov" else F.when((cxx > 0) & (cyy > 0), cxy / F.sqrt(cxx * cyy))
    rows = rows.withColumn(out, F.when((n >= min_periods) & (n >= 2), stat))
    return runs.with_df(rows.drop("__ax", "__ay", *names, *[f"__q{i}" for i in range(6)]))


# -- weighted and exponential --------------------------------------------------------------------


def weighted(
    df: DataFrame, col: str, weights: Sequence[float], by: Sequence[str], order: Sequence[str], fn: str = "mean", out: str | None = None, **kw
) -> DataFrame:
    """Sum, mean or variance with fixed weights over the last ``len(weights)`` rows.

    Windows that are not full are NULL, as are those with a NULL in them.
    """
    out = out or f"weighted_{fn}"
    size = len(weights)
    w_sum = float(sum(weights))

    def exprs(w: Window) -> dict[str, Column]:
        values = F.collect_list(F.col(col)).over(w)
        ws = F.array(*[F.lit(float(v)) for v in weights])
        zero = F.lit(0.0)

        def total(term: Callable[[Column, Column], Column]) -> Column:
            return F.aggregate(F.zip_with(values, ws, term), zero, lambda a, b: a + b)

        s = total(lambda v, u: v * u)
        if fn == "sum":
            stat = s
        elif fn == "mean":
            stat = s / w_sum
        else:
            stat = total(lambda v, u: u * (v - s / w_sum) * (v - s / w_sum)) * size / ((size - 1) * w_sum)
        return {out: F.when(F.size(values) == size, stat)}

    return Runs(df, by, order, **kw).rolling(size, [col], exprs).rows()


def ewm(
    df: DataFrame, col: str, alpha: float, by: Sequence[str], order: Sequence[str], adjust: bool = True, out: str = "ewm", fn: str = "mean",
    other: str | None = None, ignore_na: bool = False, bias: bool = False, min_periods: int = 0, **kw,
) -> DataFrame:
    """Exponentially weighted mean, variance, standard deviation, or covariance and correlation with ``other``.

    A NULL value repeats the result and ages the weights, or does not with ``ignore_na``. See ``decay.exponential``.
    """
    # A run is one Arrow table in a Python worker, so runs are shorter here.
    kw.setdefault("rows_per_run", min(runs_module.ROWS_PER_RUN, 1_000_000))
    return exponential(df, col, alpha, by, order, fn, other, adjust, ignore_na, bias, min_periods, out, **kw)
