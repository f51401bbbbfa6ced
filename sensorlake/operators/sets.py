"""Order, limits, samples, unions and duplicates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from sensorlake.operators.aggregates import on_keys
from sensorlake.operators.runs import Runs
from sensorlake.session import pin

Keys = Sequence[str | tuple[str, str]]


def sort_columns(df: DataFrame, keys: Keys, nulls: str = "last") -> list[Column]:
    """Sort expressions; NaN stands with the NULLs, and equals them, whichever way a key runs."""
    out = []
    for key in keys:
        name, way = (key, "asc") if isinstance(key, str) else key
        c = present(df, name)
        if nulls == "last":
            out.append(c.asc_nulls_last() if way == "asc" else c.desc_nulls_last())
        else:
            out.append(c.asc_nulls_first() if way == "asc" else c.desc_nulls_first())
    return out


def present(df: DataFrame, name: str) -> Column:
    """The column, NULL where it is NaN."""
    floats = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return F.when(~F.isnan(name), F.col(name)) if floats else F.col(name)


def sort(df: DataFrame, keys: Keys, nulls: str = "last") -> DataFrame:
    """Whole-table order by several keys (C82): range partitions, sorted with spill."""
    return df.orderBy(*sort_columns(df, keys, nulls))


# So many rows one task may put in order; beyond that the k-th row is found by sampled ranks.
ONE_TASK = 100_000
SAMPLE = 20_000


def top_k(df: DataFrame, k: int, keys: Keys, by: Sequence[str] = (), ties: str = "first", one_task: int = ONE_TASK) -> DataFrame:
    """The first ``k`` rows in key order, overall or per group.

    ``ties="all"`` keeps every row equal to the last one kept. A bound on the rank lets each task
    drop all but its own best rows before the shuffle; for a ``k`` above ``one_task`` see ``smallest``.
    """
    order = sort_columns(df, keys)
    if not by:
        large = k > one_task
        last = smallest(df, k, keys, one_task) if large else df.orderBy(*order).limit(k)
        if ties == "first":
            return last.orderBy(*order) if large else last
        names = [key if isinstance(key, str) else key[0] for key in keys]
        # The last of the k rows; every row not after it stays.
        flipped = [(key, "desc") if isinstance(key, str) else (key[0], "asc" if key[1] == "desc" else "desc") for key in keys]
        edge = last.orderBy(*sort_columns(last, flipped, "first")).limit(1).select(F.struct(*[present(last, n).alias(n) for n in names]).alias("__edge"))
        return df.join(F.broadcast(edge), _not_after(df, keys), "left_semi")
    window = Window.partitionBy(*by).orderBy(*order)
    place = F.rank() if ties == "all" else F.row_number()
    return df.withColumn("__place", place.over(window)).where(F.col("__place") <= k).drop("__place")


def smallest(df: DataFrame, k: int, keys: Keys, one_task: int = ONE_TASK) -> DataFrame:
    """The first ``k`` rows in key order, in no order, for any ``k``.

    The k-th key is found first, then the rows up to it are one filter. Ranks in a sample of bounded size give two keys between which
    the k-th lies; one scan counts the rows up to each, and the same is done with the keys between, which are kept: few of them, and
    fewer each time, until one task can put them in order. No task holds ``k`` rows, and the keys are worked out once per row and scan.
    Rows with equal keys are told apart by a hash of the whole row; of rows that are equal in full any may stand for the others.
    """
    hashed = df.withColumn("__tie", F.xxhash64(*df.columns))
    ways = [key if isinstance(key, tuple) else (key, "asc") for key in [*keys, "__tie"]]
    rows = df.count()
    if k >= rows:
        return df
    if rows <= one_task:
        return hashed.orderBy(*sort_columns(hashed, ways)).limit(k).drop("__tie")
    fields = [present(hashed, name).alias(f"k{i}") for i, (name, _) in enumerate(ways)]
    # A row made by a generator is not worked out again for every use of its fields.
    keyed = hashed.withColumn("__key", F.explode(F.array(F.struct(*fields)))).drop("__tie")
    edge, n_before, n_equal = _kth(keyed.select("__key"), k, [way for _, way in ways], one_task, rows)
    before, equal = edge
    if n_before + n_equal == k:
        return keyed.where(before | equal).drop("__key")
    return keyed.where(before).unionByName(keyed.where(equal).limit(k - n_before)).drop("__key")


def _kth(points: DataFrame, k: int, ways: Sequence[str], one_task: int, rows: int) -> tuple[tuple[Column, Column], int, int]:
    """Conditions for keys before the k-th and equal to it, and how many rows meet each."""
    key, types = F.col("__key"), points.schema["__key"].dataType
    order = [key[f"k{i}"].asc_nulls_last() if way == "asc" else key[f"k{i}"].desc_nulls_last() for i, way in enumerate(ways)]

    def sides(edge: Row) -> tuple[Column, Column]:
        before, equal = F.lit(False), F.lit(True)
        for i, way in reversed(list(enumerate(ways))):
            mine, there = key[f"k{i}"], F.lit(edge[i]).cast(types[i].dataType)
            ahead = (mine < there) if way == "asc" else (mine > there)
            ahead = F.coalesce(ahead, F.lit(False)) | (mine.isNotNull() & there.isNull())
            same = mine.eqNullSafe(there)
            before, equal = ahead | (same & before), same & equal
        return before, equal

    passed, sure = 0, False
    while True:
        # What one task may order is ordered; the rank is then exact.
        whole = sure or rows <= max(one_task, SAMPLE)
        rate = 1.0 if whole else SAMPLE / rows
        middle, spread = rate * k, 4 * math.sqrt(rate * k) + 4
        places = [k] if whole else [math.floor(middle - spread), math.ceil(middle + spread)]
        drawn = points if whole else points.sample(rate, seed=3)
        ranked = drawn.withColumn("__n", F.row_number().over(Window.orderBy(*order))).where(F.col("__n").isin(places)).orderBy("__n").collect()
        sure = not ranked
        if sure:
            continue
        edges = [sides(r["__key"]) for r in ranked]
        counts = points.agg(*[F.count_if(c) for edge in edges for c in edge]).first()
        low, n_low, high, n_high = None, 0, None, rows
        for edge, n_before, n_equal in zip(edges, counts[::2], counts[1::2]):
            if n_before < k <= n_before + n_equal:
                return edge, passed + n_before, n_equal
            if k <= n_before:
                if high is None:
                    high, n_high = edge, n_before
            else:
                low, n_low = edge, n_before + n_equal
        # The edges themselves are out, so there are fewer rows each time.
        between = points if low is None else points.where(~(low[0] | low[1]))
        between = between if high is None else between.where(high[0])
        points, rows, k, passed = pin(between), n_high - n_low, k - n_low, passed + n_low


def _not_after(df: DataFrame, keys: Keys, edge_row: Column | None = None) -> Column:
    cond: Column | None = None
    for key in reversed(list(keys)):
        name, way = (key, "asc") if isinstance(key, str) else key
        mine, edge = present(df, name), (F.col("__edge") if edge_row is None else edge_row)[name]
        before = (mine < edge) if way == "asc" else (mine > edge)
        before = before | (mine.isNotNull() & edge.isNull())
        equal = mine.eqNullSafe(edge)
        cond = (F.coalesce(before, F.lit(False)) | equal) if cond is None else F.coalesce(before, F.lit(False)) | (equal & cond)
    return cond


def head(df: DataFrame, n: int, order: Keys) -> DataFrame:
    """First rows in a stated order."""
    return top_k(df, n, order)


def tail(df: DataFrame, n: int, order: Keys) -> DataFrame:
    """Last rows in a stated order."""
    back = [(k, "desc") if isinstance(k, str) else (k[0], "asc" if k[1] == "desc" else "desc") for k in order]
    return top_k(df, n, back)


def sample(
    df: DataFrame, fraction: float | None = None, n: int | None = None, weights: str | None = None, seed: int = 0, key: Sequence[str] = (),
    one_task: int = ONE_TASK,
) -> DataFrame:
    """Random rows (C86): a fraction, or exactly ``n``, by weight if given (zero weight: never).

    With ``key``, columns that tell rows apart, the draw of a row depends on them and on the seed only: the same rows are
    drawn however the table is laid out.
    """
    if (fraction is None) == (n is None):
        raise ValueError("give fraction or n")
    if fraction is not None and weights is None and not key:
        return df.sample(fraction=fraction, seed=seed)
    draw = uniform(key, seed) if key else 1 - F.rand(seed)
    if weights is not None:
        # Smallest exponential waiting times, a row's rate being its weight.
        df = df.where(F.col(weights) > 0)
        draw = -F.log(draw) / F.col(weights)
    if n is None:
        n = round(fraction * df.count())
    drawn = df.withColumn("__draw", draw)
    if n > one_task and not key:
        drawn = pin(drawn)  # several scans must see the same draws
    return top_k(drawn, n, ["__draw"], one_task=one_task).drop("__draw")


def uniform(key: Sequence[str], seed: int) -> Column:
    """A number in (0, 1) from 52 bits of a digest of the seed and the key."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    return (F.conv(F.substr(digest, F.lit(1), F.lit(13)), 16, 10).cast("double") + 0.5) / float(1 << 52)


def random_column(df: DataFrame, name: str = "random", seed: int = 0) -> DataFrame:
    """Uniform numbers in [0, 1)."""
    return df.withColumn(name, F.rand(seed))


def concat(dfs: Sequence[DataFrame], join: str = "outer") -> DataFrame:
    """Rows of all tables by column name; missing ones NULL, or only the common ones."""
    if join == "inner":
        common = [c for c in dfs[0].columns if all(c in d.columns for d in dfs)]
        dfs = [d.select(*common) for d in dfs]
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def dedup(df: DataFrame, subset: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per ``subset``: the first or last by ``order``, or only rows without a double (C89).

    The survivor is an aggregate, so copies are combined before the shuffle however many there are.
    """
    rows = df.withColumns({"__row": F.struct(*df.columns), "__at": F.struct(*order)})
    pick = F.max_by("__row", "__at") if keep == "last" else F.min_by("__row", "__at")
    out = rows.groupBy(*subset).agg(pick.alias("__row"), F.count(F.lit(1)).alias("__n"))
    if keep == "none":
        out = out.where(F.col("__n") == 1)
    return out.select("__row.*")


def duplicated(df: DataFrame, subset: Sequence[str], order: Sequence[str], keep: str = "first", out: str = "duplicated", **kw) -> DataFrame:
    """Whether a row repeats one that is kept (C89)."""
    if keep == "none":
        counts = df.groupBy(*subset).agg(F.count(F.lit(1)).alias("__n"))
        return on_keys(df, counts, subset).withColumn(out, F.col("__n") > 1).drop("__n")
    runs = Runs(df, subset, order, descending=keep == "last", **kw).row_number("__n")
    return runs.rows().withColumn(out, F.col("__n") > 1).drop("__n")
