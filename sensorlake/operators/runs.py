"""Ordered groups that may be larger than a task.

A window over ``PARTITION BY key ORDER BY time`` puts each key in one task. That holds until one
key has a third of the rows. ``Runs`` finds such keys and cuts them, along their own order, into
consecutive runs of about ``rows_per_run / 4`` rows. Windows then work inside (key, run), and what
a run needs from the runs before it is a small carry: one summary row per run, combined before it
is shuffled, or the last few rows of a run.

Where no key is that large, nothing is cut and the plan is the plain window.

The cut points come from a sample. They are pinned: all passes over the data must agree on them, as
must a task that is run again after its executor is lost. They only steer balance; results do not
depend on where the cuts fall.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorlake.session import pin

RUN = "__run"
EDGES = "__edges"
ROWS_PER_RUN = 4_000_000
SAMPLES_PER_RUN = 256
# Carries have one row per run, at most 4 * rows / ROWS_PER_RUN in all; beyond this many they are
# joined by a shuffle.
BROADCAST_RUNS = 1_000_000


def same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right):
        cond = cond & a.eqNullSafe(b)
    return cond


class Runs:
    """The rows of ``df`` grouped by ``by`` and totally ordered by ``order`` inside a group.

    Methods add a column and return new ``Runs``; ``df`` (or ``rows()`` without the run number)
    gives the rows. ``rows_per_run`` defaults to ``ROWS_PER_RUN``; 0 says that no group is too large
    and saves the check, which reads the ``by`` columns once. Where the rows are costly to make,
    ``within`` is a table that has at least as many rows in every group and is looked at first.
    """

    def __init__(
        self,
        df: DataFrame,
        by: Sequence[str],
        order: Sequence[str],
        rows_per_run: int | None = None,
        descending: bool = False,
        within: DataFrame | None = None,
    ):
        self.order = list(order)
        self.descending = descending
        self.grouped = bool(by)
        if not by:
            df = df.withColumn("__all", F.lit(0))
        self.by = list(by) or ["__all"]
        rows_per_run = ROWS_PER_RUN if rows_per_run is None else rows_per_run
        if rows_per_run and within is not None and by and self._large(within, rows_per_run).isEmpty():
            rows_per_run = 0
        self.rows_per_run = rows_per_run
        self.edges = self._find_edges(df, rows_per_run) if rows_per_run else None
        self.df = self._place(df) if self.split else df.withColumn(RUN, F.lit(None).cast("int"))
        # Carries are worked out from here, so that a chain of methods does not nest them.
        self.base = self.df

    @property
    def split(self) -> bool:
        return self.edges is not None

    def with_df(self, df: DataFrame, base: DataFrame | None = None) -> Runs:
        """The same runs over ``df``, which has the same rows and runs."""
        out = object.__new__(Runs)
        out.__dict__.update(self.__dict__)
        out.df, out.base = df, base or self.base
        return out

    def reversed(self) -> Runs:
        """The same runs, read from the other end."""
        out = self.with_df(self.df)
        out.descending = not self.descending
        return out

    def rows(self) -> DataFrame:
        return self.df.drop(RUN, "__all")

    # -- cutting ---------------------------------------------------------------------------------

    def _point(self) -> Column:
        return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(self.order)])

    def _large(self, df: DataFrame, rows_per_run: int) -> DataFrame:
        return df.groupBy(*self.by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_run)

    def _find_edges(self, df: DataFrame, rows_per_run: int) -> DataFrame | None:
        large = self._large(df, rows_per_run)
        if large.isEmpty():
            return None
        rate = min(1.0, SAMPLES_PER_RUN / rows_per_run)
        stride = max(1, round(rate * rows_per_run / 4))
        keys = large.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(self.by)])
        # At most rows / rows_per_run keys are this large.
        cond = same([F.col(c) for c in self.by], [F.col(f"__k{i}") for i in range(len(self.by))])
        sampled = df.select(*self.by, self._point().alias("p"))
        if rate < 1:
            sampled = sampled.sample(rate, seed=7)
        sampled = sampled.join(F.broadcast(keys), cond, "left_semi")
        nth = F.row_number().over(Window.partitionBy(*self.by).orderBy("p"))
        cuts = sampled.withColumn("nth", nth).where(F.col("nth") % stride == 0)
        edges = cuts.groupBy(*self.by).agg(F.sort_array(F.collect_set("p")).alias(EDGES))
        edges = pin(edges)
        self.n_runs, longest = edges.agg(F.coalesce(F.sum(F.size(EDGES) + 1), F.lit(0)), F.max(F.size(EDGES))).first()
        self.steps = [1 << i for i in reversed(range((longest or 0).bit_length()))]
        return edges.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(self.by)], EDGES) if self.n_runs else None

    def _small(self, df: DataFrame, items: int = 1) -> DataFrame:
        """To be broadcast if its ``items`` per run are few in all."""
        return F.broadcast(df) if self.n_runs * items <= BROADCAST_RUNS else df

    def _search(self, passed: Callable[[Column], Column]) -> Column:
        """How many edges are ``passed``, by bisection."""

        def step(i: Column, s: Column) -> Column:
            return F.when(passed(F.get(F.col(EDGES), i + s - 1)), i + s).otherwise(i)

        return F.aggregate(F.array(*[F.lit(s) for s in self.steps]), F.lit(0), step)

    def _place(self, df: DataFrame, **extra: Column) -> DataFrame:
        keys = [f"__k{i}" for i in range(len(self.by))]
        cond = same([F.col(c) for c in self.by], [F.col(k) for k in keys])
        joined = df.join(self._small(self.edges), cond, "left")
        found = {RUN: self._search(lambda edge: edge <= self._point()), **extra}
        return joined.withColumns({n: F.when(F.col(EDGES).isNotNull(), c) for n, c in found.items()}).drop(EDGES, *keys)

    # -- building blocks -------------------------------------------------------------------------

    def sort(self) -> list[Column]:
        return [F.col(c).desc_nulls_last() if self.descending else F.col(c).asc_nulls_first() for c in self.order]

    def window(self) -> Window:
        keys = [*self.by, RUN] if self.split else self.by
        return Window.partitionBy(*keys).orderBy(*self.sort())

    def so_far(self) -> Window:
        return self.window().rowsBetween(Window.unboundedPreceding, 0)

    def _run_order(self) -> Window:
        run = F.col(RUN).desc() if self.descending else F.col(RUN).asc()
        return Window.partitionBy(*self.by).orderBy(run)

    def _source(self, columns: Sequence[str]) -> DataFrame:
        """Rows in runs with these columns, from as early as they are there."""
        return self.base if set(columns) <= set(self.base.columns) else self.df

    def carry(self, columns: Sequence[str], aggs: dict[str, Column], folds: dict[str, Callable[[Window], Column]]) -> DataFrame:
        """Summarise ``columns`` of each run by ``aggs``, then fold the summaries of the runs before it."""
        summary = self._source(columns).where(F.col(RUN).isNotNull()).groupBy(*self.by, RUN)
        summary = summary.agg(*[c.alias(n) for n, c in aggs.items()])
        before = self._run_order().rowsBetween(Window.unboundedPreceding, -1)
        return summary.select(*self.by, RUN, *[fold(before).alias(n) for n, fold in folds.items()])

    def attach(self, df: DataFrame, carry: DataFrame, items: int = 1) -> DataFrame:
        keys = [*self.by, RUN]
        renamed = carry.withColumnsRenamed({k: f"__c{i}" for i, k in enumerate(keys)})
        cond = same([F.col(c) for c in self.by], [F.col(f"__c{i}") for i in range(len(self.by))])
        cond = cond & (F.col(RUN) == F.col(f"__c{len(self.by)}"))
        return df.join(self._small(renamed, items), cond, "left").drop(*[f"__c{i}" for i in range(len(keys))])

    def _reach(self, n: int) -> int:
        """How many runs back hold the last ``n`` rows, at most."""
        if n <= 64:
            return n  # every run has a row
        sizes = self.base.where(F.col(RUN).isNotNull()).groupBy(*self.by, RUN).agg(F.count(F.lit(1)).alias("__n"))
        ends = sizes.withColumn("__end", F.sum("__n").over(self._run_order().rowsBetween(Window.unboundedPreceding, 0)))
        near = Window.partitionBy(*self.by).orderBy("__end").rangeBetween(1 - n, 0)
        return ends.select(F.count(F.lit(1)).over(near).alias("runs")).agg(F.max("runs")).first()[0]

    def before(self, n: int, columns: Sequence[str]) -> DataFrame:
        """(by, run, ``__prev``): the last ``n`` rows before each run, oldest first."""
        from_end = F.row_number().over(self.reversed().window())
        ends = self._source(columns).where(F.col(RUN).isNotNull()).withColumn("__end", from_end).where(F.col("__end") <= n)
        item = F.struct((-F.col("__end")).alias("__at"), *columns)
        tails = ends.groupBy(*self.by, RUN).agg(F.sort_array(F.collect_list(item)).alias("__tail"))
        gathered = F.flatten(F.collect_list("__tail").over(self._run_order().rowsBetween(-self._reach(n), -1)))
        start = F.greatest(F.size(gathered) - n + 1, F.lit(1))
        return tails.select(*self.by, RUN, F.slice(gathered, start, F.lit(n)).alias("__prev"))

    def with_lead_in(self, n: int, columns: Sequence[str]) -> DataFrame:
        """Rows plus, marked ``__extra``, a copy of the ``n`` rows before each run."""
        own = self.df.withColumn("__extra", F.lit(False))
        if not self.split:
            return own
        columns = list(dict.fromkeys([*self.order, *columns]))
        lead = self.before(n, columns).select(*self.by, RUN, F.explode("__prev").alias("__p"))
        lead = lead.select(*self.by, RUN, *[F.col(f"__p.{c}").alias(c) for c in columns if c not in self.by], F.lit(True).alias("__extra"))
        return own.unionByName(lead, allowMissingColumns=True)

    # -- columns ---------------------------------------------------------------------------------

    def _scan(self, columns: Sequence[str], out: str, local: Column, aggs: dict, folds: dict, combine: Callable[[Column], Column]) -> Runs:
        """A column from the run itself and, where runs were cut, the carry before it."""
        df, base = self.df.withColumn(out, local), self._without(out)
        if self.split:
            df = self.attach(df, self.carry(columns, aggs, folds)).withColumn(out, combine(F.col(out))).drop(*folds)
        return self.with_df(df, base)

    def _without(self, out: str) -> DataFrame:
        """The base, less a column that gets new values."""
        return self.base.drop(out)

    def row_number(self, out: str) -> Runs:
        return self._scan(
            [],
            out,
            F.row_number().over(self.window()).cast("long"),
            {"__n": F.count(F.lit(1))},
            {"__cn": lambda w: F.sum("__n").over(w)},
            lambda c: c + F.coalesce(F.col("__cn"), F.lit(0)),
        )

    def cumulative(self, col: str, fn: str, out: str, blank: bool = True) -> Runs:
        """Running sum, product, min, max or count. Where the value is NULL so is the result (but
        for a count), or, without ``blank``, what there is so far."""
        if out == col:
            raise ValueError(f"{out} is the column to accumulate")
        kinds = {
            "sum": (F.sum, F.sum, lambda a, b: F.coalesce(a + b, a, b)),
            "product": (F.product, F.product, lambda a, b: F.coalesce(a * b, a, b)),
            "min": (F.min, F.min, F.least),
            "max": (F.max, F.max, F.greatest),
            "count": (F.count, F.sum, lambda a, b: F.coalesce(a + b, a, b)),
        }
        agg, fold, merge = kinds[fn]
        done = self._scan(
            [col],
            out,
            agg(F.col(col)).over(self.so_far()),
            {"__v": agg(F.col(col))},
            {"__cv": lambda w: fold(F.col("__v")).over(w)},
            lambda c: merge(F.col("__cv"), c),
        )
        if fn == "count" or not blank:
            return done
        return done.with_df(done.df.withColumn(out, F.when(F.col(col).isNotNull(), F.col(out))))

    def total(self, agg: Column, columns: Sequence[str], out: str) -> Runs:
        """A sum or count over the whole group, on every row; ``columns`` are those it reads."""
        keys = [*self.by, RUN] if self.split else self.by
        df = self.df.withColumn(out, agg.over(Window.partitionBy(*keys)))
        if self.split:
            parts = self._source(columns).where(F.col(RUN).isNotNull()).groupBy(*self.by, RUN).agg(agg.alias("__part"))
            whole = F.sum("__part").over(Window.partitionBy(*self.by)).alias("__whole")
            df = self.attach(df, parts.select(*self.by, RUN, whole))
            df = df.withColumn(out, F.coalesce(F.col("__whole"), F.col(out))).drop("__whole")
        return self.with_df(df, self._without(out))

    def shift(self, col: str, n: int, out: str) -> Runs:
        """The value ``n`` rows back (``n`` < 0: ahead)."""
        if n < 0:
            return self.reversed().shift(col, -n, out).reversed()
        base = self._without(out)
        if n == 0:
            return self.with_df(self.df.withColumn(out, F.col(col)), base)
        local = F.lag(col, n).over(self.window())
        if not self.split:
            return self.with_df(self.df.withColumn(out, local), base)
        df = self.df.withColumn(out, local).withColumn("__at", F.row_number().over(self.window()))
        df = self.attach(df, self.before(n, [col]), items=n)
        back = F.size("__prev") - (n + 1 - F.col("__at"))
        earlier = F.when(back >= 0, F.get(F.col("__prev"), back)[col])
        df = df.withColumn(out, F.when((F.col("__at") <= n) & F.col("__prev").isNotNull(), earlier).otherwise(F.col(out)))
        return self.with_df(df.drop("__at", "__prev"), base)

    def fill(self, col: str, out: str, backward: bool = False) -> Runs:
        """The last value that is not NULL, up to this row (``backward``: the next)."""
        if backward:
            return self.reversed().fill(col, out).reversed()
        pick = F.min_by if self.descending else F.max_by
        return self._scan(
            [col],
            out,
            F.last(col, ignorenulls=True).over(self.so_far()),
            {"__v": pick(F.col(col), F.when(F.col(col).isNotNull(), self._point()))},
            {"__cv": lambda w: F.last("__v", ignorenulls=True).over(w)},
            lambda c: F.coalesce(c, F.col("__cv")),
        )

    def rolling(self, rows: int, columns: Sequence[str], exprs: Callable[[Window], dict[str, Column]]) -> Runs:
        """Window expressions over the last ``rows`` rows, this one included."""
        df = self.with_lead_in(rows - 1, columns) if rows > 1 else self.df.withColumn("__extra", F.lit(False))
        df = df.withColumns(exprs(self.window().rowsBetween(-(rows - 1), 0)))
        return self.with_df(df.where(~F.col("__extra")).drop("__extra"))

    def rolling_range(
        self, width: int, position: Column, columns: Sequence[str], exprs: Callable[[Window], dict[str, Column]], later: Column, place: bool = True
    ) -> Runs:
        """Window expressions over rows whose ``position`` is in (here - width, here].

        ``later`` is the first order column moved on by ``width``. A row of a cut group is also
        given to the runs that begin within ``width`` after it; without ``place`` no group is cut.
        """
        df = self.df.withColumn("__pos", position)
        if self.split and place:
            ahead = self._search(lambda edge: edge["o0"] <= later)
            df = self._place(df, __to=ahead)
            df = df.withColumn("__own", F.col(RUN))
            df = df.withColumn(RUN, F.explode_outer(F.sequence(F.col(RUN), F.greatest(F.col(RUN), F.col("__to")))))
            df = df.withColumn("__extra", ~F.col(RUN).eqNullSafe(F.col("__own"))).drop("__own", "__to")
        else:
            df = df.withColumn("__extra", F.lit(False))
        keys = [*self.by, RUN] if self.split else self.by
        frame = Window.partitionBy(*keys).orderBy("__pos").rangeBetween(-(width - 1), 0)
        df = df.withColumns(exprs(frame))
        return self.with_df(df.where(~F.col("__extra")).drop("__extra", "__pos"))
