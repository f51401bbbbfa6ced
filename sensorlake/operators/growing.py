"""Order statistics of a growing group: quantiles and ranks among the values up to each row.

A group that is not cut is one task's work. A cut group is worked out by run and by bucket of values:

* Values are put in buckets, at edges taken from a sample; every edge is a bucket of its own, so a value that very many rows
  share is never inside a range. A table counts the rows of each run by bucket.
* The counts, summed over the runs before, tell for every run in which buckets its quantiles can lie: those whose ranks a run of
  that length can reach. Only the values in these buckets, as many as the run has rows or a few more, are handed to
  the run, with the number of values below them. Values of single-value buckets travel as counts.
* A rank is the count in lower buckets, from the table, plus the smaller values of earlier runs in the same bucket, counted bucket
  by bucket, plus the smaller values earlier in the run.

So no task holds more than a run, a bucket or the table of counts. Results do not depend on the cuts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sensorlake.operators.runs import RUN, SAMPLES_PER_RUN, Runs, same
from sensorlake.session import pin

MAX_EDGES = 4096
# Of a sample of 64 values per run, every fourth is an edge.
STRIDE = 4
VALUE, BUCKET = "__x", "__bucket"


# -- inside a task ---------------------------------------------------------------------------------


def earlier_less(values: np.ndarray, groups: np.ndarray | None = None) -> np.ndarray:
    """For each place, how many earlier places hold a smaller value (with ``groups``, sorted: earlier groups only).

    Counted in halves, quarters and so on: of two neighbouring blocks, every element of the right one
    counts the smaller elements of the left one.
    """
    n = len(values)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    place = np.arange(n)
    if groups is not None:
        # Inside a group values fall, so nothing in it is smaller and earlier.
        inside = np.lexsort((-values, groups))
        back = np.empty(n, np.int64)
        back[inside] = place
        return earlier_less(values[inside])[back]
    # Ascending values; equal ones from the last place to the first, so that they are not counted.
    order = np.lexsort((-place, values))
    half = 1
    while half < n:
        by_block = order[np.argsort(order // (2 * half), kind="stable")]
        left = (by_block // half) % 2 == 0
        block = by_block // (2 * half)
        so_far = np.cumsum(left)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
        base = np.concatenate([[0], so_far])[starts]
        right = ~left
        which = np.searchsorted(starts, np.arange(n), side="right") - 1
        found[by_block[right]] += (so_far - base[which])[right]
        half *= 2
    return found


def earlier_equal(values: np.ndarray) -> np.ndarray:
    """For each place, how many earlier places hold the same value."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1]) if len(values) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(values)))
    found = np.empty(len(values), np.int64)
    found[order] = np.arange(len(values)) - np.repeat(starts, sizes)
    return found


def growing_quantile(values: np.ndarray, q: float, lead: np.ndarray, below: int, before: int, min_periods: int) -> np.ndarray:
    """The quantile of ``before`` values and those of ``values`` up to each place (NaN: none).

    ``lead`` holds the sorted earlier values of ranks ``below`` and up that can be asked for. All values are put in order at
    once and taken out again from the last: what is in the middle moves by a step at a time.
    """
    out = np.full(len(values), np.nan)
    present = np.flatnonzero(values == values)
    total = before + len(present)
    everything = np.concatenate([lead, values[present]])
    order = np.argsort(everything, kind="stable")
    ordered = everything[order].tolist()
    size = len(ordered)
    spots = np.empty(size, np.int64)
    spots[order] = np.arange(size)
    spots = spots[len(lead) :].tolist()
    following, previous = list(range(1, size + 1)), list(range(-1, size - 1))

    def low(n: int) -> int:
        return int(q * (n - 1))

    at = rank = low(total) - below if total else 0  # the element now at the lower rank
    number = np.cumsum(values == values).tolist()
    results = []
    for i in range(len(values) - 1, -1, -1):
        n = before + number[i]
        if n >= max(min_periods, 1):
            spot = q * (n - 1)
            value = ordered[at]
            if spot > int(spot):
                value += (ordered[following[at]] - value) * (spot - int(spot))
            results.append((i, value))
        if values[i] == values[i]:
            gone = spots[number[i] - 1]
            a, b = previous[gone], following[gone]
            if a >= 0:
                following[a] = b
            if b < size:
                previous[b] = a
            if gone == at:
                at = b
            elif gone < at:
                rank -= 1
            want = low(n - 1) - below if n > 1 else 0
            while rank > want:
                at, rank = (previous[at] if at < size else a), rank - 1
            while rank < want:
                at, rank = following[at], rank + 1
    if results:
        places, found = zip(*results)
        out[list(places)] = found
    return out


# -- over runs -------------------------------------------------------------------------------------


class Steps:
    """What tasks do, with none of the data frames: ``{out: (kind, q)}`` with kind ``quantile`` or ``rank``."""

    NOTES = "kind string, which int, bucket long, v double, a long, b long"

    def __init__(self, by: Sequence[str], order: Sequence[str], descending: bool, wanted: Mapping[str, tuple[str, float]], min_periods: int):
        self.by, self.order, self.descending = list(by), list(order), descending
        self.outs, self.min_periods = list(wanted), min_periods
        self.quantiles = [(out, q) for out, (kind, q) in wanted.items() if kind == "quantile"]
        self.ranks = [out for out, (kind, _) in wanted.items() if kind == "rank"]

    def _ordered(self, table: pa.Table, columns: Sequence[str]) -> pa.Table:
        keys = [(c, "descending" if self.descending else "ascending") for c in columns]
        return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_end" if self.descending else "at_start"))

    def _finish(self, table: pa.Table, found: dict[str, np.ndarray], columns: Sequence[str]) -> pa.Table:
        table = table.select(columns)
        for out in self.outs:
            table = table.append_column(out, pa.array(found[out], pa.float64(), from_pandas=True))
        return table

    def _rank(self, values: np.ndarray, less: np.ndarray, equal: np.ndarray, before: int) -> np.ndarray:
        """Average ranks, from what is smaller and equal in earlier runs and the values of this one."""
        out = np.full(len(values), np.nan)
        here = np.flatnonzero(values == values)
        v = values[here]
        out[here] = less[here] + earlier_less(v) + (equal[here] + earlier_equal(v) + 2) / 2
        enough = before + np.cumsum(values == values) >= max(self.min_periods, 1)
        return np.where(enough, out, np.nan)

    def whole(self, table: pa.Table) -> pa.Table:
        """A group that is not cut."""
        columns = table.column_names
        table = self._ordered(table, self.order)
        values = _numbers(table[VALUE])
        none = np.zeros(len(values))
        found = {out: growing_quantile(values, q, np.empty(0), 0, 0, self.min_periods) for out, q in self.quantiles}
        found |= {out: self._rank(values, none, none, 0) for out in self.ranks}
        return self._finish(table, found, columns)

    def plan(self, table: pa.Table) -> pa.Table:
        """What every run of a group needs to know of the runs before it.

        ``before``: how many values there were; ``less``: for a bucket of the run, those in lower buckets (a) and in it (b);
        ``rank``: for a quantile, the ranks needed (a, b) and how many values are below the first bucket sent (``bucket``);
        ``one``: a single-value bucket among them and its count; ``want``: buckets from ``bucket`` to ``reach`` to be sent.
        """
        table = self._ordered(table, [RUN])
        run, n, v = table[RUN].to_numpy(), table["n"].to_numpy(), _numbers(table["v"])
        bucket = table[BUCKET].fill_null(-1).to_numpy()
        keys = table.select(self.by).slice(0, 1)
        base = np.zeros(int(bucket.max()) + 1 if len(bucket) else 0, np.int64)
        single = np.full(len(base), np.nan)
        out: list[tuple] = []
        starts = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
        for start, stop in zip(starts, [*starts[1:], len(run)]):
            here = slice(start, stop)
            r, own, size = int(run[start]), bucket[here], n[here]
            some = own >= 0
            own, size = own[some], size[some]
            upto = np.cumsum(base)
            total = int(upto[-1]) if len(upto) else 0
            out.append((r, "before", 0, 0, 0.0, total, 0, 0))
            if self.ranks:
                for b in own.tolist():
                    out.append((r, "less", 0, b, 0.0, int(upto[b] - base[b]), int(base[b]), 0))
            m = int(size.sum())
            for which, (_, q) in enumerate(self.quantiles):
                if not total:
                    continue
                first = max(math.floor(q * (total - 1) - (1 - q) * m) - 1, 0)
                last = min(math.ceil(q * (total + m - 1)) + 2, total - 1)
                lo, hi = (int(np.searchsorted(upto, k, side="right")) for k in (first, last))
                out.append((r, "rank", which, int(upto[lo] - base[lo]), 0.0, first, last, 0))
                out.append((r, "want", which, lo, 0.0, 0, 0, hi))
                for b in range(lo | 1, hi + 1, 2):
                    if base[b]:
                        out.append((r, "one", which, b, float(single[b]), int(base[b]), 0, 0))
            base[own] += size
            ones = own % 2 == 1
            single[own[ones]] = v[here][some][ones]
        types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
        repeated = keys.take(pa.array(np.zeros(len(out), np.int64)))
        return pa.table([*repeated.columns, *columns], names=[*self.by, RUN, "kind", "which", "bucket", "v", "a", "b", "reach"])

    def in_bucket(self, table: pa.Table) -> pa.Table:
        """For values of one range, how many of earlier runs are smaller and equal."""
        sign = -1 if self.descending else 1
        bucket, n = table[BUCKET][0].as_py(), table.num_rows
        less = equal = np.zeros(n, np.int64)
        if bucket is not None and bucket % 2 == 0:
            values, run = _numbers(table[VALUE]), sign * table[RUN].to_numpy().astype(np.int64)
            less = earlier_less(values, run)
            # Equal values in earlier runs: those earlier in run order, less those of the same run.
            order = np.lexsort((run, values))
            v, r = values[order], run[order]
            fresh_value = np.concatenate([[True], v[1:] != v[:-1]])
            fresh_run = fresh_value | np.concatenate([[True], r[1:] != r[:-1]])
            first_of_value = np.maximum.accumulate(np.where(fresh_value, np.arange(n), 0))
            first_of_run = np.maximum.accumulate(np.where(fresh_run, np.arange(n), 0))
            equal = np.empty(n, np.int64)
            equal[order] = first_of_run - first_of_value
        return table.append_column("__less", pa.array(less)).append_column("__equal", pa.array(equal))

    def run(self, table: pa.Table, notes: pa.Table) -> pa.Table:
        """A run of a cut group, with the notes of the plan."""
        columns = [c for c in table.column_names if c not in (BUCKET, "__less", "__equal")]
        table = self._ordered(table, self.order)
        values = _numbers(table[VALUE])
        which, bucket, v, a, b = (_numbers(notes[c]) if c == "v" else notes[c].to_numpy() for c in ("which", "bucket", "v", "a", "b"))
        kind = np.array(notes["kind"].to_pylist(), object)
        before = int(a[kind == "before"][0]) if (kind == "before").any() else 0
        found = {}
        for i, (out, q) in enumerate(self.quantiles):
            mine = which == i
            head = np.flatnonzero(mine & (kind == "rank"))
            lead, below = np.empty(0), 0
            if len(head):
                below, first, last = int(bucket[head[0]]), int(a[head[0]]), int(b[head[0]])
                sent = mine & ((kind == "lead") | (kind == "one"))
                order = np.argsort(v[sent], kind="stable")
                ends = below + np.cumsum(a[sent][order])
                starts = np.concatenate([[below], ends[:-1]])
                # Of each value only the ranks that can be asked for.
                numbers = np.clip(ends, first, last + 1) - np.clip(starts, first, last + 1)
                lead, below = np.repeat(v[sent][order], numbers), first
            found[out] = growing_quantile(values, q, lead, below, before, self.min_periods)
        if self.ranks:
            less, equal = table["__less"].to_numpy().copy(), table["__equal"].to_numpy().copy()
            told = kind == "less"
            own = table[BUCKET].fill_null(-1).to_numpy()
            order = np.argsort(bucket[told])
            known, lower, inside = bucket[told][order], a[told][order], b[told][order]
            some = own >= 0
            at = np.searchsorted(known, own[some])
            less[some] += lower[at]
            equal[some] += np.where(own[some] % 2 == 1, inside[at], 0)
            for out in self.ranks:
                found[out] = self._rank(values, less, equal, before)
        return self._finish(table, found, columns)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Doubles, NaN where there is none."""
    return column.cast(pa.float64()).to_numpy()


# -- plans -------------------------------------------------------------------------------------------


def growing(df: DataFrame, col: str, wanted: Mapping[str, tuple[str, float]], by: Sequence[str], order: Sequence[str], min_periods: int = 1, **kw) -> DataFrame:
    """Adds ``{out: (kind, q)}``: ``quantile`` (interpolated) or ``rank`` (average) among the values of the group up to each row.

    NULL and NaN are no values: they have no rank, and quantiles pass them by.
    """
    runs = Runs(df, by, order, **kw)
    steps = Steps(runs.by, runs.order, runs.descending, wanted, min_periods)
    value = F.col(col).cast("double")
    rows = runs.df.withColumn(VALUE, F.when(~F.isnan(value), value))
    schema = T.StructType([*rows.schema, *[T.StructField(out, T.DoubleType()) for out in wanted]])

    def whole(part: DataFrame) -> DataFrame:
        return part.groupBy(*runs.by).applyInArrow(lambda t: steps.whole(t), schema)

    if not runs.split:
        return whole(rows).drop(RUN, VALUE, "__all")
    cut = _cut(rows.where(F.col(RUN).isNotNull()), runs, steps, schema)
    return whole(rows.where(F.col(RUN).isNull())).unionByName(cut).drop(RUN, VALUE, "__all")


def _cut(rows: DataFrame, runs: Runs, steps: Steps, schema: T.StructType) -> DataFrame:
    keys = [rows.schema[c] for c in (*runs.by, RUN)]
    rows = _bucketed(rows, runs, _edges(rows, runs))
    counts = rows.groupBy(*runs.by, RUN, BUCKET).agg(F.count(VALUE).alias("n"), F.min(VALUE).alias("v"))
    noted = T.StructType([*keys, *T.StructType.fromDDL(Steps.NOTES), T.StructField("reach", T.LongType())])
    plan = pin(counts.groupBy(*runs.by).applyInArrow(lambda t: steps.plan(t), noted))
    notes = plan.where("kind <> 'want'").drop("reach")
    if steps.quantiles:
        notes = notes.unionByName(_leads(rows, runs, plan, len(steps.quantiles)))
    if steps.ranks:
        rows = _rank_in_buckets(rows, runs, steps)
    by_run = [*runs.by, RUN]
    return rows.groupBy(*by_run).cogroup(notes.groupBy(*by_run)).applyInArrow(lambda t, notes: steps.run(t, notes), schema)


def _rank_in_buckets(rows: DataFrame, runs: Runs, steps: Steps) -> DataFrame:
    # Values that are a bucket of their own, and missing ones, need no look at other runs and stay apart by run.
    apart = F.when(F.col(BUCKET).isNull() | (F.col(BUCKET) % 2 == 1), F.col(RUN))
    keyed = rows.withColumn("__apart", apart)
    schema = T.StructType([*keyed.schema, T.StructField("__less", T.LongType()), T.StructField("__equal", T.LongType())])
    return keyed.groupBy(*runs.by, BUCKET, "__apart").applyInArrow(lambda t: steps.in_bucket(t), schema).drop("__apart")


def _edges(df: DataFrame, runs: Runs) -> DataFrame:
    """(by, __edges): sorted sample values of every cut group."""
    rate = min(1.0, SAMPLES_PER_RUN / max(runs.rows_per_run, 1))
    sampled = df.where(F.col(VALUE).isNotNull()).select(*runs.by, VALUE)
    if rate < 1:
        sampled = sampled.sample(rate, seed=11)
    by = Window.partitionBy(*runs.by)
    sampled = sampled.withColumns({"__nth": F.row_number().over(by.orderBy(VALUE)), "__of": F.count(F.lit(1)).over(by)})
    stride = F.greatest(F.lit(STRIDE), F.ceil(F.col("__of") / MAX_EDGES))
    edges = sampled.where(F.col("__nth") % stride == 0).groupBy(*runs.by).agg(F.sort_array(F.collect_set(VALUE)).alias("__edges"))
    return pin(edges)


def _bucketed(df: DataFrame, runs: Runs, edges: DataFrame) -> DataFrame:
    """Bucket 2k+1 is edge k alone, bucket 2k the values between the edges k-1 and k."""
    most = edges.agg(F.max(F.size("__edges"))).first()[0] or 0
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))]) if most else F.array().cast("array<int>")
    by = runs.by
    renamed = edges.withColumnsRenamed({k: f"__e{i}" for i, k in enumerate(by)})
    cond = same([F.col(k) for k in by], [F.col(f"__e{i}") for i in range(len(by))])
    joined = df.join(runs._small(renamed, 64 // STRIDE), cond, "left")
    passed = F.aggregate(steps, F.lit(0), lambda i, s: F.when(F.get(F.col("__edges"), i + s - 1) <= F.col(VALUE), i + s).otherwise(i))
    on = F.coalesce(F.get(F.col("__edges"), passed - 1) == F.col(VALUE), F.lit(False))
    bucket = F.when(F.col(VALUE).isNotNull(), 2 * passed - on.cast("int"))
    return joined.withColumn(BUCKET, bucket).drop("__edges", *[f"__e{i}" for i in range(len(by))])


def _leads(rows: DataFrame, runs: Runs, plan: DataFrame, quantiles: int) -> DataFrame:
    """Values of earlier runs that a run's quantiles can reach, with their numbers, addressed to that run."""
    by = runs.by
    later = F.col("__to") > F.col(RUN) if not runs.descending else F.col("__to") < F.col(RUN)
    want = plan.where("kind = 'want'").withColumn("__wanted", F.explode(F.sequence("bucket", "reach"))).where("__wanted % 2 = 0")
    want = want.select(*[F.col(c).alias(f"__w{i}") for i, c in enumerate(by)], F.col(RUN).alias("__to"), "which", "__wanted")
    cond = same([F.col(c) for c in by], [F.col(f"__w{i}") for i in range(len(by))]) & (F.col(BUCKET) == F.col("__wanted")) & later
    # About twenty buckets per run and quantile; broadcast where that is few in all.
    sent = rows.where(F.col(BUCKET) % 2 == 0).select(*by, RUN, BUCKET, VALUE)
    sent = sent.join(runs._small(want, 32 * quantiles), cond)
    sent = sent.groupBy(*by, "__to", "which", VALUE).agg(F.count(F.lit(1)).alias("a"))
    none = F.lit(0).cast("long")
    return sent.select(
        *by, F.col("__to").alias(RUN), F.lit("lead").alias("kind"), "which", none.alias("bucket"), F.col(VALUE).alias("v"), "a", none.alias("b")
    )
