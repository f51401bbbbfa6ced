"""Statistics over a period of time in groups that are cut into runs.

A window (here - period, here] that reaches over many runs is put together from three parts: the last rows of the run it begins in,
the runs that lie between, and the rows of its own run. A row leaves the windows one period after its time, so besides its own run
a row is needed in just one other, the run of that moment: every row is placed twice at most, whatever the period. What lies
between is the same for all windows of a run and comes from a table with a row per run and run of leaving, which a tree of
partial results sums up, extremes too. Nothing is ever taken off a total, so a window's result has the rounding of its own
rows only, and a NaN is seen by the windows that hold it and by no others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorlake.operators.runs import RUN, Runs
from sensorlake.session import pin

FUNCTIONS = ("count", "sum", "mean", "min", "max", "var", "std", "sem", "skew", "kurt")
POS, VALUE, LEAVES = "__pos", "__x", "__leaves"
POWERS = 4
# What is added up: rows, values, their sum, and sums of powers about a point near the data; then the extremes.
PARTS = ["rows", "n", "sum", *[f"p{k}" for k in range(1, POWERS + 1)], "min", "max"]
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _merge(part: str):
    return {"min": np.fmin, "max": np.maximum}.get(part, np.add)


def _nothing(part: str, dtype: np.dtype) -> np.ndarray:
    """The value that changes nothing. Only windows with a value are asked for extremes."""
    if part not in ("min", "max"):
        return dtype.type(0)
    if dtype.kind == "i":
        return np.iinfo(dtype).max if part == "min" else np.iinfo(dtype).min
    return np.nan if part == "min" else -np.inf


def moved(sums: Sequence[np.ndarray], shift: float) -> list[np.ndarray]:
    """n and sums of powers of (x - a) from a to a + shift."""
    n, s1, s2, s3, s4 = sums
    d = -shift
    return [
        n, s1 + n * d, s2 + 2 * d * s1 + n * d**2, s3 + 3 * d * s2 + 3 * d**2 * s1 + n * d**3,
        s4 + 4 * d * s3 + 6 * d**2 * s2 + 4 * d**3 * s1 + n * d**4,
    ]


def window_totals(lo: np.ndarray, hi: np.ndarray, parts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Each part over [lo, hi) for windows whose ends only move forward, and that are not empty.

    From a split point on, windows that begin before it are what is left of it plus what is right of it.
    """
    out = {name: np.empty(len(lo), a.dtype) for name, a in parts.items()}
    i = 0
    while i < len(lo):
        split, first = hi[i], lo[i]
        k = int(np.searchsorted(lo, split, side="left"))
        far = hi[k - 1]
        here = slice(i, k)
        for name, a in parts.items():
            op = _merge(name)
            left = op.accumulate(a[first:split][::-1])[::-1]
            right = np.concatenate([[_nothing(name, a.dtype)], op.accumulate(a[split:far])]) if far > split else np.array([_nothing(name, a.dtype)], a.dtype)
            out[name][here] = op(left[lo[here] - first], right[hi[here] - split])
        i = k
    return out


class Tree:
    """Totals of any stretch of a list, from totals of stretches of powers of two."""

    def __init__(self, part: str, values: np.ndarray):
        self.op, self.none, self.levels = _merge(part), _nothing(part, values.dtype), [values]
        while len(self.levels[-1]) > 1:
            a = self.levels[-1]
            if len(a) % 2:
                a = np.append(a, self.none).astype(a.dtype)
            self.levels.append(self.op(a[::2], a[1::2]))

    def total(self, lo: int, hi: int):
        found, level = self.none, 0
        while lo < hi:
            if lo % 2:
                found, lo = self.op(found, self.levels[level][lo]), lo + 1
            if hi % 2:
                hi -= 1
                found = self.op(found, self.levels[level][hi])
            lo, hi, level = lo // 2, hi // 2, level + 1
        return found


class Steps:
    """What tasks do: ``{out: fn}`` over (here - width, here], with at least ``least[out]`` rows (count) or values."""

    def __init__(self, by: Sequence[str], fns: Mapping[str, str], width: int, least: Mapping[str, int], integral: bool, results: T.StructType):
        self.by, self.fns, self.width, self.least, self.integral = list(by), dict(fns), width, dict(least), integral
        self.types = {f.name: f.dataType for f in results.fields}

    # -- the runs between

    def between(self, table: pa.Table) -> pa.Table:
        """From the rows of a group's (run, leaving run): per run, the total of what lies before it and leaves after it."""
        table = table.take(pc.sort_indices(table, sort_keys=[(RUN, "ascending"), (LEAVES, "ascending")]))
        runs = np.unique(table[RUN].to_numpy()).tolist()
        # A line of every run is there for its number alone.
        table = table.filter(pc.greater(table[LEAVES], table[RUN]))
        run, leaves = table[RUN].to_numpy(), table[LEAVES].to_numpy()
        n, mean = table["n"].to_numpy().astype(np.float64), self._doubles(table["mean"], 0.0)
        about = float(np.nansum(n * mean) / n.sum()) if n.sum() else 0.0
        if not np.isfinite(about):
            about = 0.0
        parts = {"rows": table["rows"].to_numpy(), "n": table["n"].to_numpy()}
        for name in ("sum", "min", "max"):
            none = _nothing(name, np.dtype(np.int64 if self.integral else np.float64))
            parts[name] = table[name].fill_null(none).to_numpy().astype(np.int64) if self.integral else self._doubles(table[name], none)
        var, skew, kurt = (self._doubles(table[c], 0.0) for c in ("var", "skew", "kurt"))
        m2 = n * var
        central = [n, np.zeros(len(n)), m2, skew * var * np.sqrt(var) * n, np.where(m2 > 0, (kurt + 3) * var * var * n, 0.0)]
        parts |= dict(zip([f"p{k}" for k in range(1, POWERS + 1)], moved(central, about - mean)[1:]))
        trees = {name: Tree(name, parts[name]) for name in PARTS} if len(run) else {}
        out = []
        # Later rows leave later: what is before a run and leaves after it is one stretch of the list.
        for r in runs:
            lo, hi = int(np.searchsorted(leaves, r, side="right")), int(np.searchsorted(run, r, side="left"))
            if lo < hi:
                out.append((r, about, {name: trees[name].total(lo, hi) for name in PARTS}))
        keys = table.select(self.by).slice(0, 1).take(pa.array(np.zeros(len(out), np.int64)))
        columns = [pa.array([r for r, *_ in out], pa.int32()), pa.array([a for _, a, _ in out], pa.float64())]
        columns += [pa.array([p[name] for *_, p in out], self._arrow(name)) for name in PARTS]
        return pa.table([*keys.columns, *columns], names=[*self.by, RUN, "about", *PARTS])

    def _arrow(self, part: str) -> pa.DataType:
        whole = part in ("rows", "n") or (self.integral and part in ("sum", "min", "max"))
        return pa.int64() if whole else pa.float64()

    def part_fields(self) -> list[T.StructField]:
        whole = [p in ("rows", "n") or (self.integral and p in ("sum", "min", "max")) for p in PARTS]
        return [T.StructField(p, T.LongType() if w else T.DoubleType()) for p, w in zip(PARTS, whole)]

    @staticmethod
    def _doubles(column: pa.ChunkedArray, none: float) -> np.ndarray:
        return column.cast(pa.float64()).fill_null(none).to_numpy()

    # -- a run

    def _parts(self, values: pa.ChunkedArray, about: float) -> dict[str, np.ndarray]:
        there = values.is_valid().to_numpy().astype(np.int64)
        have = there.astype(bool)
        x = self._doubles(values, 0.0)
        parts = {"rows": np.ones(len(there), np.int64), "n": there}
        raw = values.fill_null(0).to_numpy().astype(np.int64) if self.integral else x
        parts["sum"] = raw
        for name in ("min", "max"):
            parts[name] = np.where(have, raw, _nothing(name, raw.dtype)).astype(raw.dtype)
        d = np.where(have, x - about, 0.0)
        parts |= {f"p{k}": d**k for k in range(1, POWERS + 1)}
        return parts

    def run(self, table: pa.Table, notes: pa.Table) -> pa.Table:
        """The windows of a run; ``notes`` has the rows that leave during it and the total of what lies between."""
        columns = [c for c in table.column_names if c not in (POS, VALUE)]
        table = table.take(pc.sort_indices(table, sort_keys=[(POS, "ascending")], null_placement="at_start"))
        undated = table[POS].null_count
        results = {out: [] for out in self.fns}
        if undated:
            # Rows without a time see each other.
            parts = self._parts(table[VALUE].slice(0, undated), 0.0)
            totals = window_totals(np.zeros(1, np.int64), np.full(1, undated), parts)
            for out, found in self._statistics(totals, 0.0).items():
                results[out].append(np.repeat(found, undated))
        own = table.slice(undated)
        if own.num_rows:
            for out, found in self._dated(own, notes).items():
                results[out].append(found)
        out = table.select(columns)
        for name, pieces in results.items():
            values = np.ma.concatenate(pieces)
            arrow = pa.array(values.data, mask=np.ma.getmaskarray(values))
            out = out.append_column(name, arrow.cast(_ARROW.get(type(self.types[name]), pa.float64()), safe=False))
        return out

    def _dated(self, own: pa.Table, notes: pa.Table) -> dict[str, np.ma.MaskedArray]:
        pos = own[POS].to_numpy()
        leading = notes.filter(pc.is_valid(notes[POS]))
        leading = leading.take(pc.sort_indices(leading, sort_keys=[(POS, "ascending")]))
        middle = notes.filter(pc.is_null(notes[POS]))
        x = self._doubles(own[VALUE], np.nan)
        finite = x[np.isfinite(x)]
        about = float(finite.mean()) if len(finite) else 0.0
        pieces, places = [self._parts(leading[VALUE], about)], [leading[POS].to_numpy()]
        if middle.num_rows:
            one = {p: np.array([middle[p][0].as_py()], np.int64 if self._arrow(p) == pa.int64() else np.float64) for p in PARTS}
            powers = moved([one["n"].astype(np.float64), *[one[f"p{k}"] for k in range(1, POWERS + 1)]], about - middle["about"][0].as_py())
            pieces.append(one | {f"p{k}": powers[k] for k in range(1, POWERS + 1)})
            last = places[0][-1] if len(places[0]) else pos[-1] - self.width + 1
            places.append(np.array([max(pos[-1] - self.width + 1, last)]))
        pieces.append(self._parts(own[VALUE], about))
        places.append(pos)
        place = np.concatenate(places)
        parts = {p: np.concatenate([piece[p] for piece in pieces]) for p in PARTS if self._used(p)}
        times, back = np.unique(pos, return_inverse=True)
        totals = window_totals(np.searchsorted(place, times - self.width, side="right"), np.searchsorted(place, times, side="right"), parts)
        return {out: found[back] for out, found in self._statistics(totals, about).items()}

    def _used(self, part: str) -> bool:
        fns = set(self.fns.values())
        if part in ("min", "max", "sum"):
            return part in fns
        highest = max({"mean": 1, "var": 2, "std": 2, "sem": 2, "skew": 3, "kurt": 4}.get(f, 0) for f in fns)
        return part in ("rows", "n") or int(part[1:]) <= highest

    def _statistics(self, t: dict[str, np.ndarray], about: float) -> dict[str, np.ma.MaskedArray]:
        n = t["n"].astype(np.float64)
        with np.errstate(all="ignore"):
            m = t["p1"] / n if "p1" in t else None
            m2 = t["p2"] - n * m * m if "p2" in t else None
            if m2 is not None:
                # Equal values differ from their mean by rounding only.
                m2 = np.where(m2 <= 1e-13 * t["p2"], 0.0, m2)
            out = {}
            for name, fn in self.fns.items():
                enough = t["rows" if fn == "count" else "n"] >= self.least[name]
                if fn in ("count", "sum", "min", "max"):
                    found = t["n" if fn == "count" else fn]
                    enough = enough & ((n > 0) | (fn == "count"))
                elif fn == "mean":
                    found, enough = about + m, enough & (n > 0)
                elif fn in ("var", "std", "sem"):
                    found, enough = m2 / (n - 1), enough & (n >= 2)
                    found = found if fn == "var" else np.sqrt(found / (n - 1) if fn == "sem" else found)
                else:
                    p2 = m2 / n
                    m3 = t["p3"] - 3 * m * t["p2"] + 2 * n * m**3
                    if fn == "skew":
                        found, enough = np.sqrt(n * (n - 1)) / (n - 2) * (m3 / n) / p2**1.5, enough & (n >= 3)
                    else:
                        m4 = t["p4"] - 4 * m * t["p3"] + 6 * m * m * t["p2"] - 3 * n * m**4
                        found = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * ((m4 / n) / (p2 * p2) - 3) + 6)
                        enough = enough & (n >= 4)
                    # Values that are all equal have neither.
                    enough = enough & ((p2 > 0) | np.isnan(p2))
                out[name] = np.ma.masked_array(found, ~enough)
        return out


_ARROW = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.ShortType: pa.int16(), T.ByteType: pa.int8(), T.FloatType: pa.float32()}


def fits(df: DataFrame, col: str, fns: Mapping[str, str]) -> bool:
    """Whether these statistics can be put together from parts."""
    kind = df.schema[col].dataType
    return set(fns.values()) <= set(FUNCTIONS) and isinstance(kind, (*INTEGRAL, T.FloatType, T.DoubleType))


def sliding(runs: Runs, col: str, fns: Mapping[str, str], width: int, position: Column, later: Column, least: Mapping[str, int], results: T.StructType) -> DataFrame:
    """The rows of cut groups of ``runs``, which are cut by time alone, with ``{out: fn}`` over (here - width, here].

    ``position`` is the time in the unit of ``width``, ``later`` the time one period on, ``results`` the types of the columns.
    """
    integral = isinstance(runs.df.schema[col].dataType, INTEGRAL)
    steps = Steps(runs.by, fns, width, least, integral, results)
    rows = runs.df.where(F.col(RUN).isNotNull())
    # The run a row leaves in is the one that holds the time one period on.
    placed = runs._place(rows.drop(RUN), **{LEAVES: runs._search(lambda edge: edge["o0"] <= later)})
    x = F.col(col).cast("long" if integral else "double")
    slim = placed.select(*runs.by, RUN, LEAVES, position.alias(POS), x.alias(VALUE)).where(F.col(LEAVES) > F.col(RUN))
    v = F.col(VALUE).cast("double")
    summary = slim.groupBy(*runs.by, RUN, LEAVES).agg(
        F.count(F.lit(1)).alias("rows"), F.count(VALUE).alias("n"), F.sum(VALUE).alias("sum"), F.min(VALUE).alias("min"), F.max(VALUE).alias("max"),
        F.avg(v).alias("mean"), F.var_pop(v).alias("var"), F.skewness(v).alias("skew"), F.kurtosis(v).alias("kurt"),
    )
    # Every run needs its line, also one that no row leaves from.
    keys = [rows.schema[c] for c in (*runs.by, RUN)]
    noted = T.StructType([*keys, T.StructField("about", T.DoubleType()), *steps.part_fields()])
    every = rows.groupBy(*runs.by, RUN).agg(F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("n")).withColumn(LEAVES, F.col(RUN))
    table = summary.unionByName(every, allowMissingColumns=True)
    between = pin(table.groupBy(*runs.by).applyInArrow(lambda t: steps.between(t), noted))
    leading = slim.select(*runs.by, F.col(LEAVES).alias(RUN), POS, VALUE)
    # From the pinned table first: its columns are not those of the rows.
    notes = between.unionByName(leading, allowMissingColumns=True)
    own = rows.withColumns({POS: position, VALUE: x})
    schema = T.StructType([*rows.schema, *results.fields])
    by_run = [*runs.by, RUN]
    return own.groupBy(*by_run).cogroup(notes.groupBy(*by_run)).applyInArrow(lambda t, n: steps.run(t, n), schema)
