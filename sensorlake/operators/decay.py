"""Exponentially weighted means, variances, covariances and correlations (C81, C129).

What came before a row acts on it by a few numbers: the sum of the weights, the two means, the covariance, the sum of the squared
weights, and how long ago the last value was. Each value turns these numbers into the next ones by lines a * s + b, so a
run of rows is worked out by composing lines in pairs, pairs of pairs and so on, with arrays and no loop over rows. A whole run
is again a line: a handful of numbers that say what it makes of any state before it. Runs of a cut group, and batches of a stream,
are chained by those.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from sensorlake.operators.groups import marked, whole_groups
from sensorlake.operators.runs import RUN, Runs
from sensorlake.session import pin

FUNCTIONS = ("mean", "var", "std", "cov", "corr")


def line_scan(a: np.ndarray, b: np.ndarray, start: float = 0.0) -> np.ndarray:
    """s[i] = a[i] * s[i-1] + b[i] from ``start``: lines composed over stretches of 1, 2, 4, ... steps."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    step = 1
    while step < len(a):
        b[step:] = a[step:] * b[:-step] + b[step:]
        a[step:] = a[step:] * a[:-step]
        step *= 2
    return a * start + b


def scan_runs(a: np.ndarray, b: np.ndarray, local: np.ndarray) -> np.ndarray:
    """``line_scan`` of many runs laid end to end, each from its own first ``b``; ``local`` is the place of an entry in its run."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    step, later = 1, np.flatnonzero(local >= 1)
    while len(later):
        b[later] = a[later] * b[later - step] + b[later]
        a[later] = a[later] * a[later - step]
        step *= 2
        later = later[local[later] >= step]
    return b


@dataclass
class State:
    """What a row needs of all before it: weights, their squares over their sum squared, means, covariance, rows since the last value."""

    weight: float = 0.0
    mx: float = 0.0
    my: float = 0.0
    cov: float = 0.0
    squares: float = 0.0
    age: float = 0.0
    n: float = 0.0

    FIELDS = ("weight", "mx", "my", "cov", "squares", "age", "n")

    def numbers(self) -> tuple[float, ...]:
        return tuple(float(getattr(self, f)) for f in self.FIELDS)


def joined(f: float, a: Sequence[float], b: Sequence[float]) -> tuple[float, float, float, float]:
    """Means, covariance and squared weights of two sets together, the first with the share ``f`` of all weight."""
    g = 1.0 - f
    return (
        f * a[0] + g * b[0], f * a[1] + g * b[1],
        f * a[2] + g * b[2] + f * g * (a[0] - b[0]) * (a[1] - b[1]), f * f * a[3] + g * g * b[3],
    )


class Decay:
    """How weights fall: by 1 - alpha per row, or per value with ``ignore_na``. With ``adjust`` every value comes in with weight 1,
    without it with the share alpha against what is there."""

    #: Of a run: rows, values, rows up to the first value, rows after the last, the first value, then of the others the factor on
    #: what is before them, their weight, means, covariance and squared weights.
    SUMMARY = ("rows", "n", "lead", "tail", "x", "y", "factor", "weight", "mx", "my", "cov", "squares")

    def __init__(self, alpha: float, adjust: bool = True, ignore_na: bool = False):
        if not 0 < alpha <= 1:
            raise ValueError(f"alpha: {alpha}")
        self.alpha, self.adjust, self.ignore_na, self.fall = alpha, adjust, ignore_na, 1.0 - alpha

    def _gaps(self, places: np.ndarray) -> np.ndarray:
        return np.ones(len(places) - 1) if self.ignore_na else np.diff(places)

    def _lines(self, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per value: the factor on what is before it, and its own weight."""
        kept = self.fall**gaps
        if self.adjust:
            return kept, np.ones(len(gaps))
        share = self.alpha / (kept + self.alpha)
        return 1.0 - share, share

    def _ages(self, n: int, places: np.ndarray) -> tuple[float, float]:
        """Rows up to the first value, and rows after the last."""
        return (1.0, 0.0) if self.ignore_na else (float(places[0] + 1), float(n - 1 - places[-1]))

    def summary(self, x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
        """A run in short; rows where x or y is NaN have no value."""
        places = np.flatnonzero((x == x) & (y == y))
        if not len(places):
            return (float(len(x)), *[0.0] * 11)
        lead, tail = self._ages(len(x), places)
        u, v = x[places], y[places]
        if len(places) == 1:
            return (float(len(x)), 1.0, lead, tail, float(u[0]), float(v[0]), 1.0, *[0.0] * 5)
        a, w = self._lines(self._gaps(places))
        cx, cy = u.mean(), v.mean()
        p, q = u[1:] - cx, v[1:] - cy
        weight, sx, sy, sq = (float(line_scan(a, b)[-1]) for b in (w, w * p, w * q, w * p * q))
        squares = float(line_scan(a * a, w * w)[-1])
        factor = float(np.prod(a))
        if not weight:
            return (float(len(x)), float(len(places)), lead, tail, float(u[0]), float(v[0]), factor, *[0.0] * 5)
        mx, my = sx / weight, sy / weight
        return (
            float(len(x)), float(len(places)), lead, tail, float(u[0]), float(v[0]), factor,
            weight, mx + cx, my + cy, sq / weight - mx * my, squares / weight**2,
        )

    def after(self, s: State, numbers: Sequence[float]) -> State:
        """The state behind a run, from the state before it and its summary."""
        rows, n, lead, tail, x, y, factor, weight, mx, my, cov, squares = numbers
        if not n:
            return State(s.weight, s.mx, s.my, s.cov, s.squares, 0.0 if self.ignore_na else s.age + rows, s.n)
        first, share = self._first(s, lead)
        here = joined(1.0 - share, (s.mx, s.my, s.cov, s.squares), (x, y, 0.0, 1.0))
        before = factor * first
        if weight:
            here = joined(before / (before + weight), here, (mx, my, cov, squares))
        return State(before + weight if self.adjust else 1.0, *here, tail, s.n + n)

    def _first(self, s: State, lead: float) -> tuple[float, float]:
        """The weight with the first value of a run, and that value's share of it."""
        if not s.weight:
            return 1.0, 1.0
        kept = self.fall ** (s.age + lead)
        if self.adjust:
            return kept * s.weight + 1.0, 1.0 / (kept * s.weight + 1.0)
        return 1.0, self.alpha / (kept + self.alpha)

    def rows(self, x: np.ndarray, y: np.ndarray, s: State) -> dict[str, np.ndarray]:
        """Mean of x, covariance, sum of squared weights (of weights that sum to 1) and number of values at every row."""
        places = np.flatnonzero((x == x) & (y == y))
        found = {"mean": [s.mx], "cov": [s.cov], "squares": [s.squares], "n": [s.n]}
        if len(places):
            lead, _ = self._ages(len(x), places)
            a, w = self._lines(self._gaps(places))
            weight, share = self._first(s, lead)
            u, v = x[places], y[places]
            cx, cy = u.mean(), v.mean()
            p, q = u - cx, v - cy
            # The first value together with what is before it is where the lines start.
            mx, my, cov, squares = joined(1.0 - share, (s.mx, s.my, s.cov, s.squares), (u[0], v[0], 0.0, 1.0))
            mx, my = mx - cx, my - cy

            def scan(b: np.ndarray, start: float, a: np.ndarray = a) -> np.ndarray:
                return np.concatenate([[start], line_scan(a, b, start)])

            total = scan(w, weight)
            sx, sy = scan(w * p[1:], weight * mx) / total, scan(w * q[1:], weight * my) / total
            sq = scan(w * p[1:] * q[1:], weight * (cov + mx * my)) / total
            found["mean"] = np.concatenate([found["mean"], sx + cx])
            found["cov"] = np.concatenate([found["cov"], sq - sx * sy])
            found["squares"] = np.concatenate([found["squares"], scan(w * w, weight**2 * squares, a * a) / total**2])
            found["n"] = np.concatenate([found["n"], s.n + np.arange(1, len(places) + 1)])
        latest = np.searchsorted(places, np.arange(len(x)), side="right")
        return {k: np.asarray(f, np.float64)[latest] for k, f in found.items()}

    def _places(self, x: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of runs laid end to end: the rows that have a value, the run of each, and which value of its run it is, from 0."""
        run = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(x))))
        places = np.flatnonzero(x == x)
        run = run[places]
        return places, run, np.arange(len(places)) - np.searchsorted(run, run)

    def summaries(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """``summary`` of (x, x) of many runs at once, one a line, as far as the mean goes: without covariance and squared weights."""
        out = np.zeros((len(begins), len(self.SUMMARY)))
        ends = np.append(begins[1:], len(x))
        out[:, 0] = ends - begins
        places, run, local = self._places(x, begins)
        if not len(places):
            return out
        first = np.flatnonzero(local == 0)
        last, found = np.append(first[1:], len(places)) - 1, run[first]
        u, rest = x[places], local > 0
        a, w = self._lines(self._gaps(np.concatenate([places[:1] - 1, places])))
        a, w = np.where(rest, a, 1.0), np.where(rest, w, 0.0)
        centre = (np.add.reduceat(u, first) / (last - first + 1))[np.cumsum(~rest) - 1]
        weight, sx = (scan_runs(a, b, local)[last] for b in (w, w * np.where(rest, u - centre, 0.0)))
        several = weight > 0
        mean = np.where(several, sx / np.where(several, weight, 1.0) + centre[first], 0.0)
        lead, tail = (1.0, 0.0) if self.ignore_na else (places[first] + 1 - begins[found], ends[found] - 1 - places[last])
        for name, values in (("n", last - first + 1), ("lead", lead), ("tail", tail), ("x", u[first]), ("y", u[first]),
                             ("factor", np.multiply.reduceat(a, first)), ("weight", weight), ("mx", mean), ("my", mean)):
            out[found, self.SUMMARY.index(name)] = values
        return out

    def means(self, x: np.ndarray, begins: np.ndarray, states: np.ndarray) -> np.ndarray:
        """The mean at every row of many runs, each from the numbers of its own state."""
        state = {f: states[:, i] for i, f in enumerate(State.FIELDS)}
        places, run, local = self._places(x, begins)
        size = np.diff(np.append(begins, len(x)))
        out = np.repeat(np.where(state["n"] > 0, state["mx"], np.nan), size)
        if not len(places):
            return out
        rest, first = local > 0, np.flatnonzero(local == 0)
        found, u = run[first], x[places]
        a, w = self._lines(self._gaps(np.concatenate([places[:1] - 1, places])))
        lead = 1.0 if self.ignore_na else places[first] + 1 - begins[found]
        kept, held = self.fall ** (state["age"][found] + lead), state["weight"][found]
        weight = np.where(held > 0, kept * held + 1.0, 1.0) if self.adjust else np.ones(len(first))
        share = 1.0 / weight if self.adjust else np.where(held > 0, self.alpha / (kept + self.alpha), 1.0)
        which = np.cumsum(~rest) - 1
        centre = np.add.reduceat(u, first) / np.diff(np.append(first, len(u)))
        # The first value together with what is before it is where the lines start.
        start = weight * ((1.0 - share) * state["mx"][found] + share * u[first] - centre)
        total = scan_runs(a, np.where(rest, w, weight[which]), local)
        sx = scan_runs(a, np.where(rest, w * (u - centre[which]), start[which]), local)
        mean = sx / total + centre[which]
        latest = np.cumsum(x == x) - 1
        own = (latest >= 0) & (run[np.maximum(latest, 0)] == np.repeat(np.arange(len(begins)), size))
        return np.where(own, mean[latest], out)


def _spread(rows: Mapping[str, np.ndarray], bias: bool) -> np.ndarray:
    """The covariance, by default freed of bias: NaN where all weight is on one value."""
    if bias:
        return rows["cov"]
    left = 1.0 - rows["squares"]
    return np.where((rows["n"] > 1) & (left > 1e-15), rows["cov"] / np.where(left > 0, left, 1.0), np.nan)


def statistic(decay: Decay, fn: str, x: np.ndarray, y: np.ndarray, states: Sequence[State], bias: bool, min_periods: int) -> np.ndarray:
    """One statistic at every row; ``states`` are those of (x, y), (x, x) and (y, y), as far as the statistic needs them."""
    rows = decay.rows(x, y, states[0])
    enough = rows["n"] >= max(min_periods, 1)
    with np.errstate(all="ignore"):
        if fn == "mean":
            found = rows["mean"]
        elif fn in ("var", "cov"):
            found = _spread(rows, bias)
        elif fn == "std":
            found = np.sqrt(np.maximum(_spread(rows, bias), 0.0))
        else:
            both = (x == x) & (y == y)
            own = [decay.rows(v, v, s)["cov"] for v, s in ((np.where(both, x, np.nan), states[1]), (np.where(both, y, np.nan), states[2]))]
            found = np.where((own[0] > 0) & (own[1] > 0), rows["cov"] / np.sqrt(own[0] * own[1]), np.nan)
    return np.where(enough, found, np.nan)


def numbers_of(values: pa.ChunkedArray) -> np.ndarray:
    return values.cast(pa.float64()).to_numpy()


class Steps:
    """What tasks do for one statistic."""

    def __init__(self, decay: Decay, fn: str, col: str, other: str | None, by: Sequence[str], order: Sequence[str], out: str, bias: bool, min_periods: int):
        self.decay, self.fn, self.col, self.other, self.by, self.order, self.out = decay, fn, col, other, list(by), list(order), out
        self.bias, self.min_periods = bias, min_periods
        # A correlation needs the two variances besides the covariance.
        self.pairs = 3 if fn == "corr" else 1
        self.states = [f"__{f}{i}" for i in range(self.pairs) for f in State.FIELDS]
        self.summaries = [f"__{f}{i}" for i in range(self.pairs) for f in Decay.SUMMARY]

    def _ordered(self, table: pa.Table) -> pa.Table:
        return table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in self.order], null_placement="at_start"))

    def _values(self, table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
        x = numbers_of(table[self.col])
        y = numbers_of(table[self.other]) if self.other else x
        if self.pairs == 1:
            return [(x, y)]
        both = (x == x) & (y == y)
        x, y = np.where(both, x, np.nan), np.where(both, y, np.nan)
        return [(x, y), (x, x), (y, y)]

    def summarise(self, table: pa.Table) -> pa.Table:
        head = table.select([*self.by, RUN]).slice(0, 1)
        found = [v for x, y in self._values(self._ordered(table)) for v in self.decay.summary(x, y)]
        for name, value in zip(self.summaries, found):
            head = head.append_column(name, pa.array([value], pa.float64()))
        return head

    def chain(self, table: pa.Table) -> pa.Table:
        """The states before each run of a group."""
        table = table.take(pc.sort_indices(table, sort_keys=[(RUN, "ascending")]))
        width, lines = len(Decay.SUMMARY), list(zip(*[table[n].to_pylist() for n in self.summaries]))
        now, states = [State() for _ in range(self.pairs)], []
        for line in lines:
            states.append([v for s in now for v in s.numbers()])
            now = [self.decay.after(s, line[i * width : (i + 1) * width]) for i, s in enumerate(now)]
        out = table.select([*self.by, RUN])
        for name, column in zip(self.states, zip(*states)):
            out = out.append_column(name, pa.array(column, pa.float64()))
        return out

    def smooth(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The statistic of whole runs, which come in batches and in order."""
        for table, ends in whole_groups(batches):
            width, cut = len(State.FIELDS), self.states[0] in table.column_names
            before = [table[n].take(pa.array([a for a, _ in ends])).to_pylist() if cut else None for n in self.states]
            (x, y), *_ = self._values(table)
            found = np.empty(len(x))
            for i, (a, b) in enumerate(ends):
                first = [v[i] or 0.0 if cut else 0.0 for v in before]
                states = [State(*first[k * width : (k + 1) * width]) for k in range(self.pairs)]
                found[a:b] = statistic(self.decay, self.fn, x[a:b], y[a:b], states, self.bias, self.min_periods)
            table = table.select([c for c in table.column_names if c not in self.states])
            yield from table.append_column(self.out, pa.array(found, pa.float64(), from_pandas=True)).to_batches(max_chunksize=10_000)


def exponential(
    df: DataFrame, col: str, alpha: float, by: Sequence[str], order: Sequence[str], fn: str = "mean", other: str | None = None,
    adjust: bool = True, ignore_na: bool = False, bias: bool = False, min_periods: int = 0, out: str = "ewm", **kw,
) -> DataFrame:
    """Exponentially weighted ``mean``, ``var``, ``std``, or ``cov`` and ``corr`` with ``other``.

    A NULL value (for pairs: either) repeats the result; it ages the weights unless ``ignore_na``. ``bias`` keeps the plain
    weighted second moment. A cut group needs one summary row per run, chained in order.
    """
    if fn not in FUNCTIONS or (other is None) != (fn in ("mean", "var", "std")):
        raise ValueError(f"fn: {fn}, other: {other}")
    runs = Runs(df, by, order, **kw)
    steps = Steps(Decay(alpha, adjust, ignore_na), fn, col, other, runs.by, runs.order, out, bias, min_periods)
    keys, rows = [*runs.by, RUN], runs.df
    fields = [runs.df.schema[c] for c in keys]
    if runs.split:
        used = list(dict.fromkeys([*keys, *runs.order, col, *([other] if other else [])]))
        cut = rows.where(F.col(RUN).isNotNull()).select(*used)
        summary = T.StructType(fields + [T.StructField(n, T.DoubleType()) for n in steps.summaries])
        state = T.StructType(fields + [T.StructField(n, T.DoubleType()) for n in steps.states])
        summaries = cut.groupBy(*keys).applyInArrow(lambda t: steps.summarise(t), summary)
        states = pin(summaries.groupBy(*runs.by).applyInArrow(lambda t: steps.chain(t), state))
        rows = runs.attach(rows, states)
    schema = T.StructType([*runs.df.schema, T.StructField(out, T.DoubleType())])
    # Most groups are small: they go to the tasks many at a time.
    return runs.with_df(marked(rows, keys, runs.order).mapInArrow(steps.smooth, schema)).rows()
