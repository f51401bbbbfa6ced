"""Windows over time in cut groups against plain Spark windows, and how often rows are placed."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from sensorlake.operators import sliding as S
from sensorlake.operators import windows as W
from sensorlake.operators.runs import RUN, Runs

FNS = {f: f for f in S.FUNCTIONS}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(12)
    n = 1200
    second = np.sort(rng.integers(0, 40_000, n)) // 3 * 3
    second[500:530] = second[500]
    data = []
    for i in range(n):
        v = None if i % 9 == 0 else float(np.round(rng.normal(100, 3), 3)) if not 600 <= i < 660 else 7.25
        data.append((i, "hot" if i % 10 < 7 else None if i % 10 == 7 else "b", None if i % 97 == 0 else int(second[i]), v, None if i % 7 == 0 else int(rng.integers(-50, 50))))
    df = spark.createDataFrame(data, "id int, k string, s long, v double, n int")
    return df.withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s").cache()


def plain(df, col, fns, width, by, least=None):
    pos = W.micros(df, "t")
    w = Window.partitionBy(*by).orderBy(pos).rangeBetween(-(width * 1_000_000 - 1), 0)
    seen = {f: F.count(F.lit(1)) if f == "count" else F.count(col) for f in fns}
    least = {f: (0 if f == "count" else 1) if least is None else least for f in fns}
    return df.select("id", *[F.when(seen[f].over(w) >= least[f], W.frame_statistic(f, col)(w)).alias(f) for f in fns])


def same(got, want, names):
    got, want = ({r["id"]: r for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for i, r in want.items():
        for name in names:
            a, b = got[i][name], r[name]
            assert (a is None) == (b is None), (i, name, a, b)
            assert b is None or a == pytest.approx(b, rel=1e-6, abs=1e-9, nan_ok=True), (i, name)


@pytest.mark.parametrize("period", [1, 60, 700, 9_000, 100_000])
def test_every_period(rows, period):
    got = W.rolling(rows, "v", FNS, ["k"], ["t", "id"], period=f"{period}s", rows_per_run=40)
    same(got, plain(rows, "v", FNS, period, ["k"]), FNS)


def test_whole_numbers_and_one_group(rows):
    fns = {f: f for f in ("sum", "min", "max", "count", "mean")}
    got = W.rolling(rows, "n", fns, [], ["t", "id"], period="2000s", min_periods=3, rows_per_run=40)
    want = plain(rows, "n", fns, 2000, [], 3)
    assert [f.dataType for f in got.select(*fns).schema] == [f.dataType for f in want.select(*fns).schema]
    same(got, want, fns)


def test_nan_is_seen_by_its_windows_only(rows):
    df = rows.withColumn("v", F.when(F.col("id") % 50 == 3, F.lit(float("nan"))).otherwise(F.col("v")))
    fns = {f: f for f in ("sum", "min", "max", "count", "mean", "std")}
    same(W.rolling(df, "v", fns, ["k"], ["t", "id"], period="500s", rows_per_run=40), plain(df, "v", fns, 500, ["k"]), fns)


def test_small_and_cut_groups_together(rows):
    got = W.rolling(rows, "v", {"sum": "sum"}, ["k"], ["t", "id"], period="5000s", rows_per_run=300)
    same(got, plain(rows, "v", {"sum": "sum"}, 5000, ["k"]), ["sum"])
    assert got.columns == [*rows.columns, "sum"]


def test_median_goes_the_old_way(rows):
    got = W.rolling(rows, "v", {"median": "median"}, ["k"], ["t", "id"], period="300s", rows_per_run=40)
    same(got, plain(rows, "v", {"median": "median"}, 300, ["k"]), ["median"])


@pytest.mark.parametrize("seconds", [10, 3_000, 30_000, 10**6])
def test_rows_are_placed_twice_at_most(rows, seconds):
    cut = Runs(rows, ["k"], ["t"], rows_per_run=40)
    later = F.col("t") + F.make_dt_interval(secs=F.lit(seconds))
    placed = cut._place(cut.df.drop(RUN), **{S.LEAVES: cut._search(lambda edge: edge["o0"] <= later)}).where(F.col(RUN).isNotNull())
    own, copies, runs = placed.select(F.count(F.lit(1)), F.count_if(F.col(S.LEAVES) > F.col(RUN)), F.countDistinct("k", RUN)).first()
    assert runs > 10 and copies <= own


def test_totals_of_parts():
    rng = np.random.default_rng(1)
    a = rng.integers(-9, 9, 57)
    lo = np.sort(rng.integers(0, 50, 40))
    hi = np.maximum(np.sort(rng.integers(1, 58, 40)), lo + 1)
    hi = np.maximum.accumulate(hi)
    got = S.window_totals(lo, hi, {"sum": a, "min": a, "max": a.astype(float)})
    for i, (x, y) in enumerate(zip(lo, hi)):
        assert (got["sum"][i], got["min"][i], got["max"][i]) == (a[x:y].sum(), a[x:y].min(), a[x:y].max())
    for name, f in (("sum", np.sum), ("min", np.min), ("max", np.max)):
        tree = S.Tree(name, a)
        for x, y in ((0, 57), (3, 4), (5, 41), (56, 57)):
            assert tree.total(x, y) == f(a[x:y])


def test_moved_sums():
    x = np.array([1.5, 4.0, -2.0, 7.0])
    sums = [np.array([4.0])] + [np.array([((x - 2.0) ** k).sum()]) for k in range(1, 5)]
    for k, got in enumerate(S.moved(sums, 3.0)[1:], 1):
        assert got[0] == pytest.approx(((x - 5.0) ** k).sum())
