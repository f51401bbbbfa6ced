"""Window operators against pandas, whole and with every group cut."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorlake.operators import windows as W

BY, ORDER = ["k"], ["ts", "event_id"]
CUTS = [0, 24]


@pytest.fixture(scope="module")
def frame(events):
    v = F.when(F.col("event_id") % 5 > 0, F.col("value") % 7)
    k = F.when(F.col("event_id") % 3 > 0, F.lit(-1)).otherwise(F.col("event_id") % 4)
    df = events.select("event_id", k.alias("k"), "ts", v.alias("v"), F.round("value").alias("u")).cache()
    return df, df.toPandas().sort_values(["k", "ts", "event_id"]).reset_index(drop=True)


def check(got, pdf, want, col="out"):
    got = got.select("event_id", col).toPandas().set_index("event_id")[col].astype(float)
    want = pd.Series(np.asarray(want, dtype=float), index=pdf["event_id"])
    assert len(got) == len(want)
    pd.testing.assert_series_equal(got.sort_index(), want.sort_index(), check_names=False, rtol=1e-7, atol=1e-9)


def each(pdf, fn, col="v"):
    return pdf.groupby("k", group_keys=False)[col].apply(fn).sort_index()


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("fn", ["sum", "max"])
def test_cumulative(frame, fn, cut):
    df, pdf = frame
    check(W.cumulative(df, "v", fn, BY, ORDER, "out", rows_per_run=cut), pdf, getattr(pdf.groupby("k")["v"], f"cum{fn}")())


@pytest.mark.parametrize("cut", CUTS)
def test_product(frame, cut):
    df, pdf = frame
    df = df.withColumn("v", 1 + F.col("v") / 1000)
    check(W.cumulative(df, "v", "product", BY, ORDER, "out", rows_per_run=cut), pdf, (1 + pdf["v"] / 1000).groupby(pdf["k"]).cumprod())


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("method", ["average", "min", "max", "dense", "first"])
@pytest.mark.parametrize("pct", [False, True])
def test_rank(frame, method, pct, cut):
    df, pdf = frame
    got = W.rank(df, "u", BY, method, ORDER, pct=pct, out="out", rows_per_run=cut)
    check(got, pdf, pdf.groupby("k")["u"].rank(method, pct=pct))


def test_rank_skips_null(frame):
    df, pdf = frame
    check(W.rank(df, "v", BY, "min", out="out"), pdf, pdf.groupby("k")["v"].rank("min"))


@pytest.mark.parametrize("cut", CUTS)
def test_difference_and_change(frame, cut):
    df, pdf = frame
    check(W.difference(df, "v", BY, ORDER, out="out", rows_per_run=cut), pdf, pdf.groupby("k")["v"].diff())
    df = df.withColumn("u", F.col("u") + 1)
    want = (pdf["u"] + 1).groupby(pdf["k"]).pct_change(3)
    check(W.pct_change(df, "u", BY, ORDER, 3, "out", rows_per_run=cut), pdf, want)


def test_numbers(frame):
    df, pdf = frame
    check(W.row_number(df, BY, ORDER, "out", rows_per_run=24), pdf, pdf.groupby("k").cumcount())
    check(W.group_number(df, BY, "out"), pdf, pdf.groupby("k").ngroup())


@pytest.mark.parametrize("n", [0, 2, -1, -3])
def test_nth(frame, n):
    df, pdf = frame
    want = pdf.groupby("k").nth(n)["event_id"]
    assert sorted(r.event_id for r in W.nth(df, BY, ORDER, n).collect()) == sorted(want)


def test_head_tail(frame):
    df, pdf = frame
    assert {r.event_id for r in W.head(df, BY, ORDER, 4).collect()} == set(pdf.groupby("k").head(4)["event_id"])
    assert {r.event_id for r in W.tail(df, BY, ORDER, 4).collect()} == set(pdf.groupby("k").tail(4)["event_id"])


@pytest.mark.parametrize("fn", ["sum", "mean", "var", "std", "sem", "skew", "kurt", "median", "min", "max", "quantile", "rank", "count"])
def test_rolling(frame, fn):
    df, pdf = frame
    got = W.rolling(df, "v", fn, BY, ORDER, rows=9, min_periods=5, q=0.25, out="out", rows_per_run=24)
    args = (0.25,) if fn == "quantile" else ()
    want = each(pdf, lambda s: getattr(s.rolling(9, min_periods=5), fn)(*args))
    if fn == "rank":
        want = want.where(pdf["v"].notna())
    if fn == "sem":
        n = each(pdf, lambda s: s.rolling(9, min_periods=1).count())
        want = each(pdf, lambda s: s.rolling(9, min_periods=5).std()) / np.sqrt(n - 1)
    check(got, pdf, want)


@pytest.mark.parametrize("cut", CUTS)
def test_rolling_time_and_forward(frame, cut):
    df, pdf = frame
    got = W.rolling(df, "v", "sum", BY, ORDER, period="36h", out="out", rows_per_run=cut)
    want = pdf.groupby("k", group_keys=False)[["ts", "v"]].apply(lambda g: g.rolling("36h", on="ts")["v"].sum()).sort_index()
    check(got, pdf, want)
    got = W.rolling(df, "v", "mean", BY, ORDER, rows=5, min_periods=1, forward=True, out="out", rows_per_run=cut)
    check(got, pdf, each(pdf, lambda s: s[::-1].rolling(5, min_periods=1).mean()[::-1]))


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("fn", ["count", "sum", "max", "min", "mean", "median", "std", "var", "sem", "skew", "kurt", "quantile"])
def test_expanding(frame, fn, cut):
    df, pdf = frame
    args = (0.5,) if fn == "quantile" else ()
    want = each(pdf, lambda s: getattr(s.expanding(1), fn)(*args))
    if fn in ("skew", "kurt"):
        want = want.where(each(pdf, lambda s: s.expanding(1).count()) >= (3 if fn == "skew" else 4))
    check(W.expanding(df, "v", fn, BY, ORDER, out="out", rows_per_run=cut), pdf, want)


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("fn", ["cov", "corr"])
def test_expanding_pair(frame, fn, cut):
    df, pdf = frame
    got = W.expanding(df, "v", fn, BY, ORDER, other="u", out="out", rows_per_run=cut)
    want = pdf.groupby("k", group_keys=False)[["v", "u"]].apply(lambda g: getattr(g["v"].expanding(2), fn)(g["u"])).sort_index()
    check(got, pdf, want)


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("adjust", [True, False])
def test_ewm(frame, adjust, cut):
    df, pdf = frame
    got = W.ewm(df, "v", 0.3, BY, ORDER, adjust, "out", rows_per_run=cut)
    check(got, pdf, each(pdf, lambda s: s.ewm(alpha=0.3, adjust=adjust).mean()))


def test_weighted(frame):
    df, pdf = frame
    weights = [0.25, 0.5, 1.0, 0.5]

    def mean(x):
        return np.dot(x, weights) / sum(weights)

    fns = {
        "sum": lambda x: np.dot(x, weights),
        "mean": mean,
        "var": lambda x: np.dot(weights, (x - mean(x)) ** 2) * 4 / (3 * sum(weights)),
    }
    for fn, ref in fns.items():
        got = W.weighted(df, "u", weights, BY, ORDER, fn, "out", rows_per_run=24)
        check(got, pdf, each(pdf, lambda s: s.rolling(4).apply(ref, raw=True), "u"))
