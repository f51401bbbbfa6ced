"""Cut runs give what one plain window gives, with one key holding most rows."""

import pytest
from pyspark.sql import Window, functions as F

from sensorlake.operators.runs import RUN, Runs

BY, ORDER = ["k"], ["ts", "event_id"]


@pytest.fixture(scope="module")
def skewed(events):
    # One key has two thirds of the rows; every fifth value is NULL.
    k = F.when(F.col("event_id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("event_id") % 7))
    v = F.when(F.col("event_id") % 5 > 0, F.round("value"))
    return events.select("event_id", F.when(F.col("event_id") % 11 > 0, k).alias("k"), "ts", v.alias("v")).cache()


def check(skewed, got, want, by=BY):
    got = {r.event_id: r.out for r in got.rows().select("event_id", "out").collect()}
    want = {r.event_id: r.out for r in skewed.select("event_id", want.alias("out")).collect()}
    assert len(got) == len(want)
    assert got == pytest.approx(want, nan_ok=True)


def runs(skewed, by=BY, n=16):
    cut = Runs(skewed, by, ORDER, rows_per_run=n)
    assert cut.split and cut.df.select(RUN).distinct().count() > 10
    return cut


def plain():
    return Window.partitionBy("k").orderBy(*ORDER)


@pytest.mark.parametrize("fn", ["sum", "min", "max", "count"])
def test_cumulative(skewed, fn):
    agg = getattr(F, fn)("v").over(plain().rowsBetween(Window.unboundedPreceding, 0))
    want = agg if fn == "count" else F.when(F.col("v").isNotNull(), agg)
    check(skewed, runs(skewed).cumulative("v", fn, "out"), want)


@pytest.mark.parametrize("n", [1, 3, 40, 100, -1, -90])
def test_shift(skewed, n):
    check(skewed, runs(skewed).shift("v", n, "out"), F.lag("v", n).over(plain()) if n > 0 else F.lead("v", -n).over(plain()))


@pytest.mark.parametrize("backward", [False, True])
def test_fill(skewed, backward):
    if backward:
        want = F.first("v", ignorenulls=True).over(plain().rowsBetween(0, Window.unboundedFollowing))
    else:
        want = F.last("v", ignorenulls=True).over(plain().rowsBetween(Window.unboundedPreceding, 0))
    check(skewed, runs(skewed).fill("v", "out", backward), want)


def test_row_number(skewed):
    check(skewed, runs(skewed).row_number("out"), F.row_number().over(plain()))
    whole = Window.orderBy(*ORDER)
    check(skewed, runs(skewed, by=[]).row_number("out"), F.row_number().over(whole))


@pytest.mark.parametrize("n", [1, 2, 9, 50, 150])
def test_rolling_rows(skewed, n):
    got = runs(skewed).rolling(n, ["v"], lambda w: {"out": F.sum("v").over(w)})
    check(skewed, got, F.sum("v").over(plain().rowsBetween(-(n - 1), 0)))


@pytest.mark.parametrize("hours", [1, 24, 200])
def test_rolling_range(skewed, hours):
    width = hours * 3600 * 1_000_000
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    later = F.col("ts") + F.make_dt_interval(hours=F.lit(hours))
    got = runs(skewed).rolling_range(width, micros, ["v"], lambda w: {"out": F.sum("v").over(w)}, later)
    check(skewed, got, F.sum("v").over(Window.partitionBy("k").orderBy(micros).rangeBetween(-(width - 1), 0)))


def test_descending(skewed):
    got = Runs(skewed, BY, ORDER, rows_per_run=16, descending=True).cumulative("v", "sum", "out")
    down = Window.partitionBy("k").orderBy(F.desc("ts"), F.desc("event_id")).rowsBetween(Window.unboundedPreceding, 0)
    check(skewed, got, F.when(F.col("v").isNotNull(), F.sum("v").over(down)))


def test_sampled_edges(skewed):
    # A rate below one: edges from part of the rows, results unchanged.
    cut = Runs(skewed, BY, ORDER, rows_per_run=400)
    assert cut.split
    check(skewed, cut.cumulative("v", "sum", "out"), F.when(F.col("v").isNotNull(), F.sum("v").over(plain().rowsBetween(Window.unboundedPreceding, 0))))


def test_small_groups_stay_whole(skewed):
    whole = Runs(skewed, BY, ORDER)
    assert not whole.split
    check(skewed, whole.shift("v", 1, "out"), F.lag("v").over(plain()))
