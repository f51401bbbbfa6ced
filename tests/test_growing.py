"""Quantiles and ranks of growing groups against pandas, whole, cut, and with one key that holds all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorlake.operators import growing as G
from sensorlake.operators.runs import RUN, Runs

BY, ORDER = ["k"], ["t"]
WANTED = {"med": ("quantile", 0.5), "low": ("quantile", 0.1), "top": ("quantile", 1.0), "rank": ("rank", 0.0)}


def made(kind: str, n: int = 3000) -> pd.DataFrame:
    rng = np.random.default_rng(7)
    t = rng.permutation(n)
    v = {
        "random": rng.normal(size=n), "rising": t + rng.normal(size=n), "falling": -t.astype(float),
        "ties": rng.integers(0, 4, n).astype(float), "one": np.where(rng.random(n) < 0.6, 5.0, rng.normal(5, 1, n)), "same": np.ones(n),
    }[kind]
    v = np.where(rng.random(n) < 0.15, np.nan, v)
    keys = np.where(rng.random(n) < 0.7, "hot", np.where(rng.random(n) < 0.5, "a", "b"))
    return pd.DataFrame({"k": keys, "t": t, "v": v})


def check(spark, pdf, by, min_periods=1, **kw):
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.col("t") % 2 == 0, F.nanvl("v", F.lit(None))).otherwise(F.col("v")))
    got = G.growing(df, "v", WANTED, by, ORDER, min_periods, **kw)
    assert set(got.columns) == {*pdf.columns, *WANTED}
    got = got.toPandas().sort_values("t").set_index("t")
    rows = pdf.sort_values("t").set_index("t")
    groups = rows.groupby("k") if by else [(0, rows)]
    for _, g in groups:
        e = g["v"].expanding(min_periods)
        for out, want in {"med": e.median(), "low": e.quantile(0.1), "top": e.quantile(1.0), "rank": e.rank()}.items():
            np.testing.assert_allclose(got.loc[g.index, out].astype(float), want, rtol=1e-12, err_msg=out)


@pytest.mark.parametrize("kind", ["random", "rising", "falling", "ties", "one", "same"])
def test_cut_groups(spark, kind):
    check(spark, made(kind), BY, rows_per_run=200)


def test_whole_groups(spark):
    check(spark, made("random", 600), BY, min_periods=5)
    check(spark, made("ties", 600), BY)


@pytest.mark.parametrize("kind", ["random", "one"])
def test_one_key_holds_all_rows(spark, kind):
    pdf = made(kind).assign(k="x")
    check(spark, pdf, BY, min_periods=7, rows_per_run=120)
    check(spark, pdf, [], rows_per_run=120)


def test_null_keys_and_no_values(spark):
    pdf = made("random", 900)
    pdf.loc[pdf["k"] == "a", "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    got = G.growing(df, "v", WANTED, BY, ORDER, rows_per_run=50).toPandas().sort_values("t").set_index("t")
    rows = pdf.sort_values("t").set_index("t")
    e = rows[rows["k"] == "hot"]["v"].expanding()
    np.testing.assert_allclose(got.loc[rows.index[rows["k"] == "hot"], "med"].astype(float), e.median())
    assert got.loc[rows.index[rows["k"] == "a"], ["med", "rank"]].isna().all().all()


def test_sampled_cuts_and_spread(spark):
    pdf = made("random", 6000).assign(k="x")
    check(spark, pdf, BY, rows_per_run=1000)
    # All rows of the one key are worked on in many tasks.
    cut = Runs(spark.createDataFrame(pdf), BY, ORDER, rows_per_run=1000)
    sizes = [r["count"] for r in cut.df.groupBy(RUN).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 1000
    bucketed = G._bucketed(cut.df.withColumn(G.VALUE, F.col("v")), cut, G._edges(cut.df.withColumn(G.VALUE, F.col("v")), cut))
    assert max(r["count"] for r in bucketed.where(f"{G.BUCKET} % 2 = 0").groupBy(G.BUCKET).count().collect()) < 600


def test_leads_are_as_many_as_the_rows(spark):
    # What is handed to the runs grows with the rows, not with rows times runs.
    pdf = made("random", 4000).assign(k="x")
    cut = Runs(spark.createDataFrame(pdf), BY, ORDER, rows_per_run=100)
    rows = cut.df.withColumn(G.VALUE, F.when(~F.isnan("v"), F.col("v")))
    steps = G.Steps(BY, ORDER, False, {"m": ("quantile", 0.5)}, 1)
    bucketed = G._bucketed(rows, cut, G._edges(rows, cut))
    counts = bucketed.groupBy(*BY, RUN, G.BUCKET).agg(F.count(G.VALUE).alias("n"), F.min(G.VALUE).alias("v"))
    schema = G.T.StructType([*[rows.schema[c] for c in (*BY, RUN)], *G.T.StructType.fromDDL(G.Steps.NOTES), G.T.StructField("reach", G.T.LongType())])
    plan = counts.groupBy(*BY).applyInArrow(lambda t: steps.plan(t), schema)
    sent = G._leads(bucketed, cut, plan, 1).agg(F.sum("a")).first()[0]
    assert sent < 2 * len(pdf)


def test_earlier_less():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 64, 101):
        v = rng.integers(0, 9, n).astype(float)
        assert G.earlier_less(v).tolist() == [int((v[:i] < v[i]).sum()) for i in range(n)]
        assert G.earlier_equal(v).tolist() == [int((v[:i] == v[i]).sum()) for i in range(n)]
        g = rng.integers(0, 4, n)
        assert G.earlier_less(v, g).tolist() == [int(((v < v[i]) & (g < g[i])).sum()) for i in range(n)]
