"""Small groups in batches: the same as one by one."""

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorlake.operators import udfs as U, windows as W
from sensorlake.operators.groups import FIRST, whole_groups


@pytest.fixture()
def rows(spark):
    day = dt.date(2024, 1, 1)
    made = [
        (None if i % 11 == 0 else i % 7, None if i % 13 == 0 else float(i % 2), i, None if i % 7 == 3 and i % 2 else 2**53 + i, None if i % 9 == 0 else i % 4 > 1, f"t{i}", day)
        for i in range(300)
    ]
    return spark.createDataFrame(made, "a int, b double, i long, big long, flag boolean, t string, d date").repartition(5)


@pytest.mark.parametrize("size", [10_000, 7])
def test_groups_look_as_they_would_alone(spark, rows, size):
    def seen(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i").reset_index(drop=True)
        kinds = ",".join(f"{c}:{k}" for c, k in pdf.dtypes.items())
        return pdf[["i"]].assign(n=len(pdf), kinds=kinds, last=str(pdf["big"].iloc[-1]), flags=str(list(pdf["flag"])), total=float(pdf["big"].max()))

    schema = "i long, n long, kinds string, last string, flags string, total double"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        for by in (["a"], ["a", "b"], ["b", "flag"]):
            got = U.group_apply(rows, by, seen, schema).collect()
            want = rows.groupBy(*by).applyInPandas(seen, schema).collect()
            assert len(got) == 300 and sorted(map(str, got)) == sorted(map(str, want))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_small_groups_reach_a_task_together(spark, rows):
    made = U.group_apply(rows, ["i"], lambda pdf: pdf[["i"]], "i long")
    plan = made._jdf.queryExecution().toString()
    assert "MapInPandas" in plan and "FlatMapGroupsInPandas" not in plan
    assert {r.i for r in made.collect()} == set(range(300))


def test_results_of_groups_keep_their_types(spark, rows):
    """One group gives whole numbers above 2^53, another NULLs, a third no rows, a fourth no columns."""

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        a = pdf["a"].iloc[0]
        if a == 1:
            return pdf[["i"]].assign(v=None)
        if a == 2:
            return pdf.iloc[:0][["i"]].assign(v=pdf["i"].iloc[:0])
        if a == 4:
            return pd.DataFrame()
        return pdf[["i"]].assign(v=pdf["i"] + 2**60)

    got = {(r.i, r.v) for r in U.group_apply(rows, ["a"], pick, "i long, v long").collect()}
    want = {(r.i, r.v) for r in rows.groupBy("a").applyInPandas(pick, "i long, v long").collect()}
    assert got == want and (3, 2**60 + 3) in got and all(v is None or v > 2**60 - 1 for _, v in got)


def test_names_or_places_of_result_columns(spark, rows):
    turned = U.group_apply(rows, ["a"], lambda pdf: pdf[["t", "i"]], "i long, t string")
    assert {(r.i, r.t) for r in turned.collect()} == {(i, f"t{i}") for i in range(300)}
    placed = U.group_apply(rows, ["a"], lambda pdf: pd.DataFrame({0: pdf["i"], 1: pdf["t"]}), "i long, t string")
    assert {(r.i, r.t) for r in placed.collect()} == {(i, f"t{i}") for i in range(300)}
    for bad in (lambda pdf: pdf[["i", "t", "a"]], lambda pdf: pdf[["i", "a"]], lambda pdf: 3):
        with pytest.raises(Exception):
            U.group_apply(rows, ["a"], bad, "i long, t string").collect()


def test_key_and_group(spark, rows):
    made = U.group_apply(rows, ["a"], lambda key, pdf: pd.DataFrame({"a": [key[0]], "n": [len(pdf)]}), "a double, n long")
    assert sum(r.n for r in made.collect()) == 300
    nested = rows.withColumn("s", F.array("i"))
    assert U.group_apply(nested, ["a"], lambda pdf: pdf[["i"]], "i long").count() == 300


def test_groups_as_tables(spark, rows):
    def part(table: pa.Table) -> pa.Table:
        return pa.table({"n": pa.array([table.num_rows] * table.num_rows), "i": table["i"], "none": pa.nulls(table.num_rows) if table["a"][0].as_py() == 2 else table["big"]})

    made = U.group_apply(rows, ["a"], part, "i long, n int, none long")
    assert "FlatMapGroups" not in made._jdf.queryExecution().toString()
    want = {(r.i, r.n, r.v) for r in rows.selectExpr("i", "count(*) over (partition by a) AS n", "CASE WHEN a = 2 THEN NULL ELSE big END AS v").collect()}
    assert {tuple(r) for r in made.collect()} == want


def test_groups_over_batches():
    lengths = [3, 1, 40, 2, 9]
    first = [k == 0 for n in lengths for k in range(n)]
    table = pa.table({"g": [g for g, n in enumerate(lengths) for _ in range(n)], FIRST: first})
    for size in (1, 2, 5, 100):
        got = [part["g"].slice(a, b - a).to_pylist() for part, ends in whole_groups(iter(table.to_batches(size))) for a, b in ends]
        assert got == [[g] * n for g, n in enumerate(lengths)]


@pytest.mark.parametrize("cut", [0, 25])
@pytest.mark.parametrize("size", [10_000, 6])
def test_exponential_of_small_groups(spark, size, cut):
    """Groups of 1 to 60 rows, one with a NULL key, in batches that end inside them."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame([(k, t, None if rng.random() < 0.2 else float(rng.normal()), float(rng.normal())) for k in range(30) for t in range(1 + 2 * k)], columns=list("ktxy"))
    want = pdf.groupby("k")[["x", "y"]].apply(lambda g: g["x"].ewm(alpha=0.3).cov(g["y"])).droplevel(0)
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x"))).withColumn("k", F.when(F.col("k") != 7, F.col("k"))).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        made = W.ewm(df, "x", 0.3, ["k"], ["t"], out="c", fn="cov", other="y", rows_per_run=cut)
        assert "FlatMapGroupsInArrow" not in made._jdf.queryExecution().toString().split("Checkpoint")[0]
        got = made.toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got["k"] = got["k"].fillna(7).astype(int)
    got = got.sort_values(["k", "t"], ignore_index=True)
    assert len(got) == len(pdf)
    np.testing.assert_allclose(got["c"].astype(float), want.to_numpy(), rtol=1e-9, atol=1e-12)
