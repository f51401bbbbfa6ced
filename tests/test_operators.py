"""Edge cases of operators and functions on literal rows."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F, types as T

from sensorlake.functions import strings as X, times as C
from sensorlake.operators import aggregates as A, joins as J, reshape as H, rows as R, sets as S, timeseries as Z, udfs as U
from sensorlake.streaming.buckets import run_to_table, windowed
from sensorlake.streaming.online import online_ewm

NAN = float("nan")


def one(spark, c):
    return spark.range(1).select(c).first()[0]


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(2, "x"), (3, "y"), (None, "m")], "k int, r string")
    return left, right


@pytest.mark.parametrize(
    "how, want",
    [
        ("inner", {(2, "b", "x"), (2, "bb", "x")}),
        ("left", {(1, "a", None), (2, "b", "x"), (2, "bb", "x"), (None, "n", None)}),
        ("right", {(2, "b", "x"), (2, "bb", "x"), (3, None, "y"), (None, None, "m")}),
        ("full", {(1, "a", None), (2, "b", "x"), (2, "bb", "x"), (None, "n", None), (3, None, "y"), (None, None, "m")}),
        ("left_semi", {(2, "b"), (2, "bb")}),
        ("left_anti", {(1, "a"), (None, "n")}),
        ("right_semi", {(2, "x")}),
        ("right_anti", {(3, "y"), (None, "m")}),
    ],
)
def test_joins(sides, how, want):
    rows = [tuple(r) for r in J.join(*sides, ["k"], how).collect()]
    assert set(rows) == want and len(rows) == len(want)


@pytest.mark.parametrize("cut", [0, 2])
@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 2])
def test_asof(spark, direction, tolerance, cut):
    left = pd.DataFrame({"g": list("aaaabb"), "t": [1, 5, 10, 20, 3, 7], "v": range(6)})
    right = pd.DataFrame({"g": list("aaabbb"), "t": [2, 5, 9, 1, 8, 30], "w": [1.0, 2, 3, 4, 5, 6]})
    got = J.asof_join(spark.createDataFrame(left), spark.createDataFrame(right), "t", ["g"], direction, tolerance, rows_per_run=cut).toPandas()
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("t"), on="t", by="g", direction=direction, tolerance=tolerance)
    order = ["g", "t"]
    pd.testing.assert_frame_equal(got.sort_values(order).reset_index(drop=True), want.sort_values(order).reset_index(drop=True), check_dtype=False)


def test_asof_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, 5, 1), ("a", None, 2)], "g string, t int, v int")
    right = spark.createDataFrame([(None, 4, 1.0), ("a", 1, 2.0)], "g string, t int, w double")
    assert [r.w for r in J.asof_join(left, right, "t", ["g"]).collect()] == [None, None]


def test_range_join(spark):
    points = spark.createDataFrame([(i,) for i in range(10)], "x int")
    spans = spark.createDataFrame([("a", 0, 3), ("b", 2, 25), ("c", 9, 9), ("d", 5, 6)], "n string, lo int, hi int")
    got = J.range_join(points, spans, "x", "lo", "hi", width=4)
    assert {(r.x, r.n) for r in got.collect()} == {(x, n) for x in range(10) for n, a, b in [("a", 0, 3), ("b", 2, 25), ("d", 5, 6)] if a <= x < b}
    assert got.count() == 3 + 8 + 1


def test_missing_values_sort_last(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, NAN), (3, None), (4, 1.0)], "i int, v double")
    for way, first in (("asc", [4, 1]), ("desc", [1, 4])):
        assert [r.i for r in S.sort(rows, [("v", way), "i"]).collect()][:2] == first
        assert {r.i for r in S.sort(rows, [("v", way), "i"], nulls="first").collect()[:2]} == {2, 3}


@pytest.mark.parametrize("way", ["asc", "desc"])
def test_top_k_all_ties(spark, way):
    rows = spark.createDataFrame([(v,) for v in [5, 5, 3, 3, 3, 1]], "v int")
    want = [5, 5, 3, 3, 3] if way == "desc" else [1, 3, 3, 3]
    assert sorted((r.v for r in S.top_k(rows, 3 if way == "desc" else 2, [("v", way)], ties="all").collect()), reverse=way == "desc") == want


@pytest.mark.parametrize("cut", [0, 3])
@pytest.mark.parametrize("kind", ["linear", "lower", "higher", "nearest", "midpoint"])
def test_quantiles(spark, kind, cut):
    pdf = pd.DataFrame({"g": ["a"] * 7 + ["b"] * 4 + ["c"], "v": [1.0, 5, 5, 2, 9, 9, 9, 4, 3, 8, 1, 7]})
    qs = {f"q{i}": q for i, q in enumerate((0.0, 0.25, 0.5, 0.9, 1.0))}
    got = A.quantiles(spark.createDataFrame(pdf), ["g"], "v", qs, kind, rows_per_run=cut).toPandas().set_index("g")
    for name, q in qs.items():
        want = pdf.groupby("g")["v"].apply(lambda s: s.quantile(q, interpolation=kind))
        assert got[name].sort_index().to_dict() == pytest.approx(want.to_dict())


def test_statistics_without_spread(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert A.correlate(rows, "a", "b").first()[0] is None
    out = A.aggregate(rows, [], {"s": ("a", "skew"), "k": ("a", "kurt"), "m": ("a", "sem")}).first()
    assert out.m == 0


def test_pivot_wider_errors(spark):
    rows = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0), (2, "z", 3.0)], "k int, n string, v double")
    with pytest.raises(Exception, match="more than one value"):
        A.pivot_wider(rows, ["k"], "n", "v", ["x"]).collect()
    with pytest.raises(Exception, match="unexpected name"):
        A.pivot_wider(rows, ["k"], "n", "v", ["x"], "error").collect()


def test_bins(spark):
    values = [0.0, 1.0, 1.5, 2.0, 4.0, 10.0, None]
    pdf = pd.Series(values)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for right in (True, False):
        got = [r.b for r in df.select("i", H.cut("v", H.equal_width_edges(df, "v", 4, right), right, labels=[0, 1, 2, 3]).alias("b")).orderBy("i").collect()]
        want = pd.cut(pdf, 4, right=right, labels=False)
        assert [NAN if g is None else g for g in got] == pytest.approx(list(want), nan_ok=True)
    got = [r.bin for r in H.qcut(df, "v", 3).orderBy("i").collect()]
    assert [NAN if g is None else g for g in got] == pytest.approx(list(pd.qcut(pdf, 3, labels=False)), nan_ok=True)


def test_modulo_follows_the_divisor(spark):
    for a, b in ((-7, 3), (7, -3), (7, 3), (-7, -3)):
        assert one(spark, R.modulo(F.lit(a), F.lit(b))) == a % b
        assert one(spark, R.floor_divide(F.lit(a), F.lit(b))) == a // b


TEXTS = ["", "Hello World", "they're BILL's", "ßtraße ÄÖ", "  a b\t", "12", "²", "½", "Ab Cd", "aB", "x.y.z", "-5", "+42"]


@pytest.mark.parametrize(
    "name, ours, theirs",
    [
        ("upper", X.upper, str.upper),
        ("casefold", X.casefold, str.casefold),
        ("title", X.title, str.title),
        ("capitalize", X.capitalize, str.capitalize),
        ("swapcase", X.swapcase, str.swapcase),
        ("strip", X.strip, str.strip),
        ("centre", lambda c: X.pad(c, 8, "both", "*"), lambda t: t.center(8, "*")),
        ("zfill", lambda c: X.zfill(c, 5), lambda t: t.zfill(5)),
        ("find", lambda c: X.find(c, "l"), lambda t: t.find("l")),
        ("rfind", lambda c: X.rfind(c, "l"), lambda t: t.rfind("l")),
        ("split", X.split, str.split),
        ("split dot", lambda c: X.split(c, ".", 1), lambda t: t.split(".", 1)),
        ("rsplit", lambda c: X.rsplit(c, ".", 1), lambda t: t.rsplit(".", 1)),
        ("partition", lambda c: X.partition(c, "."), lambda t: list(t.partition("."))),
        ("rpartition", lambda c: X.rpartition(c, "."), lambda t: list(t.rpartition("."))),
        ("slice", lambda c: X.slice(c, 1, -1), lambda t: t[1:-1]),
        ("slice step", lambda c: X.slice(c, 0, None, 2), lambda t: t[::2]),
        ("slice_replace", lambda c: X.slice_replace(c, 1, 3, "_"), lambda t: t[:1] + "_" + t[3:]),
        ("removesuffix", lambda c: X.removesuffix(c, "ld"), lambda t: t.removesuffix("ld")),
        *[(n, lambda c, n=n: X.is_class(c, n), lambda t, n=n: getattr(t, f"is{n}")()) for n in X.CLASSES],
    ],
)
def test_text(spark, name, ours, theirs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = [r[1] for r in df.select("i", ours(F.col("t"))).orderBy("i").collect()]
    assert dict(zip(TEXTS, got)) == {t: theirs(t) for t in TEXTS}


def test_slug(spark):
    for text, want in (("Été à  Paris!", "ete-a-paris"), ("it's 1,000 m", "it-s-1000-m"), ("--", "")):
        assert one(spark, X.slug(F.lit(text))) == want


OFFSETS = {
    "month_begin": pd.offsets.MonthBegin, "month_end": pd.offsets.MonthEnd, "quarter_begin": lambda n: pd.offsets.QuarterBegin(n, startingMonth=1),
    "quarter_end": lambda n: pd.offsets.QuarterEnd(n, startingMonth=3), "year_begin": pd.offsets.YearBegin, "year_end": pd.offsets.YearEnd,
}


def test_calendar_steps(spark):
    days = [dt.datetime(2024, 1, 1, 3) + dt.timedelta(days=i) for i in range(0, 400, 3)] + [dt.datetime(2024, 12, 31), dt.datetime(2024, 2, 29), dt.datetime(2023, 9, 30)]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    for n in (1, 3):
        for name, offset in OFFSETS.items():
            got = {r.d: r[1] for r in df.select("d", getattr(C, name)("d", n)).collect()}
            assert got == {d: (pd.Timestamp(d) + offset(n)).to_pydatetime() for d in days}, name
    for n in (-8, -5, -1, 1, 4, 5, 11):
        got = {r.d: r[1] for r in df.select("d", C.business_days("d", n)).collect()}
        assert got == {d: (pd.Timestamp(d) + pd.offsets.BDay(n)).to_pydatetime() for d in days}, n


@pytest.mark.parametrize("how", ["floor", "ceil", "round"])
def test_round_time(spark, how):
    times = [dt.datetime(2024, 1, 1, 0, 7, 30), dt.datetime(2024, 1, 1, 0, 22, 30), dt.datetime(2024, 1, 1, 0, 15), dt.datetime(1969, 12, 31, 23, 59, 59, 5)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = {r.t: r[1] for r in df.select("t", getattr(C, how)("t", "15min")).collect()}
    assert got == {t: getattr(pd.Timestamp(t), how)("15min").to_pydatetime() for t in times}


def test_interpolate_ends(spark):
    rows = [(1, 0, None), (1, 1, 2.0), (1, 3, None), (1, 5, 6.0), (1, 6, None)]
    df = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), v) for k, h, v in rows], "k int, t timestamp_ntz, v double")
    assert [r.v for r in Z.interpolate(df, "v", "t", ["k"]).orderBy("t").collect()] == [None, 2.0, 4.0, 6.0, 6.0]


def test_group_combine_in_batches(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("CAST(id % 3 AS INT) AS k", "id AS v")

    def part(pdf):
        return pd.DataFrame({"k": [pdf["k"].iloc[0]], "n": [len(pdf)], "s": [pdf["v"].sum()]}).astype({"n": "int64", "s": "int64"})

    def merge(pdf):
        return pd.DataFrame({"k": [pdf["k"].iloc[0]], "n": [pdf["n"].sum()], "s": [pdf["s"].sum()]})

    got = {r.k: (r.n, r.s) for r in U.group_combine(df, ["k"], part, merge, "k int, n long, s long").collect()}
    assert got == {k: (len(range(k, 5000, 3)), sum(range(k, 5000, 3))) for k in range(3)}


def test_late_rows_are_dropped(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, ts timestamp_ntz, v double")

    def land(name, times):
        rows = [(1, dt.datetime(2024, 1, 1, h, m), 1.0) for h, m in times]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "src" / name))

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "src"))
        out = windowed(stream, "ts", ["k"], "1 hour", {"n": ("v", "count")}, lateness="30 minutes")
        return {r.start.hour: r.n for r in run_to_table(spark, out, str(tmp_path / "out"), str(tmp_path / "ck")).collect()}

    land("a", [(1, 5), (1, 30), (4, 0)])
    run()
    land("b", [(1, 59), (4, 10), (7, 0)])  # the first of these is too late
    assert run() == {1: 2, 4: 2}


def test_online_mean_goes_on(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, t int, v double")
    data = [(k, t, None if t == 3 else float(k + t)) for k in (1, 2) for t in range(8)]
    for i, part in enumerate((data[:6] + data[8:11], data[6:8] + data[11:])):
        spark.createDataFrame(part, schema).write.parquet(str(tmp_path / "src" / str(i)))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "src"))
        q = online_ewm(stream, "v", 0.4, ["k"], ["t"], adjust=False).writeStream.format("parquet")
        q.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = {(r.k, r.t): r.ewm for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    pdf = pd.DataFrame(data, columns=["k", "t", "v"])
    pdf["want"] = pdf.groupby("k")["v"].transform(lambda s: s.ewm(alpha=0.4, adjust=False).mean())
    assert got == pytest.approx({(r.k, r.t): r.want for r in pdf.itertuples()})


def test_exact_arithmetic_labels_and_times(spark):
    from sensorlake.functions import nested, times
    from sensorlake.operators import aggregates, reshape, rows

    df = spark.createDataFrame([(2**60 + 1, 7), (-7, 2), (7, -2), (7, 0)], "a long, b long")
    got = [tuple(r) for r in df.select(rows.modulo(F.col("a"), F.col("b")), rows.floor_divide(F.col("a"), F.col("b"))).collect()]
    assert got == [((2**60 + 1) % 7, (2**60 + 1) // 7), (1, -4), (-1, -4), (None, None)]
    bins = spark.range(1).select(reshape.cut(F.lit(1234.5615), [1234.561, 1234.562, 1234.563]).alias("a"), reshape.cut(F.lit(1234.5625), [1234.561, 1234.562, 1234.563]).alias("b")).first()
    assert bins.a != bins.b
    seen = spark.createDataFrame([("k", "2024-01-01", 1), ("k", "2024-01-02", 3), ("k", "2024-01-02", 2)], "k string, t string, n int").withColumn("t", F.to_timestamp("t"))
    assert aggregates.aggregate(seen, ["k"], {"at": ("t", "argmax", {"of": "n"})}).first()["at"] == 2
    clock = spark.createDataFrame([("2:30:15PM",), ("0230PM",), ("14:30",), ("143015",), ("2:30 PM",), ("nope",)], "s string")
    assert [r[0] for r in clock.select(times.parse_time("s")).collect()] == [52215, 52200, 52200, 52215, 52200, None]
    assert spark.range(1).select(nested.json_avg(F.lit("[]"))).first()[0] is None


def test_extremes_of_text_and_nan(spark):
    from sensorlake.operators import aggregates, sets

    nan = float("nan")
    df = spark.createDataFrame([("k", "b", 2, 1.0), ("k", "c", 9, nan), ("k", "c", 4, 3.0), ("k", None, 1, 3.0)], "k string, t string, n int, v double")
    spec = {"a": ("t", "argmax", {"of": "n"}), "b": ("v", "argmax", {"of": "t"}), "c": ("v", "argmax", {"of": "n"}), "d": ("t", "argmin", {"of": "n"})}
    assert aggregates.aggregate(df, ["k"], spec).first().asDict() == {"k": "k", "a": 4, "b": "c", "c": 1, "d": 2}
    assert aggregates.aggregate(df, [], {"b": ("v", "argmax", {"of": "t"})}).first()["b"] == "c"
    rows = spark.createDataFrame([(1.0,), (2.0,), (nan,), (None,), (2.0,)], "v double")
    top = [r.v for r in sets.top_k(rows, 1, [("v", "desc")], ties="all").collect()]
    assert top == [2.0, 2.0]
    assert [r.v for r in sets.top_k(rows, 2, ["v"], ties="all").collect()].count(2.0) == 2
    assert sets.top_k(rows, 4, ["v"], ties="all").count() == 5  # NaN and NULL are equals, and last


def test_json_texts(spark):
    from sensorlake.functions import nested

    df = spark.createDataFrame([('["b", "a", "é"]',), ('[3, 1]',), ('["b", 1]',), ('[]',), ('nope',), (None,), ('["b", null]',)], "j string")
    got = [tuple(r) for r in df.select(nested.json_sort("j", "text"), nested.json_min("j", "text"), nested.json_max("j", "text")).collect()]
    assert got == [(["a", "b", "é"], "a", "é"), (None, None, None), (None, None, None), ([], None, None), (None, None, None), (None, None, None), (None, None, None)]
    assert df.select(nested.json_sort("j")).collect()[1][0] == [1.0, 3.0]


@pytest.mark.parametrize("kind", ["normal", "ties", "one", "long", "few"])
def test_bracketed_quantiles_are_exact(spark, kind, monkeypatch):
    import numpy as np

    from sensorlake.operators import aggregates as A

    monkeypatch.setattr(A, "ACCURACY", 100)  # brackets of a few rows, at this size
    rng = np.random.default_rng(5)
    n = 4 if kind == "few" else 5000
    x = {"normal": rng.normal(size=n), "ties": rng.integers(0, 5, n), "one": np.full(n, 3.0), "long": rng.integers(-(2**62), 2**62, n), "few": np.arange(n)}[kind]
    whole = kind in ("long", "ties", "few")
    df = spark.createDataFrame([(int(v) if whole else float(v), None if i % 3 else float(i)) for i, v in enumerate(x)], f"x {'long' if whole else 'double'}, y double")
    qs = {f"q{i}": (q, k) for i, (q, k) in enumerate((q, k) for q in (0.0, 0.013, 0.5, 0.9, 1.0) for k in ("linear", "lower", "higher", "nearest", "midpoint"))}
    got = {r["column"]: r for r in A.bracketed_quantiles(df, {"x": F.col("x").cast("double"), "y": F.col("y")}, qs).collect()}
    y = np.arange(0, n, 3, dtype=float)
    for col, values in (("x", x.astype(float)), ("y", y)):
        for out, (q, k) in qs.items():
            assert got[col][out] == pytest.approx(np.quantile(values, q, method=k), rel=1e-9), (col, out, q, k)
    exact = A.quantiles(df, [], "x", {"lo": (0.3, "lower"), "hi": (0.3, "higher")}).first()
    assert (exact["lo"], exact["hi"]) == tuple(np.sort(x)[[math.floor(0.3 * (n - 1)), math.ceil(0.3 * (n - 1))]])
    # Little more than the brackets is left after the filter.
    none = A.bracketed_quantiles(df.where("x is null"), {"x": F.col("x")}, {"m": 0.5}).collect()
    assert [tuple(r) for r in none] == [("x", None)]


def test_describe_in_one_pass(spark):
    from sensorlake.operators import aggregates as A

    df = spark.createDataFrame([(i, None if i % 2 else float(i), None) for i in range(10)], "a int, b double, c double")
    got = {r["column"]: r.asDict() for r in A.describe(df, ["a", "b", "c"]).collect()}
    assert got["a"] | {"std": 0} == {"column": "a", "count": 10, "mean": 4.5, "std": 0, "min": 0.0, "max": 9.0, "p25": 2.25, "p50": 4.5, "p75": 6.75}
    assert got["b"]["p50"] == 4.0 and got["c"]["count"] == 0 and got["c"]["p50"] is None
    assert "Unpivot" not in A.describe(df, ["a", "b"])._jdf.queryExecution().toString()


def test_spine_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(Z, "STRETCH", 7)
    t = dt.datetime(2024, 2, 28, 23, 59, 59, 250_000)
    rows = [("a", t), ("a", t + dt.timedelta(seconds=100.7)), ("b", t), (None, t + dt.timedelta(days=3)), (None, t), ("c", None)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz")
    got = Z.spine(df, "t", "900 milliseconds", ["k"]).collect()
    want = {("a", t + dt.timedelta(seconds=0.9 * i)) for i in range(112)} | {("b", t)} | {(None, t + dt.timedelta(seconds=0.9 * i)) for i in range(288_001)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    days = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 5),)], "d date")
    assert sorted(r.d.day for r in Z.spine(days, "d", "1 day", []).collect()) == [1, 2, 3, 4, 5]


def test_twenty_four_years_by_the_second(spark):
    # 757 million steps of one group: no row and no task holds them.
    ends = spark.createDataFrame([(dt.datetime(2000, 1, 1),), (dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    n, last = Z.spine(ends, "t", "1 second", []).agg(F.count(F.lit(1)), F.max("t")).first()
    assert (n, last) == (24 * 365 * 86400 + 6 * 86400 + 1, dt.datetime(2024, 1, 1))


def test_aggregate_in_parts(spark):
    import numpy as np
    import pyarrow as pa

    def part(table: pa.Table) -> dict:
        v = table["v"].drop_null().to_numpy()
        return {"n": len(v), "s": float(v.sum()), "tasks": [f"{len(v)}"]}

    def merge(a: dict, b: dict) -> dict:
        return {"n": a["n"] + b["n"], "s": a["s"] + b["s"], "tasks": sorted(a["tasks"] + b["tasks"])}

    mean = U.Aggregate(part, merge, lambda s: s["s"] / s["n"] if s["n"] else None, "n long, s double, tasks array<string>")
    parts = U.Aggregate(part, merge, lambda s: s["n"], "n long, s double, tasks array<string>", "long")
    rows = [("hot" if i % 50 else None, None if i % 7 == 0 else float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(16)
    got = {r.k: (r.mean, r.n) for r in U.group_aggregate(df, ["k"], ["v"], {"mean": mean, "n": parts}, salts=3).collect()}
    for k in ("hot", None):
        v = [x for key, x in rows if key == k and x is not None]
        assert got[k] == (pytest.approx(np.mean(v)), len(v))
    # A key with all rows is worked on in many tasks: every part of the table makes a state of its own.
    by_task = lambda t: {"tasks": [str(TaskContext.get().partitionId())]}
    found = U.Aggregate(by_task, lambda a, b: {"tasks": sorted({*a["tasks"], *b["tasks"]})}, lambda s: len(s["tasks"]), "tasks array<string>", "int")
    assert U.group_aggregate(df.withColumn("k", F.lit("x")), ["k"], ["v"], {"tasks": found}).first()["tasks"] == 16
    assert U.group_aggregate(df.limit(0), ["k"], ["v"], {"mean": mean}).collect() == []


def test_merge_that_depends_on_the_cuts_is_refused(spark):
    halves = U.Aggregate(lambda t: {"m": t["v"].to_numpy().mean()}, lambda a, b: {"m": (a["m"] + b["m"]) / 2}, lambda s: s["m"], "m double")
    df = spark.createDataFrame([("x", float(i * i)) for i in range(100)], "k string, v double").coalesce(1)
    with pytest.raises(Exception, match="merge depends on how a group is cut"):
        U.group_aggregate(df, ["k"], ["v"], {"m": halves}).collect()


@pytest.mark.parametrize("k", [1, 700, 2999, 3000, 5000])
def test_large_k(spark, k, monkeypatch):
    import numpy as np

    monkeypatch.setattr(S, "SAMPLE", 300)
    rng = np.random.default_rng(3)
    x = [None if i % 40 == 0 else float("nan") if i % 41 == 0 else float(v) for i, v in enumerate(rng.integers(0, 60, 3000))]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x double")
    for way in ("asc", "desc"):
        sign = 1 if way == "asc" else -1
        order = sorted(range(3000), key=lambda i: (x[i] is None or x[i] != x[i], 0 if x[i] is None or x[i] != x[i] else sign * x[i], i))
        got = [r.i for r in S.top_k(df, k, [("x", way), "i"], one_task=50).collect()]
        assert got == order[:k]
    ties = S.top_k(df, k, ["x"], ties="all", one_task=50).count()
    edge = x[sorted(range(3000), key=lambda i: (x[i] is None or x[i] != x[i], x[i] if x[i] is not None and x[i] == x[i] else 0))[min(k, 3000) - 1]]
    missing = edge is None or edge != edge
    assert ties == (3000 if missing else sum(v is not None and v == v and v <= edge for v in x))


def test_large_k_of_equal_rows(spark):
    df = spark.range(2000).select(F.lit(1).alias("x"))
    assert S.smallest(df, 900, ["x"], one_task=50).count() == 900


@pytest.mark.parametrize("k", [1, 200, 201, 1900, 2399])
def test_large_k_among_many_equal_rows(spark, k, monkeypatch):
    """Nine tenths of the rows are equal in full; those before and after them are not taken for them."""
    monkeypatch.setattr(S, "SAMPLE", 100)
    x = sorted([*range(200), *[500] * 2000, *range(600, 800)])
    df = spark.createDataFrame([(v,) for v in x], "x int").repartition(4)
    assert sorted(r.x for r in S.smallest(df, k, ["x"], one_task=50).collect()) == x[:k]


def test_keys_are_worked_out_once_per_scan(spark):
    """The filter of a large draw reads the draw from a column: digests are not repeated in every condition."""
    drawn = S.sample(spark.range(3000), fraction=0.4, seed=7, key=["id"], one_task=100)
    assert drawn.count() == 1200
    assert drawn._jdf.queryExecution().optimizedPlan().toString().count("md5") <= 2


def test_weights_decide_how_often_a_row_is_drawn(spark):
    df = spark.createDataFrame([(i, float(1 + 9 * (i % 2))) for i in range(4000)], "i int, w double")
    drawn = S.sample(df, n=400, weights="w", seed=5, key=["i"], one_task=100)
    heavy = drawn.where("w = 10").count()
    assert drawn.count() == 400 and 330 < heavy < 395  # ten times the weight: about 364 of 400
    again = S.sample(df.repartition(7), n=400, weights="w", seed=5, key=["i"], one_task=100)
    assert {r.i for r in again.collect()} == {r.i for r in drawn.collect()}
    assert S.sample(df, n=150, seed=1, one_task=100).count() == 150
