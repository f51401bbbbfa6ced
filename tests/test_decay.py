"""Exponential statistics against pandas, whole and cut, and the mean that goes on between batches."""

import itertools
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from sensorlake.operators import decay as D
from sensorlake.operators import windows as W
from sensorlake.streaming.online import online_ewm


def made(n=300):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.7, "hot", "b"), "t": rng.permutation(n), "x": rng.normal(1000, 2, n), "y": rng.normal(size=n)})
    pdf["y"] += (pdf["x"] - 1000) / 2
    pdf.loc[rng.random(n) < 0.25, "x"] = np.nan
    pdf.loc[rng.random(n) < 0.15, "y"] = np.nan
    pdf.loc[pdf["t"] < 4, "x"] = np.nan
    return pdf.sort_values("t").reset_index(drop=True)


def spark_frame(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x", "y")}).cache()


@pytest.fixture(scope="module")
def frame(spark):
    pdf = made()
    return spark_frame(spark, pdf), pdf


CASES = [(fn, adjust, ignore) for fn, adjust, ignore in itertools.product(D.FUNCTIONS, (True, False), (True, False))]


@pytest.mark.parametrize("fn, adjust, ignore_na", CASES)
def test_against_pandas(frame, fn, adjust, ignore_na):
    df, pdf = frame
    other = "y" if fn in ("cov", "corr") else None

    def want(g):
        e = g["x"].ewm(alpha=0.2, adjust=adjust, ignore_na=ignore_na, min_periods=3)
        return getattr(e, fn)(g["y"]) if other else getattr(e, fn)()

    for cut in (0, 20):
        got = W.ewm(df, "x", 0.2, ["k"], ["t"], adjust, "out", fn, other, ignore_na, min_periods=3, rows_per_run=cut)
        got = got.toPandas().sort_values("t").set_index("t")["out"].astype(float)
        expected = pd.concat([want(g.set_index("t")) for _, g in pdf.groupby("k")]).sort_index()
        np.testing.assert_allclose(got, expected, rtol=1e-7, atol=1e-9)


@pytest.mark.parametrize("fn", ["var", "cov"])
def test_biased(frame, fn):
    df, pdf = frame
    other = "y" if fn == "cov" else None
    got = W.ewm(df, "x", 0.5, [], ["t"], out="out", fn=fn, other=other, bias=True, rows_per_run=25).toPandas().sort_values("t")["out"].astype(float)
    e = pdf["x"].ewm(alpha=0.5)
    np.testing.assert_allclose(got, e.cov(pdf["y"], bias=True) if other else e.var(bias=True), rtol=1e-7, atol=1e-9)


def test_all_weight_on_the_last(frame):
    df, pdf = frame
    got = W.ewm(df, "x", 1.0, [], ["t"], out="out", rows_per_run=25).toPandas().sort_values("t")["out"].astype(float)
    np.testing.assert_allclose(got, pdf["x"].ffill())
    with pytest.raises(ValueError):
        W.ewm(df, "x", 0.0, [], ["t"])
    with pytest.raises(ValueError):
        W.ewm(df, "x", 0.5, [], ["t"], fn="cov")


def test_runs_chain_to_the_same_state():
    rng = np.random.default_rng(9)
    for adjust, ignore in itertools.product((True, False), (True, False)):
        decay = D.Decay(0.15, adjust, ignore)
        x, y = rng.normal(50, 1, 200), rng.normal(size=200)
        x[rng.random(200) < 0.4] = np.nan
        x[:7] = np.nan
        whole = decay.after(D.State(), decay.summary(x, y)).numbers()
        for cuts in ([3, 9, 10, 150], [1], [100, 101, 102], [199]):
            now = D.State()
            for a, b in zip(np.split(x, cuts), np.split(y, cuts)):
                now = decay.after(now, decay.summary(a, b))
            np.testing.assert_allclose(now.numbers(), whole, rtol=1e-9)


def test_line_scan():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5, 64, 77):
        a, b = rng.random(n), rng.normal(size=n)
        s, want = 3.0, []
        for i in range(n):
            s = a[i] * s + b[i]
            want.append(s)
        np.testing.assert_allclose(D.line_scan(a, b, 3.0), want)


class Stream:
    """Files landed one after the other, worked through by one query each."""

    def __init__(self, spark, tmp_path, schema, **kw):
        self.spark, self.path, self.schema, self.kw, self.n = spark, tmp_path, T.StructType.fromDDL(schema), kw, 0

    def land(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(str(self.path / "src" / str(self.n)))
        self.n += 1
        stream = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(str(self.path / "src"))
        sink = online_ewm(stream, "v", 0.4, **self.kw).writeStream.format("parquet").option("path", str(self.path / "out"))
        query = sink.option("checkpointLocation", str(self.path / "ck")).trigger(availableNow=True).start()
        if not query.awaitTermination(60):
            query.stop()
            raise AssertionError("the stream does not end")

    def result(self, *key):
        return {tuple(r[c] for c in key): r["ewm"] for r in self.spark.read.parquet(str(self.path / "out")).collect()}


def test_a_hot_key_in_many_chunks(spark, tmp_path, monkeypatch):
    # Small Arrow batches: a key's rows come in chunks, some of which overlap in order.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = np.random.default_rng(2)
        data = [("hot" if i % 5 else None, i, None if i % 6 == 0 else float(rng.normal())) for i in range(120)]
        stream = Stream(spark, tmp_path, "k string, t int, v double", by=["k"], order=["t"], ignore_na=False)
        stream.land([data[i] for i in [*range(0, 20), *range(40, 50), *range(20, 40), *rng.permutation(range(50, 80)).tolist()]])
        stream.land(data[80:])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = stream.result("k", "t")
    pdf = pd.DataFrame(data, columns=["k", "t", "v"])
    want = pdf.groupby("k", dropna=False)["v"].transform(lambda s: s.ewm(alpha=0.4).mean())
    assert len(got) == 120
    for (k, t, _), w in zip(data, want):
        assert (got[k, t] is None) == (w != w) and (w != w or got[k, t] == pytest.approx(w)), (k, t)


def seconds(n):
    return datetime(2024, 1, 1) + timedelta(seconds=n)


def test_state_expires_and_late_rows_are_dropped(spark, tmp_path):
    stream = Stream(spark, tmp_path, "k string, t timestamp_ntz, v double", by=["k"], order=["t"], time="t", lateness="10 seconds", idle="60 seconds")
    stream.land([("a", seconds(0), 1.0), ("b", seconds(0), 1.0)])
    stream.land([("a", seconds(30), 3.0)])
    stream.land([("c", seconds(100), 5.0)])  # the watermark is at 90 then: past a's and b's times
    stream.land([("a", seconds(20), 99.0), ("a", seconds(95), 7.0), ("b", seconds(95), 9.0), ("c", seconds(105), 6.0)])
    got = stream.result("k", "t")
    goes_on = pd.Series([5.0, 6.0]).ewm(alpha=0.4).mean()[1]
    assert ("a", seconds(20)) not in got  # later than the watermark
    assert got["a", seconds(30)] == pytest.approx(pd.Series([1.0, 3.0]).ewm(alpha=0.4).mean()[1])
    assert got["b", seconds(95)] == 9.0 and got["c", seconds(105)] == pytest.approx(goes_on)
    # b was idle from 0 to 95, past its minute, and starts anew; a, last seen at 30, expires at 90 as well.
    assert got["a", seconds(95)] == 7.0


def test_state_expires_by_the_clock(spark, tmp_path):
    import time

    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # else a run by the clock never ends
    try:
        stream = Stream(spark, tmp_path, "k int, t int, v double", by=["k"], order=["t"], ttl="2 seconds")
        stream.land([(1, 0, 1.0)])
        time.sleep(3)
        stream.land([(1, 1, 3.0), (1, 2, 5.0)])
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    got = stream.result("k", "t")
    assert got[1, 1] == 3.0 and got[1, 2] == pytest.approx(pd.Series([3.0, 5.0]).ewm(alpha=0.4).mean()[1])


@pytest.mark.parametrize("adjust", [True, False])
@pytest.mark.parametrize("ignore_na", [True, False])
def test_many_runs_at_once(adjust, ignore_na):
    rng, decay = np.random.default_rng(5), D.Decay(0.3, adjust, ignore_na)
    for _ in range(50):
        sizes = rng.integers(1, 9, rng.integers(1, 8))
        x = rng.normal(100, 1, sizes.sum())
        x[rng.random(len(x)) < 0.4] = np.nan
        begins = np.cumsum([0, *sizes[:-1]])
        states = [D.State() if i % 3 == 0 else decay.after(D.State(), decay.summary(v, v)) for i, v in enumerate(np.where(rng.random((len(sizes), 4)) < 0.4, np.nan, 2.0))]
        lines, means = decay.summaries(x, begins), decay.means(x, begins, np.array([s.numbers() for s in states]))
        for line, s, a, n in zip(lines, states, begins, sizes):
            own = x[a : a + n]
            np.testing.assert_allclose(line[:10], decay.summary(own, own)[:10], rtol=1e-9)
            rows = decay.rows(own, own, s)
            np.testing.assert_allclose(means[a : a + n], np.where(rows["n"] > 0, rows["mean"], np.nan), rtol=1e-9)


def test_small_keys_share_the_work(spark, tmp_path, monkeypatch):
    # Chunks do not end with the Arrow batch: 3 rows a batch, and yet one chunk for each of 40 keys and task.
    from sensorlake.streaming import online

    schema = pa.schema([("k", pa.int32()), ("t", pa.int32()), ("v", pa.float64())])
    data = [(i % 40, i, None if i % 7 == 0 else float(i % 11)) for i in range(400)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*data[i : i + 3]), schema)], schema=schema) for i in range(0, 400, 3)]
    chunks = online.Chunks(["k"], ["t"], "v", None, ["k", "t", "v"], schema, D.Decay(0.4))
    assert sum(b.num_rows for b in chunks.pack(iter(batches))) == 40
    monkeypatch.setattr(online, "CUT_ROWS", 50)
    packed = [r for b in chunks.pack(iter(batches)) for r in b.to_pylist()]
    assert len(packed) > 40 and sum(chunks.opened(r["__chunk"], online.LINE).num_rows for r in packed) == 400
    # Rows of a key come in several chunks, out of order; null is a key like others.
    data = [(k or None, t, v) for k, t, v in data]
    stream = Stream(spark, tmp_path, "k int, t int, v double", by=["k"], order=["t"])
    stream.land([data[i] for i in np.random.default_rng(1).permutation(200)])
    stream.land(data[200:])
    got = stream.result("k", "t")
    want = pd.DataFrame(data, columns=["k", "t", "v"]).groupby("k", dropna=False)["v"].transform(lambda s: s.ewm(alpha=0.4).mean())
    assert len(got) == 400
    for (k, t, _), w in zip(data, want):
        assert (got[k, t] is None) == (w != w) and (w != w or got[k, t] == pytest.approx(w)), (k, t)


def test_no_keys_and_wrong_arguments(spark, tmp_path):
    stream = Stream(spark, tmp_path, "t int, v double", by=[], order=["t"], adjust=False)
    stream.land([(0, 1.0), (1, 2.0)])
    stream.land([(2, 4.0)])
    want = pd.Series([1.0, 2.0, 4.0]).ewm(alpha=0.4, adjust=False).mean()
    assert stream.result("t") == pytest.approx({(i,): w for i, w in enumerate(want)})
    with pytest.raises(ValueError):
        online_ewm(spark.readStream.schema("t int, v double").parquet(str(tmp_path / "src")), "v", 0.4, [], ["t"], idle="1 hour")
