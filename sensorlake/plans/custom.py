"""Queries of user functions and of state kept between batches (C124-C129)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators import udfs as U
from sensorlake.plans.columns import gappy
from sensorlake.plans.landing import new_table
from sensorlake.plans.ordered import BY, ORDER, POSITIONS, events
from sensorlake.plans.registry import query, r, table
from sensorlake.session import scratch_dir
from sensorlake.sources.formats import write_table
from sensorlake.streaming.online import online_ewm


@query("c124_scalar_function", "SELECT event_id, round(value * 1.8 + 32, 6) AS f FROM events")
def scalar_function(spark: SparkSession, sf: str) -> DataFrame:
    name = new_table("fahrenheit")
    U.register(spark, name, lambda c: c * 1.8 + 32)
    return spark.sql(f"SELECT event_id, round({name}(value), 6) AS f FROM {{e}}", e=table(spark, sf, "events"))


@query("c125_aggregate_function", "SELECT user_id, event_type, round(max(value) - min(value), 6) AS spread FROM events GROUP BY 1, 2")
def aggregate_function(spark: SparkSession, sf: str) -> DataFrame:
    name = new_table("spread")
    U.register(spark, name, lambda v: float(v.max() - v.min()), "agg")
    return spark.sql(f"SELECT user_id, event_type, round({name}(value), 6) AS spread FROM {{e}} GROUP BY 1, 2", e=table(spark, sf, "events"))


@query(
    "c125_aggregate_in_parts",
    """SELECT event_type, round(exp(avg(ln(value + 1))), 6) AS geometric, round(max(value) - min(value), 6) AS spread, count(value) AS n FROM events GROUP BY 1""",
)
def aggregate_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Functions of the user over groups that no worker ever holds."""

    def logs(table: pa.Table) -> dict:
        v = table["value"].drop_null().to_numpy()
        return {"total": float(np.log1p(v).sum()), "n": len(v)}

    def ends(table: pa.Table) -> dict:
        v = table["value"].drop_null().to_numpy()
        return {"lo": float(v.min()), "hi": float(v.max())} if len(v) else {"lo": None, "hi": None}

    def wider(a: dict, b: dict) -> dict:
        both = [x for x in (a, b) if x["lo"] is not None]
        return {"lo": min(x["lo"] for x in both), "hi": max(x["hi"] for x in both)} if both else a

    def added(a: dict, b: dict) -> dict:
        return {k: a[k] + b[k] for k in a}

    aggs = {
        "geometric": U.Aggregate(logs, added, lambda s: math.exp(s["total"] / s["n"]) if s["n"] else None, "total double, n long"),
        "spread": U.Aggregate(ends, wider, lambda s: None if s["lo"] is None else s["hi"] - s["lo"], "lo double, hi double"),
        "n": U.Aggregate(logs, added, lambda s: s["n"], "total double, n long", "long"),
    }
    out = U.group_aggregate(table(spark, sf, "events"), ["event_type"], ["value"], aggs)
    return out.select("event_type", r("geometric").alias("geometric"), r("spread").alias("spread"), "n")


class Words:
    def eval(self, text: str):
        for i, word in enumerate(text.split()):
            yield i, word


@query(
    "c126_table_function",
    r"SELECT p_partkey, CAST(i - 1 AS INT) AS place, w[i] AS word FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part) AS p, unnest(generate_series(1, len(w))) AS u(i)",
)
def table_function(spark: SparkSession, sf: str) -> DataFrame:
    name = new_table("words")
    U.register(spark, name, Words, "table", "place int, word string")
    return spark.sql(f"SELECT p_partkey, place, word FROM {{p}} AS p, LATERAL {name}(p.p_name)", p=table(spark, sf, "part"))


@query("c127_map_batches", "SELECT event_id, value - 1 AS less FROM events")
def mapped(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "value")
    return U.map_batches(e, lambda pdf: pd.DataFrame({"event_id": pdf["event_id"], "less": pdf["value"] - 1}), "event_id long, less double")


@query("c127_group_combine", "SELECT event_type, count(*) AS n, round(sum(value * value), 4) AS squares FROM events GROUP BY 1")
def combined(spark: SparkSession, sf: str) -> DataFrame:
    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_type": [pdf["event_type"].iloc[0]], "n": [len(pdf)], "squares": [float(np.square(pdf["value"]).sum())]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"event_type": [pdf["event_type"].iloc[0]], "n": [pdf["n"].sum()], "squares": [pdf["squares"].sum()]})

    e = table(spark, sf, "events").select("event_type", "value")
    out = U.group_combine(e, ["event_type"], part, merge, "event_type string, n long, squares double")
    return out.withColumn("squares", r("squares", 4))


@query("c127_group_transform", "SELECT event_id, round(value - avg(value) OVER (PARTITION BY user_id), 8) AS above FROM events")
def transformed(spark: SparkSession, sf: str) -> DataFrame:
    def centre(df: DataFrame) -> DataFrame:
        return df.withColumn("above", r(F.col("value") - F.col("usual"), 8))

    with_mean = U.group_transform(table(spark, sf, "events"), ["user_id"], "usual", F.avg("value"))
    return U.pipe(with_mean, centre, lambda df: df.select("event_id", "above"))


@query(
    "c127_group_apply",
    "SELECT o_custkey, o_orderkey, o_totalprice - max(o_totalprice) OVER (PARTITION BY o_custkey) AS below_best FROM orders",
)
def applied(spark: SparkSession, sf: str) -> DataFrame:
    """A whole customer at a time: few orders each."""

    def below(orders: pa.Table) -> pa.Table:
        price = orders["o_totalprice"]
        return orders.select(["o_custkey", "o_orderkey"]).append_column("below_best", pc.subtract(price, pc.max(price)))

    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return U.group_apply(o, ["o_custkey"], below, "o_custkey long, o_orderkey long, below_best double")


@query(
    "c128_rolling_apply",
    """SELECT event_id, CASE WHEN count(*) OVER w >= 5 THEN round(max(value) OVER w - min(value) OVER w, 6) END AS spread
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 4 PRECEDING)""",
)
def rolling_apply(spark: SparkSession, sf: str) -> DataFrame:
    out = U.rolling_apply(events(spark, sf), "value", lambda v: v.max() - v.min(), BY, ORDER, 5, out="spread")
    return out.select("event_id", r("spread").alias("spread"))


@query(
    "c128_expanding_apply",
    "SELECT event_id, round(max(value) OVER w - min(value) OVER w, 6) AS spread FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
)
def expanding_apply(spark: SparkSession, sf: str) -> DataFrame:
    out = U.expanding_apply(events(spark, sf), "value", lambda v: v.max() - v.min(), BY, ORDER, out="spread")
    return out.select("event_id", r("spread").alias("spread"))


@query(
    "c129_online_exponential_mean",
    f"""SELECT a.event_id, round(sum(b.v * pow(0.7, a.n - b.n)) / sum(CASE WHEN b.v IS NOT NULL THEN pow(0.7, a.n - b.n) END), 6) AS ewm
    FROM {POSITIONS} AS a JOIN {POSITIONS} AS b ON a.user_id = b.user_id AND b.n <= a.n GROUP BY 1""",
)
def online_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches of files, a state per user between them; the result is that of one pass."""
    root = scratch_dir(spark, "online")
    e = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for label, rows in (("early", e.where(early)), ("late", e.where(~early))):
        write_table(rows, f"{root}/src/{label}")
        stream = spark.readStream.schema(e.schema).option("recursiveFileLookup", "true").parquet(f"{root}/src")
        out = online_ewm(stream, "v", 0.3, BY, ORDER)
        sink = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", r("ewm").alias("ewm"))
