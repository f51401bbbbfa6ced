"""Queries of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators import joins as J
from sensorlake.plans.registry import query, table

# Two sides, whole tables, with keys the other has not: some are moved out of its range.
ORDERS = "(SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS k, o_totalprice AS amount FROM orders) AS o"
CUSTOMERS = "(SELECT CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 10000000000 ELSE c_custkey END AS k, c_name, c_acctbal AS amount FROM customer) AS c"


def orders(spark: SparkSession, sf: str) -> DataFrame:
    k = "CASE WHEN o_custkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS k"
    return table(spark, sf, "orders").selectExpr("o_orderkey", k, "o_totalprice AS amount")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    k = "CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 10000000000 ELSE c_custkey END AS k"
    return table(spark, sf, "customer").selectExpr(k, "c_name", "c_acctbal AS amount")


def outer(kind: str) -> str:
    return f"SELECT k, o_orderkey, o.amount AS amount, c_name, c.amount AS amount_r FROM {ORDERS} {kind} JOIN {CUSTOMERS} USING (k)"


@query("c33_inner_join", outer("INNER"))
def inner(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"])


@query("c34_left_join", outer("LEFT"))
def left(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"], "left")


@query("c34_right_join", outer("RIGHT"))
def right(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"], "right")


@query("c35_full_join", outer("FULL"))
def full(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"], "full")


@query("c36_left_semi_join", f"SELECT * FROM {ORDERS} WHERE k IN (SELECT k FROM {CUSTOMERS})")
def left_semi(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"], "left_semi")


@query("c36_left_anti_join", f"SELECT * FROM {ORDERS} WHERE k NOT IN (SELECT k FROM {CUSTOMERS})")
def left_anti(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"], "left_anti")


@query("c37_right_semi_join", f"SELECT * FROM {CUSTOMERS} WHERE k IN (SELECT k FROM {ORDERS})")
def right_semi(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"], "right_semi")


@query("c37_right_anti_join", f"SELECT * FROM {CUSTOMERS} WHERE k NOT IN (SELECT k FROM {ORDERS})")
def right_anti(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"], "right_anti")


@query("c38_join_suffixes", f"SELECT k, o_orderkey, o.amount AS amount_order, c_name, c.amount AS amount_customer FROM {ORDERS} JOIN {CUSTOMERS} USING (k)")
def suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return J.join(orders(spark, sf), customers(spark, sf), ["k"], suffixes=("_order", "_customer"))


CLICKS = "(SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click') AS l"
ERRORS = "(SELECT user_id, ts, event_id AS error_id, value AS error_value FROM events WHERE event_type = 'error') AS r"


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where("event_type = 'click'").select("event_id", "user_id", "ts", "value")


def errors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where("event_type = 'error'").selectExpr("user_id", "ts", "event_id AS error_id", "value AS error_value")


def asof_sql(sign: str, tolerance: str | None) -> str:
    near = f"abs(epoch_us(l.ts) - epoch_us(r.ts)) <= epoch_us(TIMESTAMP '1970-01-01' + INTERVAL {tolerance})" if tolerance else "true"
    return f"""SELECT l.event_id, l.user_id, l.ts, l.value, CASE WHEN {near} THEN error_id END AS error_id,
    CASE WHEN {near} THEN error_value END AS error_value FROM {CLICKS} ASOF LEFT JOIN {ERRORS} ON l.user_id = r.user_id AND l.ts {sign} r.ts"""


@query("c39_asof_backward", asof_sql(">=", None))
def asof_backward(spark: SparkSession, sf: str) -> DataFrame:
    return J.asof_join(clicks(spark, sf), errors(spark, sf), "ts", ["user_id"])


@query("c39_asof_tolerance", asof_sql(">=", "6 HOUR"))
def asof_tolerance(spark: SparkSession, sf: str) -> DataFrame:
    return J.asof_join(clicks(spark, sf), errors(spark, sf), "ts", ["user_id"], tolerance="6 hours")


@query(
    "c39_asof_without_keys",
    f"""SELECT l.event_id, l.ts, r.error_id FROM {CLICKS} ASOF LEFT JOIN {ERRORS} ON l.ts >= r.ts""",
)
def asof_without_keys(spark: SparkSession, sf: str) -> DataFrame:
    """One time line for the whole table."""
    found = J.asof_join(clicks(spark, sf).select("event_id", "ts"), errors(spark, sf).select("ts", "error_id"), "ts")
    return found.select("event_id", "ts", "error_id")


@query("c40_asof_forward", asof_sql("<=", "2 DAY"))
def asof_forward(spark: SparkSession, sf: str) -> DataFrame:
    return J.asof_join(clicks(spark, sf), errors(spark, sf), "ts", ["user_id"], "forward", "2 days")


@query(
    "c40_asof_nearest",
    f"""SELECT event_id, CASE WHEN b_id IS NULL OR f_gap < b_gap THEN f_id ELSE b_id END AS error_id FROM (
      SELECT l.event_id, r.error_id AS b_id, epoch_us(l.ts) - epoch_us(r.ts) AS b_gap
      FROM {CLICKS} ASOF LEFT JOIN {ERRORS} ON l.user_id = r.user_id AND l.ts >= r.ts) AS b
    JOIN (SELECT l.event_id, r.error_id AS f_id, epoch_us(r.ts) - epoch_us(l.ts) AS f_gap
      FROM {CLICKS} ASOF LEFT JOIN {ERRORS} ON l.user_id = r.user_id AND l.ts <= r.ts) AS f USING (event_id)""",
)
def asof_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return J.asof_join(clicks(spark, sf), errors(spark, sf), "ts", ["user_id"], "nearest").select("event_id", "error_id")


def daily(kind: str) -> str:
    return f"(SELECT user_id, date_trunc('day', ts) AS day, count(*) AS {kind}s FROM events WHERE event_type = '{kind}' GROUP BY 1, 2)"


@query(
    "c41_ordered_merge",
    f"""SELECT user_id, day, last_value(clicks IGNORE NULLS) OVER w AS clicks, last_value(errors IGNORE NULLS) OVER w AS errors
    FROM {daily('click')} AS l FULL JOIN {daily('error')} AS r USING (user_id, day)
    WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING)""",
)
def merged(spark: SparkSession, sf: str) -> DataFrame:
    def per_day(kind: str) -> DataFrame:
        day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
        some = table(spark, sf, "events").where(F.col("event_type") == kind)
        return some.groupBy("user_id", day).agg(F.count(F.lit(1)).alias(f"{kind}s"))

    return J.ordered_merge(per_day("click"), per_day("error"), "day", ["user_id"], fill="forward")


# Two versions of the customer table, each with keys of its own; the second has changed balances, or none.
OLD = "(SELECT CASE WHEN c_custkey % 4 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey, c_acctbal, c_mktsegment FROM customer) AS a"
NEW = """(SELECT CASE WHEN c_custkey % 6 = 0 THEN c_custkey + 10000000000 ELSE c_custkey END AS c_custkey,
CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer) AS b"""


def versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    balance = F.when(k % 3 == 0, None).when(k % 3 == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    old = c.withColumn("c_custkey", F.when(k % 4 == 0, -k).otherwise(k))
    return old, c.withColumns({"c_custkey": F.when(k % 6 == 0, k + 10_000_000_000).otherwise(k), "c_acctbal": balance})


@query(
    "c43_combine_first",
    f"""SELECT c_custkey, coalesce(b.c_acctbal, a.c_acctbal) AS c_acctbal, coalesce(b.c_mktsegment, a.c_mktsegment) AS c_mktsegment
    FROM {NEW} FULL JOIN {OLD} USING (c_custkey)""",
)
def combined(spark: SparkSession, sf: str) -> DataFrame:
    old, new = versions(spark, sf)
    return J.combine_first(new, old, ["c_custkey"])


@query(
    "c43_update",
    f"""SELECT a.c_custkey, coalesce(b.c_acctbal, a.c_acctbal) AS c_acctbal, coalesce(b.c_mktsegment, a.c_mktsegment) AS c_mktsegment
    FROM {OLD} LEFT JOIN {NEW} ON a.c_custkey = b.c_custkey""",
)
def updated(spark: SparkSession, sf: str) -> DataFrame:
    old, new = versions(spark, sf)
    return J.update(old, new, ["c_custkey"])


@query(
    "c44_compare",
    f"""SELECT c_custkey, CASE WHEN b.c_mktsegment IS NULL THEN 'left_only' WHEN a.c_mktsegment IS NULL THEN 'right_only' ELSE 'differs' END AS status,
    CASE WHEN a.c_acctbal IS DISTINCT FROM b.c_acctbal THEN a.c_acctbal END AS c_acctbal_left,
    CASE WHEN a.c_acctbal IS DISTINCT FROM b.c_acctbal THEN b.c_acctbal END AS c_acctbal_right,
    CASE WHEN a.c_mktsegment IS DISTINCT FROM b.c_mktsegment THEN a.c_mktsegment END AS c_mktsegment_left,
    CASE WHEN a.c_mktsegment IS DISTINCT FROM b.c_mktsegment THEN b.c_mktsegment END AS c_mktsegment_right
    FROM {OLD} FULL JOIN {NEW} USING (c_custkey)
    WHERE a.c_acctbal IS DISTINCT FROM b.c_acctbal OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment""",
)
def compared(spark: SparkSession, sf: str) -> DataFrame:
    return J.compare(*versions(spark, sf), ["c_custkey"])
