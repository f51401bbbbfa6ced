"""Queries of projections, filters, casts and missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators import rows as R
from sensorlake.plans.registry import query, table

# Events with every fifth value missing, in Spark and in the checks.
GAPPY = "(SELECT *, CASE WHEN event_id % 5 > 0 THEN value END AS v FROM events) AS e"


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("v", F.when(F.col("event_id") % 5 > 0, F.col("value")))


@query("c18_project", "SELECT l_orderkey, l_extendedprice * (1 - l_discount) AS net, upper(l_returnflag) || l_linestatus AS flags FROM lineitem")
def projected(spark: SparkSession, sf: str) -> DataFrame:
    exprs = {
        "l_orderkey": "l_orderkey",
        "net": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "flags": F.concat(F.upper("l_returnflag"), "l_linestatus"),
    }
    return R.project(table(spark, sf, "lineitem"), exprs)


@query("c19_filter_null_is_not_true", f"SELECT event_id, v FROM {GAPPY} WHERE v > 20 OR user_id = 3")
def filtered(spark: SparkSession, sf: str) -> DataFrame:
    return R.where(gappy(spark, sf), (F.col("v") > 20) | (F.col("user_id") == 3)).select("event_id", "v")


@query("c20_evaluate", "SELECT o_orderkey, o_totalprice * 2 + o_custkey AS score FROM orders WHERE o_totalprice > 1000 AND NOT o_orderstatus = 'P'")
def evaluated(spark: SparkSession, sf: str) -> DataFrame:
    kept = R.where(table(spark, sf, "orders"), "o_totalprice > 1000 AND NOT o_orderstatus = 'P'")
    return R.evaluate(kept, "score = o_totalprice * 2 + o_custkey").select("o_orderkey", "score")


@query(
    "c21_operators",
    """SELECT o_orderkey, a - floor(a / 7.0) * 7 AS rest, CAST(floor(a / 7.0) AS BIGINT) AS whole, a <> 3 AS differs,
    o_orderstatus IN ('F', 'O') AS listed, (a > 0) OR NOT (a < -100) AS logic, a * 2 - 1 AS sums
    FROM (SELECT *, o_custkey - 500 AS a FROM orders) AS o""",
)
def operators(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("o_custkey") - 500
    return table(spark, sf, "orders").select(
        "o_orderkey",
        R.modulo(a, F.lit(7)).cast("double").alias("rest"),
        R.floor_divide(a, F.lit(7)).alias("whole"),
        (a != 3).alias("differs"),
        F.col("o_orderstatus").isin("F", "O").alias("listed"),
        ((a > 0) | ~(a < -100)).alias("logic"),
        (a * 2 - 1).alias("sums"),
    )


@query(
    "c22_casts",
    """SELECT p_partkey, CAST(trunc(p_retailprice) AS BIGINT) AS whole, CAST(p_size AS VARCHAR) AS text, TRY_CAST(p_partkey AS TINYINT) AS small
    FROM part""",
)
def casts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey",
        R.safe_cast("p_retailprice", "bigint").alias("whole"),
        R.safe_cast("p_size", "string").alias("text"),
        R.safe_cast("p_partkey", "tinyint", errors="null").alias("small"),
    )


@query("c23_to_numeric", "SELECT event_id, CASE WHEN event_id % 9 = 4 THEN NULL ELSE value END AS number FROM events")
def numeric(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_id") % 9 == 4, "n/a?").otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return table(spark, sf, "events").select("event_id", R.to_numeric(text, "coerce").alias("number"))


@query(
    "c24_is_missing",
    f"SELECT event_id, v IS NULL OR user_id % 6 = 1 AS missing, v IS NULL AND user_id % 6 <> 1 AS is_null FROM {GAPPY}",
)
def missing(spark: SparkSession, sf: str) -> DataFrame:
    x = F.when(F.col("user_id") % 6 == 1, F.lit(float("nan"))).otherwise(F.col("v"))
    return gappy(spark, sf).select("event_id", R.is_missing(x).alias("missing"), R.is_missing(x, nan=False).alias("is_null"))


@query("c25_fill_null", f"SELECT event_id, coalesce(v, -1) AS v, coalesce(CASE WHEN user_id % 3 > 0 THEN event_type END, 'none') AS kind FROM {GAPPY}")
def filled(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "v", F.when(F.col("user_id") % 3 > 0, F.col("event_type")).alias("kind"))
    return R.fill_null(df, {"v": -1.0, "kind": "none"})


HOLES = "(SELECT event_id, CASE WHEN event_id % 5 > 0 THEN value END AS a, CASE WHEN event_id % 3 > 0 THEN user_id END AS b, CASE WHEN event_id % 2 > 0 THEN event_type END AS c FROM events) AS h"


def holes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf, "events").select(
        k, F.when(k % 5 > 0, F.col("value")).alias("a"), F.when(k % 3 > 0, F.col("user_id")).alias("b"), F.when(k % 2 > 0, F.col("event_type")).alias("c")
    )


@query("c26_drop_nulls_any", f"SELECT * FROM {HOLES} WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL")
def drop_any(spark: SparkSession, sf: str) -> DataFrame:
    return R.drop_nulls(holes(spark, sf))


@query("c26_drop_nulls_thresh", f"SELECT * FROM {HOLES} WHERE (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT >= 2")
def drop_thresh(spark: SparkSession, sf: str) -> DataFrame:
    return R.drop_nulls(holes(spark, sf), thresh=2, subset=["a", "b", "c"])


@query("c26_drop_nulls_all", f"SELECT * FROM {HOLES} WHERE a IS NOT NULL OR b IS NOT NULL OR c IS NOT NULL")
def drop_all(spark: SparkSession, sf: str) -> DataFrame:
    return R.drop_nulls(holes(spark, sf), how="all", subset=["a", "b", "c"])


@query(
    "c27_replace_values",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'tap' WHEN 'error' THEN NULL ELSE event_type END AS kind,
    regexp_replace(regexp_replace(props, '[0-9]+', '#', 'g'), '"', '''', 'g') AS props FROM events""",
)
def replaced(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        R.replace_values("event_type", {"click": "tap", "error": None}).alias("kind"),
        R.replace_values("props", {"[0-9]+": "#", '"': "'"}, regex=True).alias("props"),
    )


@query("c28_member_of_list", "SELECT event_id FROM events WHERE user_id IN (1, 5, 9)")
def member_of_list(spark: SparkSession, sf: str) -> DataFrame:
    return R.is_in(table(spark, sf, "events"), "user_id", [1, 5, 9]).select("event_id")


@query("c28_member_of_table", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def member_of_table(spark: SparkSession, sf: str) -> DataFrame:
    debtors = table(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey")
    return R.is_in(table(spark, sf, "orders"), "o_custkey", debtors).select("o_orderkey")


@query(
    "c29_between_clip_case",
    f"""SELECT event_id, v > 10 AND v <= 50 AS mid, CASE WHEN v IS NOT NULL THEN least(greatest(v, 5), 60) END AS clipped,
    CASE WHEN v < 10 THEN 'low' WHEN v < 40 THEN 'mid' ELSE 'high' END AS band FROM {GAPPY}""",
)
def between_clip_case(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("v")
    return gappy(spark, sf).select(
        "event_id",
        R.between("v", 10, 50, "right").alias("mid"),
        R.clip("v", 5.0, 60.0).alias("clipped"),
        R.case_when([(v < 10, "low"), (v < 40, "mid")], "high").alias("band"),
    )


@query("c30_columns", "SELECT l_quantity AS x_qty_y, l_tax AS x_l_tax_y, l_quantity * l_tax AS x_both_y FROM lineitem")
def columns(spark: SparkSession, sf: str) -> DataFrame:
    picked = R.select_columns(table(spark, sf, "lineitem"), types=["float"], regex="quantity|tax")
    more = R.assign(picked, both=F.col("l_quantity") * F.col("l_tax"))
    return R.add_affix(R.rename(more, {"l_quantity": "qty"}), "x_", "_y")


@query(
    "c31_take_positions",
    """SELECT event_id, position FROM (SELECT event_id, row_number() OVER (ORDER BY value, event_id) - 1 AS position FROM events) AS e
    JOIN (SELECT p_partkey * 3 AS at FROM part) AS p ON p.at = e.position""",
)
def taken(spark: SparkSession, sf: str) -> DataFrame:
    at = table(spark, sf, "part").select((F.col("p_partkey") * 3).alias("at"))
    return R.take(table(spark, sf, "events"), at, ["value", "event_id"]).select("event_id", "position")


@query(
    "c32_index_of",
    """SELECT coalesce(min(position) FILTER (WHERE event_type = 'error'), -1) AS first_error
    FROM (SELECT event_type, row_number() OVER (ORDER BY value DESC, event_id DESC) - 1 AS position FROM events) AS e""",
)
def first_index(spark: SparkSession, sf: str) -> DataFrame:
    return R.index_of(table(spark, sf, "events"), "event_type", "error", ["value", "event_id"], "first_error", descending=True)
