"""Queries of aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators import aggregates as A
from sensorlake.plans.columns import GAPPY, gappy
from sensorlake.plans.registry import query, r, table


def rounded(df: DataFrame, digits: int = 6, *names: str) -> DataFrame:
    names = names or tuple(n for n, t in df.dtypes if t == "double")
    return df.withColumns({n: r(n, digits) for n in names})


@query("c45_aggregate_whole_table", "SELECT count(*) AS n, round(sum(l_quantity), 2) AS total, max(l_shipdate) AS latest FROM lineitem")
def whole(spark: SparkSession, sf: str) -> DataFrame:
    spec = {"n": (None, "count_all"), "total": ("l_quantity", "sum"), "latest": ("l_shipdate", "max")}
    return rounded(A.aggregate(table(spark, sf, "lineitem"), [], spec), 2)


@query(
    "c45_aggregate_groups",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS qty, round(avg(l_extendedprice), 4) AS price, count(*) AS n
    FROM lineitem GROUP BY 1, 2""",
)
def groups(spark: SparkSession, sf: str) -> DataFrame:
    spec = {"qty": ("l_quantity", "sum"), "price": ("l_extendedprice", "mean"), "n": (None, "count_all")}
    return rounded(rounded(A.aggregate(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], spec), 2, "qty"), 4, "price")


@query("c46_counts", f"SELECT user_id, count(v) AS present, count(*) - count(v) AS missing, count(*) AS rows FROM {GAPPY} GROUP BY user_id")
def counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.aggregate(gappy(spark, sf), ["user_id"], {"present": ("v", "count"), "missing": ("v", "count_null"), "rows": ("v", "count_all")})


@query(
    "c47_sum_product_mean",
    """SELECT l_shipmonth, round(sum(l_tax), 6) AS s, round(product(1 + l_discount / 1000), 8) AS p, round(avg(l_quantity), 8) AS m
    FROM (SELECT *, month(l_shipdate) AS l_shipmonth FROM lineitem) AS l GROUP BY 1""",
)
def sum_product_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").withColumns({"l_shipmonth": F.month("l_shipdate").cast("long"), "f": 1 + F.col("l_discount") / 1000})
    out = A.aggregate(df, ["l_shipmonth"], {"s": ("l_tax", "sum"), "p": ("f", "product"), "m": ("l_quantity", "mean")})
    return rounded(rounded(out, 6, "s"), 8, "p", "m")


@query("c48_min_max", "SELECT o_orderstatus, min(o_totalprice) AS lo, max(o_totalprice) AS hi, min(o_orderdate) AS first, max(o_orderpriority) AS p FROM orders GROUP BY 1")
def min_max(spark: SparkSession, sf: str) -> DataFrame:
    spec = {"lo": ("o_totalprice", "min"), "hi": ("o_totalprice", "max"), "first": ("o_orderdate", "min"), "p": ("o_orderpriority", "max")}
    return A.aggregate(table(spark, sf, "orders"), ["o_orderstatus"], spec)


@query(
    "c49_first_last",
    f"SELECT user_id, arg_min(v, ts) FILTER (WHERE v IS NOT NULL) AS first_v, arg_max(v, ts) FILTER (WHERE v IS NOT NULL) AS last_v FROM {GAPPY} GROUP BY 1",
)
def first_last(spark: SparkSession, sf: str) -> DataFrame:
    order = {"order": ["ts", "event_id"]}
    return A.aggregate(gappy(spark, sf), ["user_id"], {"first_v": ("v", "first", order), "last_v": ("v", "last", order)})


@query("c50_any_all", "SELECT user_id, bool_or(value > 150) AS any_big, bool_and(value < 200) AS all_small FROM events GROUP BY 1")
def any_all(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("user_id", (F.col("value") > 150).alias("big"), (F.col("value") < 200).alias("small"))
    return A.aggregate(df, ["user_id"], {"any_big": ("big", "any"), "all_small": ("small", "all")})


@query(
    "c51_mode",
    """SELECT l_returnflag, l_partkey, count, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY count DESC, l_partkey) AS place
    FROM (SELECT l_returnflag, l_partkey, count(*) AS count FROM lineitem GROUP BY 1, 2) AS c) AS m WHERE place <= 3""",
)
def modes(spark: SparkSession, sf: str) -> DataFrame:
    return A.mode(table(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey", 3)


@query(
    "c52_variance",
    f"""SELECT event_type, round(var_pop(v), 4) AS var0, round(var_samp(v), 4) AS var1, round(stddev_pop(v), 6) AS std0, round(stddev_samp(v), 6) AS std1
    FROM {GAPPY} GROUP BY 1""",
)
def variance(spark: SparkSession, sf: str) -> DataFrame:
    one = {"ddof": 1}
    out = A.aggregate(gappy(spark, sf), ["event_type"], {"var0": ("v", "var"), "var1": ("v", "var", one), "std0": ("v", "std"), "std1": ("v", "std", one)})
    return rounded(rounded(out, 4, "var0", "var1"), 6, "std0", "std1")


@query(
    "c53_skewness",
    f"""SELECT event_type, round((avg(v * v * v) - 3 * avg(v) * avg(v * v) + 2 * pow(avg(v), 3)) / pow(var_pop(v), 1.5), 6) AS skew
    FROM {GAPPY} GROUP BY 1""",
)
def skew(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.aggregate(gappy(spark, sf), ["event_type"], {"skew": ("v", "skew")}))


@query("c54_kurtosis", f"SELECT event_type, round(kurtosis_pop(v), 6) AS kurt FROM {GAPPY} GROUP BY 1")
def kurt(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.aggregate(gappy(spark, sf), ["event_type"], {"kurt": ("v", "kurt")}))


@query(
    "c55_quantiles",
    f"""SELECT event_type, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.99), 6) AS p99
    FROM {GAPPY} GROUP BY 1""",
)
def exact_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.quantiles(gappy(spark, sf), ["event_type"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}))


SORTED = f"""(SELECT user_id, list_sort(list(v) FILTER (WHERE v IS NOT NULL)) AS s, 0.3 * (count(v) - 1) AS spot FROM {GAPPY} GROUP BY 1 HAVING count(v) > 0) AS q"""


@query(
    "c55_quantile_interpolation",
    f"""SELECT user_id, s[CAST(floor(spot) AS BIGINT) + 1] AS low, s[CAST(ceil(spot) AS BIGINT) + 1] AS high,
    s[CAST(round_even(spot, 0) AS BIGINT) + 1] AS near, round((s[CAST(floor(spot) AS BIGINT) + 1] + s[CAST(ceil(spot) AS BIGINT) + 1]) / 2, 6) AS mid FROM {SORTED}""",
)
def interpolations(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf)
    kinds = {"low": "lower", "high": "higher", "near": "nearest", "mid": "midpoint"}
    return rounded(A.aggregate(df.where("v IS NOT NULL"), ["user_id"], {n: ("v", "quantile", {"q": 0.3, "interpolation": k}) for n, k in kinds.items()}), 6, "mid")


@query(
    "c55_quantiles_of_table",
    f"""SELECT round(quantile_cont(v, 0), 6) AS least, round(quantile_cont(v, 0.001), 6) AS low, round(quantile_cont(v, 0.5), 6) AS mid,
    round(quantile_cont(v, 0.9999), 6) AS high, round(quantile_cont(v, 1), 6) AS most FROM {GAPPY}""",
)
def quantiles_of_table(spark: SparkSession, sf: str) -> DataFrame:
    """Over all rows: what is shuffled lies in the brackets of a sketch."""
    return rounded(A.quantiles(gappy(spark, sf), [], "v", {"least": 0.0, "low": 0.001, "mid": 0.5, "high": 0.9999, "most": 1.0}))


@query("c56_approx_quantiles")
def approx_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return A.aggregate(table(spark, sf, "events"), ["event_type"], {"p90": ("value", "approx_quantile", {"q": 0.9})})


@query("c57_median_sem", f"SELECT user_id, round(median(v), 6) AS median, round(stddev_samp(v) / sqrt(count(v)), 6) AS sem FROM {GAPPY} GROUP BY 1")
def median_sem(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.aggregate(gappy(spark, sf), ["user_id"], {"median": ("v", "median"), "sem": ("v", "sem")}))


@query("c58_distinct_count", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(*) AS size FROM lineitem GROUP BY 1")
def distinct_count(spark: SparkSession, sf: str) -> DataFrame:
    return A.aggregate(table(spark, sf, "lineitem"), ["l_returnflag"], {"parts": ("l_partkey", "nunique"), "suppliers": ("l_suppkey", "nunique"), "size": (None, "size")})


@query(
    "c59_row_of_extreme",
    "SELECT user_id, arg_max(event_id, (value, -event_id)) AS at_max, arg_min(event_id, (value, event_id)) AS at_min FROM events GROUP BY 1",
)
def extremes(spark: SparkSession, sf: str) -> DataFrame:
    of = {"of": "event_id"}
    return A.aggregate(table(spark, sf, "events"), ["user_id"], {"at_max": ("value", "argmax", of), "at_min": ("value", "argmin", of)})


@query(
    "c59_row_of_extreme_text",
    """SELECT c_mktsegment, arg_max(c_custkey, c_name) AS last_name_of, min(c_name) FILTER (WHERE c_acctbal = top) AS richest, arg_min(c_name, c_acctbal) AS poorest
    FROM (SELECT *, max(c_acctbal) OVER (PARTITION BY c_mktsegment) AS top FROM customer) GROUP BY 1""",
)
def text_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """The greatest of a text, and texts reported for the greatest and the least number."""
    spec = {"last_name_of": ("c_name", "argmax", {"of": "c_custkey"}), "richest": ("c_acctbal", "argmax", {"of": "c_name"}), "poorest": ("c_acctbal", "argmin", {"of": "c_name"})}
    return A.aggregate(table(spark, sf, "customer"), ["c_mktsegment"], spec)


@query(
    "c60_null_skipping_min_count",
    f"""SELECT user_id, round(CASE WHEN count(v) >= 50 THEN sum(v) END, 6) AS enough, CASE WHEN count(v) = count(*) THEN max(v) END AS strict
    FROM {GAPPY} GROUP BY 1""",
)
def min_count(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.aggregate(gappy(spark, sf), ["user_id"], {"enough": ("v", "sum", {"min_count": 50}), "strict": ("v", "max", {"skip_nulls": False})}))


@query(
    "c61_open_high_low_close",
    """SELECT user_id, CAST(ts AS DATE) AS day, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close
    FROM events GROUP BY 1, 2""",
)
def open_high_low_close(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    return A.ohlc(df, ["user_id", "day"], "value", ["ts", "event_id"])


@query("c62_value_counts", "SELECT p_brand, count(*) AS count FROM part GROUP BY 1")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.value_counts(table(spark, sf, "part"), "p_brand")


@query("c62_value_shares", "SELECT p_brand, round(count(*) / (SELECT count(*) FROM part), 8) AS proportion FROM part GROUP BY 1")
def value_shares(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.value_counts(table(spark, sf, "part"), "p_brand", normalize=True), 8)


def describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
    round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
    CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""


@query("c63_describe_numbers", " UNION ALL ".join(describe_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")))
def describe_numbers(spark: SparkSession, sf: str) -> DataFrame:
    out = A.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])
    return rounded(out, 4, "mean", "std", "p25", "p50", "p75")


def category_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", arg_min({c}, (-n, {c})) AS top, max(n) AS freq
    FROM (SELECT {c}, count(*) AS n FROM orders GROUP BY 1) AS t"""


@query("c63_describe_categories", " UNION ALL ".join(category_sql(c) for c in ("o_orderstatus", "o_orderpriority")))
def describe_categories(spark: SparkSession, sf: str) -> DataFrame:
    return A.describe_categories(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "c63_describe_times",
    """SELECT 'ts' AS "column", count(ts) AS count, make_timestamp(CAST(round(avg(epoch_us(ts))) AS BIGINT)) AS mean, min(ts) AS min,
    make_timestamp(CAST(round(quantile_cont(epoch_us(ts), 0.5)) AS BIGINT)) AS p50, max(ts) AS max FROM events""",
)
def describe_times(spark: SparkSession, sf: str) -> DataFrame:
    return A.describe_times(table(spark, sf, "events"), ["ts"], [0.5])


@query("c64_pearson", "SELECT event_type, round(corr(value, event_id % 100), 8) AS pearson FROM events GROUP BY 1")
def pearson(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").withColumn("z", F.col("event_id") % 100)
    return rounded(A.correlate(df, "value", "z", "pearson", ["event_type"]), 8)


@query("c64_covariance", "SELECT event_type, round(covar_samp(value, event_id % 100), 6) AS covariance FROM events GROUP BY 1")
def covariance(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").withColumn("z", F.col("event_id") % 100)
    return rounded(A.correlate(df, "value", "z", "covariance", ["event_type"]))


RANKED = "rank() OVER (PARTITION BY event_type ORDER BY {0}) + (count(*) OVER (PARTITION BY event_type, {0}) - 1) / 2"


@query(
    "c64_spearman",
    f"""SELECT event_type, round(corr(a, b), 8) AS spearman FROM (SELECT event_type, {RANKED.format('value')} AS a, {RANKED.format('z')} AS b
    FROM (SELECT *, event_id % 100 AS z FROM events) AS e) AS t GROUP BY 1""",
)
def spearman(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").withColumn("z", F.col("event_id") % 100)
    return rounded(A.correlate(df, "value", "z", "spearman", ["event_type"]), 8)


DAILY = "(SELECT user_id, event_type, round(sum(value), 4) AS total FROM events GROUP BY 1, 2) AS d"


@query(
    "c65_pivot_wider",
    f"""SELECT user_id, max(total) FILTER (WHERE event_type = 'click') AS click, max(total) FILTER (WHERE event_type = 'error') AS error
    FROM {DAILY} GROUP BY 1""",
)
def wider(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "events").groupBy("user_id", "event_type").agg(r(F.sum("value"), 4).alias("total"))
    return A.pivot_wider(d, ["user_id"], "event_type", "total", ["click", "error"])


@query(
    "c66_pivot_table",
    """SELECT o_orderpriority, round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4) AS "F",
    round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 4) AS "O", round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 4) AS "P"
    FROM orders GROUP BY 1""",
)
def pivoted(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(A.pivot_table(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", "o_totalprice"), 4)


@query(
    "c66_crosstab_margins",
    """SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'All' ELSE o_orderpriority END AS o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
    count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P", count(*) AS "All"
    FROM orders GROUP BY ROLLUP (o_orderpriority)""",
)
def crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return A.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", margins=True)


@query(
    "c67_group_filter",
    "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING avg(value) > 40 AND count(*) >= 5)",
)
def group_filter(spark: SparkSession, sf: str) -> DataFrame:
    keep = (F.avg("value") > 40) & (F.count(F.lit(1)) >= 5)
    return A.group_filter(table(spark, sf, "events"), ["user_id"], keep).select("event_id", "user_id")


@query("c68_row_extremes", f"SELECT event_id, least(v, CAST(user_id AS DOUBLE)) AS lo, greatest(v, CAST(user_id AS DOUBLE)) AS hi FROM {GAPPY}")
def row_extremes(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).withColumn("u", F.col("user_id").cast("double"))
    return df.select("event_id", A.row_min("v", "u").alias("lo"), A.row_max("v", "u").alias("hi"))
