"""Queries of window operators (C69-C81), per user in the order of time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators import windows as W
from sensorlake.operators.aggregates import on_keys
from sensorlake.plans.columns import GAPPY, gappy
from sensorlake.plans.registry import query, r, table

BY, ORDER = ["user_id"], ["ts", "event_id"]
OVER = "OVER (PARTITION BY user_id ORDER BY ts, event_id"
SO_FAR = f"{OVER} ROWS UNBOUNDED PRECEDING)"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


@query(
    "c69_cumulative",
    f"""SELECT event_id, round(sum(value) {SO_FAR}, 4) AS s, min(value) {SO_FAR} AS lo, max(value) {SO_FAR} AS hi,
    round(product(1 + value / 10000) {SO_FAR}, 8) AS p FROM events""",
)
def cumulative(spark: SparkSession, sf: str) -> DataFrame:
    df = events(spark, sf).withColumn("f", 1 + F.col("value") / 10000)
    runs = W.Runs(df, BY, ORDER)
    for col, fn, out in (("value", "sum", "s"), ("value", "min", "lo"), ("value", "max", "hi"), ("f", "product", "p")):
        runs = runs.cumulative(col, fn, out)
    return runs.rows().select("event_id", r("s", 4).alias("s"), "lo", "hi", r("p", 8).alias("p"))


@query("c69_cumulative_whole_table", "SELECT event_id, round(sum(value) OVER (ORDER BY ts, event_id), 4) AS s FROM events")
def cumulative_whole(spark: SparkSession, sf: str) -> DataFrame:
    """One order for all rows of the table."""
    out = W.cumulative(events(spark, sf), "value", "sum", [], ORDER, "s")
    return out.select("event_id", r("s", 4).alias("s"))


@query("c70_shift", f"SELECT event_id, lag(value) {OVER}) AS back, lead(value, 2) {OVER}) AS ahead FROM events")
def shifted(spark: SparkSession, sf: str) -> DataFrame:
    runs = W.Runs(events(spark, sf), BY, ORDER).shift("value", 1, "back").shift("value", -2, "ahead")
    return runs.rows().select("event_id", "back", "ahead")


@query(
    "c71_difference_and_change",
    f"""SELECT event_id, round(value - lag(value) {OVER}), 6) AS diff, round(value / lag(value, 3) {OVER}) - 1, 6) AS pct_change FROM events""",
)
def difference(spark: SparkSession, sf: str) -> DataFrame:
    df = W.difference(events(spark, sf), "value", BY, ORDER)
    df = W.pct_change(df, "value", BY, ORDER, 3)
    return df.select("event_id", r("diff").alias("diff"), r("pct_change").alias("pct_change"))


U = "(SELECT *, round(value / 10) AS u FROM events) AS e"
BY_U = "OVER (PARTITION BY user_id ORDER BY u)"
TIES = "count(*) OVER (PARTITION BY user_id, u)"


@query(
    "c72_rank",
    f"""SELECT event_id, rank() {BY_U} + ({TIES} - 1) / 2 AS average, CAST(rank() {BY_U} AS DOUBLE) AS min, CAST(rank() {BY_U} + {TIES} - 1 AS DOUBLE) AS max,
    CAST(dense_rank() {BY_U} AS DOUBLE) AS dense, CAST(row_number() OVER (PARTITION BY user_id ORDER BY u, event_id) AS DOUBLE) AS first,
    round((rank() {BY_U} + ({TIES} - 1) / 2) / count(*) OVER (PARTITION BY user_id), 8) AS pct FROM {U}""",
)
def ranked(spark: SparkSession, sf: str) -> DataFrame:
    df = events(spark, sf).withColumn("u", F.round(F.col("value") / 10)).select("event_id", "user_id", "u")
    df = W.rank(df, "u", BY, "first", ["event_id"], out="first")
    ranks = {m: (m, False) for m in ("average", "min", "max", "dense")}
    df = on_keys(df, W.value_ranks(df, "u", BY, {**ranks, "pct": ("average", True)}), [*BY, "u"])
    return df.select("event_id", "average", "min", "max", "dense", "first", r("pct", 8).alias("pct"))


@query("c73_row_and_group_number", f"SELECT event_id, row_number() {OVER}) - 1 AS n, dense_rank() OVER (ORDER BY user_id) - 1 AS \"group\" FROM events")
def numbered(spark: SparkSession, sf: str) -> DataFrame:
    df = W.row_number(events(spark, sf), BY, ORDER)
    return W.group_number(df, BY).select("event_id", "n", "group")


@query(
    "c74_fill",
    f"""SELECT event_id, last_value(v IGNORE NULLS) {SO_FAR} AS f, first_value(v IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b
    FROM {GAPPY}""",
)
def filled(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    return W.Runs(df, BY, ORDER).fill("v", "f").fill("v", "b", backward=True).rows().select("event_id", "f", "b")


NTH = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS m"


@query("c75_nth", f"SELECT event_id, user_id FROM (SELECT *, {NTH} FROM events) AS e WHERE n = 4 UNION ALL SELECT event_id, user_id FROM (SELECT *, {NTH} FROM events) AS e WHERE m = 2")
def nth(spark: SparkSession, sf: str) -> DataFrame:
    df = events(spark, sf).select("event_id", "user_id", "ts")
    return W.nth(df, BY, ORDER, 3).unionByName(W.nth(df, BY, ORDER, -2)).select("event_id", "user_id")


@query("c75_head", f"SELECT event_id, user_id FROM (SELECT *, {NTH} FROM events) AS e WHERE n <= 3")
def head(spark: SparkSession, sf: str) -> DataFrame:
    return W.head(events(spark, sf), BY, ORDER, 3).select("event_id", "user_id")


@query("c75_tail", f"SELECT event_id, user_id FROM (SELECT *, {NTH} FROM events) AS e WHERE m <= 3")
def tail(spark: SparkSession, sf: str) -> DataFrame:
    return W.tail(events(spark, sf), BY, ORDER, 3).select("event_id", "user_id")


def frame_sql(frame: str, least: int) -> str:
    """Statistics of v over a frame, NULL below ``least`` values."""

    def gate(expr: str, need: int = least) -> str:
        return f"CASE WHEN count(v) OVER w >= {need} THEN {expr} END"

    return f"""SELECT event_id, {gate('round(sum(v) OVER w, 4)')} AS sum, {gate('round(avg(v) OVER w, 8)')} AS mean,
    {gate('round(var_samp(v) OVER w, 8)', max(least, 2))} AS var, {gate('round(stddev_samp(v) OVER w, 6)', max(least, 2))} AS std,
    {gate('round(stddev_samp(v) OVER w / sqrt(count(v) OVER w - 1), 6)', max(least, 2))} AS sem,
    {gate('min(v) OVER w')} AS min, {gate('max(v) OVER w')} AS max, {gate('round(median(v) OVER w, 6)')} AS median,
    {gate('round(quantile_cont(v, 0.25) OVER w, 6)')} AS quantile,
    CASE WHEN v IS NOT NULL AND count(v) OVER w >= {least} THEN len(list_filter(list(v) OVER w, lambda x: x < v))
      + (len(list_filter(list(v) OVER w, lambda x: x = v)) + 1) / 2 END AS rank,
    count(v) OVER w AS count FROM {GAPPY} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id {frame})"""


FRAME_FNS = ("sum", "mean", "var", "std", "sem", "min", "max", "median", "quantile", "rank", "count")
DIGITS = {"sum": 4, "mean": 8, "var": 8, "std": 6, "sem": 6, "median": 6, "quantile": 6}


def shown(df: DataFrame) -> DataFrame:
    return df.select("event_id", *[r(fn, DIGITS[fn]).alias(fn) if fn in DIGITS else F.col(fn) for fn in FRAME_FNS])


@query("c76_rolling_rows", frame_sql("ROWS 6 PRECEDING", 4))
def rolling_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    fns = {fn: fn for fn in FRAME_FNS if fn != "count"}
    df = W.rolling(df, "v", fns, BY, ORDER, rows=7, min_periods=4, q=0.25)
    return shown(W.rolling(df, "v", "count", BY, ORDER, rows=7, out="count"))


@query(
    "c76_rolling_shape",
    f"""SELECT event_id, CASE WHEN count(v) OVER w >= 12 THEN round(skewness(v) OVER w, 5) END AS skew,
    CASE WHEN count(v) OVER w >= 12 THEN round(kurtosis(v) OVER w, 5) END AS kurt
    FROM {GAPPY} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 19 PRECEDING)""",
)
def rolling_shape(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    df = W.rolling(df, "v", {"skew": "skew", "kurt": "kurt"}, BY, ORDER, rows=20, min_periods=12)
    return df.select("event_id", r("skew", 5).alias("skew"), r("kurt", 5).alias("kurt"))


DAY = "RANGE BETWEEN INTERVAL 86399999999 MICROSECONDS PRECEDING AND CURRENT ROW"


@query(
    "c77_rolling_time",
    f"""SELECT event_id, round(sum(value) OVER w, 4) AS s, count(value) OVER w AS n
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts {DAY})""",
)
def rolling_time(spark: SparkSession, sf: str) -> DataFrame:
    df = W.rolling(events(spark, sf), "value", {"s": "sum", "n": "count"}, BY, ORDER, period="1 day")
    return df.select("event_id", r("s", 4).alias("s"), "n")


@query(
    "c78_rolling_forward",
    f"""SELECT event_id, CASE WHEN count(v) OVER w >= 2 THEN round(avg(v) OVER w, 8) END AS mean
    FROM {GAPPY} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)""",
)
def rolling_forward(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    df = W.rolling(df, "v", "mean", BY, ORDER, rows=5, min_periods=2, forward=True, out="mean")
    return df.select("event_id", r("mean", 8).alias("mean"))


@query("c79_expanding", frame_sql("ROWS UNBOUNDED PRECEDING", 1))
def expanding(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    return shown(W.expanding(df, "v", {fn: fn for fn in FRAME_FNS}, BY, ORDER, q=0.25))


@query(
    "c79_expanding_shape",
    f"""SELECT event_id, CASE WHEN count(v) OVER w >= 12 THEN round(skewness(v) OVER w, 5) END AS skew,
    CASE WHEN count(v) OVER w >= 12 THEN round(kurtosis(v) OVER w, 5) END AS kurt
    FROM {GAPPY} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def expanding_shape(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    df = W.expanding(df, "v", {"skew": "skew", "kurt": "kurt"}, BY, ORDER, min_periods=12)
    return df.select("event_id", r("skew", 5).alias("skew"), r("kurt", 5).alias("kurt"))


@query(
    "c79_expanding_pairs",
    f"""SELECT event_id, CASE WHEN count(v) OVER w >= 5 THEN round(covar_samp(v, z) OVER w, 8) END AS cov,
    CASE WHEN count(v) OVER w >= 5 THEN round(corr(v, z) OVER w, 6) END AS corr
    FROM (SELECT *, event_id % 100 AS z FROM {GAPPY}) AS g WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def expanding_pairs(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).withColumn("z", F.col("event_id") % 100).select("event_id", "user_id", "ts", "v", "z")
    df = W.expanding(df, "v", {"cov": "cov", "corr": "corr"}, BY, ORDER, other="z", min_periods=5)
    return df.select("event_id", r("cov", 8).alias("cov"), r("corr").alias("corr"))


L = [f"lag(value, {i}) {OVER})" for i in range(4)]
WSUM = f"({L[3]} * 0.25 + {L[2]} * 0.5 + {L[1]} + value * 0.5)"


@query("c80_rolling_weighted", f"SELECT event_id, round({WSUM}, 6) AS s, round({WSUM} / 2.25, 6) AS mean FROM events")
def weighted(spark: SparkSession, sf: str) -> DataFrame:
    weights = [0.25, 0.5, 1.0, 0.5]
    df = W.weighted(events(spark, sf), "value", weights, BY, ORDER, "sum", "s")
    df = W.weighted(df, "value", weights, BY, ORDER, "mean", "mean")
    return df.select("event_id", r("s").alias("s"), r("mean").alias("mean"))


POSITIONS = f"(SELECT event_id, user_id, v, row_number() {OVER}) AS n FROM {GAPPY})"


WVAR = f"""(0.25 * pow({L[3]} - {WSUM} / 2.25, 2) + 0.5 * pow({L[2]} - {WSUM} / 2.25, 2) + pow({L[1]} - {WSUM} / 2.25, 2)
    + 0.5 * pow(value - {WSUM} / 2.25, 2)) * 4 / (3 * 2.25)"""


@query("c80_rolling_weighted_variance", f"SELECT event_id, round({WVAR}, 4) AS var FROM events")
def weighted_variance(spark: SparkSession, sf: str) -> DataFrame:
    df = W.weighted(events(spark, sf), "value", [0.25, 0.5, 1.0, 0.5], BY, ORDER, "var", "var")
    return df.select("event_id", r("var", 4).alias("var"))


@query(
    "c81_exponential_mean",
    f"""SELECT a.event_id, round(sum(b.v * pow(0.7, a.n - b.n)) / sum(CASE WHEN b.v IS NOT NULL THEN pow(0.7, a.n - b.n) END), 6) AS ewm
    FROM {POSITIONS} AS a JOIN {POSITIONS} AS b ON a.user_id = b.user_id AND b.n <= a.n GROUP BY 1""",
)
def exponential(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    return W.ewm(df, "v", 0.3, BY, ORDER).select("event_id", r("ewm").alias("ewm"))


@query(
    "c81_exponential_recurrence",
    f"""SELECT a.event_id, round(sum(b.value * pow(0.7, a.n - b.n) * CASE WHEN b.n = 1 THEN 1 ELSE 0.3 END), 8) AS ewm
    FROM (SELECT *, row_number() {OVER}) AS n FROM events) AS a JOIN (SELECT *, row_number() {OVER}) AS n FROM events) AS b
    ON a.user_id = b.user_id AND b.n <= a.n GROUP BY 1""",
)
def recurrence(spark: SparkSession, sf: str) -> DataFrame:
    return W.ewm(events(spark, sf), "value", 0.3, BY, ORDER, adjust=False).select("event_id", r("ewm", 8).alias("ewm"))


SEEN = f"""(SELECT event_id, user_id, v, event_id % 100 AS z, row_number() {OVER}) AS n, count(v) {SO_FAR} AS m FROM {GAPPY})"""


# Rounded, and without the sign of a zero.
PLAIN = "CASE WHEN abs({0}) < 0.0005 THEN 0.0::DOUBLE ELSE round({0}, 3) END"


@query(
    "c81_exponential_covariance",
    f"""SELECT event_id, {PLAIN.format('cov')} AS cov, {PLAIN.format('cov_ignoring')} AS cov_ignoring, {PLAIN.format('biased')} AS biased, mean_ignoring
    FROM (SELECT event_id, CASE WHEN n > 1 THEN c / (1 - ww / (w * w)) END AS cov, CASE WHEN n > 1 THEN c2 / (1 - uu / (u * u)) END AS cov_ignoring,
    c AS biased, round(m, 6) AS mean_ignoring FROM (SELECT event_id, count(x) AS n, sum(w) AS w, sum(w * w) AS ww, sum(u) AS u, sum(u * u) AS uu, sum(u * x) / sum(u) AS m,
      sum(w * x * y) / sum(w) - sum(w * x) / sum(w) * sum(w * y) / sum(w) AS c, sum(u * x * y) / sum(u) - sum(u * x) / sum(u) * sum(u * y) / sum(u) AS c2
      FROM (SELECT a.event_id, b.v AS x, b.z AS y, pow(0.7, a.n - b.n) AS w, pow(0.7, a.m - b.m) AS u
        FROM {SEEN} AS a LEFT JOIN {SEEN} AS b ON a.user_id = b.user_id AND b.n <= a.n AND b.v IS NOT NULL) GROUP BY 1))""",
)
def exponential_covariance(spark: SparkSession, sf: str) -> DataFrame:
    """Covariances with weights that fall by row or by value, with and without bias."""
    df = rows = gappy(spark, sf).withColumn("z", F.col("event_id") % 100).select("event_id", "user_id", "ts", "v", "z")
    # The sizes of the groups are those of the table: no step is worked out again to count them.
    for out, kw in {"cov": {}, "cov_ignoring": {"ignore_na": True}, "biased": {"bias": True}}.items():
        df = W.ewm(df, "v", 0.3, BY, ORDER, out=out, fn="cov", other="z", within=rows, **kw)
    df = W.ewm(df, "v", 0.3, BY, ORDER, out="mean_ignoring", ignore_na=True, within=rows)
    plain = [F.when(F.abs(c) < 0.0005, 0.0).otherwise(r(c, 3)).alias(c) for c in ("cov", "cov_ignoring", "biased")]
    return df.select("event_id", *plain, r("mean_ignoring").alias("mean_ignoring"))
