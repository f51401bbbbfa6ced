"""Queries over the table of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators.joins import join, range_join
from sensorlake.operators.runs import Runs
from sensorlake.operators.windows import micros, rank
from sensorlake.plans.landing import new_table
from sensorlake.plans.registry import SENSORS, query, r, sensors, table
from sensorlake.schemas import SCHEMAS, conform
from sensorlake.session import scratch_dir
from sensorlake.sources.formats import write_table
from sensorlake.sources.tables import register_table, sql, write_processed
from sensorlake.sources.text import scan_csv
from sensorlake.streaming.buckets import run_to_table, windowed

STATS = """count(*) AS n, round(avg(accel_x), 6) AS mean_x, min(accel_x) AS min_x, max(accel_x) AS max_x,
round(stddev_samp(accel_x), 6) AS std_x"""


def on_sensors(spark: SparkSession, sf: str, text: str) -> DataFrame:
    return sql(spark, text, s=sensors(spark, sf))


def both(name: str, text: str) -> None:
    """A query whose text is the same in Spark and in the check; ``{s}`` is the sensor view."""

    @query(name, text.replace("{s}", SENSORS))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return on_sensors(spark, sf, text)


both(
    "b01_filter_identity_time_range",
    """SELECT id, timestamp, accel_x FROM {s} WHERE id = '8' AND timestamp >= TIMESTAMP '2024-01-05 00:00:00'
    AND timestamp < TIMESTAMP '2024-01-25 00:00:00' AND accel_x BETWEEN 5 AND 60""",
)

both(
    "b02_magnitude",
    "SELECT id, timestamp, round(sqrt(accel_x * accel_x + accel_y * accel_y + accel_z * accel_z), 6) AS magnitude FROM {s}",
)


@query("b03_group_aggregate", f"SELECT id, activity, {STATS} FROM {SENSORS} GROUP BY id, activity")
def group_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return on_sensors(spark, sf, f"SELECT id, activity, {STATS} FROM {{s}} GROUP BY id, activity")


@query("b03_group_aggregate_of_table", f"SELECT user_id, activity, {STATS} FROM (SELECT id AS user_id, * FROM {SENSORS}) AS t GROUP BY user_id, activity")
def group_aggregate_of_table(spark: SparkSession, sf: str) -> DataFrame:
    """End to end: CSV files, scan, mapping, processed Parquet, registered table, SQL."""
    root = scratch_dir(spark, "readings")
    write_table(sensors(spark, sf), f"{root}/raw", "csv")
    spec = SCHEMAS["sensor6"]
    names = {"user_id": "id", "sensor1": "accel_x", "sensor2": "accel_y", "sensor3": "accel_z"}
    write_processed(conform(scan_csv(spark, f"{root}/raw"), spec, names), f"{root}/processed")
    name = new_table("readings")
    register_table(spark, name, f"{root}/processed", spec.struct)
    return sql(spark, f"SELECT user_id, activity, {STATS.replace('accel_x', 'sensor1')} FROM {name} GROUP BY user_id, activity")


both("b04_distinct_count", "SELECT activity, count(DISTINCT id) AS ids, count(DISTINCT accel_y) AS readings FROM {s} GROUP BY activity")


@query("b04_approx_distinct_count")
def approx_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return on_sensors(spark, sf, "SELECT activity, approx_count_distinct(id) AS ids FROM {s} GROUP BY activity")


GROUPED = "SELECT id, activity, count(*) AS n, round(sum(accel_x), 4) AS total FROM {s} GROUP BY"
both("b05_rollup", f"{GROUPED} ROLLUP (id, activity)")
both("b05_cube", f"{GROUPED} CUBE (id, activity)")
both("b05_grouping_sets", f"{GROUPED} GROUPING SETS ((id), (activity), ())")

HOURLY = "SELECT id, {0} AS hour, count(*) AS n, round(avg(accel_x), 6) AS mean_x FROM {1} GROUP BY 1, 2"


@query("b06_time_bucket", HOURLY.format('date_trunc(\'hour\', "timestamp")', SENSORS))
def time_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return on_sensors(spark, sf, HOURLY.format("CAST(date_trunc('hour', timestamp) AS TIMESTAMP_NTZ)", "{s}"))


W = 'OVER (PARTITION BY id ORDER BY "timestamp"'


# Readings of one time are told apart by their values, so that the order is total.
W_TOTAL = 'OVER (PARTITION BY id ORDER BY "timestamp", accel_x, accel_z'


@query(
    "b07_window_functions",
    f"""SELECT id, "timestamp", accel_x, lag(accel_x) {W_TOTAL}) AS previous, round(avg(accel_x) {W_TOTAL} ROWS UNBOUNDED PRECEDING), 8) AS running_mean,
    CAST(rank() OVER (PARTITION BY id ORDER BY accel_x DESC) AS DOUBLE) AS place FROM {SENSORS}""",
)
def window_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Previous reading, running mean and rank per id, an id of any size."""
    s = sensors(spark, sf).select("id", "timestamp", "accel_x", "accel_z")
    runs = Runs(s, ["id"], ["timestamp", "accel_x", "accel_z"]).shift("accel_x", 1, "previous")
    runs = runs.cumulative("accel_x", "sum", "__sum").row_number("__n")
    rows = runs.rows().withColumn("running_mean", r(F.col("__sum") / F.col("__n"), 8)).drop("__sum", "__n", "accel_z")
    return rank(rows, "accel_x", ["id"], "min", descending=True, out="place")


def profile(s: DataFrame) -> DataFrame:
    # All readings; one device goes by another name, so that a key is on either side alone.
    named = F.when(F.col("id") == "3", "three").otherwise(F.col("id")).alias("id")
    return s.groupBy(named).agg(F.avg("accel_x").alias("usual"))


PROFILE = f"(SELECT CASE WHEN id = '3' THEN 'three' ELSE id END AS id, avg(accel_x) AS usual FROM {SENSORS} GROUP BY 1) AS p"


@query("b08_join_inner", f'SELECT s.id, s."timestamp", round(accel_x - usual, 6) AS above FROM {SENSORS} JOIN {PROFILE} ON s.id = p.id')
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    s = sensors(spark, sf)
    return join(s, profile(s), ["id"]).select("id", "timestamp", r(F.col("accel_x") - F.col("usual")).alias("above"))


@query("b08_join_left", f'SELECT s.id, s."timestamp", round(usual, 6) AS usual FROM {SENSORS} LEFT JOIN {PROFILE} ON s.id = p.id')
def join_left(spark: SparkSession, sf: str) -> DataFrame:
    s = sensors(spark, sf)
    return join(s, profile(s), ["id"], "left").select("id", "timestamp", r("usual").alias("usual"))


@query("b08_join_full", f"SELECT coalesce(s.id, CAST(c_custkey AS VARCHAR)) AS id, accel_x, c_name FROM {SENSORS} FULL JOIN customer c ON s.id = CAST(c.c_custkey AS VARCHAR)")
def join_full(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_name")
    return join(sensors(spark, sf).select("id", "accel_x"), customers, ["id"], "full")


both("b08_join_semi", "SELECT a.id, a.timestamp FROM (SELECT * FROM {s}) a WHERE EXISTS (SELECT 1 FROM (SELECT * FROM {s}) b WHERE b.id = a.id AND b.accel_x > 200)")
both("b08_join_anti", "SELECT a.id, a.timestamp FROM (SELECT * FROM {s}) a WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM {s}) b WHERE b.id = a.id AND b.accel_x > 200)")


@query(
    "b09_range_join",
    f"""SELECT s.id, s."timestamp", i.shift FROM {SENSORS} JOIN
    (SELECT o_orderkey AS shift, TIMESTAMP '2024-01-01' + to_minutes(o_orderkey * 53 % 43200) AS lo,
     TIMESTAMP '2024-01-01' + to_minutes(o_orderkey * 53 % 43200 + 1 + o_custkey % 9) AS hi FROM orders) AS i
    ON s."timestamp" >= i.lo AND s."timestamp" < i.hi""",
)
def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("o_orderkey") * 53 % 43200
    base = F.lit("2024-01-01").cast("timestamp_ntz")

    def after(minutes):
        return base + F.make_dt_interval(mins=minutes.cast("int"))

    shifts = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("shift"), after(start).alias("lo"), after(start + 1 + F.col("o_custkey") % 9).alias("hi")
    )
    s = sensors(spark, sf).select("id", "timestamp")
    return range_join(s, shifts, "timestamp", "lo", "hi", width=600).select("id", "timestamp", "shift")


MAGNITUDE = "round(sqrt(accel_x * accel_x + accel_y * accel_y + accel_z * accel_z), 6)"
both("b10_top_ten", f"SELECT id, timestamp, {MAGNITUDE} AS magnitude FROM {{s}} ORDER BY magnitude DESC, timestamp LIMIT 10")

both(
    "b11_top_three_per_id",
    """SELECT id, timestamp, accel_x, place FROM (SELECT id, timestamp, accel_x,
    CAST(row_number() OVER (PARTITION BY id ORDER BY accel_x DESC, timestamp) AS INT) AS place FROM {s}) AS t WHERE place <= 3""",
)


def two_days(op: str) -> str:
    day = "SELECT id, activity FROM {s} WHERE timestamp >= TIMESTAMP '2024-01-%s 00:00:00' AND timestamp < TIMESTAMP '2024-01-%s 00:00:00'"
    return f"{day % ('10', '11')} {op} {day % ('11', '12')}"


both("b12_union", two_days("UNION"))
both("b12_union_all", two_days("UNION ALL"))
both("b12_intersect", two_days("INTERSECT"))
both("b12_except", two_days("EXCEPT"))

both(
    "b13_above_own_mean",
    "SELECT a.id, a.timestamp, a.accel_x FROM (SELECT * FROM {s}) a WHERE a.accel_x > (SELECT avg(b.accel_x) FROM (SELECT * FROM {s}) b WHERE b.id = a.id)",
)


@query(
    "b14_sessions",
    f"""SELECT id, min("timestamp") AS starts, max("timestamp") AS ends, count(*) AS n FROM (
      SELECT id, "timestamp", sum(fresh) {W}) AS session FROM (
        SELECT id, "timestamp", CASE WHEN "timestamp" - lag("timestamp") {W}) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
        FROM {SENSORS}) AS a) AS b GROUP BY id, session""",
)
def sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions end after 30 minutes without a reading; an id may have any number of readings."""
    s = sensors(spark, sf).select("id", "timestamp")
    s = s.withColumn("at", micros(s, "timestamp"))
    runs = Runs(s, ["id"], ["timestamp"]).shift("at", 1, "was")
    fresh = F.when(F.col("at") - F.col("was") <= 30 * 60 * 1_000_000, 0).otherwise(1)
    runs = runs.with_df(runs.df.withColumn("fresh", fresh)).cumulative("fresh", "sum", "session")
    return runs.rows().groupBy("id", "session").agg(
        F.min("timestamp").alias("starts"), F.max("timestamp").alias("ends"), F.count(F.lit(1)).alias("n")
    ).drop("session")


# Windows that end at or before the newest time less the hour of grace are closed.
CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


@query(
    "b15_streamed_tumbling_mean",
    f"""SELECT * FROM (SELECT user_id, date_trunc('day', ts) AS start, date_trunc('day', ts) + INTERVAL 1 DAY AS "end", count(*) AS n,
    round(avg(value), 6) AS mean FROM events GROUP BY 1, 2) AS t WHERE "end" <= {CLOSED}""",
)
def streamed_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return streamed(spark, sf, "1 day", None)


@query(
    "b15_streamed_sliding_mean",
    f"""SELECT * FROM (SELECT user_id, start, start + INTERVAL 1 DAY AS "end", count(*) AS n, round(avg(value), 6) AS mean
    FROM (SELECT user_id, value, unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS start
    FROM events) AS e GROUP BY 1, 2) AS t WHERE "end" <= {CLOSED}""",
)
def streamed_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return streamed(spark, sf, "1 day", "12 hours")


def streamed(spark: SparkSession, sf: str, size: str, slide: str | None) -> DataFrame:
    root = scratch_dir(spark, "stream")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out = windowed(stream, "ts", ["user_id"], size, {"n": ("value", "count_all"), "mean": ("value", "mean")}, slide)
    return run_to_table(spark, out, f"{root}/out", f"{root}/checkpoint").withColumn("mean", r("mean"))
