"""Queries of dates, times and time series (C106-C111, C120-C123)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.functions import times as C
from sensorlake.operators import timeseries as Z
from sensorlake.plans.columns import GAPPY, gappy
from sensorlake.plans.registry import query, r, table

PARTS = {
    "year": "CAST(year(ts) AS INT)",
    "quarter": "CAST(quarter(ts) AS INT)",
    "month": "CAST(month(ts) AS INT)",
    "day": "CAST(day(ts) AS INT)",
    "hour": "CAST(hour(ts) AS INT)",
    "minute": "CAST(minute(ts) AS INT)",
    "second": "CAST(second(ts) AS INT)",
    "microsecond": "CAST(microsecond(ts) % 1000000 AS INT)",
    "week": "CAST(week(ts) AS INT)",
    "iso_year": "CAST(isoyear(ts) AS INT)",
    "dayofweek": "CAST(isodow(ts) - 1 AS INT)",
    "dayofyear": "CAST(dayofyear(ts) AS INT)",
    "days_in_month": "CAST(day(last_day(ts)) AS INT)",
    "is_leap_year": "(year(ts) % 4 = 0 AND (year(ts) % 100 <> 0 OR year(ts) % 400 = 0))",
    "is_month_start": "(day(ts) = 1)",
    "is_month_end": "(CAST(ts AS DATE) = last_day(ts))",
    "is_quarter_start": "(CAST(ts AS DATE) = date_trunc('quarter', ts))",
    "is_quarter_end": "(CAST(ts AS DATE) + 1 = date_trunc('quarter', CAST(ts AS DATE) + 1))",
    "is_year_start": "(dayofyear(ts) = 1)",
    "is_year_end": "(month(ts) = 12 AND day(ts) = 31)",
    "day_name": "dayname(ts)",
    "month_name": "monthname(ts)",
}

# Order dates span years; event times add the hours.
MOMENTS = "(SELECT o_orderkey, o_orderdate + to_microseconds(o_orderkey * 7919123457 % 86400000000) AS ts FROM orders) AS m"


def moments(spark: SparkSession, sf: str) -> DataFrame:
    micros = F.col("o_orderkey") * F.lit(7919123457) % F.lit(86400000000)
    ts = F.col("o_orderdate") + F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)"))
    return table(spark, sf, "orders").select("o_orderkey", ts.alias("ts"))


@query("c106_parts", f"SELECT o_orderkey, {', '.join(f'{e} AS {n}' for n, e in PARTS.items())} FROM {MOMENTS}")
def parts(spark: SparkSession, sf: str) -> DataFrame:
    return moments(spark, sf).select("o_orderkey", *[C.part("ts", n).alias(n) for n in PARTS])


STEP = "900000000"


@query(
    "c107_round_time",
    f"""SELECT o_orderkey, make_timestamp(us // {STEP} * {STEP}) AS low, make_timestamp((us + {STEP} - 1) // {STEP} * {STEP}) AS high,
    make_timestamp(CAST(round_even(us / {STEP}, 0) AS BIGINT) * {STEP}) AS near, date_trunc('day', ts)::TIMESTAMP AS midnight
    FROM (SELECT *, epoch_us(ts) AS us FROM {MOMENTS}) AS t""",
)
def rounding(spark: SparkSession, sf: str) -> DataFrame:
    step = "15 minutes"
    return moments(spark, sf).select(
        "o_orderkey",
        C.floor("ts", step).alias("low"),
        C.ceil("ts", step).alias("high"),
        C.round("ts", step).alias("near"),
        C.normalize("ts").alias("midnight"),
    )


@query(
    "c108_format_and_parse",
    f"""SELECT o_orderkey, strftime(ts, '%d.%m.%Y at %H:%M:%S') AS text, strftime(ts, '%A %d %B %Y') AS long_text,
    date_trunc('second', ts)::TIMESTAMP AS parsed, CASE WHEN o_orderkey % 5 > 0 THEN date_trunc('day', ts)::TIMESTAMP END AS coerced FROM {MOMENTS}""",
)
def format_and_parse(spark: SparkSession, sf: str) -> DataFrame:
    text = C.strftime("ts", "%d.%m.%Y at %H:%M:%S")
    spoiled = F.when(F.col("o_orderkey") % 5 > 0, C.strftime("ts", "%Y/%m/%d")).otherwise("no date")
    return moments(spark, sf).select(
        "o_orderkey",
        text.alias("text"),
        C.strftime("ts", "%A %d %B %Y").alias("long_text"),
        C.strptime(text, "%d.%m.%Y at %H:%M:%S").alias("parsed"),
        C.strptime(spoiled, "%Y/%m/%d", "coerce").alias("coerced"),
    )


@query(
    "c109_zones",
    f"""SELECT o_orderkey, ts + INTERVAL 9 HOUR AS tokyo, ts - INTERVAL 9 HOUR AS from_tokyo,
    ts + INTERVAL 5 HOUR + INTERVAL 30 MINUTE AS kolkata FROM {MOMENTS}""",
)
def zones(spark: SparkSession, sf: str) -> DataFrame:
    return moments(spark, sf).select(
        "o_orderkey",
        C.convert("ts", "Asia/Tokyo").alias("tokyo"),
        C.localize("ts", "Asia/Tokyo").cast("timestamp_ntz").alias("from_tokyo"),
        C.convert("ts", "Asia/Kolkata").alias("kolkata"),
    )


@query(
    "c110_durations",
    f"""SELECT o_orderkey, ts + to_seconds(o_orderkey % 5000 * 90) AS later, epoch_us(ts) / 1e6 - 946684800 AS since, strftime(ts, '%H:%M:%S.%f') AS clock,
    CAST(hour(ts) * 3600 + minute(ts) * 60 AS INT) AS seconds FROM {MOMENTS}""",
)
def durations(spark: SparkSession, sf: str) -> DataFrame:
    start = F.lit("2000-01-01").cast("timestamp_ntz")
    return moments(spark, sf).select(
        "o_orderkey",
        (F.col("ts") + C.duration(F.col("o_orderkey") % 5000 * 1.5, "m")).alias("later"),
        C.seconds_between(start, "ts").alias("since"),
        C.time_of_day("ts").alias("clock"),
        C.parse_time(C.strftime("ts", "%I:%M %p")).alias("seconds"),
    )


DAY = "CAST(ts AS DATE)"
TIME = "(ts - date_trunc('day', ts))"


@query(
    "c111_calendar_steps",
    f"""SELECT o_orderkey, date_trunc('month', ts)::TIMESTAMP + INTERVAL 1 MONTH + {TIME} AS month_begin,
    CASE WHEN {DAY} = last_day(ts) THEN last_day({DAY} + 1)::TIMESTAMP ELSE last_day(ts)::TIMESTAMP END + {TIME} AS month_end,
    date_trunc('quarter', ts)::TIMESTAMP + INTERVAL 3 MONTH + {TIME} AS quarter_begin,
    date_trunc('quarter', {DAY} + 1)::TIMESTAMP + INTERVAL 3 MONTH - INTERVAL 1 DAY + {TIME} AS quarter_end,
    date_trunc('year', ts)::TIMESTAMP + INTERVAL 1 YEAR + {TIME} AS year_begin,
    date_trunc('year', {DAY} + 1)::TIMESTAMP + INTERVAL 1 YEAR - INTERVAL 1 DAY + {TIME} AS year_end,
    ts + to_days(CAST(CASE WHEN isodow(ts) < 3 THEN 3 - isodow(ts) ELSE 10 - isodow(ts) END AS INT)) AS wednesday,
    ts + to_days(CAST(CASE WHEN isodow(ts) <= 2 THEN 3 WHEN isodow(ts) <= 5 THEN 5 WHEN isodow(ts) = 6 THEN 4 ELSE 3 END AS INT)) AS business_3,
    ts - to_days(CAST(CASE WHEN isodow(ts) = 1 THEN 3 WHEN isodow(ts) = 7 THEN 2 ELSE 1 END AS INT)) AS business_back
    FROM {MOMENTS}""",
)
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return moments(spark, sf).select(
        "o_orderkey",
        *[getattr(C, n)("ts").alias(n) for n in ("month_begin", "month_end", "quarter_begin", "quarter_end", "year_begin", "year_end")],
        C.next_weekday("ts", 2).alias("wednesday"),
        C.business_days("ts", 3).alias("business_3"),
        C.business_days("ts", -1).alias("business_back"),
    )


HOURS = """(SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS ts, count(*) AS n, avg(value) AS mean FROM events GROUP BY 1, 2)"""
SPINE = f"(SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 6 HOUR)) AS ts FROM {HOURS} AS h GROUP BY 1)"


@query("c120_resample", f"SELECT user_id, ts, n, round(mean, 8) AS mean FROM {SPINE} AS s LEFT JOIN {HOURS} AS h USING (user_id, ts)")
def resampled(spark: SparkSession, sf: str) -> DataFrame:
    out = Z.resample(table(spark, sf, "events"), "ts", "6 hours", ["user_id"], {"n": ("value", "count"), "mean": ("value", "mean")})
    return out.withColumn("mean", r("mean", 8))


@query(
    "c120_resample_filled",
    f"""SELECT user_id, ts, last_value(n IGNORE NULLS) OVER w AS n FROM {SPINE} AS s LEFT JOIN {HOURS} AS h USING (user_id, ts)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)""",
)
def resampled_filled(spark: SparkSession, sf: str) -> DataFrame:
    return Z.resample(table(spark, sf, "events"), "ts", "6 hours", ["user_id"], {"n": ("value", "count")}, fill="forward")


DAYS = "(SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS ts, max(value) AS top FROM events GROUP BY 1, 2)"


@query(
    "c121_as_frequency",
    f"""SELECT user_id, ts, last_value(top IGNORE NULLS) OVER w AS top FROM
    (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 12 HOUR)) AS ts FROM {DAYS} AS d GROUP BY 1) AS s LEFT JOIN {DAYS} AS d USING (user_id, ts)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)""",
)
def as_frequency(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "events").groupBy("user_id", F.col("ts").cast("date").cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("top"))
    return Z.as_freq(days, "ts", "12 hours", ["user_id"], fill="forward")


@query(
    "c122_interpolate",
    f"""SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
      ELSE pv + (nv - pv) * (us - pt) / (nt - pt) END, 6) AS v FROM (
      SELECT event_id, v, us, last_value(v IGNORE NULLS) OVER p AS pv, last_value(t IGNORE NULLS) OVER p AS pt,
        first_value(v IGNORE NULLS) OVER n AS nv, first_value(t IGNORE NULLS) OVER n AS nt
      FROM (SELECT *, epoch_us(ts) AS us, CASE WHEN v IS NOT NULL THEN epoch_us(ts) END AS t FROM {GAPPY}) AS g
      WINDOW p AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING),
        n AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS f""",
)
def interpolated(spark: SparkSession, sf: str) -> DataFrame:
    df = gappy(spark, sf).select("event_id", "user_id", "ts", "v")
    return Z.interpolate(df, "v", "ts", ["user_id"], ["event_id"]).select("event_id", r("v").alias("v"))


@query(
    "c123_time_of_day",
    """SELECT event_id, 'day' AS part FROM events WHERE CAST(ts AS TIME) BETWEEN TIME '09:30:00' AND TIME '17:00:00'
    UNION ALL SELECT event_id, 'night' FROM events WHERE CAST(ts AS TIME) >= TIME '22:00:00' OR CAST(ts AS TIME) <= TIME '05:00:00'
    UNION ALL SELECT event_id, 'some' FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-08 12:00:00' AND TIMESTAMP '2024-01-20 00:00:00'""",
)
def time_of_day(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    day = Z.between_times(e, "ts", "09:30", "17:00").select("event_id", F.lit("day").alias("part"))
    night = Z.between_times(e, "ts", "22:00", "05:00").select("event_id", F.lit("night").alias("part"))
    some = Z.truncate(e, "ts", "2024-01-08 12:00:00", "2024-01-20").select("event_id", F.lit("some").alias("part"))
    return day.unionByName(night).unionByName(some)


@query("c123_at_time", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS TIME) = TIME '00:00:00'")
def at_time(spark: SparkSession, sf: str) -> DataFrame:
    return Z.at_time(table(spark, sf, "orders"), "o_orderdate", "00:00").select("o_orderkey")
