"""Queries over files: landing, staging, the processed table."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sensorlake.operators.mapping import apply_mapping, normalize_columns, select_fields, stage_key, to_ts
from sensorlake.operators.quality import file_counts, ingest_summary, quarantine
from sensorlake.operators.udfs import group_apply
from sensorlake.plans.flow import FlowConfig, land_archives, land_errors, run_flow
from sensorlake.plans.registry import SENSORS, query, sensors, table
from sensorlake.schemas import SCHEMAS, conform
from sensorlake.session import pin, scratch_dir
from sensorlake.sources.archives import scan_archive_lines, scan_archives
from sensorlake.sources.batches import BATCH, new_batch, read_batches, write_batch
from sensorlake.sources.files import locate, plain_path
from sensorlake.sources.formats import write_table
from sensorlake.sources.landing import filter_objects, landing_manifest, scan_landing, scan_notified
from sensorlake.sources.tables import read_stage, register_table, scan_parquet, scan_table, sql, write_processed, write_stage
from sensorlake.sources.text import CORRUPT, scan_csv, scan_log
from sensorlake.streaming.incremental import run_incremental

ALL = f"SELECT * FROM {SENSORS}"
ACCEL = ("id", "timestamp", "accel_x", "accel_y", "accel_z")
SENSOR_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()), T.StructField("activity", T.StringType())]
    + [T.StructField(f"accel_{axis}", T.DoubleType()) for axis in "xyz"]
)
LINE = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SENSOR_SCHEMA.fields)


def new_table(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def land_csv(spark: SparkSession, sf: str, label: str, **kw) -> str:
    path = scratch_dir(spark, label)
    write_table(sensors(spark, sf), path, "csv", **kw)
    return path


def land_zips(spark: SparkSession, sf: str, columns: Sequence[str] = SENSOR_SCHEMA.names) -> str:
    """The sensor rows as CSV members of zip archives: 1000 rows a member, five members an archive."""
    root = scratch_dir(spark, "zips")
    s = sensors(spark, sf).withColumn("event_id", F.monotonically_increasing_id())
    fields = [F.col(c).cast("string") for c in columns]
    lines = s.select(
        F.floor(F.col("event_id") / 5000).alias("archive"), F.floor(F.col("event_id") / 1000).alias("member"), F.concat_ws(",", *fields).alias("line")
    )
    members = lines.groupBy("archive", "member").agg(F.array_join(F.collect_list("line"), "\n").alias("text"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
            for member, text in zip(pdf["member"], pdf["text"]):
                archive.writestr(f"d{member}/readings.csv", text + "\n")
            archive.writestr("readme.txt", "not data")
        system, name = locate(f"{root}/a{pdf['archive'].iloc[0]}.zip")
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(name) as out:
            out.write(data.getvalue())
        return pd.DataFrame({"n": [len(pdf)]})

    members.groupBy("archive").applyInPandas(pack, "n long").agg(F.sum("n")).collect()
    return root


@query("a01_archive_member_scan", ALL)
def archive_member_scan(spark: SparkSession, sf: str) -> DataFrame:
    members = scan_archives(spark, land_zips(spark, sf), "*.csv")
    lines = members.select(F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("line <> ''")
    return lines.select(F.from_csv("line", LINE).alias("r")).select("r.*")


@query("a01_archive_line_scan", ALL)
def archive_line_scan(spark: SparkSession, sf: str) -> DataFrame:
    lines = scan_archive_lines(spark, land_zips(spark, sf), "*.csv")
    return lines.select(F.from_csv("line", LINE).alias("r")).select("r.*")


@query("a02_landing_scan", f"SELECT activity AS folder, count(*) AS n_rows FROM {SENSORS} GROUP BY activity")
def landing_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = land_csv(spark, sf, "landing", partition_by=["activity"])
    folder = F.regexp_extract("rel", r"activity=([^/]+)/", 1)
    files = scan_landing(spark, root, "*.csv").select(plain_path(F.col("path")).alias("file"), folder.alias("folder"))
    rows = scan_csv(spark, root, keep_source=True).groupBy(plain_path(F.col("source_file")).alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return files.join(rows, "file").groupBy("folder").agg(F.sum("n").alias("n_rows"))


PAGE_KEYS = "SELECT *, 'raw/' || regexp_extract(url, '([^/]*)$', 1) AS key FROM pages"


@query(
    "a03_landing_manifest_flat",
    f"""SELECT key, arg_max(url, page_id) AS path, arg_max(length(html), page_id) AS size, max(page_id) AS mtime,
    count(*) - 1 AS n_collisions FROM ({PAGE_KEYS}) GROUP BY key""",
)
def manifest_flat(spark: SparkSession, sf: str) -> DataFrame:
    return landing_manifest(page_files(spark, sf), "flat")


def page_files(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        F.col("url").alias("path"),
        F.regexp_replace("url", "^[a-z]+://", "").alias("rel"),
        F.char_length("html").cast("long").alias("size"),
        F.col("page_id").alias("mtime"),
    )


@query(
    "a03_landing_manifest_tree",
    """SELECT 'raw/' || regexp_replace(url, '^[a-z]+://', '') AS key, arg_max(url, page_id) AS path,
    arg_max(length(html), page_id) AS size, max(page_id) AS mtime, count(*) - 1 AS n_collisions FROM pages GROUP BY 1""",
)
def manifest_tree(spark: SparkSession, sf: str) -> DataFrame:
    return landing_manifest(page_files(spark, sf), "tree")


@query("a04_filter_objects", "SELECT page_id, url FROM pages WHERE url LIKE 'https://%' AND url LIKE '%#top'")
def filtered_objects(spark: SparkSession, sf: str) -> DataFrame:
    return filter_objects(table(spark, sf, "pages").select("page_id", "url"), "https://", "#top", key="url")


@query("a05_notified_scan", f"SELECT * FROM {SENSORS} WHERE activity IN ('click', 'error')")
def notified_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "notified")
    bucket = f"{root}/bucket"
    write_table(sensors(spark, sf), bucket, partition_by=["activity"])
    files = scan_landing(spark, bucket, "*.parquet").where(F.col("rel").rlike("^activity=(click|error)/"))
    record = F.struct(
        F.struct(F.struct(F.lit("bucket").alias("name")).alias("bucket"), F.struct(F.col("rel").alias("key")).alias("object")).alias("s3")
    )
    notes = files.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("body"))
    found = scan_notified(spark, notes, lambda paths: spark.read.option("basePath", bucket).parquet(*paths), root, suffix=".parquet")
    return found.select(*SENSOR_SCHEMA.fieldNames())


@query("a06_csv_scan", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    events = table(spark, sf, "events")
    write_table(events, path, "csv")
    return scan_csv(spark, path, schema=events.schema)


@query("a06_csv_scan_inferred", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def csv_scan_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    write_table(table(spark, sf, "part"), path, "csv")
    return scan_csv(spark, path, infer=True)


@query(
    "a06_null_tokens",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS o_totalprice FROM orders",
)
def null_tokens(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    tokens = F.array(*[F.lit(t) for t in ("", "NA", "N/A", "null", "NaN", "None", "<NA>", "#N/A")])
    token = F.get(tokens, (F.col("o_orderkey") % 8).cast("int"))
    price = F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice").cast("string")).otherwise(token)
    write_table(table(spark, sf, "orders").select("o_orderkey", price.alias("o_totalprice")), path, "csv")
    return scan_csv(spark, path, schema=T.StructType.fromDDL("o_orderkey bigint, o_totalprice double"))


@query("a07_log_scan", ALL)
def log_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "log")
    write_table(sensors(spark, sf), path, "tsv", header="false")
    return scan_log(spark, path, SENSOR_SCHEMA, sep="\t", glob="*.csv")


@query("a07_log_scan_blanks", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def log_scan_blanks(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "log")
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    cols = [F.col(c).cast("string") for c in items.columns]
    items.select(F.concat(F.lit("  "), F.concat_ws("   ", *cols))).write.text(path)
    return scan_log(spark, path, items.schema, sep=None, glob="*.txt")


@query("a08_catalog_scan", ALL)
def catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "stage")
    write_processed(sensors(spark, sf), path)
    name = new_table("stage")
    register_table(spark, f"default.{name}", path, SENSOR_SCHEMA)
    return scan_table(spark, f"default.{name}")


@query("a09_processed_scan", ALL)
def processed_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "processed")
    write_processed(sensors(spark, sf), path)
    return scan_parquet(spark, path, SENSOR_SCHEMA)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query("a10_apply_mapping", f'SELECT id AS device, "timestamp" AS "at", accel_x AS x, CAST(accel_z AS BIGINT) AS z FROM {SENSORS}')
def mapped(spark: SparkSession, sf: str) -> DataFrame:
    s = as_text(sensors(spark, sf)).select(F.struct("id", "timestamp").alias("who"), F.struct(F.struct("accel_x").alias("a")).alias("v"), "accel_z")
    return apply_mapping(
        s,
        [
            ("who.id", "string", "device", "string"),
            ("who.timestamp", "string", "at", "timestamp_ntz"),
            ("v.a.accel_x", "double", "x", "double"),
            ("accel_z", "double", "z", "bigint"),
        ],
    )


@query(
    "a11_text_to_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 IN (0, 1, 2) THEN NULL ELSE o_orderdate END AS iso,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS slashed FROM orders""",
)
def text_to_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    bad = F.when(k % 11 == 0, "nope").when(k % 11 == 1, "").when(k % 11 == 2, "2024-13-01")
    iso = bad.otherwise(F.col("o_orderdate").cast("string"))
    slashed = F.when(k % 13 == 0, "31/31/1999 99").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH"))
    return table(spark, sf, "orders").select("o_orderkey", to_ts(iso).alias("iso"), to_ts(slashed, "dd/MM/yyyy HH").alias("slashed"))


@query("a12_typed_pass_through", f"SELECT id, accel_x, accel_y, accel_z FROM {SENSORS}")
def pass_through(spark: SparkSession, sf: str) -> DataFrame:
    return apply_mapping(sensors(spark, sf), [m for m in SCHEMAS["accel5"].mapping() if m[0] != "timestamp"])


@query("a13_select_fields", f'SELECT accel_z, id, "timestamp" FROM {SENSORS}')
def selected(spark: SparkSession, sf: str) -> DataFrame:
    return select_fields(sensors(spark, sf), ["accel_z", "id", "timestamp"])


@query("a14_normalize_columns", 'SELECT id AS sensor_id, "timestamp" AS time_stamp, accel_x, accel_y AS accel_y_1, activity AS activity FROM ' + SENSORS)
def normalized(spark: SparkSession, sf: str) -> DataFrame:
    s = sensors(spark, sf).select("id", "timestamp", "accel_x", "accel_y", "activity")
    odd = s.toDF(" Sensor ID ", "timeStamp", "Accel X", "ACCEL-Y 1", "Activity")
    return normalize_columns(odd, on_collision="suffix")


@query(
    "a15_stage_key",
    """SELECT page_id, regexp_replace(regexp_replace('raw/' || url || '/raw/a.csv.b.csv', '^raw/', 'stage/'), '\\.csv$', '.parquet') AS key
    FROM pages""",
)
def stage_keys(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat(F.lit("raw/"), F.col("url"), F.lit("/raw/a.csv.b.csv"))
    return table(spark, sf, "pages").select("page_id", stage_key(key).alias("key"))


@query(
    "a16_stage_replace_per_source",
    f"SELECT id, accel_x + CASE WHEN activity = 'click' THEN 1 ELSE 0 END AS accel_x, activity AS source_file FROM {SENSORS}",
)
def stage_replace(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "stage")
    s = sensors(spark, sf).select("id", "accel_x", F.col("activity").alias("source_file"))
    write_stage(s, path)
    changed = s.where("source_file = 'click'").withColumn("accel_x", F.col("accel_x") + 1)
    write_stage(changed, path)
    return read_stage(spark, path)


@query("a17_processed_append", f"SELECT * FROM {SENSORS} UNION ALL SELECT * FROM {SENSORS}")
def processed_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "processed")
    s = sensors(spark, sf)
    write_processed(s, path, "overwrite")
    write_processed(s, path, "append")
    return spark.read.parquet(path)


@query("a18_register_table", ALL)
def registered(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "processed")
    write_processed(sensors(spark, sf), path, partition_by=["activity"])
    name = new_table("readings")
    register_table(spark, name, path, SENSOR_SCHEMA, partition_by=["activity"])
    return sql(spark, f"SELECT * FROM {name}").select(*SENSOR_SCHEMA.fieldNames())


def to_accel(df: DataFrame) -> DataFrame:
    return select_fields(conform(df, SCHEMAS["accel5"]), ACCEL)


@query("a19_incremental_run", f'SELECT id, "timestamp", accel_x, accel_y, accel_z FROM {SENSORS}')
def incremental(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "incremental")
    s = as_text(sensors(spark, sf))
    early = F.col("timestamp") < "2024-01-15"
    args = (spark, f"{root}/src", to_accel, f"{root}/dst", f"{root}/checkpoint", s.schema)
    write_table(s.where(early), f"{root}/src/day1")
    run_incremental(*args)
    run_incremental(*args)  # nothing new: nothing added
    write_table(s.where(~early), f"{root}/src/day2")
    return run_incremental(*args)


def flow_config(root: str, name: str, **kw) -> FlowConfig:
    return FlowConfig(f"{root}/raw", f"{root}/stage", f"{root}/processed", f"{root}/rejects", name, SCHEMAS["accel5"], **kw)


@query("a20_raw_to_table", f'SELECT id, "timestamp", accel_x, accel_y, accel_z FROM {SENSORS}')
def raw_to_table(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "flow")
    s = sensors(spark, sf).select(*ACCEL).toDF("ID", "Timestamp", "Accel X", "accelY", "accel-z")
    write_table(s, f"{root}/raw", "csv")
    return run_flow(spark, flow_config(root, new_table("readings"))).table


@query("a20_log_to_table", f'SELECT id, "timestamp", accel_x, accel_y, accel_z FROM {SENSORS}')
def log_to_table(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "flow")
    write_table(sensors(spark, sf).select(*ACCEL), f"{root}/raw", "tsv", header="false")
    return run_flow(spark, flow_config(root, new_table("readings"), fmt="log", sep="\t")).table


@query("a20_archives_to_table", f'SELECT id, "timestamp", accel_x, accel_y, accel_z FROM {SENSORS}')
def archives_to_table(spark: SparkSession, sf: str) -> DataFrame:
    """From zip archives: unpack, land, stage, map, write, register."""
    root = scratch_dir(spark, "flow")
    land_archives(spark, land_zips(spark, sf, ACCEL), root, "*.csv")
    return run_flow(spark, flow_config(root, new_table("readings"), fmt="log", sep=",")).table


def land_files(spark: SparkSession, sf: str, root: str, where: str = "true", shift: float = 0.0) -> None:
    """The readings as CSV files of 250 events, ``file`` numbering them; each is written by a task."""
    file = F.floor(F.col("event_id") / 250).alias("file")
    rows = table(spark, sf, "events").select(
        file, F.col("user_id").cast("string").alias("id"), F.col("ts").cast("string").alias("timestamp"), (F.col("value") + shift).alias("accel_x"),
        F.get_json_object("props", "$.k").cast("double").alias("accel_y"), (F.col("event_id") % 100).cast("double").alias("accel_z"),
    )

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        system, name = locate(f"{root}/raw/f{pdf['file'].iloc[0]}.csv")
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(name) as out:
            out.write(pdf[list(ACCEL)].to_csv(index=False).encode())
        return pd.DataFrame({"n": [len(pdf)]})

    group_apply(rows.where(where), ["file"], put, "n long").agg(F.sum("n")).collect()


@query("a20_run_twice", f'SELECT id, "timestamp", accel_x, accel_y, accel_z FROM {SENSORS}')
def run_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Appended in two days, each run twice, with what a run leaves in between that died before its commit."""
    root, name = scratch_dir(spark, "flow"), new_table("readings")
    cfg = flow_config(root, name, mode="append")
    land_files(spark, sf, root, "file % 2 = 0")
    run_flow(spark, cfg)
    run_flow(spark, cfg)
    land_files(spark, sf, root, "file % 2 = 1")
    half = spark.table(name).drop(BATCH).withColumn("source_file", F.lit("half"))
    write_batch(half, cfg.processed, new_batch())
    run_flow(spark, cfg)
    return run_flow(spark, cfg).table


SHIFTED = "value + CASE WHEN event_id // 250 % 2 = 0 THEN 1 ELSE 0 END AS accel_x"


@query(
    "a20_changed_file",
    f"""SELECT CAST(user_id AS VARCHAR) AS id, ts AS "timestamp", {SHIFTED},
    CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS accel_y, CAST(event_id % 100 AS DOUBLE) AS accel_z FROM events""",
)
def changed_file(spark: SparkSession, sf: str) -> DataFrame:
    """Files that come again with other readings replace their old rows, and only those."""
    root = scratch_dir(spark, "flow")
    cfg = flow_config(root, new_table("readings"), mode="append")
    land_files(spark, sf, root)
    run_flow(spark, cfg)
    land_files(spark, sf, root, "file % 2 = 0", shift=1.0)
    return run_flow(spark, cfg).table


@query(
    "a21_files",
    """SELECT count(DISTINCT f) AS files_landed, count(DISTINCT f) FILTER (WHERE f % 2 = 1) AS files_converted,
    count(DISTINCT f) FILTER (WHERE f % 2 = 0) AS files_skipped, 0 AS files_failed FROM (SELECT event_id // 250 AS f FROM events)""",
)
def files_counted(spark: SparkSession, sf: str) -> DataFrame:
    """Files landed, converted and skipped by the second of two runs."""
    root = scratch_dir(spark, "flow")
    cfg = flow_config(root, new_table("readings"), mode="append")
    for where in ("file % 2 = 0", "file % 2 = 1"):
        land_files(spark, sf, root, where)
        result = run_flow(spark, cfg)
    return file_counts(result.files)


@query("a22_bad_archive", f'SELECT activity || \'.zip\' AS archive, count(*) AS rows FROM {SENSORS} WHERE activity IN (\'click\', \'view\') GROUP BY 1')
def bad_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Archives that are none (the text of an activity's rows under a zip's name) are named with the reason; the good ones land."""
    root = scratch_dir(spark, "archives")
    zips = land_zips(spark, sf, ACCEL)
    rows = sensors(spark, sf).where("activity IN ('click', 'view')").select("activity", F.to_csv(F.struct(*ACCEL)).alias("line"))

    def spoil(pdf: pd.DataFrame) -> pd.DataFrame:
        system, name = locate(f"{zips}/{pdf['activity'].iloc[0]}.zip")
        with system.open_output_stream(name) as out:
            out.write("\n".join(pdf["line"]).encode())
        return pd.DataFrame({"archive": [f"{pdf['activity'].iloc[0]}.zip"], "rows": [len(pdf)]})

    sizes = pin(rows.groupBy("activity").applyInPandas(spoil, "archive string, rows long"))
    land_archives(spark, zips, root, "*.csv")
    named = land_errors(spark, root).where("error <> ''").select(F.regexp_extract("source_file", r"([^/]*)$", 1).alias("archive"))
    return named.join(sizes, "archive")


def spoiled(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor rows as text, some with a bad time or a bad reading; one source per activity."""
    s = sensors(spark, sf)
    text = as_text(s).withColumn("source_file", F.col("activity"))
    z = F.col("accel_z").cast("double").cast("int")
    return text.withColumns(
        {
            "timestamp": F.when(z % 10 == 3, "nope").otherwise(F.col("timestamp")),
            "accel_y": F.when(z % 10 == 7, "abc").otherwise(F.col("accel_y")),
        }
    )


def checked(spark: SparkSession, sf: str) -> DataFrame:
    mapping = SCHEMAS["accel5"].mapping() + [("source_file", "string", "source_file", "string")]
    return apply_mapping(spoiled(spark, sf), mapping, on_error="quarantine")


IS_BAD = "CAST(accel_z AS BIGINT) % 10 IN (3, 7)"


@query(
    "a21_ingest_summary",
    f"""SELECT activity AS source_file, count(*) AS rows_in, count(*) FILTER (WHERE NOT {IS_BAD}) AS rows_out,
    count(*) FILTER (WHERE {IS_BAD}) AS rows_rejected FROM {SENSORS} GROUP BY activity""",
)
def summary(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = quarantine(checked(spark, sf))
    return ingest_summary(spoiled(spark, sf), good, bad)


@query(
    "a22_quarantine_rejects",
    f"""SELECT id, accel_x, accel_z, CASE WHEN CAST(accel_z AS BIGINT) % 10 = 3 THEN 'timestamp' ELSE 'accel_y' END AS failed
    FROM {SENSORS} WHERE {IS_BAD}""",
)
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = quarantine(checked(spark, sf))
    return bad.select("id", "accel_x", "accel_z", F.array_join("_errors", ",").alias("failed"))


@query("a22_quarantine_good", f'SELECT id, "timestamp", accel_x, accel_y, accel_z FROM {SENSORS} WHERE NOT {IS_BAD}')
def accepted(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = quarantine(checked(spark, sf))
    return good.select(*ACCEL)


@query("a22_unreadable_rows", "SELECT source, count(*) AS rows, count(*) FILTER (WHERE doc_id % 3 > 0) AS rejected FROM documents GROUP BY source")
def unreadable_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows too short or too long for their header, found while reading."""
    path = scratch_dir(spark, "ragged")
    k = F.col("doc_id") % 3
    docs = table(spark, sf, "documents")
    fields = F.concat_ws(",", "doc_id", "source", "lang")
    line = F.when(k == 0, fields).when(k == 1, F.concat(fields, F.lit(",more"))).otherwise(F.concat_ws(",", "doc_id", "source"))
    docs.select(line).write.option("header", "false").text(path)
    read = scan_log(spark, path, T.StructType.fromDDL("doc_id bigint, source string, lang string"), sep=",", on_bad="quarantine", glob="*.txt")
    return read.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("rejected"))


@query("a23_conform_sensor6", f'SELECT id AS user_id, activity, "timestamp", accel_x AS sensor1, accel_y AS sensor2, CAST(NULL AS DOUBLE) AS sensor3 FROM {SENSORS}')
def conformed(spark: SparkSession, sf: str) -> DataFrame:
    s = sensors(spark, sf).drop("accel_z")
    return conform(s, SCHEMAS["sensor6"], {"user_id": "id", "sensor1": "accel_x", "sensor2": "accel_y"})
