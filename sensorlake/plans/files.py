"""Queries over file formats and datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sensorlake.plans.registry import query, r, table
from sensorlake.session import scratch_dir
from sensorlake.sources.formats import (
    flatten_json,
    path_partitions,
    read_chunks,
    read_dialect,
    read_fixed_width,
    read_table,
    write_csv,
    write_table,
)

EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def round_trip(spark: SparkSession, df: DataFrame, fmt: str, **opts) -> DataFrame:
    path = scratch_dir(spark, fmt)
    write_table(df, path, fmt, **opts)
    return read_table(spark, path, fmt, schema=df.schema, **opts)


@query(
    "c01_parquet_columns_and_filter",
    "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity < 10 AND l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'",
)
def parquet_columns(spark: SparkSession, sf: str) -> DataFrame:
    wanted = (F.col("l_quantity") < 10) & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return read_table(spark, f"{sf}/lineitem.parquet", columns=["l_orderkey", "l_extendedprice"], filters=wanted)


@query("c02_parquet_partitioned_write", EVENTS)
def parquet_write(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    write_table(events(spark, sf), path, partition_by=["event_type"])
    return read_table(spark, path)


@query("c03_orc_read", "SELECT event_id, value FROM events WHERE user_id < 20")
def orc_read(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "orc")
    write_table(events(spark, sf), path, "orc")
    return read_table(spark, path, "orc", ["event_id", "value"], "user_id < 20")


@query("c04_orc_write", EVENTS)
def orc_write(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(spark, events(spark, sf), "orc")


@query("c05_json_records", EVENTS)
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(spark, events(spark, sf), "json", timestampNTZFormat=MICROS)


@query(
    "c06_csv_dialect",
    """SELECT c_custkey, c_name, c_acctbal, c_acctbal > 0 AS in_credit, CASE WHEN c_nationkey <> 7 THEN c_nationkey END AS c_nationkey
    FROM customer""",
)
def csv_dialect(spark: SparkSession, sf: str) -> DataFrame:
    """Semicolons, a decimal comma, yes and no, a token for NULL, line breaks inside quotes."""
    path = scratch_dir(spark, "dialect")
    c = table(spark, sf, "customer")
    text = c.select(
        "c_custkey",
        F.concat(F.col("c_name"), F.lit('\n"; ')).alias("c_name"),
        F.replace(F.col("c_acctbal").cast("decimal(20,2)").cast("string"), F.lit("."), F.lit(",")).alias("c_acctbal"),
        F.when(F.col("c_acctbal") > 0, "yes").otherwise("no").alias("in_credit"),
        F.when(F.col("c_nationkey") == 7, "-").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"),
    )
    write_csv(text, path, delimiter=";")
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double, in_credit boolean, c_nationkey int")
    back = read_dialect(
        spark, path, schema, delimiter=";", newlines_in_values=True, null_tokens=("", "-"), true_tokens=("yes",), false_tokens=("no",), decimal_point=","
    )
    return back.withColumn("c_name", F.replace("c_name", F.lit('\n"; '), F.lit("")))


@query(
    "c07_csv_quoting",
    """SELECT '"' || p_partkey || '"|"' || p_name || '"|"' || p_size || '"' AS line FROM part""",
)
def csv_quoting(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "quoted")
    write_csv(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), path, header=False, delimiter="|", quoting="all")
    return spark.read.text(path).toDF("line")


@query("c08_fixed_width", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def fixed_width(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "fixed")
    cols = {"c_custkey": 12, "c_name": 24, "c_acctbal": 14, "c_mktsegment": 12}
    table(spark, sf, "customer").select(F.concat(*[F.rpad(F.col(c).cast("string"), n, " ") for c, n in cols.items()])).write.text(path)
    return read_fixed_width(
        spark, path, {"c_custkey": (0, 12, "bigint"), "c_name": (12, 36, "string"), "c_acctbal": (36, 50, "double"), "c_mktsegment": (50, 62, "string")}
    )


@query("c09_tab_separated", EVENTS)
def tab_separated(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(spark, events(spark, sf), "tsv")


@query("c10_xml_rows", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def xml_rows(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(spark, table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), "xml")


@query("c11_partition_discovery", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def partition_discovery(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "hive")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    write_table(orders, path, partition_by=["o_orderstatus", "o_orderpriority"])
    return read_table(spark, path, filters="o_orderstatus = 'F'")


@query("c12_path_partitions", "SELECT event_id, event_type AS kind, user_id % 4 AS part FROM events")
def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "folders")
    parted = events(spark, sf).select("event_id", "event_type", (F.col("user_id") % 4).alias("p"))
    write_table(parted, path, partition_by=["event_type", "p"])
    flat = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return path_partitions(flat, r"event_type=(?<kind>[^/]+)/p=(?<part>\d+)/", {"part": "bigint"}).select("event_id", "kind", "part")


@query(
    "c13_write_modes",
    """SELECT event_id, event_type, value + 1 AS value FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_id, event_type, value FROM events WHERE event_type = 'click'""",
)
def write_modes(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "modes")
    e = events(spark, sf).select("event_id", "value", "event_type")
    write_table(e, path, mode="error", partition_by=["event_type"])
    changed = e.where("event_type = 'error'").withColumn("value", F.col("value") + 1)
    write_table(changed, path, mode="delete_matching", partition_by=["event_type"])
    write_table(e.where("event_type = 'click'"), path, mode="overwrite_or_ignore", partition_by=["event_type"])
    return read_table(spark, path)


@query("c14_rows_per_file", "SELECT count(*) AS n_rows, true AS bounded, count(*) >= 500 AS several FROM lineitem")
def rows_per_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "capped")
    write_table(table(spark, sf, "lineitem"), path, max_rows_per_file=500)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 500).alias("bounded"), (F.count(F.lit(1)) > 1).alias("several"))


@query(
    "c15_dataset_scan",
    "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000 GROUP BY 1",
)
def dataset_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "dataset")
    write_table(table(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    wanted = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000)
    scan = read_table(spark, path, columns=["o_orderpriority", "o_totalprice"], filters=wanted)
    return scan.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), r(F.sum("o_totalprice"), 2).alias("total"))


@query("c16_chunked_read", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def chunked_read(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "chunks")
    e = events(spark, sf)
    write_table(e, f"{root}/src", partition_by=["event_type"])

    def summarise(chunk: DataFrame, number: int) -> None:
        sums = chunk.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        write_table(sums, f"{root}/sums/chunk={number}", mode="overwrite")

    chunks = read_chunks(spark, f"{root}/src", e.schema, files_per_chunk=2)
    chunks.writeStream.foreachBatch(summarise).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    sums = spark.read.parquet(f"{root}/sums")
    return sums.groupBy("event_type").agg(F.sum("n").alias("n"), r(F.sum("total"), 4).alias("total"))


@query(
    "c17_flatten_json",
    """SELECT o_orderkey, o_custkey AS "buyer_id", o_orderstatus AS "buyer_state_code", o_totalprice AS "price_total", o_totalprice / 2 AS "price_half_value"
    FROM orders""",
)
def flattened(spark: SparkSession, sf: str) -> DataFrame:
    price = F.struct(F.col("o_totalprice").alias("total"), F.struct((F.col("o_totalprice") / 2).alias("value")).alias("half"))
    buyer = F.struct(F.col("o_custkey").alias("id"), F.struct(F.col("o_orderstatus").alias("code")).alias("state"))
    text = F.to_json(F.struct(buyer.alias("buyer"), price.alias("price")))
    docs = table(spark, sf, "orders").select("o_orderkey", text.alias("doc"))
    schema = "buyer struct<id: bigint, state: struct<code: string>>, price struct<total: double, half: struct<value: double>>"
    return flatten_json(docs, "doc", schema, sep="_")


@query(
    "c17_flatten_json_records",
    """SELECT o_orderkey, o_custkey AS "buyer_id", kind, amount FROM orders,
    LATERAL (SELECT 'gross' AS kind, o_totalprice AS amount UNION ALL SELECT 'net', o_totalprice / 2) AS x""",
)
def flattened_records(spark: SparkSession, sf: str) -> DataFrame:
    items = F.array(
        F.struct(F.lit("gross").alias("kind"), F.col("o_totalprice").alias("amount")),
        F.struct(F.lit("net").alias("kind"), (F.col("o_totalprice") / 2).alias("amount")),
    )
    text = F.to_json(F.struct(F.struct(F.col("o_custkey").alias("id")).alias("buyer"), F.struct(items.alias("list")).alias("items")))
    docs = table(spark, sf, "orders").select("o_orderkey", text.alias("doc"))
    schema = "buyer struct<id: bigint>, items struct<list: array<struct<kind: string, amount: double>>>"
    return flatten_json(docs, "doc", schema, record_path=["items", "list"], meta=["buyer.id"], sep="_")
