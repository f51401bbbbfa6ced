"""Queries of order, samples, sets and shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators import reshape as H, sets as S
from sensorlake.plans.columns import GAPPY, gappy
from sensorlake.plans.registry import query, r, table


@query("c82_sort", f"SELECT event_id, v, user_id FROM {GAPPY} ORDER BY user_id, v DESC NULLS LAST, event_id")
def sorted_rows(spark: SparkSession, sf: str) -> DataFrame:
    return S.sort(gappy(spark, sf).select("event_id", "v", "user_id"), ["user_id", ("v", "desc"), "event_id"])


@query("c83_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    return S.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 25, [("o_totalprice", "desc"), "o_orderkey"])


@query("c83_bottom_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def bottom_k(spark: SparkSession, sf: str) -> DataFrame:
    return S.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 25, ["o_totalprice", "o_orderkey"])


@query("c84_largest_all_ties", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= (SELECT min(l_quantity) FROM (SELECT l_quantity FROM lineitem ORDER BY l_quantity DESC LIMIT 10))")
def largest_all(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return S.top_k(items, 10, [("l_quantity", "desc")], ties="all")


@query(
    "c84_largest_among_nan",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber % 3 > 0
    AND l_quantity >= (SELECT min(l_quantity) FROM (SELECT l_quantity FROM lineitem WHERE l_linenumber % 3 > 0 ORDER BY l_quantity DESC LIMIT 10))""",
)
def largest_among_nan(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the quantities is NaN, which is no largest value."""
    quantity = F.when(F.col("l_linenumber") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", quantity.alias("l_quantity"))
    return S.top_k(items, 10, [("l_quantity", "desc")], ties="all")


@query(
    "c84_largest_per_group",
    "SELECT p_brand, p_size, p_partkey FROM (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS n FROM part) AS p WHERE n <= 3",
)
def largest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return S.top_k(table(spark, sf, "part").select("p_brand", "p_size", "p_partkey"), 3, [("p_size", "desc")], by=["p_brand"], ties="all")


@query("c85_head_and_tail", "(SELECT event_id FROM events ORDER BY ts, event_id LIMIT 7) UNION ALL (SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 7)")
def head_and_tail(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "ts")
    return S.head(e, 7, ["ts", "event_id"]).unionByName(S.tail(e, 7, ["ts", "event_id"])).select("event_id")


@query("c86_sample_fraction")
def sample_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return S.sample(table(spark, sf, "events"), fraction=0.1, seed=3)


@query("c86_sample_weighted", "SELECT CAST(100 AS BIGINT) AS n, true AS positive")
def sample_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """A hundred customers, by balance; who is drawn is chance, how many is not."""
    drawn = S.sample(table(spark, sf, "customer"), n=100, weights="c_acctbal", seed=3)
    return drawn.agg(F.count(F.lit(1)).alias("n"), (F.min("c_acctbal") > 0).alias("positive"))


DRAW = "((CAST('0x' || substr(md5('7|' || CAST({0} AS VARCHAR)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496)"


@query(
    "c86_sample_weighted_by_key",
    f"SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 ORDER BY -ln({DRAW.format('c_custkey')}) / c_acctbal LIMIT 60",
)
def sample_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Who is drawn by weight follows from seed and key."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return S.sample(customers, n=60, weights="c_acctbal", seed=7, key=["c_custkey"])


@query("c86_sample_large", f"SELECT event_id FROM events ORDER BY {DRAW.format('event_id')} LIMIT (SELECT CAST(round(0.4 * count(*)) AS BIGINT) FROM events)")
def sample_large(spark: SparkSession, sf: str) -> DataFrame:
    """Two fifths of the rows, exactly, without bringing them to one task."""
    return S.sample(table(spark, sf, "events").select("event_id"), fraction=0.4, seed=7, key=["event_id"], one_task=100)


@query("c83_large_k", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 2500")
def large_k(spark: SparkSession, sf: str) -> DataFrame:
    """More rows than one task shall hold (set low here): the cut is found by sampled ranks."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return S.top_k(items, 2500, [("l_extendedprice", "desc"), "l_orderkey", "l_linenumber"], one_task=500)


@query("c87_random_column", "SELECT count(*) AS n, true AS inside FROM events")
def random_column(spark: SparkSession, sf: str) -> DataFrame:
    rows = S.random_column(table(spark, sf, "events"), "u", seed=5)
    return rows.agg(F.count(F.lit(1)).alias("n"), ((F.min("u") >= 0) & (F.max("u") < 1)).alias("inside"))


PEOPLE = "SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance{0} FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal{1} FROM supplier"


def people(spark: SparkSession, sf: str) -> list[DataFrame]:
    c = table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    s = table(spark, sf, "supplier").selectExpr("s_suppkey AS k", "s_name AS name", "s_acctbal AS balance")
    return [c, s]


@query("c88_concat_outer", PEOPLE.format(", c_mktsegment AS segment", ", NULL"))
def concat_outer(spark: SparkSession, sf: str) -> DataFrame:
    return S.concat(people(spark, sf))


@query("c88_concat_inner", PEOPLE.format("", ""))
def concat_inner(spark: SparkSession, sf: str) -> DataFrame:
    return S.concat(people(spark, sf), join="inner")


DOUBLES = """SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n,
row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS m, count(*) OVER (PARTITION BY user_id, event_type) AS c FROM events"""
SUBSET, ORDER = ["user_id", "event_type"], ["ts", "event_id"]


@query("c89_drop_duplicates_first", f"SELECT event_id, user_id, event_type FROM ({DOUBLES}) AS d WHERE n = 1")
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return S.dedup(table(spark, sf, "events"), SUBSET, ORDER).select("event_id", "user_id", "event_type")


@query("c89_drop_duplicates_last", f"SELECT event_id, user_id, event_type FROM ({DOUBLES}) AS d WHERE m = 1")
def dedup_last(spark: SparkSession, sf: str) -> DataFrame:
    return S.dedup(table(spark, sf, "events"), SUBSET, ORDER, "last").select("event_id", "user_id", "event_type")


@query("c89_drop_duplicates_none", "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text HAVING count(*) = 1")
def dedup_none(spark: SparkSession, sf: str) -> DataFrame:
    return S.dedup(table(spark, sf, "documents").select("text", "doc_id"), ["text"], ["doc_id"], "none")


@query("c89_duplicated", f"SELECT event_id, n > 1 AS after_first, m > 1 AS before_last, c > 1 AS any FROM ({DOUBLES}) AS d")
def duplicated(spark: SparkSession, sf: str) -> DataFrame:
    df = S.duplicated(table(spark, sf, "events"), SUBSET, ORDER, "first", "after_first")
    df = S.duplicated(df, SUBSET, ORDER, "last", "before_last")
    return S.duplicated(df, SUBSET, ORDER, "none", "any").select("event_id", "after_first", "before_last", "any")


@query(
    "c90_melt",
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""",
)
def melted(spark: SparkSession, sf: str) -> DataFrame:
    return H.melt(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"])


@query(
    "c91_wide_to_long",
    """SELECT p_partkey, p_name, 1 AS year, p_retailprice AS price, p_size AS size FROM part
    UNION ALL SELECT p_partkey, p_name, 2, p_retailprice * 2, NULL FROM part""",
)
def wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "part").selectExpr("p_partkey", "p_name", "p_retailprice AS price_1", "p_retailprice * 2 AS price_2", "p_size AS size_1")
    return H.wide_to_long(wide, ["price", "size"], ["p_partkey"], "year", "_")


@query(
    "c91_grouped_reshape",
    """SELECT o_orderkey, o_custkey AS number, o_orderstatus AS code FROM orders UNION ALL SELECT o_orderkey, o_orderkey, o_orderpriority FROM orders""",
)
def grouped_reshape(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return H.grouped_reshape(orders, {"number": ["o_custkey", "o_orderkey"], "code": ["o_orderstatus", "o_orderpriority"]}, ["o_orderkey"])


@query(
    "c92_stack_unstack",
    """SELECT user_id, max(total) FILTER (WHERE event_type = 'click') AS click, max(total) FILTER (WHERE event_type = 'error') AS error,
    max(total) FILTER (WHERE event_type = 'purchase') AS purchase, max(total) FILTER (WHERE event_type = 'signup') AS signup,
    max(total) FILTER (WHERE event_type = 'view') AS view
    FROM (SELECT user_id, event_type, round(sum(value), 4) AS total FROM events GROUP BY 1, 2) AS t GROUP BY 1""",
)
def unstacked(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "events").groupBy("user_id", "event_type").agg(r(F.sum("value"), 4).alias("total"))
    return H.unstack(totals, ["user_id"], "event_type", "total", ["click", "error", "purchase", "signup", "view"])


@query("c93_explode", "SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings")
def exploded(spark: SparkSession, sf: str) -> DataFrame:
    return H.explode(table(spark, sf, "embeddings"), "embedding", "x").select("vec_id", F.col("x").cast("double").alias("x"))


@query(
    "c93_explode_empty",
    "SELECT doc_id, word FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN [NULL] ELSE string_split(lang || ' ' || source, ' ') END AS w FROM documents) AS d, unnest(w) AS u(word)",
)
def exploded_empty(spark: SparkSession, sf: str) -> DataFrame:
    words = F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.split(F.concat_ws(" ", "lang", "source"), " "))
    return H.explode(table(spark, sf, "documents").select("doc_id", words.alias("word")), "word")


@query(
    "c94_one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INT) AS "s_F", CAST(o_orderstatus = 'O' AS INT) AS "s_O", CAST(o_orderstatus = 'P' AS INT) AS "s_P"
    FROM orders""",
)
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    return H.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", prefix="s")


@query("c94_one_hot_decode", "SELECT o_orderkey, o_orderstatus AS status FROM orders")
def one_hot_decode(spark: SparkSession, sf: str) -> DataFrame:
    coded = H.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"], "s")
    return H.one_hot_decode(coded, {"s_F": "F", "s_O": "O", "s_P": "P"}, "status")


@query(
    "c95_cut",
    """SELECT event_id, CASE WHEN value > 0 AND value <= 10 THEN '(0, 10]' WHEN value > 10 AND value <= 50 THEN '(10, 50]'
    WHEN value > 50 AND value <= 100 THEN '(50, 100]' END AS bin,
    CASE WHEN value >= 0 AND value < 10 THEN 'low' WHEN value >= 10 AND value < 50 THEN 'mid' WHEN value >= 50 AND value < 100 THEN 'high' END AS left_bin
    FROM events""",
)
def cut(spark: SparkSession, sf: str) -> DataFrame:
    edges = [0, 10, 50, 100]
    return table(spark, sf, "events").select(
        "event_id", H.cut("value", edges).alias("bin"), H.cut("value", edges, right=False, labels=["low", "mid", "high"]).alias("left_bin")
    )


@query(
    "c95_cut_equal_width",
    """SELECT c_custkey, CASE WHEN c_acctbal <= lo + (hi - lo) * 1 / 4 THEN 0 WHEN c_acctbal <= lo + (hi - lo) * 2 / 4 THEN 1
    WHEN c_acctbal <= lo + (hi - lo) * 3 / 4 THEN 2 ELSE 3 END AS bin FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer) AS m""",
)
def cut_equal_width(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select("c_custkey", H.cut("c_acctbal", H.equal_width_edges(c, "c_acctbal", 4), labels=[0, 1, 2, 3]).alias("bin"))


@query(
    "c96_quantile_bins",
    """SELECT c_custkey, CASE WHEN c_acctbal <= q[1] THEN 0 WHEN c_acctbal <= q[2] THEN 1 WHEN c_acctbal <= q[3] THEN 2 ELSE 3 END AS bin
    FROM customer, (SELECT quantile_cont(c_acctbal, [0.25, 0.5, 0.75]) AS q FROM customer) AS m""",
)
def quantile_bins(spark: SparkSession, sf: str) -> DataFrame:
    return H.qcut(table(spark, sf, "customer"), "c_acctbal", 4).select("c_custkey", "bin")


ALL_OF_A_LINE = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"""


@query("c97_row_hash", f"SELECT count(DISTINCT ({ALL_OF_A_LINE})) AS distinct_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys, count(*) AS rows FROM lineitem")
def row_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with equal hashes are equal in all columns, and the other way round."""
    lines = table(spark, sf, "lineitem")
    hashed = H.row_hash(lines, lines.columns)
    key = H.row_hash(lines, ["l_orderkey", "l_linenumber"]).select("hash").distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))
    counts = hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("distinct_rows"), F.sum("n").alias("rows"))
    return counts.join(F.broadcast(key))
