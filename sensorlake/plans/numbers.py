"""Queries of number, list, struct, map and JSON functions (C112-C118)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.functions import maths as M, nested as N
from sensorlake.plans.registry import query, r, table

# The functions by name and the check's expression; x is in (0, 5), u in [0, 1).
MATHS = {
    "sin": "sin(x)", "cos": "cos(x)", "tan": "tan(u)", "arcsin": "asin(u)", "arccos": "acos(u)", "arctan": "atan(x)",
    "sinh": "sinh(x)", "cosh": "cosh(x)", "tanh": "tanh(x)", "arcsinh": "asinh(x)", "arccosh": "acosh(1 + x)", "arctanh": "atanh(u)",
    "exp": "exp(x)", "expm1": "exp(x) - 1", "log": "ln(x)", "log10": "log10(x)", "log1p": "ln(1 + x)", "sqrt": "sqrt(x)",
}
UNIT = ("tan", "arcsin", "arccos", "arctanh")


@query(
    "c112_elementary_functions",
    f"""SELECT event_id, {', '.join(f'round({e}, 6) AS {n}' for n, e in MATHS.items())}, round(atan2(u, x), 6) AS arctan2, abs(1 - x) AS "abs",
    CAST(floor(x) AS BIGINT) AS "floor", CAST(ceil(x) AS BIGINT) AS "ceil" FROM (SELECT event_id, value / 100 AS x, event_id % 100 / 101 AS u FROM events) AS e""",
)
def elementary(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", (F.col("value") / 100).alias("x"), (F.col("event_id") % 100 / 101).alias("u"))

    def arg(name: str):
        return 1 + F.col("x") if name == "arccosh" else F.col("u" if name in UNIT else "x")

    return e.select(
        "event_id",
        *[r(M.apply(n, arg(n))).alias(n) for n in MATHS],
        r(M.arctan2("u", "x")).alias("arctan2"),
        M.apply("abs", 1 - F.col("x")).alias("abs"),
        M.apply("floor", "x").alias("floor"),
        M.apply("ceil", "x").alias("ceil"),
    )


@query(
    "c113_rounding",
    """SELECT event_id, round_even(event_id / 2, 0) AS even, round(event_id / 2, 0) AS up, round_even(event_id / 10, 0) * 5 AS multiple FROM events""",
)
def rounding(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id",
        M.round_digits(k / 2).alias("even"),
        M.round_digits(k / 2, 0, "up").alias("up"),
        M.round_multiple(k / 2, 5.0).alias("multiple"),
    )


SORTED = "(SELECT event_type, list_sort(list(value)) AS s, count(*) - 1 AS m FROM events GROUP BY 1) AS q"


@query(
    "c114_winsorize",
    f"""SELECT event_id, least(greatest(value, s[CAST(round_even(0.05 * m, 0) AS BIGINT) + 1]), s[CAST(round_even(0.9 * m, 0) AS BIGINT) + 1]) AS value
    FROM events JOIN {SORTED} USING (event_type)""",
)
def winsorized(spark: SparkSession, sf: str) -> DataFrame:
    return M.winsorize(table(spark, sf, "events"), "value", 0.05, 0.1, ["event_type"]).select("event_id", "value")


@query(
    "c115_lists",
    """SELECT vec_id, CAST(len(embedding) AS INT) AS n, CAST(embedding[4] AS DOUBLE) AS fourth, CAST(embedding[-1] AS DOUBLE) AS last,
    round(list_sum(list_transform(embedding[11:20], lambda x: CAST(x AS DOUBLE))), 8) AS part,
    CAST(len(flatten([embedding, embedding[1:3]])) AS INT) AS flat, CAST(embedding[5] AS DOUBLE) AS third_of_every_second FROM embeddings""",
)
def lists(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("embedding")

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    return table(spark, sf, "embeddings").select(
        "vec_id",
        N.list_len(e).alias("n"),
        N.list_get(e, 3).cast("double").alias("fourth"),
        N.list_get(e, -1).cast("double").alias("last"),
        r(total(N.list_slice(e, 10, 20)), 8).alias("part"),
        F.size(N.list_flatten(F.array(e, N.list_slice(e, 0, 3)))).alias("flat"),
        N.list_get(N.list_slice(e, step=2), 2).cast("double").alias("third_of_every_second"),
    )


@query("c116_structs", "SELECT o_orderkey, o_custkey AS id, o_orderstatus AS code, o_orderstatus AS direct FROM orders")
def structs(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumnsRenamed({"o_custkey": "id", "o_orderstatus": "code"})
    nested = o.select("o_orderkey", N.make_struct("id", "code").alias("who"))
    both = nested.withColumn("direct", N.struct_field(F.struct(F.col("who").alias("a")), "a", "code"))
    return N.struct_expand(both, "who")


@query("c117_map_lookup", "SELECT o_orderkey, o_totalprice AS price, CAST(NULL AS DOUBLE) AS nothing, o_totalprice * 2 AS second FROM orders")
def map_lookup(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    m = F.create_map(F.lit("price"), price, F.lit("twice"), price * 2)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        N.map_lookup(m, "price").alias("price"),
        N.map_lookup(m, "nothing", "only").alias("nothing"),
        N.map_lookup(m, "twice", "last").alias("second"),
    )


@query(
    "c118_json_paths",
    """SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, 'k' AS keys, CAST(1 AS INT) AS n, least(user_id % 7 - 3, value) AS lo, greatest(user_id % 5 + 4, value) AS hi,
    round(user_id % 7 - 3 + user_id % 5 + 4 + value, 4) AS total, list_sort([user_id % 7 - 3, value, user_id % 5 + 4])[2] AS middle FROM events""",
)
def json_paths(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("user_id")
    numbers = F.to_json(F.array((u % 7 - 3).cast("double"), F.col("value"), (u % 5 + 4).cast("double")))
    e = table(spark, sf, "events").withColumn("numbers", numbers)
    return e.select(
        "event_id",
        N.json_get("props", "$.k").cast("int").alias("k"),
        F.array_join(N.json_keys("props"), ",").alias("keys"),
        N.json_length("props").alias("n"),
        N.json_min("numbers").alias("lo"),
        N.json_max("numbers").alias("hi"),
        r(N.json_sum("numbers"), 4).alias("total"),
        F.get(N.json_sort("numbers"), F.lit(1)).alias("middle"),
    )


@query(
    "c118_json_texts",
    """SELECT p_partkey, array_to_string(list_sort([p_type, p_name, p_brand]), '|') AS ordered, least(p_type, p_name, p_brand) AS first_text,
    greatest(p_type, p_name, p_brand) AS last_text FROM part""",
)
def json_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of texts in JSON, put in order."""
    texts = table(spark, sf, "part").select("p_partkey", F.to_json(F.array("p_type", "p_name", "p_brand")).alias("texts"))
    return texts.select(
        "p_partkey", F.array_join(N.json_sort("texts", "text"), "|").alias("ordered"), N.json_min("texts", "text").alias("first_text"), N.json_max("texts", "text").alias("last_text")
    )
