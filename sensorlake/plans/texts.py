"""Queries of text functions over documents, pages and names (C98-C105, C119)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorlake.functions import strings as X
from sensorlake.plans.registry import query, table


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


# Results over whole texts are compared by their length and digest.
def digest(name: str, expr: str) -> str:
    return f"md5({expr}) AS {name}, length({expr}) AS {name}_n"


def digests(**columns: Column) -> list[Column]:
    out = []
    for name, c in columns.items():
        out += [F.md5(c).alias(name), F.char_length(c).cast("long").alias(f"{name}_n")]
    return out


UPPER = "replace(replace(upper(text), 'ß', 'SS'), 'ẞ', 'SS')"


@query(
    "c98_case",
    f"""SELECT doc_id, {digest('up', UPPER)}, {digest('low', 'lower(text)')}, {digest('cap', "CASE WHEN text[1] = 'ß' THEN 'Ss' ELSE upper(text[1]) END || lower(text[2:])")},
    {digest('folded', "replace(lower(text), 'ß', 'ss')")} FROM documents""",
)
def case(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id", *digests(up=X.upper("text"), low=X.lower("text"), cap=X.capitalize("text"), folded=X.casefold("text"))
    )


LETTERS = r"regexp_extract_all({0}, '[A-Za-z]+|[^A-Za-z]+')"


@query(
    "c98_title_and_swapcase",
    f"""SELECT p_partkey, list_aggregate(list_transform({LETTERS.format("p_name || ''' s-' || p_type")}, lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '') AS title,
    list_aggregate(list_transform(regexp_extract_all(p_name || p_type, '[A-Z]+|[^A-Z]+'), lambda x: CASE WHEN regexp_matches(x, '^[A-Z]') THEN lower(x) ELSE upper(x) END), 'string_agg', '') AS swapped
    FROM part""",
)
def title(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat("p_name", F.lit("' s-"), "p_type")
    return table(spark, sf, "part").select("p_partkey", X.title(text).alias("title"), X.swapcase(F.concat("p_name", "p_type")).alias("swapped"))


@query(
    "c99_trim_and_pad",
    """SELECT c_custkey, trim(padded) AS both, ltrim(padded) AS l, rtrim(padded) AS r, trim(padded, ' 0C') AS chars,
    CASE WHEN length(c_mktsegment) >= 10 THEN c_mktsegment ELSE lpad(c_mktsegment, 10, '*') END AS left_pad,
    CASE WHEN length(c_mktsegment) >= 10 THEN c_mktsegment ELSE rpad(c_mktsegment, 10, '*') END AS right_pad,
    CASE WHEN length(c_mktsegment) >= 11 THEN c_mktsegment ELSE
      rpad(repeat('*', CAST((11 - length(c_mktsegment)) // 2 + ((11 - length(c_mktsegment)) & 11 & 1) AS INT)) || c_mktsegment, 11, '*') END AS centre,
    CASE WHEN c_acctbal < 0 THEN '-' || lpad(substr(b, 2), 9, '0') ELSE lpad(b, 10, '0') END AS zeros, repeat(c_mktsegment, 2) AS twice,
    CASE WHEN starts_with(c_name, 'Customer#') THEN substr(c_name, 10) ELSE c_name END AS no_prefix,
    CASE WHEN ends_with(c_name, '0') THEN left(c_name, length(c_name) - 1) ELSE c_name END AS no_suffix
    FROM (SELECT *, '  ' || c_name || '   ' AS padded, printf('%.2f', c_acctbal) AS b FROM customer) AS c""",
)
def trim_and_pad(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit("  "), "c_name", F.lit("   "))
    seg = "c_mktsegment"
    return table(spark, sf, "customer").select(
        "c_custkey",
        X.strip(padded).alias("both"),
        X.lstrip(padded).alias("l"),
        X.rstrip(padded).alias("r"),
        X.strip(padded, " 0C").alias("chars"),
        X.pad(seg, 10, "left", "*").alias("left_pad"),
        X.pad(seg, 10, "right", "*").alias("right_pad"),
        X.pad(seg, 11, "both", "*").alias("centre"),
        X.zfill(F.format_string("%.2f", "c_acctbal"), 10).alias("zeros"),
        X.repeat(seg, 2).alias("twice"),
        X.removeprefix("c_name", "Customer#").alias("no_prefix"),
        X.removesuffix("c_name", "0").alias("no_suffix"),
    )


@query(
    "c100_tests",
    r"""SELECT doc_id, regexp_matches(text, 'ou[a-z]') AS found, regexp_matches(text, '(?i)THE') AS any_case, contains(text, 'e.') AS plain,
    (starts_with(text, 'E') OR starts_with(text, 'I')) AS starts, ends_with(text, '.') AS ends, regexp_matches(text, '^[A-Z][a-z]+ ') AS at_start,
    regexp_full_match(source, 'src[0-9]') AS whole FROM documents""",
)
def tests(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id",
        X.contains("text", "ou[a-z]").alias("found"),
        X.contains("text", "THE", case=False).alias("any_case"),
        X.contains("text", "e.", regex=False).alias("plain"),
        X.startswith("text", "E", "I").alias("starts"),
        X.endswith("text", ".").alias("ends"),
        X.match("text", "[A-Z][a-z]+ ").alias("at_start"),
        X.fullmatch("source", "src[0-9]").alias("whole"),
    )


@query(
    "c101_search",
    r"""SELECT doc_id, CAST(instr(text, 'en') - 1 AS INT) AS first, CAST(CASE WHEN instr(text, 'en') = 0 THEN -1 ELSE length(text) - instr(reverse(text), 'ne') - 1 END AS INT) AS last,
    CAST(len(regexp_extract_all(text, '[0-9]+')) AS INT) AS numbers, md5(array_to_string(regexp_extract_all(text, '[A-Z][a-z]+'), '|')) AS words,
    CASE WHEN regexp_matches(text, '([a-z]+)\. ') THEN regexp_extract(text, '([a-z]+)\. ', 1) END AS before_stop FROM documents""",
)
def search(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id",
        X.find("text", "en").alias("first"),
        X.rfind("text", "en").alias("last"),
        X.count("text", "[0-9]+").alias("numbers"),
        F.md5(X.join(X.findall("text", "[A-Z][a-z]+"), "|")).alias("words"),
        X.extract("text", r"([a-z]+)\. ").alias("before_stop"),
    )


@query(
    "c102_split_and_join",
    r"""SELECT page_id, CAST(len(string_split(url, '/')) AS INT) AS parts, string_split(url, '/')[3] AS host, string_split(url, '/')[-1] AS tail,
    regexp_extract(url, '^(.*)/[^/]*$', 1) AS all_but_last, split_part(url, '://', 1) AS scheme, regexp_extract(url, '^.*?://(.*)$', 1) AS rest,
    regexp_extract(url, '([^.]*)$', 1) AS after_dot, array_to_string(string_split(url, '/'), '>') AS joined,
    CAST(len(string_split_regex(trim(html, E' \n\t\r'), '\s+')) AS INT) AS words FROM pages""",
)
def split_and_join(spark: SparkSession, sf: str) -> DataFrame:
    url = X.split("url", "/")
    return table(spark, sf, "pages").select(
        "page_id",
        F.size(url).alias("parts"),
        X.get(url, 2).alias("host"),
        X.get(url, -1).alias("tail"),
        X.get(X.rsplit("url", "/", 1), 0).alias("all_but_last"),
        X.get(X.partition("url", "://"), 0).alias("scheme"),
        X.get(X.partition("url", "://"), 2).alias("rest"),
        X.get(X.rpartition("url", "."), 2).alias("after_dot"),
        X.join(url, ">").alias("joined"),
        F.size(X.split("html")).alias("words"),
    )


@query(
    "c103_slice_and_replace",
    r"""SELECT doc_id, md5(substr(text, 6)) AS from_five, text[-10:] AS last_ten, md5(text[1:-4]) AS but_three, 'X' || text[4:] = 'X' || substr(text, 4) AS same,
    md5('***' || substr(text, 4)) AS masked, md5(replace(text, 'ou', 'OU')) AS plain, md5(regexp_replace(text, '[0-9]+', '#', 'g')) AS patterned,
    md5(translate(text, 'aeb', 'AE')) AS translated, substr(text, 1, 1) || substr(text, 3, 1) || substr(text, 5, 1) AS every_second FROM documents""",
)
def slice_and_replace(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id",
        F.md5(X.slice("text", 5)).alias("from_five"),
        X.slice("text", -10).alias("last_ten"),
        F.md5(X.slice("text", 0, -3)).alias("but_three"),
        (F.concat(F.lit("X"), X.slice("text", 3)) == X.slice_replace("text", 0, 3, "X")).alias("same"),
        F.md5(X.slice_replace("text", 0, 3, "***")).alias("masked"),
        F.md5(X.replace("text", "ou", "OU")).alias("plain"),
        F.md5(X.replace("text", "[0-9]+", "#", regex=True)).alias("patterned"),
        F.md5(X.translate("text", {"a": "A", "e": "E", "b": None})).alias("translated"),
        X.slice("text", 0, 6, 2).alias("every_second"),
    )


FIRST = r"string_split_regex(trim(text, E' \n\t\r'), '\s+')[1]"


@query(
    "c104_character_classes",
    rf"""SELECT doc_id, regexp_full_match(w, '[\p{{L}}\p{{N}}]+') AS alnum, regexp_full_match(w, '\p{{L}}+') AS alpha, regexp_full_match(source, '[0-9]+') AS "decimal",
    regexp_full_match(w, '[0-9]+') AS digit, regexp_full_match(w, '\p{{N}}+') AS "numeric", false AS space,
    regexp_matches(w, '\p{{Ll}}') AND NOT regexp_matches(w, '\p{{Lu}}') AS lower, regexp_matches(w, '\p{{Lu}}') AND NOT regexp_matches(w, '\p{{Ll}}') AS upper,
    regexp_full_match(w, '[^\p{{L}}]*(\p{{Lu}}\p{{Ll}}*([^\p{{L}}]+|$))+') AS title
    FROM (SELECT *, {FIRST} AS w FROM documents) AS d""",
)
def classes(spark: SparkSession, sf: str) -> DataFrame:
    first = X.get(X.split("text"), 0)
    names = ("alnum", "alpha", "digit", "numeric", "space", "lower", "upper", "title")
    return documents(spark, sf).select("doc_id", X.is_class("source", "decimal").alias("decimal"), *[X.is_class(first, n).alias(n) for n in names])


@query(
    "c105_length_and_forms",
    "SELECT doc_id, CAST(length(text) AS INT) AS chars, CAST(strlen(text) AS INT) AS bytes, md5(nfc_normalize(text)) AS nfc FROM documents",
)
def length_and_forms(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id", X.length("text").alias("chars"), F.octet_length(X.encode("text")).alias("bytes"), F.md5(X.normalize(X.normalize("text", "NFD"))).alias("nfc")
    )


# The words that names of parts are made of.
NAME_WORDS = ("anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod", "small", "widget")


@query(
    "c105_indicators",
    "SELECT p_partkey, p_name, " + ", ".join(f"CAST(list_contains(string_split(p_name, ' '), '{w}') AS INT) AS {w}" for w in NAME_WORDS) + " FROM part",
)
def indicators(spark: SparkSession, sf: str) -> DataFrame:
    return X.indicators(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", " ", list(NAME_WORDS))


@query(
    "c119_slug",
    """SELECT doc_id, md5(trim(regexp_replace(lower(strip_accents(replace(regexp_replace(text, '''+', '-', 'g'), 'ß', ' '))), '[^a-z0-9]+', '-', 'g'), '-')) AS slug,
    'the-' || lang || '_' || source AS short FROM documents""",
)
def slugs(spark: SparkSession, sf: str) -> DataFrame:
    label = F.concat(F.lit(" The_"), "lang", F.lit("!"))
    short = F.concat_ws("_", X.slug(label), X.slug("source"))
    return documents(spark, sf).select("doc_id", F.md5(X.slug("text")).alias("slug"), short.alias("short"))
