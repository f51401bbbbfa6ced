"""URL filters: host and path rules first, then association rules of URL tokens, mined with FP-growth.

Pages that a list already judges are the labels: those under a block rule, and those with a seed word in the host, are bad, all others
are not. FP-growth finds the token sets that at least ``MIN_COUNT`` bad pages share, however many pages there are; they are counted over
all pages, and a set becomes a rule if its confidence is high and no smaller rule inside it does as well. An inverted index finds the
sets of a page: each is filed under its rarest token. A page that no list rule judges is blocked by a seed word in its own host, too.

Defined results: a null url, or one without ``://``, has an empty host and path, no tokens, and is allowed; of host and path rules that
fit, the longest wins, of equal length the first in order of text; ties in rarity go to the first token; repeated rows are judged one by
one; an empty table gives no rules.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.shared import ascii_lower, kept, table

MIN_COUNT = 5
MIN_CONFIDENCE = 0.8
MAX_TOKENS = 4

# Fixed by the contract of the query: host, path, verdict.
LIST = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Words of host names that mark a page as bad by themselves; a parameter of the method.
SEED_WORDS = ["casino", "bets", "betting", "poker", "pills", "viagra", "ads", "track", "tracking", "spam", "farm", "adult", "porn", "xxx", "warez"]


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed(h: Column, p: Column, rules: list[tuple[str, str, str]] = LIST) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, or null: one conditional expression."""
    out = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def tokens(h: Column, p: Column) -> Column:
    """Distinct tokens: labels and words of the host, the top domain, path segments with numbers made one, the first two in place."""
    labels = F.split(h, r"\.")
    words = F.transform(F.split(h, r"[.-]"), lambda w: F.concat(F.lit("h:"), w))
    top = F.array(F.concat(F.lit("top:"), F.element_at(labels, -1)), F.concat(F.lit("site:"), F.substring_index(h, ".", -2)))
    parts = F.transform(F.filter(F.split(p, "/"), lambda s: s != ""), lambda s: F.concat(F.lit("p:"), F.regexp_replace(ascii_lower(s), "[0-9]+", "0")))
    return F.when(h != "", F.array_distinct(F.concat(words, top, parts))).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, confidence, support) from rows of ``tokens`` and ``bad``: sets frequent among the bad rows, counted over all rows."""
    # Rows with equal tokens count together: a host with very many pages has few different ones.
    pages = labelled.groupBy(F.array_sort("tokens").alias("tokens")).agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
    pages = kept(pages, "url-tokens")
    n_bad = pages.agg(F.coalesce(F.sum("n_bad"), F.lit(0))).first()[0]
    model = FPGrowth(itemsCol="tokens", minSupport=min(1.0, (min_count - 0.5) / max(n_bad, 1)))
    frequent = model.fit(labelled.filter("bad").select("tokens")).freqItemsets.filter(F.size("items") <= MAX_TOKENS)
    sets = kept(frequent.filter(F.col("freq") >= min_count).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("support")), "url-itemsets")
    good = pages.select(F.col("tokens").alias("key"), "tokens", (F.col("n") - F.col("n_bad")).alias("n")).filter("n > 0")
    clean = _fits(good, sets.select("tokens")).groupBy(F.col("wanted").alias("tokens")).agg(F.sum("n").alias("clean"))
    seen = F.col("support") + F.coalesce("clean", F.lit(0))
    rules = sets.join(clean, "tokens", "left").withColumn("confidence", F.col("support") / seen).filter(F.col("confidence") >= min_confidence)
    rules = kept(rules.select("tokens", "support", "confidence"), "url-rules")
    # A rule goes if one inside it is as sure. Its smaller sets are found by key: a set has at most 2 ** MAX_TOKENS of them.
    inside = rules.select("tokens", "confidence", F.explode(_subsets(F.col("tokens"))).alias("part"))
    smaller = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("sure"))
    worse = inside.join(smaller, "part").filter("sure >= confidence").select("tokens").distinct()
    return rules.join(worse, "tokens", "left_anti")


def _subsets(items: Column) -> Column:
    """All smaller non-empty sets of a sorted list."""
    every = F.transform(
        F.sequence(F.lit(1), F.pow(F.lit(2), F.size(items)).cast("int") - 2),
        lambda mask: F.filter(items, lambda x, i: (F.floor(mask / F.pow(F.lit(2), i)) % 2) == 1),
    )
    return F.when(F.size(items) > 1, every).otherwise(F.array().cast("array<array<string>>"))


def _fits(pages: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of ``pages`` with every set (as ``wanted``) that their tokens hold: the index gives sets by their rarest token."""
    seen = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("uses"))
    ranked = sets.withColumn("token", F.explode("tokens")).join(seen, "token")
    others = [c for c in sets.columns if c != "tokens"]
    filed = ranked.groupBy("tokens", *others).agg(F.min_by("token", F.struct("uses", "token")).alias("token"))
    index = filed.select("token", F.col("tokens").alias("wanted"), *others)
    # Spark broadcasts the sets if their measured size is small, and shuffles them otherwise.
    found = pages.withColumn("token", F.explode("tokens")).join(index, "token")
    return found.filter(F.size(F.array_intersect("tokens", "wanted")) == F.size("wanted")).drop("token")


def match(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of ``key`` and ``tokens`` with the number of rules that fit."""
    fits = _fits(pages.select("key", "tokens"), rules.select("tokens", "confidence"))
    return fits.groupBy("key").agg(F.count("*").alias("n_rules"), F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, rules_list: list[tuple[str, str, str]] = LIST, seeds: list[str] = SEED_WORDS) -> DataFrame:
    """page_id, host, path, rule, verdict, n_rules and confidence of the mined rules that fit."""
    urls = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    urls = urls.withColumn("hit", listed(F.col("host"), F.col("path"), rules_list)).withColumn("tokens", tokens(F.col("host"), F.col("path")))
    seeded = F.arrays_overlap("tokens", F.array(*[F.lit(f"h:{w}") for w in seeds])) if seeds else F.lit(False)
    # Equal hosts and paths get equal verdicts, so they are matched by that pair, not by ids that may repeat.
    urls = kept(urls.withColumn("bad", F.coalesce(F.col("hit.verdict") == "block", F.lit(False)) | seeded), "urls")
    rules = mine(urls.filter(F.size("tokens") > 0))
    key = F.struct("host", "path")
    found = match(urls.filter("hit is null").select(key.alias("key"), "tokens").dropDuplicates(["key"]), rules)
    out = urls.join(found.select("key.host", "key.path", "n_rules", "confidence"), ["host", "path"], "left")
    return out.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when((F.col("n_rules") > 0) | F.col("bad"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"), "confidence",
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))
