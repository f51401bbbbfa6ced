"""Quality rules: a decision list learned by sequential covering, applied as one ordered conditional expression.

Statistics, candidate counts and verdicts are DataFrame expressions; the driver sees counts per threshold only.

Defined results: a null or empty text has no words and fails the base rule; labels repeated for a document count once (the
lower quality wins); a table without labels, or with one class only, teaches an empty list, and the base rule alone decides;
extra columns pass through ``judge`` untouched; repeated rows are judged one by one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.shared import fold, kept, table

PLACE_BITS = 24
THRESHOLDS = 32
MAX_CONDITIONS = 3
MAX_RULES = 12
MIN_PRECISION = 0.9
MIN_COVER = 5

FEATURES = ["symbol_share", "dup_line_share", "repeat_share", "mean_word", "distinct_share", "letter_share", "words", "words_per_line"]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    covered: int = 0
    precision: float = 0.0

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, (c.column() for c in self.conditions))


@dataclass(frozen=True)
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def first_match(self) -> Column:
        """The number of the first rule that fires, from 1, or null."""
        out = None
        for i, rule in enumerate(self.rules, 1):
            out = F.when(rule.column(), F.lit(i)) if out is None else out.when(rule.column(), F.lit(i))
        return F.lit(None).cast("int") if out is None else out


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add counts of words, symbols and repeats under the names of the contract."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_words", F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), ""))
    out = out.withColumn("_lines", F.filter(F.split(t, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    # A window's hash and place share one long, so that windows of equal hash are neighbours after a sort of plain numbers.
    # `_words` is named more than once here, which keeps the optimizer from computing it again per element.
    at = lambda i: F.get(F.col("_words"), i)
    hashed = F.transform("_words", lambda w, i: F.shiftleft(F.xxhash64(w, at(i + 1), at(i + 2)), PLACE_BITS).bitwiseOR(i.cast("long")))
    n_windows = F.greatest(F.size("_words") - 2, F.lit(0))
    out = out.withColumn("_hashed", F.sort_array(F.slice(hashed, F.lit(1), n_windows)))
    hash_at = lambda i: F.shiftright(F.get(F.col("_hashed"), i), PLACE_BITS)
    twice = F.filter("_hashed", lambda x, i: (hash_at(i - 1) == F.shiftright(x, PLACE_BITS)) | (hash_at(i + 1) == F.shiftright(x, PLACE_BITS)))
    places = F.transform(twice, lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))
    # Where places outgrow their bits, every window is compared in full.
    every = F.when(n_windows > 0, F.sequence(F.lit(0), n_windows - 1)).otherwise(F.array().cast("array<int>"))
    out = out.withColumn("_maybe", F.when(F.size("_words") < 1 << PLACE_BITS, places).otherwise(every))
    # Windows of equal hash are compared as text, so a collision counts for nothing. Words hold no space: a space joins them without
    # ambiguity.
    window = lambda i: F.struct(F.concat_ws(" ", at(i), at(i + 1), at(i + 2)).alias("w"), i.alias("i"))
    out = out.withColumn("_sorted", F.sort_array(F.transform("_maybe", window)))
    text_at = lambda i: F.get(F.col("_sorted"), i)["w"]
    same = F.filter("_sorted", lambda x, i: (text_at(i - 1) == x["w"]) | (text_at(i + 1) == x["w"]))
    out = out.withColumn("_at", F.transform(same, lambda x: x["i"]))
    covered = F.array_distinct(F.concat(F.col("_at"), F.transform("_at", lambda i: i + 1), F.transform("_at", lambda i: i + 2)))
    return out.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace(t, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def shares(stats: DataFrame) -> DataFrame:
    """Add the shares that conditions compare."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return stats.select(
        "*",
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("n_dup_lines") / lines).alias("dup_line_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("word_chars") / words).alias("mean_word"),
        (F.col("n_distinct") / words).alias("distinct_share"),
        (F.col("n_letters") / chars).alias("letter_share"),
        F.col("n_words").cast("double").alias("words"),
        (F.col("n_words") / lines).alias("words_per_line"),
    )


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """How many bits a condition saves over the rule before it, for the bad rows that it covers."""
    if p == 0 or p0 == 0:
        return -1.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition | None, float]:
    """The condition of most gain, from one aggregate of counts per feature and bin."""
    parts = []
    for name, points in cuts.items():
        bin_no = F.lit(0)
        for p in points:
            bin_no = bin_no + (F.col(name) > F.lit(p)).cast("int")
        parts.append(F.struct(F.lit(name).alias("feature"), bin_no.alias("bin")))
    counts = rows.select(F.explode(F.array(*parts)).alias("b"), "bad").groupBy("b.feature", "b.bin", "bad").count().collect()
    table_ = {name: [[0, 0] for _ in range(len(points) + 1)] for name, points in cuts.items()}
    for r in counts:
        table_[r["feature"]][r["bin"]][int(r["bad"])] += r["count"]
    best, most = None, 0.0
    for name, bins in sorted(table_.items()):
        n0, p0 = (sum(b[k] for b in bins) for k in (0, 1))
        low_n = low_p = 0
        for point, (n, p) in zip(cuts[name], bins):
            low_n, low_p = low_n + n, low_p + p
            for above, pp, nn in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                gain = _gain(pp, nn, p0, n0)
                if pp + nn < p0 + n0 and pp >= MIN_COVER and gain > most + 1e-12:
                    best, most = Condition(name, above, point), gain
    return best, most


def learn(labelled: DataFrame, features: list[str] = FEATURES) -> DecisionList:
    """Grow rules for rows with ``bad`` = 1 on two thirds of the rows, prune them on the rest, and stop when no rule holds."""
    rows = labelled.filter(F.col("bad").isNotNull()).select("doc_id", F.col("bad").cast("int").alias("bad"), *features)
    rows = kept(rows.withColumn("grow", fold(F.col("doc_id"), 3) != 2), "quality-labelled")
    points = rows.approxQuantile(features, [i / THRESHOLDS for i in range(1, THRESHOLDS)], 0.002)
    cuts = {f: sorted(set(p)) for f, p in zip(features, points) if p}
    rules: list[Rule] = []
    while cuts and len(rules) < MAX_RULES:
        left = rows
        for rule in rules:
            left = left.filter(~rule.column())
        conditions: list[Condition] = []
        while len(conditions) < MAX_CONDITIONS:
            grown = left.filter("grow")
            for c in conditions:
                grown = grown.filter(c.column())
            best, _ = _best(grown, cuts)
            if best is None:
                break
            conditions.append(best)
        if not conditions:
            break
        # Prune: of all prefixes of the rule, the shortest with the best worth on the rows it was not grown from.
        prefixes = [Rule(tuple(conditions[: i + 1])).column() for i in range(len(conditions))]
        sums = [F.sum(F.when(c & (F.col("bad") == b), 1).otherwise(0)).alias(f"c{i}_{b}") for i, c in enumerate(prefixes) for b in (0, 1)]
        got = left.filter("not grow").agg(*sums).first()
        pairs = [(got[f"c{i}_1"] or 0, got[f"c{i}_0"] or 0) for i in range(len(prefixes))]
        p, n, i = max(((p, n, i) for i, (p, n) in enumerate(pairs)), key=lambda x: ((x[0] - x[1]) / max(x[0] + x[1], 1), -x[2]))
        if p < 1 or p / (p + n) < MIN_PRECISION:
            break
        rules.append(Rule(tuple(conditions[: i + 1]), p + n, p / (p + n)))
    return DecisionList(rules)


def learn_from(stats: DataFrame, labels: DataFrame) -> DecisionList:
    marks = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.min("quality") == 0).cast("int").alias("bad"))
    return learn(stats.join(marks, "doc_id"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row its id, statistics, the base verdict, the number of the rule that rejects it, and ``kept``."""
    stats = kept(statistics(docs.select("doc_id", "text")).drop("text"), "quality-stats")
    measured = shares(stats)
    rules = learn_from(measured, labels)
    out = measured.withColumn("rule_no", rules.first_match()).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule_no").isNull())


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule_no")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rule or the decision list rejects; rows are carried whole, beside their statistics."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")
    measured = shares(kept(statistics(packed).drop("text"), "quality-stage"))
    rules = learn_from(measured.drop("_row"), table(spark, sf_dir, "labels"))
    return measured.filter(~base_failed() & rules.first_match().isNull()).select("_row.*")
