"""Personal data: regular expressions propose spans, validators confirm them, context words move the score.

All steps are SQL expressions over one row. ``split`` gives the gaps between matches and ``regexp_extract_all`` the matches;
their lengths give the places. Patterns use possessive groups, which Java matches in a loop, so a run of a million digits
does not exhaust the stack. A look-behind starts each run once: where a run fails from its first character it fails from any
later one.

Defined results: a null or empty text has no spans; offsets are code points, ends exclusive; a row's result depends on its text
alone, so repeated rows and clashing names do not matter; ``redacted`` replaces each stretch of overlapping confirmed spans by
its first kind in brackets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.shared import table

CONTEXT_CHARS = 48
ACCEPT = 0.5


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Fourteen to nineteen digits whose Luhn sum is a multiple of ten."""
    d = F.reverse(digits(m))
    return F.when(F.length(d).between(14, 19), F.aggregate(F.transform(F.split(d, ""), _luhn_value), F.lit(0), lambda a, x: a + x) % 10 == 0).otherwise(False)


def _luhn_value(c: Column, i: Column) -> Column:
    """What the digit at place ``i`` from the right adds."""
    v = F.coalesce(c.try_cast("int"), F.lit(0))
    return F.when(i % 2 == 0, v).otherwise(2 * v - F.when(v > 4, 9).otherwise(0))


def small_parts(m: Column) -> Column:
    """Every dotted part is a number of at most 255."""
    return F.forall(F.split(m, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int") <= 255, F.lit(False)))


def phone_digits(m: Column) -> Column:
    return F.length(digits(m)).between(10, 15)


def mod97(m: Column) -> Column:
    """An account number: country and check digits go last, letters count from 10, the remainder is 1."""
    moved = F.concat(F.substr(m, F.lit(5)), F.substr(m, F.lit(1), F.lit(4)))
    step = lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97
    ).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def social(m: Column) -> Column:
    """Area, group and serial numbers that are given out."""
    return ~F.substr(m, F.lit(1), F.lit(3)).isin("000", "666") & ~m.startswith("9") & (F.substr(m, F.lit(5), F.lit(2)) != "00") & ~m.endswith("0000")


@dataclass(frozen=True)
class Kind:
    """``first`` and ``hint``: cheap tests that a text can hold the kind at all. ``score``: of a confirmed span without context."""

    name: str
    pattern: str
    valid: object
    hint: str
    score: float
    context: str


# Fixed by the contract of the queries: the first four kinds, in this order. Context words are a parameter of the method.
BASE = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, "@", 0.9, "mail|contact|write"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", small_parts, ".", 0.6, "ip|host|server|address"),
    # A run of digits with single separators, from its first digit; runs too short to pass are not even proposed.
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])(?=[0-9](?:[\x20-]?[0-9]){13})[0-9](?:[\x20-]?[0-9])++", luhn, "", 0.8, "card|visa|credit|payment|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", phone_digits, "+", 0.7, "phone|call|tel|mobile|fax"),
]
ADDED = [
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", mod97, "", 0.8, "iban|account|bank|konto"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", social, "-", 0.4, "ssn|social|security|tax"),
]
KINDS = BASE + ADDED


def _present(kind: Kind, text: Column) -> Column:
    return text.contains(kind.hint) if kind.hint else text.rlike(r"[0-9]{2}|[0-9][\x20-][0-9]")


def _gaps(kind: Kind, text: Column) -> Column:
    return F.when(_present(kind, text), F.split(text, kind.pattern, -1)).otherwise(F.array(text))


def _matches(kind: Kind, text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.when(_present(kind, text), found).otherwise(F.array().cast("array<string>"))


def _score(kind: Kind, gaps: Column, i: Column) -> Column:
    """Context words shortly before or after raise the score."""
    near = F.concat(F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS)), F.lit(" "), F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS)))
    return F.lit(kind.score) + F.when(F.lower(near).rlike(rf"\b(?:{kind.context})\b"), 0.2).otherwise(0.0)


def add_spans(df: DataFrame, text: str = "text", out: str = "spans", kinds: list[Kind] = KINDS) -> DataFrame:
    """Add an array of (start, rank, kind, end, score), in order of start and then of kind. Base kinds are all kept; an added
    one needs a score of ``ACCEPT``. Work columns start with two underscores and leave with the row."""
    names = df.columns
    df = df.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    for k in kinds:
        gaps, matches = F.col(f"__g_{k.name}"), F.col(f"__m_{k.name}")
        df = df.withColumn(f"__g_{k.name}", _gaps(k, F.col("__text"))).withColumn(f"__m_{k.name}", _matches(k, F.col("__text")))
        lengths = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        df = df.withColumn(f"__e_{k.name}", _running(lengths, F.size(matches)))
        ends = F.col(f"__e_{k.name}")
        spans = F.transform(matches, _span(k, gaps, ends))
        good = (lambda s: s["ok"]) if k in BASE else (lambda s: s["ok"] & (s["score"] >= ACCEPT))
        df = df.withColumn(f"__s_{k.name}", F.transform(F.filter(spans, good), lambda s: s.dropFields("ok")))
    merged = F.array_sort(F.concat(*[F.col(f"__s_{k.name}") for k in kinds]))
    return df.select(*[F.col(f"`{c}`") for c in names], merged.alias(out))


def _span(k: Kind, gaps: Column, ends: Column):
    return lambda m, i: F.struct(
        (F.get(ends, i) - F.length(m)).alias("start"), F.lit(KINDS.index(k)).alias("rank"), F.lit(k.name).alias("kind"),
        F.get(ends, i).alias("end"), _score(k, gaps, i).alias("score"), _valid(k, m).alias("ok"),
    )


def _valid(k: Kind, m: Column) -> Column:
    return F.lit(True) if k.valid is None else F.coalesce(k.valid(m), F.lit(False))


def _running(lengths: Column, n: Column, op=lambda a, x: a + x) -> Column:
    """Running sums of a list, or its running values of ``op``."""
    zero = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
    step = lambda a, x: F.struct(op(a["sum"], x).alias("sum"), F.concat(a["all"], F.array(op(a["sum"], x))).alias("all"))
    return F.when(n > 0, F.aggregate(lengths, zero, step)["all"]).otherwise(F.array().cast("array<int>"))


def redacted(df: DataFrame, text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """Replace ``text`` in place. Spans of the original text that overlap are one stretch, named by the first of them."""
    names = df.columns
    df = add_spans(df.withColumn("__original", F.col(text)), "__original", "__spans", kinds)
    old, spans = F.col("__original"), F.col("__spans")
    ends = _running(F.transform(spans, lambda s: s["end"]), F.size(spans), F.greatest)
    df = df.withColumn("__ends", F.when(F.size(spans) > 0, ends))
    # A span that starts behind all before it starts a stretch, and the one before ends there.
    heads = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (F.get(F.col("__ends"), i - 1) <= F.get(spans, i)["start"]))
    df = df.withColumn("__heads", F.when(F.size(spans) > 0, heads))
    heads = F.col("__heads")

    def piece(i: Column, k: Column) -> Column:
        """The text between the stretch before and this one, and its kind."""
        at = F.when(k > 0, F.get(F.col("__ends"), i - 1)).otherwise(0)
        return F.concat(F.substring(old, at + 1, F.get(spans, i)["start"] - at), F.lit("["), F.get(spans, i)["kind"], F.lit("]"))

    rest = F.substring(old, F.element_at(F.col("__ends"), -1) + 1, F.length(old))
    new = F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(heads, piece), ""), rest)).otherwise(old)
    return df.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in names])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = add_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), out="found")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return out.select(
        "doc_id", *[count(k.name) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")
    )


def stage_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the text; no document leaves. The row is carried as one struct, so no name can clash."""
    out = redacted(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"))
    return out.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
