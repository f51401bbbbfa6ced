"""Text functions on columns (C98-C105, C119)."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sensorlake.operators.aggregates import values_of


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- case (C98) ------------------------------------------------------------------------------------


def upper(c):
    return F.upper(_c(c))


def lower(c):
    return F.lower(_c(c))


def casefold(c):
    """Lower case for comparison: ß is ss, a final sigma is a sigma."""
    return F.replace(F.translate(F.lower(_c(c)), "ς", "σ"), F.lit("ß"), F.lit("ss"))


def _pieces(c: Column, pattern: str, fn) -> Column:
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), fn), "")


def title(c):
    """Every run of letters capitalised, whatever separates the runs."""
    return _pieces(_c(c), r"(?s)\p{L}+|[^\p{L}]+", capitalize)


def capitalize(c):
    c = _c(c)
    # A letter whose capital is two letters keeps the second one small.
    first = F.upper(F.substring(c, 1, 1))
    return F.concat(F.substring(first, 1, 1), F.lower(F.substr(first, F.lit(2))), F.lower(F.substr(c, F.lit(2))))


def swapcase(c):
    return _pieces(_c(c), r"(?s)\p{Lu}+|[^\p{Lu}]+", lambda x: F.when(F.rlike(x, F.lit(r"^\p{Lu}")), F.lower(x)).otherwise(F.upper(x)))


# -- trim and pad (C99) ------------------------------------------------------------------------


def strip(c, chars: str | None = None):
    return rstrip(lstrip(c, chars), chars)


def lstrip(c, chars: str | None = None):
    return F.regexp_replace(_c(c), r"(?U)^\s+", "") if chars is None else F.ltrim(_c(c), F.lit(chars))


def rstrip(c, chars: str | None = None):
    return F.regexp_replace(_c(c), r"(?U)\s+\z", "") if chars is None else F.rtrim(_c(c), F.lit(chars))


def pad(c, width: int, side: str = "left", fill: str = " "):
    """Filled up to ``width`` on the left, right or both sides; longer text is left alone."""
    c = _c(c)
    n = F.char_length(c)
    if side == "left":
        padded = F.lpad(c, width, fill)
    elif side == "right":
        padded = F.rpad(c, width, fill)
    else:
        missing = F.lit(width) - n
        left = F.floor(missing / 2) + F.when((missing % 2 == 1) & F.lit(width % 2 == 1), 1).otherwise(0)
        padded = F.rpad(F.concat(F.repeat(F.lit(fill), left.cast("int")), c), width, fill)
    return F.when(n >= width, c).otherwise(padded)


def zfill(c, width: int):
    """Zeros after the sign, if there is one."""
    c = _c(c)
    sign = F.regexp_extract(c, r"^[+-]?", 0)
    zeros = F.lpad(F.substr(c, F.char_length(sign) + 1), F.lit(width) - F.char_length(sign), F.lit("0"))
    return F.when(F.char_length(c) >= width, c).otherwise(F.concat(sign, zeros))


def repeat(c, n: int):
    return F.repeat(_c(c), n)


def removeprefix(c, prefix: str):
    c = _c(c)
    return F.when(F.startswith(c, F.lit(prefix)), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def removesuffix(c, suffix: str):
    c = _c(c)
    if not suffix:
        return c
    return F.when(F.endswith(c, F.lit(suffix)), F.substr(c, F.lit(1), F.char_length(c) - len(suffix))).otherwise(c)


# -- tests (C100) ----------------------------------------------------------------------------------


def contains(c, pattern: str, regex: bool = True, case: bool = True):
    if regex:
        return F.rlike(_c(c), F.lit(pattern if case else f"(?iu){pattern}"))
    return F.contains(_c(c), F.lit(pattern)) if case else F.contains(F.upper(_c(c)), F.lit(pattern.upper()))


def startswith(c, *prefixes: str):
    out = F.lit(False)
    for p in prefixes:
        out = out | F.startswith(_c(c), F.lit(p))
    return out


def endswith(c, *suffixes: str):
    out = F.lit(False)
    for s in suffixes:
        out = out | F.endswith(_c(c), F.lit(s))
    return out


def match(c, pattern: str):
    """The pattern fits at the start."""
    return F.rlike(_c(c), F.lit(rf"\A(?:{pattern})"))


def fullmatch(c, pattern: str):
    return F.rlike(_c(c), F.lit(rf"\A(?:{pattern})\z"))


# -- search (C101) -----------------------------------------------------------------------------


def find(c, sub: str):
    """Position from 0 of the first occurrence, or -1."""
    return F.instr(_c(c), sub) - 1


def rfind(c, sub: str):
    c = _c(c)
    back = F.instr(F.reverse(c), sub[::-1])
    return F.when(back > 0, F.char_length(c) - back - len(sub) + 1).otherwise(F.when(c.isNotNull(), -1))


def count(c, pattern: str):
    return F.regexp_count(_c(c), F.lit(pattern))


def findall(c, pattern: str, group: int = 0):
    return F.regexp_extract_all(_c(c), F.lit(pattern), F.lit(group))


def extract(c, pattern: str, group: int = 1):
    """A group of the first match; NULL where nothing matches."""
    c = _c(c)
    return F.when(F.rlike(c, F.lit(pattern)), F.regexp_extract(c, pattern, group))


# -- split and join (C102) -------------------------------------------------------------------------


def _quoted(text: str) -> str:
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def split(c, sep: str | None = None, n: int = -1):
    """Parts between separators, at most ``n`` splits from the left; no separator: runs of blanks."""
    c = _c(c)
    if sep is None:
        c = strip(c)
        parts = F.split(c, r"(?U)\s+", n + 1 if n > 0 else -1)
        return F.when(c == "", F.array().cast("array<string>")).otherwise(parts)
    return F.split(c, _quoted(sep), n + 1 if n > 0 else -1)


def rsplit(c, sep: str, n: int = -1):
    """At most ``n`` splits from the right."""
    parts = split(c, sep)
    if n <= 0:
        return parts
    keep = F.greatest(F.size(parts) - n, F.lit(1))
    first = F.array_join(F.slice(parts, F.lit(1), keep), sep)
    rest = F.slice(parts, keep + 1, F.greatest(F.size(parts) - keep, F.lit(0)))
    return F.when(_c(c).isNotNull(), F.concat(F.array(first), rest))


def partition(c, sep: str):
    """(before, separator, after) of the first separator."""
    c = _c(c)
    at = F.instr(c, sep)
    hit = F.array(F.substr(c, F.lit(1), at - 1), F.lit(sep), F.substr(c, at + len(sep)))
    return F.when(at > 0, hit).otherwise(F.when(c.isNotNull(), F.array(c, F.lit(""), F.lit(""))))


def rpartition(c, sep: str):
    """(before, separator, after) of the last separator."""
    c = _c(c)
    at = rfind(c, sep) + 1
    hit = F.array(F.substr(c, F.lit(1), at - 1), F.lit(sep), F.substr(c, at + len(sep)))
    return F.when(at > 0, hit).otherwise(F.when(c.isNotNull(), F.array(F.lit(""), F.lit(""), c)))


def get(parts, i: int):
    """Element from 0, or from the end if negative; NULL outside."""
    parts = _c(parts)
    return F.try_element_at(parts, F.lit(i + 1 if i >= 0 else i))


def join(parts, sep: str):
    """Joined text; NULL if any element is."""
    parts = _c(parts)
    return F.when(~F.exists(parts, lambda x: x.isNull()), F.array_join(parts, sep))


# -- slice and replace (C103) ------------------------------------------------------------------


def _bound(c: Column, at: int) -> Column:
    n = F.char_length(c)
    return F.least(F.lit(at), n) if at >= 0 else F.greatest(n + at, F.lit(0))


def slice(c, start: int = 0, stop: int | None = None, step: int = 1):
    c = _c(c)
    lo = _bound(c, start)
    hi = F.char_length(c) if stop is None else _bound(c, stop)
    part = F.substr(c, lo + 1, F.greatest(hi - lo, F.lit(0)))
    if step == 1:
        return part
    chars = F.filter(F.split(part, ""), lambda x, i: (i % step == 0))
    return F.array_join(chars, "")


def slice_replace(c, start: int = 0, stop: int | None = None, repl: str = ""):
    c = _c(c)
    lo = _bound(c, start)
    hi = F.char_length(c) if stop is None else F.greatest(_bound(c, stop), lo)
    return F.concat(F.substr(c, F.lit(1), lo), F.lit(repl), F.substr(c, hi + 1))


def replace(c, old: str, new: str, regex: bool = False):
    return F.regexp_replace(_c(c), old, new) if regex else F.replace(_c(c), F.lit(old), F.lit(new))


def translate(c, table: Mapping[str, str | None]):
    """Characters replaced one by one, or removed where the table says None."""
    kept = [k for k, v in table.items() if v is not None]
    gone = [k for k, v in table.items() if v is None]
    return F.translate(_c(c), "".join(kept + gone), "".join(table[k] for k in kept))


# -- character classes (C104) ------------------------------------------------------------------

# One pattern for each class a whole text can be of.
CLASSES = {
    "alnum": r"\A[\p{L}\p{N}]+\z",
    "alpha": r"\A\p{L}+\z",
    "decimal": r"\A\p{Nd}+\z",
    "digit": r"\A[\p{Nd}²³¹⁰⁴-⁹₀-₉]+\z",
    "numeric": r"\A\p{N}+\z",
    "space": r"(?U)\A\s+\z",
    "lower": r"(?s)\A[^\p{Lu}\p{Lt}]*\p{Ll}[^\p{Lu}\p{Lt}]*\z",
    "upper": r"(?s)\A[^\p{Ll}\p{Lt}]*\p{Lu}[^\p{Ll}\p{Lt}]*\z",
    "title": r"(?s)\A(?=.*\p{L})(?:[^\p{Lu}\p{Lt}\p{Ll}]|(?<![\p{Lu}\p{Lt}\p{Ll}])[\p{Lu}\p{Lt}]|(?<=[\p{Lu}\p{Lt}\p{Ll}])\p{Ll})+\z",
}


def is_class(c, name: str):
    return F.rlike(_c(c), F.lit(CLASSES[name]))


# -- length, bytes, Unicode forms, indicators (C105) ------------------------------------------------


def length(c):
    return F.char_length(_c(c))


def encode(c, charset: str = "utf-8"):
    return F.encode(_c(c), charset)


def normalize(c, form: str = "NFC"):
    """A Unicode normal form; the one text function that leaves the JVM, in batches."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize(form, t), na_action="ignore")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(_c(c))


def indicators(df: DataFrame, col: str, sep: str = "|", names: Sequence[str] | None = None) -> DataFrame:
    """A 0/1 column per part of a separated list (C105). Without ``names`` the parts are looked up."""
    parts = F.split(F.col(col), _quoted(sep))
    if names is None:
        names = values_of(df.select(F.explode(parts).alias("part")).where("part <> ''"), "part")
    return df.withColumns({n: F.coalesce(F.array_contains(parts, n).cast("int"), F.lit(0)) for n in names})


def slug(c, separator: str = "-", max_length: int = 0, stopwords: Sequence[str] = ()):
    """Lower-case words of ASCII letters and digits, joined (C119). Accents are removed; letters
    without an ASCII base are separators."""
    c = F.regexp_replace(_c(c), r"'+", "-")
    c = F.regexp_replace(normalize(c, "NFKD"), r"\p{M}+", "")
    c = F.regexp_replace(F.lower(c), r"(?<=\d),(?=\d)", "")
    c = F.regexp_replace(F.regexp_replace(c, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    if stopwords:
        words = F.filter(F.split(c, "-"), lambda w: ~w.isin(*[s.lower() for s in stopwords]))
        c = F.array_join(words, "-")
    if max_length:
        c = F.regexp_replace(F.substring(c, 1, max_length), r"-+$", "")
    return F.replace(c, F.lit("-"), F.lit(separator)) if separator != "-" else c
