"""Lists, structs, maps and JSON text (C115-C118)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- lists (C115) ----------------------------------------------------------------------------------


def list_len(c) -> Column:
    return F.when(_c(c).isNotNull(), F.size(_c(c)))


def list_get(c, i: int) -> Column:
    """Element from 0, or from the end if negative; NULL outside."""
    return F.get(_c(c), F.lit(i)) if i >= 0 else F.try_element_at(_c(c), F.lit(i))


def list_slice(c, start: int = 0, stop: int | None = None, step: int = 1) -> Column:
    c = _c(c)
    n = F.lit(2**31 - 1 - start) if stop is None else F.lit(max(stop - start, 0))
    part = F.slice(c, F.lit(start + 1), F.least(n, F.greatest(F.size(c), F.lit(0))))
    return part if step == 1 else F.filter(part, lambda x, i: i % step == 0)


def list_flatten(c) -> Column:
    """One level of nesting removed."""
    return F.flatten(_c(c))


# -- structs (C116) --------------------------------------------------------------------------------


def struct_field(c, *path: str) -> Column:
    c = _c(c)
    for step in path:
        c = c.getField(step)
    return c


def struct_expand(df: DataFrame, col: str) -> DataFrame:
    """The fields of a struct as columns, in its place."""
    return df.select(*[c for c in df.columns if c != col], f"`{col}`.*")


def make_struct(*names: str) -> Column:
    return F.struct(*names)


# -- maps (C117) -----------------------------------------------------------------------------------


def map_lookup(c, key, which: str = "first") -> Column:
    """The value of a key: the first, the last, or ``all`` of them, in lists of entries with doubles."""
    c = _c(c)
    if which == "only":
        return F.try_element_at(c, F.lit(key))
    found = F.transform(F.filter(F.map_entries(c), lambda e: e["key"] == F.lit(key)), lambda e: e["value"])
    if which == "all":
        return F.when(F.size(found) > 0, found)
    return F.get(found, F.lit(0)) if which == "first" else F.try_element_at(found, F.lit(-1))


# -- JSON text (C118) ------------------------------------------------------------------------------


def json_get(c, path: str) -> Column:
    """The value at a path such as ``$.a.b[0]``, as text."""
    return F.get_json_object(_c(c), path)


def json_keys(c) -> Column:
    return F.json_object_keys(_c(c))


def json_length(c) -> Column:
    """Elements of an array, keys of an object or characters of a string."""
    c = _c(c)
    return F.coalesce(F.json_array_length(c), F.size(F.json_object_keys(c)), F.char_length(F.get_json_object(c, "$")))


def json_numbers(c) -> Column:
    return F.from_json(_c(c), "array<double>")


def json_texts(c) -> Column:
    """The elements of an array that holds texts only; NULL for any other."""
    elements = F.try_variant_get(F.try_parse_json(_c(c)), "$", "array<variant>")
    texts = F.transform(elements, lambda e: F.try_variant_get(e, "$", "string"))
    return F.when(F.forall(elements, lambda e: F.schema_of_variant(e) == "STRING"), texts)


def _json_elements(c, kind: str) -> Column:
    if kind not in ("number", "text"):
        raise ValueError(f"kind: {kind}")
    return json_numbers(c) if kind == "number" else json_texts(c)


def json_sort(c, kind: str = "number") -> Column:
    """The elements of an array of numbers, or of texts, in order."""
    return F.array_sort(_json_elements(c, kind))


def json_min(c, kind: str = "number") -> Column:
    return F.array_min(_json_elements(c, kind))


def json_max(c, kind: str = "number") -> Column:
    return F.array_max(_json_elements(c, kind))


def json_sum(c) -> Column:
    return F.aggregate(json_numbers(c), F.lit(0.0), lambda a, x: a + x)


def json_avg(c) -> Column:
    """Mean of the elements; NULL without any."""
    return F.try_divide(json_sum(c), F.size(json_numbers(c)))


def json_values(c, names: Sequence[str]) -> Column:
    """Several top-level fields in one pass over the text."""
    return F.from_json(_c(c), ", ".join(f"`{n}` string" for n in names))
