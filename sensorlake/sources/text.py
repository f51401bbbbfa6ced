"""Delimited text: CSV with a header and headerless logs."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sensorlake.sources.files import list_files, literal, open_input

# Field texts that mean "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CORRUPT = "_corrupt_record"


def mangle(names: Sequence[str]) -> list[str]:
    """Repeated header names become ``a, a.1, a.2``; an empty one is named by its position."""
    seen: set[str] = set()
    out = []
    for i, raw in enumerate(names):
        name = base = raw or f"Unnamed: {i}"
        n = 0
        while name in seen:
            n += 1
            name = f"{base}.{n}"
        seen.add(name)
        out.append(name)
    return out


def headers(
    spark: SparkSession, path: str | list[str], glob: str = "*.csv", sep: str = ",", quote: str = '"', report: bool = False
) -> DataFrame:
    """(path, header) with the first record of every file; tasks read just that record.

    A file that has none is left out and one that cannot be read ends the run; with ``report`` both are rows
    without a header, and a further column ``error`` says why.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for name in batch["path"]:
                first, error = None, None
                try:
                    with open_input(name) as raw:
                        text = io.TextIOWrapper(raw, encoding="utf-8-sig", newline="")
                        first = next((r for r in csv.reader(text, delimiter=sep, quotechar=quote) if r), None)
                except (UnicodeDecodeError, csv.Error) as bad:
                    if not report:
                        raise
                    error = str(bad)
                if first is not None:
                    found.append((name, mangle(first), None))
                elif report:
                    found.append((name, None, error or "no header"))
            # A batch of files is handed on at once.
            if found:
                made = pd.DataFrame(found, columns=["path", "header", "error"])
                yield made if report else made[["path", "header"]]

    schema = "path string, header array<string>" + (", error string" if report else "")
    return list_files(spark, path, glob).select("path").mapInPandas(read, schema)


def no_value(col: Column, null_tokens: Sequence[str]) -> Column:
    return F.when(~col.isin(*null_tokens), col) if null_tokens else col


def _fields(raw: Column, sep: str) -> Column:
    """How many fields a raw line has; separators inside quotes do not count."""
    bare = F.regexp_replace(raw, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _read(spark, paths, names, sep, multiline, header, on_bad, glob) -> DataFrame:
    """One file layout, all fields as strings, ``_line`` the raw text of a row of another width."""
    columns = [T.StructField(f"_f{i}", T.StringType()) for i in range(len(names))]
    checked = on_bad != "null"
    schema = T.StructType(columns + ([T.StructField(CORRUPT, T.StringType())] if checked else []))
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
    )
    if checked:
        # Every field has to be parsed for the width of a row to be noticed.
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false")
    df = reader.csv(paths).withColumn("source_file", F.col("_metadata.file_path"))
    return df.select(
        *[F.col(f"_f{i}").alias(n) for i, n in enumerate(names)],
        "source_file",
        *([CORRUPT] if checked else []),
    )


def _fail(df: DataFrame, too_wide: Column, width: int) -> DataFrame:
    """Raise on the first row that is too wide, whichever columns are asked for."""
    failed = F.raise_error(F.concat(F.lit(f"expected {width} fields: "), F.col(CORRUPT))).cast("boolean")
    return df.where(F.when(F.col(CORRUPT).isNotNull() & too_wide, failed).otherwise(F.lit(True))).drop(CORRUPT)


def _typed(df: DataFrame, schema: T.StructType, extra: Sequence[str]) -> DataFrame:
    have = set(df.columns)
    cast = [
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cast, *extra)


def infer_types(df: DataFrame, columns: Sequence[str]) -> T.StructType:
    """Narrowest of long, double and boolean that every value of a column reads as, in one pass."""
    tests = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}

    def ok(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "boolean":
            return F.count_if(c.isin("True", "TRUE", "true", "False", "FALSE", "false"))
        return F.count(c.try_cast(kind))

    aggs = []
    for i, name in enumerate(columns):
        aggs.append(F.count(F.col(f"`{name}`")).alias(f"n{i}"))
        aggs += [ok(name, kind).alias(f"{kind}{i}") for kind in tests]
    row = df.agg(*aggs).first()
    fields = []
    for i, name in enumerate(columns):
        fits = [t for kind, t in tests.items() if row[f"n{i}"] and row[f"{kind}{i}"] == row[f"n{i}"]]
        fields.append(T.StructField(name, fits[0] if fits else T.StringType()))
    return T.StructType(fields)


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    null_tokens: Sequence[str] = NULL_TOKENS,
    on_bad: str = "null",
    sep: str = ",",
    multiline: bool = False,
    glob: str = "*.csv",
    keep_source: bool = False,
    known: DataFrame | None = None,
) -> DataFrame:
    """CSV files with a header row, each read by its own header.

    ``known`` (path, header), where it is at hand, saves reading the headers.

    Fields are strings unless ``schema`` casts them (by name) or ``infer`` finds their types. A row
    with fewer fields than the header has NULL in the rest. A row with more is an error: ``fail``
    raises, ``quarantine`` keeps the raw text of every row of the wrong width in
    ``_corrupt_record``, ``null`` drops the surplus fields.
    """
    if on_bad not in ("null", "fail", "quarantine"):
        raise ValueError(f"on_bad: {on_bad}")
    files = headers(spark, path, glob, sep) if known is None else known
    # Layouts are few; a layout's file names are collected only where layouts differ.
    found = files.groupBy("header").agg(F.min("path").alias("first")).orderBy("first")
    layouts = [tuple(r) for r in found.select("header", F.xxhash64(F.array_join("header", "\n"))).collect()]
    if not layouts:
        raise FileNotFoundError(f"no {glob} with a header below {path}")
    by_layout: dict[int, list[str]] = {}
    if len(layouts) > 1:
        for r in files.select("path", F.xxhash64(F.array_join("header", "\n")).alias("layout")).collect():
            by_layout.setdefault(r.layout, []).append(literal(r.path))
    parts = []
    for names, layout in layouts:
        paths = by_layout.get(layout, path)
        df = _read(spark, paths, names, sep, multiline, True, on_bad, glob)
        df = df.withColumns({n: no_value(F.col(f"`{n}`"), null_tokens) for n in names})
        if on_bad == "fail":
            df = _fail(df, _fields(F.col(CORRUPT), sep) > len(names), len(names))
        parts.append(df)
    df = parts[0]
    for other in parts[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    extra = [c for c in ("source_file", CORRUPT) if c in df.columns and (keep_source or c != "source_file")]
    columns = [c for c in df.columns if c not in ("source_file", CORRUPT)]
    if schema is None and infer:
        schema = infer_types(df, columns)
    if schema is not None:
        return _typed(df, schema, extra)
    return df.select(*[F.col(f"`{c}`") for c in columns], *extra)


def scan_log(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str | None = "\t",
    null_tokens: Sequence[str] = NULL_TOKENS,
    on_bad: str = "null",
    glob: str = "*.log",
    keep_source: bool = False,
) -> DataFrame:
    """Headerless delimited logs, typed by ``schema`` (A7). ``sep=None`` splits on runs of blanks."""
    names = schema.fieldNames()
    if sep is None:
        text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
        text = text.withColumn("source_file", F.col("_metadata.file_path")).where(F.trim("value") != "")
        parts = F.split(F.trim("value"), r"\s+")
        width = F.size(parts)
        wrong = F.when(width != len(names), F.col("value"))
        df = text.select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)], "source_file", wrong.alias(CORRUPT))
        if on_bad == "null":
            df = df.drop(CORRUPT)
        too_wide = F.size(F.split(F.trim(F.col(CORRUPT)), r"\s+")) > len(names)
    else:
        df = _read(spark, path, names, sep, False, False, on_bad, glob)
        too_wide = _fields(F.col(CORRUPT), sep) > len(names)
    df = df.withColumns({n: no_value(F.col(f"`{n}`"), null_tokens) for n in names})
    if on_bad == "fail":
        df = _fail(df, too_wide, len(names))
    extra = [c for c in ("source_file", CORRUPT) if c in df.columns and (keep_source or c != "source_file")]
    return _typed(df, schema, extra)
