"""Reading and writing tables in the formats Spark has."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from itertools import chain, groupby, islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sensorlake.session import pin
from sensorlake.sources.text import no_value

# Text keeps microseconds, blanks at the ends of values and doubled quotes.
TEXT = {
    "header": "true",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Formats and the options they start from.
FORMATS = {
    "parquet": {"compression": "snappy"},
    "orc": {"compression": "uncompressed"},
    "json": {},
    "csv": TEXT,
    "tsv": {**TEXT, "sep": "\t"},
    "xml": {"rowTag": "row"},
}

# What to do when the target has data already.
MODES = {
    "append": "append",
    "overwrite": "overwrite",  # the whole target
    "delete_matching": "overwrite",  # the partitions written to
    "overwrite_or_ignore": "append",  # files stay, new ones are added
    "error": "errorifexists",
}


def _format(fmt: str) -> str:
    return "csv" if fmt == "tsv" else fmt


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    filters: Column | str | None = None,
    schema: T.StructType | str | None = None,
    **opts: str,
) -> DataFrame:
    """Files as a table, only the columns and rows asked for.

    Selection and filter reach the scan: Parquet and ORC skip what they do not need.
    """
    reader = spark.read.format(_format(fmt)).options(**{**FORMATS[fmt], **opts})
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if filters is not None:
        df = df.where(filters)
    return df.select(*columns) if columns is not None else df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "error",
    partition_by: Sequence[str] = (),
    max_rows_per_file: int | None = None,
    **opts: str,
) -> None:
    """Write a table."""
    writer = df.write.format(_format(fmt)).mode(MODES[mode]).options(**{**FORMATS[fmt], **opts})
    if MODES[mode] == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if mode == "delete_matching" else "static")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_dialect(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    delimiter: str = ",",
    quote: str = '"',
    escape: str = '"',
    newlines_in_values: bool = False,
    null_tokens: Sequence[str] = ("",),
    true_tokens: Sequence[str] = ("true", "True", "TRUE", "1"),
    false_tokens: Sequence[str] = ("false", "False", "FALSE", "0"),
    decimal_point: str = ".",
    skip_rows: int = 0,
    comment: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """CSV in other dialects (C6): tokens for NULL, true and false, a decimal comma, lines to skip.

    ``skip_rows`` drops the first lines of every file. Whether a line begins a record depends on all before it, where lines are
    skipped or values hold line breaks; such files are still read in parallel, see ``csv_records``.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    options = {"sep": delimiter, "quote": quote, "escape": escape}
    if comment:
        options["comment"] = comment
    if skip_rows or newlines_in_values:
        records = csv_records(spark, path, delimiter, quote, escape, skip_rows, header, comment, newlines_in_values)
        fields = ", ".join(f"`{name}` string" for name in text.fieldNames())
        # A separator that no text holds: line breaks inside a record are part of its values.
        parsed = F.from_csv("record", fields, {**options, "lineSep": "\x01"})
        df = records.select(parsed.alias("r")).select("r.*")
    else:
        df = spark.read.schema(text).options(header=header, **options).csv(path)
    out = []
    for f in schema.fields:
        if columns is not None and f.name not in columns:
            continue
        c = no_value(F.col(f"`{f.name}`"), null_tokens)
        if isinstance(f.dataType, T.BooleanType):
            value = F.when(c.isin(*true_tokens), True).when(c.isin(*false_tokens), False)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)) and decimal_point != ".":
            value = F.replace(c, F.lit(decimal_point), F.lit(".")).try_cast(f.dataType)
        else:
            value = c.try_cast(f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)


class Lines:
    """Which lines of CSV text belong to one record: what a task knows of a stretch of a file.

    A quote opens a value only where a field begins, and closes it where it is neither doubled nor escaped.
    """

    def __init__(self, delimiter: str, quote: str, escape: str, skip: int, header: bool, comment: str | None, breaks: bool):
        self.delimiter, self.quote, self.skip, self.header, self.comment, self.breaks = delimiter, quote, skip, header, comment, breaks
        literal = re.escape(quote) * 2 if escape == quote else re.escape(escape) + "."
        self.inside = re.compile(f"(?:{literal})|({re.escape(quote)})", re.DOTALL)

    def after(self, line: str, inside: bool) -> bool:
        """Whether the text behind a line is inside quotes."""
        if not self.breaks or (not inside and (self.quote not in line or self.is_comment(line))):
            return False
        at = 0
        while True:
            if inside:
                close = next((m for m in self.inside.finditer(line, at) if m.group(1)), None)
                if close is None:
                    return True
                at, inside = close.end(), False
            elif line.startswith(self.quote, at):
                at, inside = at + len(self.quote), True
                continue
            at = line.find(self.delimiter, at)
            if at < 0:
                return False
            at += len(self.delimiter)

    def is_comment(self, line: str) -> bool:
        return bool(self.comment) and line.startswith(self.comment)

    def stretches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str], dict]]:
        """(file, start, lines, first row) per split of a file, as Spark reads them: one after the other, in order."""
        rows = (row for batch in batches for row in batch.to_pylist())
        for (file, start), part in groupby(rows, key=lambda r: (r["file"], r["start"])):
            first = next(part)
            lines = (r["value"] for r in chain([first], part))
            if start == 0:
                lines = islice((line.removeprefix("\ufeff") if i == 0 else line for i, line in enumerate(lines)), self.skip, None)
            yield file, start, lines, first

    def summaries(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a stretch makes of being outside quotes, and of being inside."""
        for file, start, lines, _ in self.stretches(batches):
            out, within = False, True
            for line in lines:
                out, within = self.after(line, out), self.after(line, within)
            yield pa.RecordBatch.from_pylist([{"file": file, "start": start, "out": out, "within": within}])

    def chain(self, table: pa.Table) -> pa.Table:
        """The state before each stretch of a file."""
        rows, now = sorted(table.to_pylist(), key=lambda r: r["start"]), False
        for r in rows:
            r["inside"], now = now, r["within"] if now else r["out"]
        return pa.Table.from_pylist([{k: r[k] for k in ("file", "start", "inside")} for r in rows], schema=STATES)

    def records(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records, and at either end of a stretch what belongs to a record that begins or ends elsewhere."""
        for file, start, lines, first in self.stretches(batches):
            inside, held, rows = bool(first["inside"]), [], []
            kind, header = "tail" if inside else "whole", self.header and start == 0
            for line in lines:
                if not held and kind == "whole" and self.is_comment(line):
                    continue
                held.append(line)
                inside = self.after(line, inside)
                if not inside:
                    record = "\n".join(held)
                    if not (header and record):
                        rows.append((file, start, kind, record))
                    header = header and not record
                    held, kind = [], "whole"
                if len(rows) >= 10_000:
                    yield _batch(rows)
                    rows = []
            if held:
                rows.append((file, start, "middle" if kind == "tail" else "head", "\n".join(held)))
            yield _batch(rows)


STATES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("inside", pa.bool_())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()))], names=["file", "start", "kind", "record"])


def csv_records(
    spark: SparkSession, path: str | list[str], delimiter: str, quote: str, escape: str, skip_rows: int = 0, header: bool = False,
    comment: str | None = None, breaks: bool = True,
) -> DataFrame:
    """(record) of CSV files whose values may hold line breaks: the texts of whole records, less skipped lines and the header.

    Spark splits files by bytes and lines. One pass finds what each split makes of either state, outside quotes or inside; these are
    chained along the file, so every split knows its state; a second pass puts its lines together. A record that reaches over
    splits comes in pieces, at most two of a split, which are joined.
    """
    steps = Lines(delimiter, quote, escape, skip_rows, header, comment, breaks)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), *place)
    states = lines.mapInArrow(steps.summaries, "file string, start long, out boolean, within boolean")
    states = pin(states.groupBy("file").applyInArrow(lambda t: steps.chain(t), "file string, start long, inside boolean"))
    # One row per split, as many as the list of files that Spark holds for the scan.
    placed = lines.join(F.broadcast(states), ["file", "start"])
    pieces = placed.mapInArrow(steps.records, "file string, start long, kind string, record string")
    whole = pieces.where("kind = 'whole'").select("record")
    parts = pieces.where("kind <> 'whole'")
    number = F.count_if(F.col("kind") == "head").over(Window.partitionBy("file").orderBy("start", F.col("kind") == "head"))
    joined = parts.withColumn("nth", number).groupBy("file", "nth").agg(F.sort_array(F.collect_list(F.struct("start", "record"))).alias("p"))
    joined = joined.select(F.array_join(F.col("p.record"), "\n").alias("record"))
    return whole.unionByName(joined).where("record <> ''").select("record")


def write_csv(df: DataFrame, path: str, mode: str = "error", header: bool = True, delimiter: str = ",", quoting: str = "needed") -> None:
    """CSV with a choice of quoting: ``needed`` or ``all``."""
    write_table(df, path, "csv", mode, header=str(header).lower(), sep=delimiter, quoteAll=str(quoting == "all").lower())


def read_fixed_width(spark: SparkSession, path: str | list[str], fields: Mapping[str, tuple[int, int, str]], null_tokens: Sequence[str] = ("",)) -> DataFrame:
    """Columns by position (C8): ``{name: (from, to, type)}``, counted from 0, blanks trimmed."""
    text = spark.read.text(path)
    return text.select(
        *[
            no_value(F.trim(F.substring("value", lo + 1, hi - lo)), null_tokens).try_cast(kind).alias(name)
            for name, (lo, hi, kind) in fields.items()
        ]
    )


def path_partitions(df: DataFrame, pattern: str, names: Mapping[str, str] | None = None, path: str = "_metadata.file_path") -> DataFrame:
    """Columns from the file's folder or name by a pattern with named groups.

    ``{"year": "int"}`` in ``names`` gives a group its type.
    """
    kinds = names or {}
    groups = re.findall(r"\(\?<([A-Za-z][A-Za-z0-9]*)>", pattern)
    found = {g: F.regexp_extract(F.col(path), pattern, i + 1) for i, g in enumerate(groups)}
    return df.withColumns({g: F.when(c != "", c).try_cast(kinds.get(g, "string")) for g, c in found.items()})


def flatten_json(
    df: DataFrame, col: str, schema: str, record_path: Sequence[str] = (), meta: Sequence[str] = (), sep: str = "."
) -> DataFrame:
    """JSON text to flat columns (C17).

    ``record_path`` leads to a list that gives one row per element; ``meta`` names outer fields to
    keep beside them, with dots for nesting. Nested names are joined by ``sep``.
    """
    parsed = df.withColumn("__j", F.from_json(F.col(col), schema)).drop(col)
    kept = parsed.columns[:-1]
    outer = F.col("__j")
    metas = [_step(outer, m.split(".")).alias(m.replace(".", sep)) for m in meta]
    if record_path:
        parsed = parsed.select(*kept, *metas, F.explode(_step(outer, record_path)).alias("__j"))
        kept = parsed.columns[:-1]
    else:
        parsed = parsed.select(*kept, *metas, "__j")
        kept = parsed.columns[:-1]
    root = parsed.schema["__j"].dataType
    if not isinstance(root, T.StructType):
        return parsed.withColumnRenamed("__j", "value")
    return parsed.select(*[F.col(f"`{k}`") for k in kept], *[c.alias(n) for n, c in _leaves(F.col("__j"), root, "", sep)])


def _step(c: Column, path: Sequence[str]) -> Column:
    for name in path:
        c = c.getField(name)
    return c


def _leaves(c: Column, kind: T.StructType, prefix: str, sep: str) -> list[tuple[str, Column]]:
    out = []
    for f in kind.fields:
        if isinstance(f.dataType, T.StructType):
            out += _leaves(c.getField(f.name), f.dataType, f"{prefix}{f.name}{sep}", sep)
        else:
            out.append((prefix + f.name, c.getField(f.name)))
    return out


def read_chunks(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_chunk: int = 1000, **opts: str) -> DataFrame:
    """The same files as a stream of bounded batches."""
    return spark.readStream.format(_format(fmt)).schema(schema).options(**{**FORMATS[fmt], **opts}).option("maxFilesPerTrigger", files_per_chunk).load(path)
