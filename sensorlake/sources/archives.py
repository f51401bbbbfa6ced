"""Zip archives as rows (A1).

A zip has a directory of its members, so the unit of work is the member, not the archive: one pass
reads only the directories, then members are dealt out over the tasks. One archive that holds most
of the data is read by as many tasks as it has members.
"""

from __future__ import annotations

import fnmatch
import io
import zipfile
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.sources.files import list_files, locate, open_input

LINES_PER_BATCH = 20_000


def _names(archive: zipfile.ZipFile, glob: str | None) -> list[zipfile.ZipInfo]:
    return [m for m in archive.infolist() if not m.is_dir() and (glob is None or fnmatch.fnmatch(m.filename, glob))]


def list_members(
    spark: SparkSession, path: str, member_glob: str | None = None, archive_glob: str = "*.zip", report: bool = False
) -> DataFrame:
    """(archive, member, size, mtime) from the archives' directories.

    An archive that cannot be read ends the run; with ``report`` it is a row without a member, and a
    further column ``error`` says why.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                try:
                    with open_input(path) as raw, zipfile.ZipFile(raw) as archive:
                        found = _names(archive, member_glob)
                except (zipfile.BadZipFile, ValueError) as bad:  # a file shorter than any archive is a ValueError of its reader
                    if not report:
                        raise
                    yield pd.DataFrame({"archive": [path], "member": [None], "size": pd.array([None], "Int64"), "mtime": [pd.NaT], "error": [str(bad)]})
                    continue
                rows = {
                    "archive": path,
                    "member": [m.filename for m in found],
                    "size": [m.file_size for m in found],
                    "mtime": pd.to_datetime([datetime(*m.date_time) for m in found]),
                }
                yield pd.DataFrame(rows | ({"error": None} if report else {}))

    schema = "archive string, member string, size long, mtime timestamp_ntz" + (", error string" if report else "")
    return list_files(spark, path, archive_glob).select("path").mapInPandas(read, schema)


def _dealt(spark: SparkSession, members: DataFrame, tasks: int | None) -> DataFrame:
    # An explicit count: the listing is tiny in bytes, and would otherwise be merged into one task.
    return members.repartition(tasks or spark.sparkContext.defaultParallelism * 4, "archive", "member")


def scan_archives(spark: SparkSession, path: str, member_glob: str | None = None, tasks: int | None = None) -> DataFrame:
    """(archive, member, content) for members that fit a row; see ``scan_archive_lines`` for large ones."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive_path, member in zip(batch["archive"], batch["member"]):
                with open_input(archive_path) as raw, zipfile.ZipFile(raw) as archive:
                    yield pd.DataFrame({"archive": [archive_path], "member": [member], "content": [archive.read(member)]})

    members = _dealt(spark, list_members(spark, path, member_glob).select("archive", "member"), tasks)
    return members.mapInPandas(read, "archive string, member string, content binary")


def scan_archive_lines(
    spark: SparkSession, path: str, member_glob: str | None = None, encoding: str = "utf-8", tasks: int | None = None
) -> DataFrame:
    """(archive, member, line_no, line), streamed: no member is ever whole in memory."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive_path, member in zip(batch["archive"], batch["member"]):
                with open_input(archive_path) as raw, zipfile.ZipFile(raw) as archive, archive.open(member) as stream:
                    lines, first = [], 0
                    for line in io.TextIOWrapper(stream, encoding=encoding, newline=None):
                        lines.append(line.rstrip("\n"))
                        if len(lines) == LINES_PER_BATCH:
                            yield _lines(archive_path, member, first, lines)
                            first, lines = first + len(lines), []
                    yield _lines(archive_path, member, first, lines)

    members = _dealt(spark, list_members(spark, path, member_glob).select("archive", "member"), tasks)
    return members.mapInPandas(read, "archive string, member string, line_no long, line string")


def _lines(archive: str, member: str, first: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame({"archive": archive, "member": member, "line_no": range(first, first + len(lines)), "line": lines})


def unpack_archives(archives: DataFrame, member_glob: str | None = None) -> DataFrame:
    """(archive, member, content) from rows that already carry the bytes of an archive."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["archive"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(data)) as archive:
                    for m in _names(archive, member_glob):
                        yield pd.DataFrame({"archive": [name], "member": [m.filename], "content": [archive.read(m)]})

    return archives.select("archive", "content").mapInPandas(read, "archive string, member string, content binary")


def land_members(spark: SparkSession, manifest: DataFrame, root: str, tasks: int | None = None) -> dict[str, int]:
    """Copy members to ``root``/key and return how many files and bytes were landed.

    ``manifest`` has (archive, member, key), one row per key (``landing.landing_manifest``). A copy
    is written aside and moved into place, so a task that is run twice leaves the same file.
    """

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import shutil
        import uuid

        for batch in batches:
            sizes = []
            for archive_path, member, key in zip(batch["archive"], batch["member"], batch["key"]):
                if ".." in key.split("/"):
                    raise ValueError(f"key leaves the landing area: {key}")
                system, target = locate(f"{root.rstrip('/')}/{key}")
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                aside = f"{target.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
                with open_input(archive_path) as raw, zipfile.ZipFile(raw) as archive, archive.open(member) as src:
                    with system.open_output_stream(aside) as out:
                        shutil.copyfileobj(src, out, 1 << 20)
                    sizes.append(archive.getinfo(member).file_size)
                system.move(aside, target)
            yield pd.DataFrame({"bytes": sizes})

    copied = _dealt(spark, manifest.select("archive", "member", "key"), tasks).mapInPandas(copy, "bytes long")
    row = copied.agg(F.count("bytes").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return row.asDict()
