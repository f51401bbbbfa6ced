"""Data sets that grow by committed batches.

Rows are written below ``root``/batch=<id>/, where no reader looks yet. A commit is one row in ``root``/_commits, in a file of its own that
Spark moves into place whole: it names the batch, its columns and the batches that it replaces. Readers take the batches the log
names and no others, so a run that dies before its commit has added nothing, whatever it has written, and the same run
started again adds everything once. Several data sets may follow one log.

Beside the rows, ``root``/_sources tells which sources (files, as a rule) a batch holds. A source that comes again replaces its old rows:
the other rows of the batches that held it are copied to the new batch, and those batches leave with the same commit.

One run writes at a time; readers may read at any time. Batches without a commit are litter, which ``vacuum`` removes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BATCH = "batch"
COMMIT = "batch string, part string, columns array<string>, replaces array<string>, at timestamp"
SOURCES = "part string, source_file string, mtime timestamp"


def new_batch() -> str:
    """A name that sorts by time."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


@dataclass
class BatchLog:
    """The commits below ``root``. ``part`` names one of the data sets that follow the log."""

    spark: SparkSession
    root: str

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def commits(self) -> DataFrame:
        """One row per commit and part."""
        if not self.exists():
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).parquet(self._path("_commits"))

    def live(self, *parts: str) -> list[dict[str, list[str]]]:
        """For each part the batches that count, oldest first, with their columns. There is one per run, less those replaced."""
        rows = sorted(self.commits().collect(), key=lambda r: r[BATCH])
        gone = {(r["part"], b) for r in rows for b in r["replaces"]}
        return [{r[BATCH]: r["columns"] for r in rows if r["part"] == p and (p, r[BATCH]) not in gone} for p in parts]

    def exists(self) -> bool:
        fs, path = hadoop(self.spark, self._path("_commits"))
        return fs.exists(path)

    def sources(self, batches: Iterable[str], part: str = "rows") -> DataFrame:
        """(source_file, mtime, batch) of these batches."""
        schema = T.StructType([*T.StructType.fromDDL(SOURCES), T.StructField(BATCH, T.StringType())])
        return read_batches(self.spark, self._path("_sources"), batches, schema, keep=True).where(F.col("part") == part).drop("part")

    def put_sources(self, batch: str, **parts: DataFrame) -> None:
        """The (source_file, mtime) that each part of a batch holds."""
        rows = [df.select(F.lit(part).alias("part"), "source_file", F.col("mtime").cast("timestamp").alias("mtime")) for part, df in parts.items()]
        reduce(DataFrame.unionByName, rows).write.mode("append").parquet(f"{self._path('_sources')}/{BATCH}={batch}")

    def commit(self, batch: str, parts: dict[str, tuple[Sequence[str], Iterable[str]]]) -> None:
        """All parts of a batch at once: ``{part: (columns, batches it replaces)}``."""
        at = datetime.now(timezone.utc)
        rows = [(batch, part, list(columns), sorted(gone), at) for part, (columns, gone) in parts.items()]
        # One file: it is there with all its rows or not at all.
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("append").parquet(self._path("_commits"))


def hadoop(spark: SparkSession, path: str):
    """Spark's own file system for a path, and the path on it."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def batch_path(root: str, batch: str) -> str:
    return f"{root.rstrip('/')}/{BATCH}={batch}"


def write_batch(df: DataFrame, root: str, batch: str) -> None:
    """Adds rows to a batch that is not committed yet: no shuffle, every task writes what it has."""
    df.write.mode("append").parquet(batch_path(root, batch))


def read_batches(spark: SparkSession, root: str, batches: Iterable[str], schema: T.StructType, keep: bool = False) -> DataFrame:
    """The rows of these batches; ``keep`` the batch they are from. No folder is listed but theirs, and no footer is read for the schema."""
    fields = T.StructType([*[f for f in schema.fields if f.name != BATCH], T.StructField(BATCH, T.StringType())])
    paths = [batch_path(root, b) for b in batches]
    df = spark.read.schema(fields).option("basePath", root).parquet(*paths) if paths else spark.createDataFrame([], fields)
    return df if keep else df.drop(BATCH)


def text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in dict.fromkeys(columns)])


def rest_of(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of sources other than these."""
    return rows.join(sources.select("source_file").distinct(), "source_file", "left_anti").select(*rows.columns)


def sync_table(spark: SparkSession, name: str, path: str, schema: T.StructType, batches: Iterable[str]) -> DataFrame:
    """The external table ``name`` over the committed batches below ``path``, each a partition of it.

    The catalog follows the log: batches it lacks are added, those that were replaced are dropped (the files stay). A run that died
    before this is put right by the next.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{BATCH}` STRING) USING PARQUET PARTITIONED BY (`{BATCH}`) LOCATION '{location}'")
    have = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    want = set(batches)
    if have - want:
        gone = ", ".join(f"PARTITION ({BATCH} = '{b}')" for b in sorted(have - want))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    if want - have:
        new = " ".join(f"PARTITION ({BATCH} = '{b}') LOCATION '{batch_path(location, b)}'" for b in sorted(want - have))
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {new}")
    spark.catalog.refreshTable(name)
    return spark.table(name).drop(BATCH)


def vacuum(spark: SparkSession, root: str, log: BatchLog, part: str = "rows") -> list[str]:
    """Deletes batches that no commit names or that were replaced; says which. Run it while no run writes and no reader reads them."""
    fs, path = hadoop(spark, root)
    (live,), gone = log.live(part), []
    for status in fs.listStatus(path) if fs.exists(path) else []:
        name = status.getPath().getName()
        if name.startswith(f"{BATCH}=") and name.split("=", 1)[1] not in live:
            fs.delete(status.getPath(), True)
            gone.append(name.split("=", 1)[1])
    return sorted(gone)
