"""The daily flow: archives to landed text to staged Parquet to a processed table.

    python -m sensorlake.plans.flow --archives in/ --lake lake/ --table readings
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorlake.operators.mapping import apply_mapping, normalize_columns
from sensorlake.operators.quality import file_counts, ingest_summary, observed, quarantine, rejected
from sensorlake.schemas import SchemaSpec
from sensorlake.session import pin
from sensorlake.sources.archives import land_members, list_members
from sensorlake.sources.batches import BATCH, BatchLog, hadoop, new_batch, read_batches, rest_of, sync_table, text_schema, write_batch
from sensorlake.sources.files import list_files, literal, plain_path
from sensorlake.sources.landing import landing_manifest
from sensorlake.sources.text import CORRUPT, headers, scan_csv, scan_log


@dataclass
class FlowConfig:
    raw: str
    stage: str
    processed: str
    rejects: str
    table: str
    spec: SchemaSpec
    sources: dict[str, str] = field(default_factory=dict)  # target column -> staged column
    formats: dict[str, str] = field(default_factory=dict)  # target column -> timestamp pattern
    fmt: str = "csv"  # or "log": headerless, fields in the order of ``spec``
    sep: str | None = ","
    glob: str = "*.csv"
    mode: str = "overwrite"


@dataclass
class FlowResult:
    table: DataFrame
    summary: DataFrame  # rows read, kept and rejected per source
    rejects: DataFrame
    files: DataFrame  # (source_file, mtime, status, error): converted, skipped or failed
    batch: str | None  # None: nothing was new


def land_archives(
    spark: SparkSession, path: str, root: str, member_glob: str | None = None, layout: str = "tree", prefix: str = "raw/", errors: str | None = None
) -> dict[str, int]:
    """Unpack the zip archives below ``path`` to ``root``/raw/; says how many files and bytes were
    landed, how many were hidden by another file of the same key, and how many archives could not be read.

    The names of those and the reasons are added to ``errors``, by default ``root``/_errors, which ``land_errors`` reads.
    """
    listed = pin(list_members(spark, path, member_glob, report=True))
    bad = listed.where("error is not null").select(F.col("archive").alias("source_file"), "error", F.current_timestamp().alias("at"))
    failed = bad.count()
    if failed:
        bad.write.mode("append").parquet(errors or f"{root.rstrip('/')}/_errors")
    members = listed.where("error is null").drop("error")
    files = members.withColumns({"path": F.concat_ws("/", "archive", "member"), "rel": F.col("member")})
    # Listed once: what is landed is what was counted.
    manifest = pin(landing_manifest(files, layout, prefix, keep=("archive", "member")))
    collisions = manifest.agg(F.coalesce(F.sum("n_collisions"), F.lit(0))).first()[0]
    return {**land_members(spark, manifest, root), "collisions": collisions, "failed": failed}


def land_errors(spark: SparkSession, root: str, errors: str | None = None) -> DataFrame:
    """(source_file, error, at) of the archives that could not be read."""
    where, schema = errors or f"{root.rstrip('/')}/_errors", "source_file string, error string, at timestamp"
    fs, path = hadoop(spark, where)
    return spark.read.schema(schema).parquet(where) if fs.exists(path) else spark.createDataFrame([], schema)


def _listed(spark: SparkSession, cfg: FlowConfig) -> DataFrame:
    """(path, source_file, mtime, header, error) of the raw files; an error where a CSV file's header cannot be read."""
    files = list_files(spark, cfg.raw, cfg.glob).select("path", plain_path(F.col("path")).alias("source_file"), "mtime")
    if cfg.fmt == "log":
        return files.withColumns({"header": F.lit(None).cast("array<string>"), "error": F.lit(None).cast("string")})
    return files.join(headers(spark, cfg.raw, cfg.glob, cfg.sep or ",", report=True), "path")


def run_flow(spark: SparkSession, cfg: FlowConfig) -> FlowResult:
    """Raw files of ``cfg.raw`` to the registered table ``cfg.table``, as one committed batch.

    With mode ``overwrite`` the listed files are staged anew and the table is made from all that is staged; with ``append``
    only files are read that are new or have changed since they were handled (by their times), and the rows of a changed file
    replace its old ones. Files that cannot be read fail with the reason and are tried again by the next run; what an
    earlier run made of them stays.

    Rows, rejects and the list of sources are written first and count from the commit on (see ``batches``): a run that
    dies, wherever, is started again and adds nothing twice. Every step up to the table is a scan and a projection: nothing is
    shuffled. The stage holds strings (and the raw text of rows of the wrong width); types come once, from the mapping.
    """
    log = BatchLog(spark, cfg.stage)
    staged_live, table_live = log.live("stage", "table")
    held, tabled = log.sources(staged_live, "stage"), log.sources(table_live, "table")
    listed, status = _listed(spark, cfg), F.when(F.col("error").isNotNull(), "failed").otherwise("converted")
    if cfg.mode == "append" and staged_live:
        known = held.select(F.col("source_file").alias("s"), F.col("mtime").alias("m"))
        listed = listed.join(known, (F.col("source_file") == F.col("s")) & F.col("mtime").eqNullSafe(F.col("m")), "left")
        status = F.when(F.col("s").isNotNull(), "skipped").otherwise(status)
    files = pin(listed.withColumn("status", status).select("path", "source_file", "mtime", "status", "error", "header"))
    todo = files.where("status = 'converted'").select("source_file", "mtime")
    # Spark's own file index holds every path of a scan on the driver, too.
    paths = [literal(r.path) for r in files.where("status = 'converted'").select("path").toLocalIterator()]
    result_files = files.drop("path", "header")
    schema = cfg.spec.struct
    if not paths:
        if cfg.mode == "overwrite":
            raise FileNotFoundError(f"no readable {cfg.glob} below {cfg.raw}")
        none = spark.createDataFrame([], "source_file string")
        return FlowResult(sync_table(spark, cfg.table, cfg.processed, schema, table_live), ingest_summary(none, none, none), none, result_files, None)

    batch = new_batch()
    if cfg.fmt == "log":
        raw = scan_log(spark, paths, cfg.spec.staged, cfg.sep, on_bad="quarantine", glob=cfg.glob, keep_source=True)
    else:
        raw = scan_csv(spark, paths, on_bad="quarantine", sep=cfg.sep or ",", glob=cfg.glob, keep_source=True, known=files.where("status = 'converted'"))
    raw = raw.withColumnsRenamed({"source_file": "source file", CORRUPT: "corrupt record"})
    staged = normalize_columns(raw).withColumn("source_file", plain_path(F.col("source_file")))
    write_batch(staged, cfg.stage, batch)

    def touched(sources: DataFrame) -> list[str]:
        """Batches with sources that come again. They are written anew, less those sources."""
        return [r[0] for r in sources.join(todo, "source_file", "left_semi").select(BATCH).distinct().collect()]

    again = touched(held) if staged_live else []
    old = text_schema(c for b in again for c in staged_live[b])
    if again:
        write_batch(rest_of(read_batches(spark, cfg.stage, again, old), todo), cfg.stage, batch)
    columns = list(dict.fromkeys([*staged.columns, *old.names]))
    in_stage = todo
    if again:
        in_stage = todo.unionByName(rest_of(held.where(F.col(BATCH).isin(again)).select("source_file", "mtime"), todo))

    if cfg.mode == "append":
        source, replaced = read_batches(spark, cfg.stage, [batch], text_schema(columns)), touched(tabled)
        if again:
            source = source.join(todo.select("source_file"), "source_file", "left_semi")
    else:
        # The table is made anew from all that is staged.
        live = {b: c for b, c in staged_live.items() if b not in again} | {batch: columns}
        source, replaced = read_batches(spark, cfg.stage, live, text_schema(c for cs in live.values() for c in cs)), list(table_live)
    keep = [("source_file", "string", "source_file", "string"), ("corrupt_record", "string", CORRUPT, "string")]
    mapped = apply_mapping(source, cfg.spec.mapping(cfg.sources) + keep, "quarantine", cfg.formats)
    # Rejects are counted while the good rows are written; only if there are any is the stage read again.
    mapped, seen = observed(mapped, f"ingest {cfg.table}", rejected=F.count_if(rejected(mapped)))
    good, bad = quarantine(mapped)
    good = good.select(*cfg.spec.columns, "source_file")
    write_batch(good, cfg.processed, batch)
    write_batch(bad if seen.get["rejected"] else spark.createDataFrame([], bad.schema), cfg.rejects, batch)
    in_table = todo
    if cfg.mode == "append" and replaced:
        for df, root in ((good, cfg.processed), (bad, cfg.rejects)):
            write_batch(rest_of(read_batches(spark, root, replaced, df.schema), todo), root, batch)
        in_table = todo.unionByName(rest_of(tabled.where(F.col(BATCH).isin(replaced)).select("source_file", "mtime"), todo))
    elif cfg.mode == "overwrite" and staged_live:
        in_table = in_stage.unionByName(held.where(~F.col(BATCH).isin(again)).select("source_file", "mtime"))
    log.put_sources(batch, stage=in_stage, table=in_table)
    log.commit(batch, {"stage": (columns, again), "table": (cfg.spec.columns, replaced)})

    table = sync_table(spark, cfg.table, cfg.processed, schema, [b for b in table_live if b not in replaced] + [batch])
    kept, rejects = (read_batches(spark, root, [batch], df.schema) for df, root in ((good, cfg.processed), (bad, cfg.rejects)))
    if cfg.mode == "append" and replaced:
        kept, rejects = [df.join(todo.select("source_file"), "source_file", "left_semi") for df in (kept, rejects)]
    return FlowResult(table, ingest_summary(source, kept, rejects), rejects, result_files, batch)


def main() -> None:
    import argparse

    from sensorlake.schemas import SCHEMAS
    from sensorlake.session import configure

    args = argparse.ArgumentParser(description="Land archives and make the table of readings.")
    args.add_argument("--archives", help="folder with zip archives; leave out if the lake's raw/ is filled already")
    args.add_argument("--lake", required=True, help="folder that holds raw/, stage/, processed/ and rejects/")
    args.add_argument("--table", required=True)
    args.add_argument("--schema", choices=sorted(SCHEMAS), default="accel5")
    args.add_argument("--format", choices=("csv", "log"), default="csv")
    args.add_argument("--sep", default=",")
    args.add_argument("--glob", help="files to read; *.csv or *.log by default")
    args.add_argument("--layout", choices=("tree", "flat"), default="tree")
    args.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    a = args.parse_args()
    spark = configure(SparkSession.builder.appName(f"make {a.table}")).getOrCreate()
    lake, glob = a.lake.rstrip("/"), a.glob or f"*.{a.format}"
    if a.archives:
        print(land_archives(spark, a.archives, lake, glob, a.layout))
    dirs = [f"{lake}/{d}" for d in ("raw", "stage", "processed", "rejects")]
    result = run_flow(spark, FlowConfig(*dirs, a.table, SCHEMAS[a.schema], fmt=a.format, sep=a.sep, glob=glob, mode=a.mode))
    result.summary.show(truncate=False)
    file_counts(result.files).show()


if __name__ == "__main__":
    main()
