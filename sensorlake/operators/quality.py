"""Setting bad rows aside and counting what happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def rejected(df: DataFrame, errors: str = "_errors", corrupt: str = "_corrupt_record") -> Column:
    """Whether a mapped value failed to cast (``errors``) or the parser kept raw text (``corrupt``)."""
    bad = F.lit(False)
    if errors in df.columns:
        bad = bad | (F.size(errors) > 0)
    if corrupt in df.columns:
        bad = bad | F.col(corrupt).isNotNull()
    return bad


def quarantine(df: DataFrame, errors: str = "_errors", corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Split into rows that read cleanly, without the marks, and rows that did not.

    Both halves are plain filters, so nothing is computed until used.
    """
    bad = rejected(df, errors, corrupt)
    return df.where(~bad).drop(errors, corrupt), df.where(bad)


def ingest_summary(df_in: DataFrame, df_out: DataFrame, rejects: DataFrame, source: str = "source_file") -> DataFrame:
    """Rows read, kept and rejected per source file.

    Each input is counted before it is shuffled, so one source holding most rows costs one
    partial count per task; the union that follows has one row per source and role.
    """

    def counts(df: DataFrame, role: str) -> DataFrame:
        return df.groupBy(F.col(source).alias("source_file")).agg(F.count(F.lit(1)).alias("n")).withColumn("role", F.lit(role))

    parts = counts(df_in, "in").unionByName(counts(df_out, "out")).unionByName(counts(rejects, "rejected"))

    def total(role: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("role") == role, F.col("n"))), F.lit(0)).cast("long")

    return parts.groupBy("source_file").agg(
        total("in").alias("rows_in"), total("out").alias("rows_out"), total("rejected").alias("rows_rejected")
    )


def file_counts(files: DataFrame) -> DataFrame:
    """One row: files landed, and how many of them were converted, skipped (handled before) and failed."""
    statuses = [F.count_if(F.col("status") == s).alias(f"files_{s}") for s in ("converted", "skipped", "failed")]
    return files.agg(F.count(F.lit(1)).alias("files_landed"), *statuses)


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Count while the rows pass on to a sink: no second scan for the summary."""
    obs = Observation(name)
    exprs = [expr.alias(out) for out, expr in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs
