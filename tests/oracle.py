"""Run queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/oracle.py [sf] [name-part ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def value(v) -> str:
    if v is None or v is pd.NaT:
        return "NULL"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if v != v:
            return "NaN"
        return f"{v:.6f}" if v != int(v) else f"{v:.6f}"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(value(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    return str(v)


def rows(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(value(r[i]) for i in order) for r in data)


# Kinds of column type that a comparison by value would tell apart.
def kind(t: str) -> str:
    t = t.lower()
    for name, words in {
        "bool": ("bool",), "int": ("int", "long", "short", "byte"), "float": ("double", "float", "decimal"),
        "time": ("timestamp",), "date": ("date",), "text": ("varchar", "string"),
    }.items():
        if any(w in t for w in words) and "[" not in t and "array" not in t and "struct" not in t:
            return name
    return "other"


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[str | None, int]:
    """What differs, or None, and the number of rows."""
    got_cols = df.columns
    got = rows(got_cols, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want_cols = rel.columns
    want_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    want = rows(want_cols, rel.fetchall())
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}", len(got)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    odd = {c: (types[c], want_types[c]) for c in got_cols if kind(types[c]) != kind(want_types[c])}
    if odd:
        return f"types {odd}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", len(got)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}", len(got)
    return None, len(got)


def main() -> None:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    oracles = entry.oracle_sql()
    failed = []
    for name, run in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = run(spark, sf)
            if name in oracles:
                problem, n = compare(df, con, oracles[name])
            else:
                problem, n = None, df.count()
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} rows={n} {time.time() - start:.1f}s{'' if name in oracles else ' (no SQL)'} {problem or ''}", flush=True)
        if problem or n == 0:
            failed.append(name)
    print(f"{len(failed)} failed or empty: {failed}")


if __name__ == "__main__":
    main()
