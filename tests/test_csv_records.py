"""CSV with line breaks in quotes and skipped lines, read in many splits, against a serial reader."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from sensorlake.sources.formats import csv_records, read_dialect

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


def made(seed, n=400):
    rng = random.Random(seed)
    parts = ["x", "", " ", "line\nbreak", 'quo"te', '"', "a,b", "é\n\n", '\n"', "# no comment", "z" * 90, "\n" * 5]
    return [[f"r{i}", *["".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 1, 3]))) for _ in range(2)]] for i in range(n)]


def text_of(rows, **kw):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", **kw).writerows(rows)
    return out.getvalue()


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def read(spark, path, **kw):
    got = read_dialect(spark, str(path), SCHEMA, newlines_in_values=True, null_tokens=(), **kw)
    return sorted(tuple(v or "" for v in r) for r in got.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_one_file_in_many_splits(spark, tmp_path, small_splits, seed):
    rows = made(seed)
    path = tmp_path / "a.csv"
    path.write_text("﻿" + text_of([["a", "b", 'c "\nd'], *rows]))
    assert csv_records(spark, str(path), ",", '"', '"', header=True).rdd.getNumPartitions() > 1
    splits = spark.read.text(str(path)).rdd.getNumPartitions()
    assert splits > 20
    assert read(spark, path) == sorted(map(tuple, rows))


def test_skipped_lines_comments_and_several_files(spark, tmp_path, small_splits):
    rows = made(3, 300)
    for i, part in enumerate((rows[:120], rows[120:])):
        body = text_of([["a", "b", "c"], *part]).split("\n")
        text = 'a line with a " quote\nand "one more\n' + "\n".join(body)
        # Comments between records, one with a quote of its own.
        text = text.replace("\nr1", '\n#comment "odd\nr1') if '"odd' not in text else text
        (tmp_path / f"{i}.csv").write_bytes(text.replace("\r", "").encode())
    got = read(spark, tmp_path, skip_rows=2, comment="#")
    assert got == sorted(map(tuple, rows))


def test_windows_line_ends_and_other_quotes(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes(b"a;b;c\r\n1;'x;\r\ny';2\r\n3;'it\\'s';4\r\n\r\n5;6;'7\r\n8'")
    got = read(spark, tmp_path, delimiter=";", quote="'", escape="\\")
    assert got == [("1", "x;\ny", "2"), ("3", "it's", "4"), ("5", "6", "7\n8")]


def test_skipped_lines_without_breaks(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("made by\nhand\na,b,c\n" + "".join(f"{i},5\" disk,{i * i}\n" for i in range(200)))
    got = read_dialect(spark, str(tmp_path), SCHEMA, skip_rows=2).collect()
    assert sorted(map(tuple, got)) == sorted((str(i), '5" disk', str(i * i)) for i in range(200))
