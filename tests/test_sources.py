"""Reading, landing, staging and incremental runs on small files."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F, types as T

from sensorlake.operators.mapping import apply_mapping, normalize_columns, stage_key, to_ts
from sensorlake.operators.quality import quarantine
from sensorlake.operators.quality import file_counts
from sensorlake.plans import flow
from sensorlake.plans.flow import FlowConfig, land_archives, land_errors, run_flow
from sensorlake.schemas import SCHEMAS, conform
from sensorlake.sources.archives import land_members, list_members, scan_archive_lines, scan_archives
from sensorlake.sources.formats import path_partitions, read_dialect, read_fixed_width
from sensorlake.sources.landing import filter_objects, landing_manifest, scan_landing, scan_notified
from sensorlake.sources.batches import BatchLog, read_batches, vacuum, write_batch
from sensorlake.sources.tables import read_stage, register_table, write_processed, write_stage
from sensorlake.sources.text import CORRUPT, NULL_TOKENS, headers, scan_csv, scan_log
from sensorlake.streaming.incremental import run_incremental


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def values(df):
    return [tuple(r) for r in df.collect()]


def test_null_tokens(spark, tmp_path):
    put(tmp_path / "a.csv", "id,v\n" + "".join(f'{i},"{t}"\n' for i, t in enumerate(NULL_TOKENS)))
    rows = scan_csv(spark, str(tmp_path))
    assert rows.count() == len(NULL_TOKENS) and rows.where("v IS NOT NULL").isEmpty()


def test_repeated_headers(spark, tmp_path):
    put(tmp_path / "a.csv", "a,a,b,b,b\n1,2,3,4,5\n")
    rows = scan_csv(spark, str(tmp_path))
    assert rows.columns == ["a", "a.1", "b", "b.1", "b.2"]
    assert values(normalize_columns(rows)) == [("1", "2", "3", "4", "5")]
    assert normalize_columns(rows).columns == ["a", "a_1", "b", "b_1", "b_2"]


def test_rows_of_the_wrong_width(spark, tmp_path):
    put(tmp_path / "a.csv", 'a,b,c\n1,2,3\n4,5\n6,7,8,"x,y",9\n')
    assert values(scan_csv(spark, str(tmp_path)).orderBy("a")) == [("1", "2", "3"), ("4", "5", None), ("6", "7", "8")]
    kept = {r.a: r[CORRUPT] for r in scan_csv(spark, str(tmp_path), on_bad="quarantine").collect()}
    assert kept == {"1": None, "4": "4,5", "6": '6,7,8,"x,y",9'}
    # A short row alone is no failure, whichever column is read.
    with pytest.raises(Exception, match="expected 3 fields"):
        scan_csv(spark, str(tmp_path), on_bad="fail").select("b").collect()
    put(tmp_path / "only" / "b.csv", "a,b,c\n4,5\n")
    assert values(scan_csv(spark, str(tmp_path / "only"), on_bad="fail")) == [("4", "5", None)]


def test_text_is_kept_as_it_is(spark, tmp_path):
    put(tmp_path / "a.csv", 'id,doc\n007,"{""k"": ""a,b\nc""}"\n')
    assert values(scan_csv(spark, str(tmp_path), multiline=True)) == [("007", '{"k": "a,b\nc"}')]


def test_files_with_other_headers(spark, tmp_path):
    put(tmp_path / "x" / "a.csv", "id,v\n1,2\n")
    put(tmp_path / "y" / "b.csv", "v,id,w\n3,4,5\n")
    put(tmp_path / "z" / "empty.csv", "")
    rows = scan_csv(spark, str(tmp_path))
    assert sorted(values(rows.select("id", "v", "w")), key=str) == [("1", "2", None), ("4", "3", "5")]


def test_inference(spark, tmp_path):
    put(tmp_path / "a.csv", "i,f,b,s,n\n1,1.5,True,x,\n2,NA,false,2,NA\n")
    kinds = dict(scan_csv(spark, str(tmp_path), infer=True).dtypes)
    assert kinds == {"i": "bigint", "f": "double", "b": "boolean", "s": "string", "n": "string"}


def test_logs(spark, tmp_path):
    schema = T.StructType.fromDDL("x double, y double, label int")
    put(tmp_path / "a.log", "1.5\t2.5\t3\n-0.0\tNA\t4\n")
    assert values(scan_log(spark, str(tmp_path), schema).orderBy("label")) == [(1.5, 2.5, 3), (-0.0, None, 4)]
    put(tmp_path / "b" / "b.log", "  1.5   2.5 3\n\n4 5\n")
    got = scan_log(spark, str(tmp_path / "b"), schema, sep=None, on_bad="quarantine").orderBy("x")
    assert values(got) == [(1.5, 2.5, 3, None), (4.0, 5.0, None, "4 5")]


def test_mapping_and_rejects(spark):
    rows = spark.createDataFrame(
        [("007", "2024-01-01 00:00:00.123456", "1e3"), ("8", "nope", "abc"), ("9", None, "-0.0"), ("10", "2024-13-01", "1")], "id string, t string, v string"
    )
    mapping = [("id", "string", "id", "string"), ("t", "string", "at", "timestamp_ntz"), ("v", "double", "v", "double")]
    good, bad = quarantine(apply_mapping(rows, mapping, "quarantine"))
    assert {(r.id, str(r.at), r.v) for r in good.collect()} == {("007", "2024-01-01 00:00:00.123456", 1000.0), ("9", "None", -0.0)}
    assert {r.id: r._errors for r in bad.collect()} == {"8": ["at", "v"], "10": ["at"]}
    with pytest.raises(Exception, match="cannot read at"):
        apply_mapping(rows, mapping, "fail").collect()
    assert str(rows.select(to_ts(F.lit("31.12.2024"), "dd.MM.yyyy")).first()[0]) == "2024-12-31 00:00:00"


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Accel X", "accelX", "ACCEL-Y", " id "])
    with pytest.raises(ValueError, match="collide"):
        normalize_columns(df)
    assert normalize_columns(df, "suffix").columns == ["accel_x", "accel_x_1", "accel_y", "id"]
    key = spark.range(1).select(stage_key(F.lit("raw/x/raw/a.csv.b.csv"))).first()[0]
    assert key == "stage/x/raw/a.csv.b.parquet"


def test_conform_adds_missing_columns(spark):
    out = conform(spark.createDataFrame([("1", "walk")], "id string, activity string"), SCHEMAS["sensor6"], {"user_id": "id"})
    assert out.schema == SCHEMAS["sensor6"].struct
    assert values(out) == [("1", "walk", None, None, None, None)]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d1/x.csv", "id,v\n1,2\n")
        z.writestr("d2/x.csv", "id,v\n3,4\n")
        z.writestr("readme.txt", "hello")
    assert {(r.member, bytes(r.content)) for r in scan_archives(spark, str(tmp_path)).collect()} == {
        ("d1/x.csv", b"id,v\n1,2\n"), ("d2/x.csv", b"id,v\n3,4\n"), ("readme.txt", b"hello"),
    }
    lines = scan_archive_lines(spark, str(tmp_path), "*.csv").where("line_no > 0")
    assert {(r.member, r.line) for r in lines.collect()} == {("d1/x.csv", "1,2"), ("d2/x.csv", "3,4")}
    members = list_members(spark, str(tmp_path))
    files = members.select(F.concat_ws("!", "archive", "member").alias("path"), F.col("member").alias("rel"), "size", F.lit(0).alias("mtime"))
    flat = {r.key: r.n_collisions for r in landing_manifest(files, "flat").collect()}
    assert flat == {"raw/x.csv": 1, "raw/readme.txt": 0}
    tree = members.withColumn("key", F.concat(F.lit("raw/"), "member"))
    assert land_members(spark, tree, str(tmp_path / "lake")) == {"files": 3, "bytes": 23}
    assert sorted(values(scan_csv(spark, str(tmp_path / "lake/raw")))) == [("1", "2"), ("3", "4")]


def test_landing(spark, tmp_path):
    for name in ("d1/x.csv", "d 2/x.csv", "d1/y.log"):
        put(tmp_path / name, "a\n1\n")
    files = scan_landing(spark, str(tmp_path), "*.csv")
    assert {r.rel for r in files.collect()} == {"d1/x.csv", "d 2/x.csv"}
    keys = landing_manifest(files)
    assert {r.key for r in filter_objects(keys, "raw/d1", ".csv").collect()} == {"raw/d1/x.csv"}


def test_notified(spark, tmp_path):
    for i in range(4):
        put(tmp_path / "lake" / "raw" / f"f {i}.csv", f"{i}\n")
    body = json.dumps({"Records": [{"s3": {"bucket": {"name": "lake"}, "object": {"key": f"raw/{k}"}}} for k in ("f 1.csv", "f 3.csv", "no.txt")]})
    notes = spark.createDataFrame([(body,), (body,)], "body string")
    reader = lambda paths: spark.read.option("recursiveFileLookup", "true").text(paths)
    got = scan_notified(spark, notes, reader, str(tmp_path), suffix=".csv")
    assert sorted(r.value for r in got.collect()) == ["1", "3"]
    assert scan_notified(spark, notes, reader, str(tmp_path), suffix=".none").collect() == []


def test_names_stay_inside_and_bad_archives_are_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "a.zip", "w") as z:
        z.writestr("../../escape.csv", "a\n1\n")
        z.writestr("x[1].csv", "b\n2\n")
    (tmp_path / "in" / "b.zip").write_bytes(b"junk")
    got = land_archives(spark, str(tmp_path / "in"), str(tmp_path / "deep" / "lake"))
    assert (got["files"], got["failed"]) == (2, 1)
    errors = land_errors(spark, str(tmp_path / "deep" / "lake")).collect()
    assert [(r.source_file.rsplit("/", 1)[1], bool(r.error)) for r in errors] == [("b.zip", True)]
    assert sorted(p.name for p in tmp_path.rglob("*.csv")) == ["escape.csv", "x[1].csv"]
    assert (tmp_path / "deep" / "lake" / "raw" / "escape.csv").exists()
    assert scan_csv(spark, str(tmp_path / "deep" / "lake" / "raw")).count() == 2


def test_flow_append_twice(spark, tmp_path):
    dirs = [str(tmp_path / d) for d in ("raw", "stage", "processed", "rejects")]
    head = "id,timestamp,accel_x,accel_y,accel_z\n"
    put(tmp_path / "raw" / "x.csv", head + "1,2024-01-01,1,2,3\n")
    cfg = FlowConfig(*dirs, "twice_table", SCHEMAS["accel5"], mode="append")
    assert run_flow(spark, cfg).table.count() == 1
    again = run_flow(spark, cfg)
    assert again.table.count() == 1 and again.summary.count() == 0
    put(tmp_path / "raw" / "y[1].csv", head + "2,2024-01-01,1,2,3\n")
    assert sorted(r.id for r in run_flow(spark, cfg).table.collect()) == ["1", "2"]


HEAD = "id,timestamp,accel_x,accel_y,accel_z\n"


def append_config(tmp_path, name):
    dirs = [str(tmp_path / d) for d in ("raw", "stage", "processed", "rejects")]
    return FlowConfig(*dirs, name, SCHEMAS["accel5"], mode="append")


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("dies", ["write_batch", "put_sources", "commit", "sync_table"])
def test_a_run_that_dies_adds_nothing_twice(spark, tmp_path, monkeypatch, dies):
    cfg = append_config(tmp_path, f"died_{dies}")
    put(tmp_path / "raw" / "x.csv", HEAD + "1,2024-01-01,1,2,3\n2,nope,1,2,3\n")
    run_flow(spark, cfg)
    put(tmp_path / "raw" / "y.csv", HEAD + "3,2024-01-01,1,2,3\n4,nope,1,2,3\n")
    put(tmp_path / "raw" / "x.csv", HEAD + "5,2024-01-01,1,2,3\n1,2024-01-01,1,2,3\n")
    owner = BatchLog if dies in ("put_sources", "commit") else flow
    real, calls = getattr(owner, dies), []

    def killed(*args, **kw):
        calls.append(dies)
        # Half-way: the first batch is written, the second is not.
        if dies == "write_batch" and len(calls) < 3:
            return real(*args, **kw)
        raise KeyboardInterrupt(dies)

    monkeypatch.setattr(owner, dies, killed)
    with pytest.raises(KeyboardInterrupt):
        run_flow(spark, cfg)
    monkeypatch.setattr(owner, dies, real)
    if dies != "sync_table":
        assert ids(spark.table(cfg.table)) == ["1"]  # readers follow the log
    result = run_flow(spark, cfg)
    assert ids(result.table) == ["1", "3", "5"] == ids(spark.table(cfg.table))
    assert ids(run_flow(spark, cfg).table) == ["1", "3", "5"]
    (live,) = BatchLog(spark, cfg.stage).live("table")
    assert ids(read_batches(spark, cfg.rejects, live, T.StructType.fromDDL("id string"))) == ["4"]


def test_changed_file_replaces_its_rows(spark, tmp_path):
    cfg = append_config(tmp_path, "changed_table")
    put(tmp_path / "raw" / "a.csv", HEAD + "1,2024-01-01,1,2,3\n2,2024-01-01,1,2,3\n")
    put(tmp_path / "raw" / "b.csv", HEAD + "3,2024-01-01,1,2,3\n")
    run_flow(spark, cfg)
    put(tmp_path / "raw" / "a.csv", HEAD + "7,2024-01-01,1,2,3\n8,bad,1,2,3\n")
    put(tmp_path / "raw" / "c.csv", "timestamp,id,extra\n2024-01-01,9,x\n")
    result = run_flow(spark, cfg)
    assert ids(result.table) == ["3", "7", "9"]
    counts = {r.source_file.rsplit("/", 1)[1]: (r.rows_in, r.rows_out, r.rows_rejected) for r in result.summary.collect()}
    assert counts == {"a.csv": (2, 1, 1), "c.csv": (1, 1, 0)}
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in read_stage(spark, cfg.stage, part="stage").collect()) == ["a.csv", "a.csv", "b.csv", "c.csv"]
    # From all that is staged, whatever the order of the runs.
    put(tmp_path / "other" / "b.csv", HEAD + "4,2024-01-01,1,2,3\n")
    again = run_flow(spark, FlowConfig(str(tmp_path / "other"), cfg.stage, cfg.processed, cfg.rejects, cfg.table, cfg.spec))
    assert ids(again.table) == ["3", "4", "7", "9"] and ids(again.rejects) == ["8"]
    put(tmp_path / "raw" / "b.csv", HEAD + "5,2024-01-01,1,2,3\n")
    assert ids(run_flow(spark, cfg).table) == ["4", "5", "7", "9"]


def test_files_that_cannot_be_read(spark, tmp_path):
    cfg = append_config(tmp_path, "unreadable_table")
    put(tmp_path / "raw" / "a.csv", HEAD + "1,2024-01-01,1,2,3\n")
    (tmp_path / "raw" / "b.csv").write_bytes(b"\xff\xfe\x00\x81,x\n1,2\n")
    put(tmp_path / "raw" / "c.csv", "\n\n")
    result = run_flow(spark, cfg)
    assert ids(result.table) == ["1"]
    errors = {r.source_file.rsplit("/", 1)[1]: (r.status, bool(r.error)) for r in result.files.collect()}
    assert errors == {"a.csv": ("converted", False), "b.csv": ("failed", True), "c.csv": ("failed", True)}
    assert file_counts(result.files).first().asDict() == {"files_landed": 3, "files_converted": 1, "files_skipped": 0, "files_failed": 2}
    put(tmp_path / "raw" / "b.csv", HEAD + "2,2024-01-01,1,2,3\n")
    assert ids(run_flow(spark, cfg).table) == ["1", "2"]


def test_vacuum(spark, tmp_path):
    cfg = append_config(tmp_path, "vacuumed_table")
    for i in (1, 2):
        put(tmp_path / "raw" / "a.csv", HEAD + f"{i},2024-01-01,1,2,3\n")
        run_flow(spark, cfg)
    write_batch(spark.range(1), cfg.processed, "litter")
    assert len(vacuum(spark, cfg.processed, BatchLog(spark, cfg.stage), "table")) == 2
    assert ids(spark.table(cfg.table)) == ["2"]


def test_stage_replaces_per_source(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "source_file string, v int")
    write_stage(df, path)
    write_stage(spark.createDataFrame([("b", 3), ("b", 4)], "source_file string, v int"), path)
    assert sorted((r.source_file, r.v) for r in read_stage(spark, path).collect()) == [("a", 1), ("b", 3), ("b", 4)]


def test_processed_and_table(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "v int, k string")
    write_processed(df, path, "overwrite", ["k"])
    write_processed(df.where("v = 1"), path, "overwrite", ["k"])
    table = register_table(spark, "kept_table", path, df.schema, ["k"])
    assert values(table) == [(1, "x")]


def test_incremental(spark, tmp_path):
    schema = T.StructType.fromDDL("id string, v double")
    args = (spark, str(tmp_path / "src"), lambda df: df.where("v > 0"), str(tmp_path / "out"), str(tmp_path / "ck"), schema, "csv")
    put(tmp_path / "src" / "a.csv", "1,1.0\n2,-1.0\n")
    assert run_incremental(*args).count() == 1
    assert run_incremental(*args).count() == 1
    put(tmp_path / "src" / "n" / "b.csv", "3,2.0\n")
    put(tmp_path / "src" / "a.csv", "9,9.0\n")  # a path seen before is not read again
    assert sorted(r.id for r in run_incremental(*args).collect()) == ["1", "3"]


def test_flow(spark, tmp_path):
    put(tmp_path / "raw" / "d1" / "x.csv", "ID,Timestamp,Accel X,accelY,accel-z\n007,2024-01-01 00:00:00,1,2,NA\n8,nope,1,2,3\n")
    put(tmp_path / "raw" / "d2" / "x.csv", "ID,Timestamp,Accel X,accelY,accel-z\n9,2024-01-02,1,2,3\n10,2024-01-01\n")
    dirs = [str(tmp_path / d) for d in ("raw", "stage", "processed", "rejects")]
    result = run_flow(spark, FlowConfig(*dirs, "flow_table", SCHEMAS["accel5"]))
    assert sorted((r.id, r.accel_z is None) for r in result.table.collect()) == [("007", True), ("9", False)]
    counts = {os.path.basename(os.path.dirname(r.source_file)): (r.rows_in, r.rows_out, r.rows_rejected) for r in result.summary.collect()}
    assert counts == {"d1": (2, 1, 1), "d2": (2, 1, 1)}
    assert sorted(r.id for r in result.rejects.collect()) == ["10", "8"]


def test_flow_again(spark, tmp_path):
    dirs = [str(tmp_path / d) for d in ("stage", "processed", "rejects")]
    head = "id,timestamp,accel_x,accel_y,accel_z\n"
    put(tmp_path / "day1" / "x.csv", head + "1,2024-01-01,1,2,3\n")
    put(tmp_path / "day2" / "x.csv", head + "2,2024-01-02,1,2,3\n3,nope,1,2,3\n")
    for day in ("day1", "day2"):
        result = run_flow(spark, FlowConfig(str(tmp_path / day), *dirs, "daily_table", SCHEMAS["accel5"], mode="append"))
    assert sorted(r.id for r in result.table.collect()) == ["1", "2"]
    assert [(r.rows_in, r.rows_out, r.rows_rejected) for r in result.summary.collect()] == [(2, 1, 1)]
    put(tmp_path / "day1" / "x.csv", head + "7,2024-01-01,1,2,3\n")
    result = run_flow(spark, FlowConfig(str(tmp_path / "day1"), *dirs, "daily_table", SCHEMAS["accel5"]))
    assert sorted(r.id for r in result.table.collect()) == ["2", "7"]


def test_dialect_and_fixed_width(spark, tmp_path):
    put(tmp_path / "a.csv", "made by hand\nsecond line\nid;ok;v\n1;y;1,5\n2;n;-\n")
    schema = T.StructType.fromDDL("id int, ok boolean, v double")
    got = read_dialect(spark, str(tmp_path / "a.csv"), schema, delimiter=";", null_tokens=("-",), true_tokens=("y",), false_tokens=("n",), decimal_point=",", skip_rows=2)
    assert sorted(values(got)) == [(1, True, 1.5), (2, False, None)]
    put(tmp_path / "f.txt", "  1abc  2.5\n 22de       \n")
    got = read_fixed_width(spark, str(tmp_path / "f.txt"), {"i": (0, 3, "int"), "s": (3, 6, "string"), "v": (6, 12, "double")})
    assert sorted(values(got)) == [(1, "abc", 2.5), (22, "de", None)]


def test_path_partitions(spark, tmp_path):
    put(tmp_path / "2024" / "07" / "dev1.txt", "x\n")
    got = path_partitions(spark.read.option("recursiveFileLookup", "true").text(str(tmp_path)), r"/(?<year>\d{4})/(?<month>\d{2})/(?<device>[^/.]+)\.", {"year": "int", "month": "int"})
    assert values(got) == [("x", 2024, 7, "dev1")]


def test_headers_of_many_files_in_one_batch(spark, tmp_path):
    """Files with, without (blank lines) and with unreadable headers beside each other; each is named once."""
    for i in range(40):
        content = b"\n\n" if i % 10 == 3 else b"\xff\xfe,\xff\n1,2\n" if i % 10 == 7 else f"a,a,c{i % 2}\n1,2,3\n".encode()
        (tmp_path / f"f{i}.csv").write_bytes(content)
    got = {int(r.path.rsplit("/f", 1)[1][:-4]): (r.header, r.error) for r in headers(spark, str(tmp_path), report=True).coalesce(1).collect()}
    assert len(got) == 40
    for i, (header, error) in got.items():
        if i % 10 == 3:
            assert header is None and error == "no header"
        elif i % 10 == 7:
            assert header is None and "decode" in error
        else:
            assert header == ["a", "a.1", f"c{i % 2}"] and error is None
    for i in range(40):
        if i % 10 == 7:
            (tmp_path / f"f{i}.csv").unlink()
    assert headers(spark, str(tmp_path)).count() == 32 and headers(spark, str(tmp_path)).columns == ["path", "header"]
