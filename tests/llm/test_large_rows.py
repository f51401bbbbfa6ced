"""Index rows hold megabytes: files and batches of them are bounded by bytes, not by rows."""

from __future__ import annotations

import glob
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import decontamination, search, shared

MB = 1 << 20


@pytest.fixture(scope="module")
def texts(spark):
    """Ten texts of 400,000 words in one task; few words are equal."""
    words = F.transform(F.sequence(F.lit(1), F.lit(400_000)), lambda i: F.substring(F.md5(F.concat_ws(" ", "id", i).cast("binary")), 1, 6))
    return spark.range(10, numPartitions=1).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))


def row_groups(index):
    """Bytes of the row groups, as written and unpacked."""
    found = []
    for path in index.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://")).metadata
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        found += [sum(g.column(c).total_compressed_size for c in range(g.num_columns)) for g in groups]
    return found


def handed_over(index):
    """Rows and bytes of the batches that a Python task is given."""

    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"n": pa.array([b.num_rows]), "bytes": pa.array([b.nbytes])})

    return [tuple(r) for r in index.mapInArrow(sizes, "n long, bytes long").collect()]


@pytest.mark.parametrize("build", [decontamination.build_index, search.build_index])
def test_index_is_read_in_bounded_pieces(spark, texts, build):
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    index = build(texts)
    assert spark.conf.get(key) == before
    groups, batches = row_groups(index), handed_over(index)
    assert sum(groups) > 20 * MB and max(groups) < 16 * MB
    assert sum(b for _, b in batches) > 40 * MB and max(b for _, b in batches) < 24 * MB


def test_scratch_passes_options_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "scratch_dir", lambda _, label: f"{tmp_path}/{label}")
    rows = spark.range(40, numPartitions=1).select("id", F.repeat(F.md5(F.col("id").cast("string")), 4000).alias("text"))
    got = shared.Scratch(spark).keep(rows, "step", options=shared.LARGE_ROWS | {"parquet.block.size": 200_000})
    (path,) = glob.glob(f"{tmp_path}/step/*.parquet")
    assert pq.ParquetFile(path).metadata.num_row_groups > 3
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def slid(words):
    """Windows of a text, one shorter window if it has few words."""
    return {tuple(words[i : i + decontamination.WINDOW]) for i in range(max(len(words) - decontamination.WINDOW, 0) + 1)} if words else set()


@pytest.mark.parametrize("at_once", [(8192, 1 << 18), (3, 7), (1, 1)])
def test_windows_are_found_many_at_a_time(monkeypatch, at_once):
    monkeypatch.setattr(decontamination, "WINDOWS", at_once[0])
    monkeypatch.setattr(decontamination, "PLACES", at_once[1])
    rng = random.Random(5)
    for _ in range(30):
        few = rng.choice([2, 10, 200])
        pick = lambda k: " ".join(rng.choice(["a", "B", "é"]) + str(int(rng.paretovariate(0.7)) % few) for _ in range(k))  # noqa: B023, E731
        docs = [decontamination.words_of(rng.choice([None, "", "?!", pick(rng.choice([1, 9, 10, 11, 300]))])) for _ in range(rng.choice([1, 5, 20]))]
        part = lambda: b" ".join(rng.choice(docs)[: rng.choice([1, 10, 15])]).decode()  # noqa: B023, E731
        items = [(str(rng.randrange(4)), rng.choice(["", "..", pick(rng.choice([1, 2, 10, 30])), part()])) for _ in range(rng.choice([0, 1, 15]))]
        wanted = {}
        for item, text in items:
            for w in slid(decontamination.words_of(text)):
                wanted.setdefault(w, set()).add(item)
        want, start = [], 0
        for words in docs:
            want += [(start + i, w, sorted(names)) for w, names in wanted.items() for i in range(len(words)) if tuple(words[i : i + len(w)]) == w]
            start += len(words)
        windows = decontamination.Windows(items)
        named = [tuple(windows.terms[c].encode() for c in row if c != decontamination.PAD) for row in windows.rows]
        assert sorted(named) == sorted(wanted)
        segment = decontamination.Segment(decontamination._segment("s", list(enumerate(docs))))
        got = [(at, named[w], sorted(set(windows.items(w)))) for found, places in segment.phrases(windows) for w, at in zip(found.tolist(), places.tolist())]
        assert sorted(got) == sorted(want)


def test_windows_of_a_block_are_small():
    """Two million letters of benchmark text were 161 MB of tuples; a task holds them beside its segments."""
    rng = random.Random(3)
    items = [(str(i), " ".join(f"w{rng.randrange(20_000)}" for _ in range(50))) for i in range(2000)]
    windows = decontamination.Windows(items)
    assert len(windows.rows) > 80_000
    assert sum(v.nbytes for v in vars(windows).values() if isinstance(v, np.ndarray)) < 70 * len(windows.rows)


def a_block(rng, n=60):
    """A block of documents and how many documents hold each word."""
    words = [f"w{i}".encode() for i in range(20_000)]
    docs = []
    for d in range(n):
        codes, counts = np.unique([rng.randrange(20_000) if rng.random() < 0.7 else rng.randrange(50) for _ in range(rng.choice([5, 50, 900]))], return_counts=True)
        docs.append((d, codes.astype(np.int64), counts))
    codes, dfs = np.unique(np.concatenate([c for _, c, _ in docs]), return_counts=True)
    total = int(sum(c.sum() for _, _, c in docs))
    return words, search.Block(search.make_block(docs, words)), {words[i]: int(k) for i, k in zip(codes, dfs)}, n, total


@pytest.mark.parametrize("cells", [1, 300, 1 << 30])
def test_bounds_of_some_queries_after_others(monkeypatch, cells):
    rng = random.Random(2)
    words, block, dfs, n, total = a_block(rng)
    texts = [b" ".join(rng.choice(words[: rng.choice([50, 20_000])]) for _ in range(rng.choice([0, 1, 8, 40]))) for _ in range(30)]
    m = 75 + 25 * block.lengths * n // total
    alone = [search.Queries([t], dfs, n, total).bounds(block, m)[0] for t in texts]
    monkeypatch.setattr(search, "CELLS", cells)
    assert np.array_equal(search.Queries(texts, dfs, n, total).bounds(block, m), np.array(alone))


def test_many_short_queries_have_no_whole_matrix():
    rng = random.Random(2)
    words, block, dfs, n, total = a_block(rng)
    known = list(dfs)
    texts = [b" ".join(rng.choice(known) for _ in range(8)) for _ in range(8000)]
    tracemalloc.start()
    queries = search.Queries(texts, dfs, n, total)
    queries.bounds(block, 75 + 25 * block.lengths * n // total)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(texts) * len(queries.terms) * 4 > 200 * MB and peak < 60 * MB


def test_query_blocks_are_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BLOCK_ROWS", 3)
    queries = spark.createDataFrame([(i, f"t{i}") for i in range(8)], "item_id bigint, text string").coalesce(1)
    assert [len(b) for b in search.query_blocks(queries, "item_id", "text")] == [3, 3, 2]
