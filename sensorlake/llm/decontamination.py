"""Benchmark decontamination with a positional inverted index that is cut by documents.

Every segment of the index is one Parquet row: the terms of a block of documents, and the positions of each term, in order.
Phrases are found by intersecting the position lists of their terms, shifted by the place of the term, from the rarest term
on. Segments are searched where they lie, so postings are not shuffled. Test windows go to the segments in blocks of at most
``QUERY_BLOCK_BYTES`` of text, whatever the size of the benchmark.

Defined results: a null or empty text has no words and is clean; an item without words has no windows; equal items are all
reported; repeated document rows are reported one by one; a null item id is reported as the empty string; an empty benchmark
leaves all documents clean. Texts are indexed whole, a very long one in a segment of its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.shared import LARGE_ROWS, Scratch, bounded_batches, few_rows_scanned, kept, table

WINDOW = 10
SEGMENT_TOKENS = 400_000
QUERY_BLOCK_BYTES = 4_000_000
WINDOWS, PLACES = 8192, 1 << 18  # that are tried at once
PAD, ABSENT = -1, -2  # instead of the number of a word
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

INDEX_SCHEMA = "segment string, doc_ids array<bigint>, starts array<int>, terms array<string>, ends array<int>, positions binary"
# Bytes above the ASCII range belong to words, so words of bytes are words of characters.
MATCH_SCHEMA = "segment string, ordinal int, doc_id bigint, n_words bigint, runs array<struct<lo:int,hi:int>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased (bytes.lower changes those letters only)."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def _segment(name: str, docs: list[tuple[int | None, list[bytes]]]) -> dict:
    """Positions run through the segment; a gap longer than no phrase keeps documents apart: starts mark where each begins."""
    ids: dict[bytes, int] = {}
    starts, codes, at = [0], [], []
    place = 0
    for _, words in docs:
        codes.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)))
        at.append(np.arange(place, place + len(words), dtype=np.int32))
        place += len(words)
        starts.append(place)
    code, pos = np.concatenate(codes), np.concatenate(at)
    order = np.argsort(code, kind="stable")
    ends = np.cumsum(np.bincount(code, minlength=len(ids))).astype(np.int32)
    return {
        "segment": name, "doc_ids": [d for d, _ in docs], "starts": starts,
        "terms": [w.decode("utf-8", "surrogatepass") for w in ids], "ends": ends.tolist(), "positions": pos[order].tobytes(),
    }


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: Callable[..., DataFrame] = kept) -> DataFrame:
    """The stored index of all words of all documents: one row per segment. ``keep`` stores it."""

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for d, t in zip(batch["doc_id"], batch["text"]):
                words = words_of(t if isinstance(t, str) else None)
                held.append((None if pd.isna(d) else int(d), words))
                size += len(words)
                if size >= SEGMENT_TOKENS or len(held) >= 20_000:
                    yield pd.DataFrame([_segment(f"{part}-{number}", held)])
                    number, held, size = number + 1, [], 0
        if held:
            yield pd.DataFrame([_segment(f"{part}-{number}", held)])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    bounded_batches(docs.sparkSession)
    with few_rows_scanned(docs.sparkSession):
        return keep(rows.mapInPandas(segments, INDEX_SCHEMA), "positional-index", options=LARGE_ROWS)


class Windows:
    """The windows of a block of items: rows of word numbers, equal rows once, and the items that hold each. An item of fewer words
    is one window, filled up with ``PAD``."""

    def __init__(self, items: list[tuple[str, str]]) -> None:
        ids: dict[bytes, int] = {}
        rows, owners = [np.empty((0, WINDOW), np.int32)], [np.empty(0, np.int64)]
        for i, (_, text) in enumerate(items):
            words = words_of(text)
            if words:
                codes = np.full(max(len(words), WINDOW), PAD, np.int32)
                codes[: len(words)] = [ids.setdefault(w, len(ids)) for w in words]
                rows.append(np.lib.stride_tricks.sliding_window_view(codes, WINDOW))
                owners.append(np.full(len(rows[-1]), i))
        every = np.concatenate(rows).view(np.dtype((np.void, 4 * WINDOW)))[:, 0]
        found, row = np.unique(every, return_inverse=True)
        self.rows = found.view(np.int32).reshape(-1, WINDOW)
        self.lengths = (self.rows != PAD).sum(axis=1)
        self.terms = [w.decode("utf-8", "surrogatepass") for w in ids]
        pairs = np.unique(row * max(len(items), 1) + np.concatenate(owners))
        self.owners = pairs % max(len(items), 1)
        self.begins = np.searchsorted(pairs // max(len(items), 1), np.arange(len(self.rows) + 1))
        self.names = [name for name, _ in items]

    def items(self, window: int) -> list[str]:
        return [self.names[i] for i in self.owners[self.begins[window] : self.begins[window + 1]].tolist()]


class Segment:
    """Postings of one index row."""

    def __init__(self, row) -> None:
        self.ids = {t: i for i, t in enumerate(row["terms"])}
        self.ends = np.asarray(row["ends"], np.int64)
        self.positions = np.frombuffer(row["positions"], np.int32)
        self.starts = np.asarray(row["starts"], np.int64)

    def postings(self, term: str) -> np.ndarray | None:
        i = self.ids.get(term)
        return None if i is None else self.positions[(self.ends[i - 1] if i else 0) : self.ends[i]]

    def phrases(self, windows: Windows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(windows, places): where windows start, inside one document."""
        of = np.fromiter((self.ids.get(t, ABSENT) for t in windows.terms), np.int64, len(windows.terms))
        of = np.append(of, PAD)
        there = np.flatnonzero(np.logical_and.reduce([of[windows.rows[:, k]] != ABSENT for k in range(WINDOW)]))
        sizes, reach = np.diff(self.ends, prepend=0), len(self.positions) + 2 * WINDOW
        # Postings as one list in order: a word, then its places.
        keys = np.repeat(np.arange(len(sizes)) * reach, sizes) + self.positions + WINDOW
        for begin in range(0, len(there), WINDOWS):
            some = there[begin : begin + WINDOWS]
            terms = of[windows.rows[some]]
            counts = np.where(terms == PAD, np.iinfo(np.int64).max, sizes[terms])
            order = np.argsort(counts, axis=1, kind="stable")
            rarest = np.take_along_axis(counts, order[:, :1], 1)[:, 0]
            cuts = np.flatnonzero(np.diff(np.cumsum(rarest) // PLACES)) + 1
            for here in np.split(np.arange(len(some)), cuts):
                # The places of each window's rarest word; of them those stay that have the next rarest where it belongs.
                n = rarest[here]
                w = np.repeat(here, n)
                column = order[w, 0]
                term = terms[w, column]
                at = self.positions[self.ends[term] - sizes[term] + np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)] - column
                for k in range(1, WINDOW):
                    column = order[w, k]
                    term = terms[w, column]
                    want = term * reach + at + column + WINDOW
                    i = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                    ok = (term == PAD) | (keys[i] == want)
                    w, at = w[ok], at[ok]
                w, at = some[w[at >= 0]], at[at >= 0]
                doc = np.searchsorted(self.starts, at, side="right") - 1
                inside = at + windows.lengths[w] <= self.starts[doc + 1]
                yield w[inside], at[inside]

    def near(self, terms: tuple[str, ...], slop: int) -> np.ndarray:
        """Places of the rarest term with every other term at most ``slop`` words away, in the same document."""
        lists = [self.postings(t) for t in dict.fromkeys(terms)]
        if not lists or any(x is None for x in lists):
            return np.empty(0, np.int64)
        lists.sort(key=len)
        at = lists[0].astype(np.int64)
        doc = np.searchsorted(self.starts, at, side="right") - 1
        lo, hi = np.maximum(self.starts[doc], at - slop), np.minimum(self.starts[doc + 1] - 1, at + slop)
        ok = np.ones(len(at), bool)
        for found in lists[1:]:
            i = np.searchsorted(found, lo)
            ok &= (i < len(found)) & (found[np.minimum(i, len(found) - 1)] <= hi)
        return at[ok]


def query_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most ``QUERY_BLOCK_BYTES`` of text (one longer item makes a block of its own)."""
    held, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).filter("t is not null").toLocalIterator():
        if held and size + len(row["t"]) > QUERY_BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((row["i"] or "", row["t"]))
        size += len(row["t"])
    yield held


def _search_block(index: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = Windows(shared.value)
        for batch in batches:
            for _, row in batch.iterrows():
                seg, hits, items_of = Segment(row), {}, {}
                for found, places in seg.phrases(windows):
                    at = np.searchsorted(seg.starts, places, side="right") - 1
                    lo = places - seg.starts[at]
                    for d, x, y in zip(at.tolist(), lo.tolist(), (lo + windows.lengths[found]).tolist()):
                        hits.setdefault(d, []).append((x, y))
                    for d, w in set(zip(at.tolist(), found.tolist())):
                        items_of.setdefault(d, set()).update(windows.items(w))
                out = []
                for d, doc_id in enumerate(row["doc_ids"]):
                    runs: list[dict] = []
                    for lo, hi in sorted(hits.get(d, ())):
                        if runs and lo <= runs[-1]["hi"]:
                            runs[-1]["hi"] = max(hi, runs[-1]["hi"])
                        else:
                            runs.append({"lo": lo, "hi": hi})
                    n = int(seg.starts[d + 1] - seg.starts[d])
                    out.append((row["segment"], d, doc_id, n, runs, sorted(items_of.get(d, ()))))
                yield pd.DataFrame(out, columns=["segment", "ordinal", "doc_id", "n_words", "runs", "items"])

    return index.mapInPandas(search, MATCH_SCHEMA)


def phrase_matches(index: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per indexed document its words, the runs of words inside matching windows, and the items they come from."""
    blocks = [_search_block(index, items) for items in query_blocks(benchmark)]
    if len(blocks) == 1:
        return blocks[0]
    # Runs of several blocks may overlap; `hit_words` counts what each adds beyond the ones before.
    return reduce(DataFrame.unionByName, blocks).groupBy("segment", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )


def proximity_matches(index: DataFrame, queries: list[tuple[str, str]], slop: int = 8) -> DataFrame:
    """(query, doc_id, position) where all words of a short query stand within ``slop`` words of its rarest word."""
    shared = index.sparkSession.sparkContext.broadcast([(q, tuple(w.decode() for w in words_of(t))) for q, t in queries])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                seg, out = Segment(row), []
                for q, terms in shared.value:
                    for at in seg.near(terms, slop):
                        d = int(np.searchsorted(seg.starts, at, side="right") - 1)
                        out.append((q, row["doc_ids"][d], int(at - seg.starts[d])))
                yield pd.DataFrame(out, columns=["query", "doc_id", "position"])

    return index.mapInPandas(search, "query string, doc_id bigint, position bigint")


def hit_words() -> Column:
    """Words inside any run; runs are in order."""
    step = lambda acc, r: F.struct(
        (acc["n"] + F.greatest(r["hi"] - F.greatest(r["lo"], acc["end"]), F.lit(0))).alias("n"), F.greatest(acc["end"], r["hi"]).alias("end")
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate("runs", zero, step, lambda acc: acc["n"]).cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame, keep: Callable[..., DataFrame] = kept) -> DataFrame:
    found = phrase_matches(build_index(docs, keep=keep), benchmark)
    return found.select(
        "doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that hold any window of the benchmark. A row is judged by its text (a 64-bit hash), whatever its id; it is carried
    as one struct, so no name can clash."""
    name = F.xxhash64("text")
    scratch = Scratch(spark)
    bad = contamination(docs.select(name.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"), scratch.keep).filter("contaminated")
    bad = kept(bad.select(F.col("doc_id").alias("name")).distinct(), "contaminated")
    scratch.clear()  # the names are written, so the index goes
    rows = docs.select(name.alias("name"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(bad, "name", "left_anti").select("row.*")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a
  FROM benchmark),
iw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(a), 10) AS n, array_to_string(a[s:s + least(len(a), 10) - 1], ' ') AS win
  FROM (SELECT item_id, a, unnest(range(1, greatest(len(a) - 10, 0) + 2)) AS s FROM i WHERE len(a) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, s, n, array_to_string(a[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, a, n, unnest(range(1, len(a) - n + 2)) AS s FROM w, sizes WHERE len(a) >= n)),
m AS (SELECT doc_id, s, dw.n AS n, item FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS j FROM m GROUP BY doc_id)
SELECT w.doc_id, CAST(len(a) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(j, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
