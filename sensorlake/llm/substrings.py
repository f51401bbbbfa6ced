"""Substring dedup: windows of 50 words that an earlier document holds, found with a count-min prefilter.

First pass: every task makes a count-min sketch of its own documents, as sorted lists of cells; the lists are merged by
block of cells, counts held at two. A window is counted under a signature, the least hash among the stretches of 26 words inside
it, once per document. Equal windows have equal signatures, so the merged count is never below the number of documents that
hold the window, and neighbouring windows share a signature, so there are about thirteen times fewer of them than windows. The sketch has a
fixed size, ``ROWS`` x ``CELLS`` bits once merged (32 MB), at any size of the corpus: a fuller one only estimates more windows as
repeated, and loses none.

Second pass: windows estimated repeated, and no others, are grouped by a 128-bit hash of their words, which gives the
smallest doc_id that holds each. Its documents get back the windows that are theirs (few where groups of copies are large);
the last pass removes words under any estimated window that is not its document's own.

Defined results: a null or empty text has no words; texts of fewer than 50 words lose nothing; whole texts are read, however long. A
row with a null doc_id is compared with nothing: it loses nothing and takes nothing from others. Rows with equal ids are one
document, none of them is earlier. Repeated rows are returned one by one. The row is carried as one struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.shared import kept, table

WINDOW, STRETCH = 50, 26
ROWS, CELLS, BLOCK = 2, 1 << 27, 1 << 20
HELD = 1_000_000  # signatures a task holds before it hands on a part of its sketch
SEGMENT = 1 << 18  # bytes of text hashed at a time
LONG_WORD = 64  # longer words have a cryptographic hash
PART = 500  # rows of a batch worked on at a time
U = np.uint64
# Odd multipliers; one row each for the two halves of a hash.
TURNS = np.array([[0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], [0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB]], np.uint64)


class Bytes:
    """What word hashes are made with: a number per byte, and powers of an odd base with their inverses, for both halves."""

    BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
    VALUES = np.array([[int.from_bytes(hashlib.blake2b(bytes([half, b]), digest_size=8).digest()) for b in range(256)] for half in (0, 1)], np.uint64)

    def __init__(self) -> None:
        bases = [int(t[0]) for t in TURNS]
        self.powers, self.inverses = (
            [np.cumprod(np.concatenate([[U(1)], np.full(SEGMENT - 1, x, np.uint64)])) for x in xs] for xs in (bases, [pow(x, -1, 1 << 64) for x in bases])
        )

    def words(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of a text, and where its words start and end."""
        data = np.frombuffer(text, np.uint8)
        blank = np.ones(len(data) + 2, bool)
        blank[1:-1] = self.BLANK[data]
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        return data, edges[::2], edges[1::2]

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, half: int) -> np.ndarray:
        """A 64-bit hash of every word: the polynomial of its bytes, from sums over the text, then mixed."""
        found = np.zeros(len(starts), np.uint64)
        first = 0
        while first < len(starts):
            # So many words as fit a segment; one longer than that is hashed below.
            begin = starts[first]
            last = max(first + 1, int(np.searchsorted(ends, begin + SEGMENT - 1, side="right")))
            s, e = starts[first:last] - begin, ends[first:last] - begin
            if e[-1] < SEGMENT:
                part = self.VALUES[half][data[begin : begin + e[-1]]]
                part *= self.powers[half][: len(part)]
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(part, out=sums[1:])
                found[first:last] = (sums[e] - sums[s]) * self.inverses[half][s]
            first = last
        length = ends - starts
        for i in np.flatnonzero(length > LONG_WORD):
            found[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=bytes([half])).digest())
        return _join(found, length.astype(np.uint64), TURNS[1 - half])


def _join(a: np.ndarray, b: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """A hash of two stretches, one after the other."""
    x = a * turn[0]
    x ^= x >> U(31)
    x += b
    x *= turn[1]
    x ^= x >> U(29)
    return x


def stretches(hashes: np.ndarray, turn: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of every stretch of each size, from stretches of powers of two."""
    powers, n = [hashes], len(hashes)
    while 2 << (len(powers) - 1) <= max(sizes):
        half = powers[-1]
        step = 1 << (len(powers) - 1)
        powers.append(_join(half[: max(len(half) - step, 0)], half[step:], turn))
    found = []
    for size in sizes:
        out, done = None, 0
        for k in reversed(range(len(powers))):
            if size >> k & 1:
                part = powers[k][done : done + max(n - size + 1, 0)]
                out = part if out is None else _join(out[: len(part)], part, turn)
                done += 1 << k
        found.append(out)
    return found


def least(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every ``size`` neighbours."""
    width, now = 1, values
    while width * 2 <= size:
        now = np.minimum(now[:-width], now[width:])
        width *= 2
    return now if width == size else np.minimum(now[: len(values) - size + 1], now[size - width :])


def signatures(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window: its signature, and the first half of its hash."""
    short, whole = stretches(hashes, TURNS[0], (STRETCH, WINDOW))
    return least(short, WINDOW - STRETCH + 1), whole


def cells(signature: np.ndarray, row: int) -> np.ndarray:
    x = signature * TURNS[row][1]
    x ^= x >> U(32)
    x *= TURNS[row][0]
    return (x >> U(64 - (CELLS.bit_length() - 1))).astype(np.uint32)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of a sketch: per row and block, the cells counted once or more, and those counted more than once."""
    known, held, size = Bytes(), [], 0

    def parts() -> pa.RecordBatch:
        rows, blocks, ones, more = [], [], [], []
        for row in range(ROWS):
            found, counts = np.unique(cells(np.concatenate(held), row), return_counts=True)
            edges = np.searchsorted(found, np.arange(0, CELLS + BLOCK, BLOCK))
            for block in np.flatnonzero(np.diff(edges)):
                here = slice(edges[block], edges[block + 1])
                low = (found[here] % BLOCK).astype(np.uint32)
                rows.append(row)
                blocks.append(int(block))
                ones.append(zlib.compress(np.diff(low, prepend=np.uint32(0)).tobytes(), 1))
                more.append(zlib.compress(np.packbits(counts[here] > 1).tobytes(), 1))
        return pa.record_batch({"row": pa.array(rows, pa.int32()), "block": pa.array(blocks, pa.int32()), "cells": pa.array(ones, pa.binary()), "more": pa.array(more, pa.binary())})

    for batch in batches:
        for text in batch.column("text"):
            data, starts, ends = known.words(text.as_py())
            if len(starts) >= WINDOW:
                held.append(np.unique(signatures(known.hashes(data, starts, ends, 0))[0]))
                size += len(held[-1])
                if size >= HELD:
                    yield parts()
                    held, size = [], 0
    if held:
        yield parts()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells counted twice or more over all parts of a block, as bits."""
    seen: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for row, block, ones, more in zip(*[c.to_pylist() for c in batch.columns]):
            once, twice = seen.setdefault((row, block), (np.zeros(BLOCK, bool), np.zeros(BLOCK, bool)))
            at = np.cumsum(np.frombuffer(zlib.decompress(ones), np.uint32), dtype=np.uint32)
            twice[at] |= once[at] | np.unpackbits(np.frombuffer(zlib.decompress(more), np.uint8), count=len(at)).astype(bool)
            once[at] = True
    out = [(r, b, zlib.compress(np.packbits(twice).tobytes(), 1)) for (r, b), (_, twice) in seen.items() if twice.any()]
    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.int32(), pa.int32(), pa.binary()))], names=["row", "block", "bits"])


class Sketch:
    """The merged sketch inside a task."""

    def __init__(self, blocks: list[tuple[int, int, bytes]]) -> None:
        self.bits = np.zeros((ROWS, CELLS // 8), np.uint8)
        for row, block, bits in blocks:
            self.bits[row, block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(zlib.decompress(bits), np.uint8)

    def repeated(self, signature: np.ndarray) -> np.ndarray:
        """Which signatures are estimated to be in two documents or more."""
        found = np.ones(len(signature), bool)
        for row in range(ROWS):
            at = cells(signature, row)
            found &= (self.bits[row, at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return found


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, PART):
            yield batch.slice(i, PART)


def suspects(text: bytes, known: Bytes, sketch: Sketch) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows estimated repeated, and their hashes in two columns."""
    none = np.empty(0, np.int64), np.empty((0, 2), np.int64)
    data, starts, ends = known.words(text)
    if len(starts) < WINDOW:
        return none
    signature, first = signatures(known.hashes(data, starts, ends, 0))
    at = np.flatnonzero(sketch.repeated(signature))
    if not len(at):
        return none
    second = stretches(known.hashes(data, starts, ends, 1), TURNS[1], (WINDOW,))[0]
    return at, np.stack([first[at], second[at]], 1).view(np.int64)


def sketch_of(docs: DataFrame, text: str = "text") -> list[tuple[int, int, bytes]]:
    """The merged sketch, at most ``ROWS * CELLS / BLOCK`` blocks of ``BLOCK`` bits."""
    texts = docs.where(F.col(text).isNotNull()).select(F.col(text).cast("binary").alias("text"))
    parts = texts.mapInArrow(_sketch, "row int, block int, cells binary, more binary")
    merged = parts.repartition("row", "block").mapInArrow(_merge, "row int, block int, bits binary")
    return [tuple(r) for r in merged.collect()]


def owned_windows(docs: DataFrame, blocks: list[tuple[int, int, bytes]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, windows): of the windows estimated repeated, those that no smaller doc_id holds."""
    shared = docs.sparkSession.sparkContext.broadcast(blocks)
    rows = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), rows.schema["doc_id"]])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, known = Sketch(shared.value), Bytes()
        for batch in _parts(batches):
            hashes, counts = [np.empty((0, 2), np.int64)], []
            for text in batch.column("text"):
                hashes.append(suspects(text.as_py(), known, sketch)[1])
                counts.append(len(hashes[-1]))
            h = np.concatenate(hashes)
            ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), ids], names=["h1", "h2", "doc_id"])

    owners = rows.mapInArrow(find, schema).groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"))
    return kept(owners.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("windows")), "owned-windows")


def _cleaner(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, known = Sketch(shared.value), Bytes()
        for batch in _parts(batches):
            totals, removed, texts = [], [], []
            for text, named, own in zip(batch.column("text"), batch.column("named"), batch.column("windows")):
                whole = text.as_py() or b""
                words = whole.split()
                at, hashes = suspects(whole, known, sketch) if named.as_py() else ((), None)
                if len(at):
                    if own.is_valid:
                        pairs = np.stack([own.values.field(k).to_numpy() for k in (0, 1)], 1)
                        mine = {p.tobytes() for p in pairs}
                        at = at[[h.tobytes() not in mine for h in hashes]]
                    cover = np.zeros(len(words) + 1, np.int64)
                    cover[at] += 1
                    cover[at + WINDOW] -= 1
                    stay = np.cumsum(cover)[:-1] == 0
                    left = [w for w, s in zip(words, stay.tolist()) if s]
                else:
                    left = words
                totals.append(len(words))
                removed.append(len(words) - len(left))
                texts.append(b" ".join(left).decode("utf-8", "replace"))
            columns = [batch.column("row"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "n_removed", "kept_text"])

    return clean


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: ``row`` (a struct of the columns in ``carry``, all if None), n_words, n_removed and kept_text."""
    blocks = sketch_of(docs, text)
    owned = owned_windows(docs, blocks, doc_id, text).withColumnRenamed("doc_id", "owner")
    rows = docs.select(F.struct(*(carry or docs.columns)).alias("row"), F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))
    joined = rows.join(owned, F.col("id") == F.col("owner"), "left")
    joined = joined.select("row", "text", F.col("id").isNotNull().alias("named"), "windows")
    schema = T.StructType([
        joined.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(blocks)
    return joined.mapInArrow(_cleaner(shared), schema)


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
win AS (
  SELECT doc_id, s, sha256(array_to_string(a[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, a, unnest(range(1, len(a) - 48)) AS s FROM d WHERE len(a) >= 50)),
owner AS (SELECT h, min(doc_id) AS o FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM win JOIN owner USING (h) WHERE o < doc_id),
words AS (SELECT doc_id, unnest(a) AS w, generate_subscripts(a, 1) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY doc_id)
SELECT d.doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(len(a) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
