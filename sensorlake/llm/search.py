"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds documents in blocks of similar numbers of terms. A block has one Bloom signature per document, stored by slice: for
every bit of the signature a bitmap over the documents of the block. A term is put in once for each power of two its count
reaches, so the bitmaps that a query term selects tell, never too low, whether a document holds the term and up to which power of two
it occurs. Weights of the query terms times these bitmaps, summed, bound every document's score from above. Documents whose bound
is below the twentieth best score seen so far by the task are provably no result; all others are scored exactly from the
block's stored terms. Each task hands on its best per query, and the best of these are the result.

Queries go to the index in blocks of at most ``QUERY_BLOCK_BYTES`` of text, one after the other, whatever their number; counts of
documents and terms are taken over the whole index.

Defined results: a null or empty text has no terms, is not counted and never found; a query without terms has no results; equal scores are
ordered by doc_id, nulls last; repeated rows are documents of their own; each query row is ranked by itself, with equal or null
ids too. Texts are indexed whole, a very long one in a block of its own. Other columns, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.shared import LARGE_ROWS, bounded_batches, few_rows_scanned, kept, table

TOP = 20
BLOCK_DOCS, BLOCK_TERMS, BUFFER_TERMS = 1024, 1_000_000, 2_000_000
BITS_PER_TERM, HASHES = 8, 4
QUERY_BLOCK_BYTES, QUERY_BLOCK_ROWS = 1_000_000, 2048
CELLS = 1 << 19  # of a matrix of queries and terms
# Bytes above the ASCII range belong to terms, so terms of bytes are terms of characters.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
U = np.uint64


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text with A-Z lower-cased (bytes.lower changes those letters only)."""
    return TERM.findall(text.lower()) if text else []


def digests(terms: list[bytes], level: int) -> np.ndarray:
    """Two numbers of each term at a level."""
    return np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16, salt=bytes([level])).digest() for t in terms), "<u8").reshape(-1, 2)


def places(both: np.ndarray, bits: int) -> np.ndarray:
    """For each pair of numbers, ``HASHES`` bits of a signature."""
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((both[:, :1] + steps * (both[:, 1:] | U(1))) & U(bits - 1)).astype(np.int64)


def _levels(counts: np.ndarray) -> np.ndarray:
    """How many powers of two each count reaches."""
    return np.frexp(counts.astype(np.float64))[1]


def make_block(docs: list[tuple[object, np.ndarray, np.ndarray]], words: list[bytes]) -> dict:
    """One index row: documents as (id, codes of their terms, counts), codes pointing into ``words``."""
    used, codes = np.unique(np.concatenate([c for _, c, _ in docs]), return_inverse=True)
    counts = np.concatenate([n for _, _, n in docs])
    sizes = np.array([len(c) for _, c, _ in docs])
    held = [words[i] for i in used]
    levels = _levels(counts)
    of = np.repeat(np.arange(len(docs)), sizes)
    entries = int(np.bincount(of, weights=levels, minlength=len(docs)).max())
    bits = 1 << max(6, (BITS_PER_TERM * entries - 1).bit_length())
    matrix = np.zeros((bits, len(docs)), bool)
    for level in range(int(levels.max())):
        reached = np.flatnonzero(levels > level)
        terms, back = np.unique(codes[reached], return_inverse=True)
        at = places(digests([held[i] for i in terms], level), bits)
        for k in range(HASHES):
            matrix[at[back, k], of[reached]] = True
    return {
        "doc_ids": [d for d, _, _ in docs],
        "lengths": np.bincount(of, weights=counts, minlength=len(docs)).astype(np.int64),
        "bits": bits, "slices": np.packbits(matrix, axis=1).tobytes(), "terms": b"\n".join(held),
        "dfs": np.bincount(codes, minlength=len(held)).astype(np.int32).tobytes(), "sizes": sizes.astype(np.int32).tobytes(),
        "codes": codes.astype(np.int32).tobytes(), "counts": counts.astype(np.int32).tobytes(),
    }


def index_schema(doc_id: T.DataType) -> T.StructType:
    fields = [("doc_ids", T.ArrayType(doc_id)), ("lengths", T.ArrayType(T.LongType())), ("bits", T.LongType())]
    fields += [(n, T.BinaryType()) for n in ("slices", "terms", "dfs", "sizes", "codes", "counts")]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all terms of all documents that have one: a row per block."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema = index_schema(rows.schema["doc_id"].dataType)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[bytes, int] = {}
        held: list[tuple[object, np.ndarray, np.ndarray]] = []
        size = 0

        def flush(arrow_id: pa.DataType) -> Iterator[pa.RecordBatch]:
            words = list(ids)
            held.sort(key=lambda d: len(d[1]))
            start = 0
            while start < len(held):
                stop, most = start, 0
                # A signature has bits for the largest document of its block.
                while stop < len(held) and stop - start < BLOCK_DOCS:
                    most = max(most, len(held[stop][1]))
                    if stop > start and most * (stop - start + 1) > BLOCK_TERMS:
                        break
                    stop += 1
                row = make_block(held[start:stop], words)
                types = [pa.list_(arrow_id), pa.list_(pa.int64()), pa.int64(), *[pa.binary()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], names=list(row))
                start = stop

        kind = pa.null()
        for batch in batches:
            kind = batch.column("doc_id").type
            for d, t in zip(batch.column("doc_id"), batch.column("text")):
                found = terms_of(t.as_py())
                if found:
                    coded = np.fromiter((ids.setdefault(w, len(ids)) for w in found), np.int64, len(found))
                    codes, counts = np.unique(coded, return_counts=True)
                    held.append((d.as_py(), codes, counts))
                    size += len(codes)
                    if size >= BUFFER_TERMS:
                        yield from flush(kind)
                        ids, held, size = {}, [], 0
        if held:
            yield from flush(kind)

    bounded_batches(docs.sparkSession)
    with few_rows_scanned(docs.sparkSession):
        return kept(rows.mapInArrow(blocks, schema), "search-index", LARGE_ROWS)


class Block:
    """One row of the index."""

    def __init__(self, row: dict) -> None:
        self.doc_ids, self.bits = row["doc_ids"], row["bits"]
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.slices = np.frombuffer(row["slices"], np.uint8).reshape(self.bits, -1)
        self.terms = row["terms"].split(b"\n")
        self.codes, self.counts = (np.frombuffer(row[n], np.int32) for n in ("codes", "counts"))
        self.ends = np.cumsum(np.frombuffer(row["sizes"], np.int32))

    def document(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(self.ends[d - 1] if d else 0, self.ends[d])
        return self.codes[here], self.counts[here]

    def bitmaps(self, at: np.ndarray) -> np.ndarray:
        """For each row of bits, which documents have them all."""
        found = self.slices[at[:, 0]]
        for k in range(1, at.shape[1]):
            found = found & self.slices[at[:, k]]
        return np.unpackbits(found, axis=1, count=len(self.doc_ids)).astype(bool)


def share(tf: np.ndarray | int, m: np.ndarray) -> np.ndarray:
    """What a term gives per unit of its weight, in millionths."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Queries:
    """A block of queries: their terms, weights and numbers of repeats. Bounds are worked out for some queries after others, whose
    matrix has at most ``CELLS`` places, or for one query."""

    def __init__(self, texts: list[bytes], dfs: dict[bytes, int], n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        counted = [Counter(terms_of(t)) for t in texts]
        # Terms of no document add nothing, nor do those of weight 0.
        weights = {t: w for t in {t for c in counted for t in c} if dfs.get(t) and (w := weight(n_docs, dfs[t])) > 0}
        self.terms = sorted(weights)
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.own = []
        # Sums of whole numbers below 2^24 are exact in short floats.
        largest = max((sum(c[t] * weights.get(t, 0) for t in c) for c in counted), default=0)
        self.kind = np.float32 if largest < 2**24 else np.float64
        for c in counted:
            at = np.array([self.place[t] for t in c if t in self.place], np.int64)
            w = np.array([c[t] * weights[t] for t in c if t in self.place], np.int64)
            self.own.append((at, w))
        self.parts: list[tuple[int, int, np.ndarray]] = []
        start, among = 0, set()
        for q, (at, _) in enumerate(self.own):
            more = among | set(at.tolist())
            if q > start and (q + 1 - start) * len(more) > CELLS:
                self.parts.append((start, q, np.array(sorted(among), np.int64)))
                start, more = q, set(at.tolist())
            among = more
        self.parts.append((start, len(self.own), np.array(sorted(among), np.int64)))
        self.known: dict[int, np.ndarray] = {}

    def places(self, level: int, bits: int, terms: np.ndarray) -> np.ndarray:
        if level not in self.known:
            self.known[level] = digests(self.terms, level)
        return places(self.known[level][terms], bits)

    def bounds(self, block: Block, m: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, one row per query, one column per document."""
        total = np.zeros((len(self.own), len(m)))
        top = int(_levels(np.array([block.counts.max()]))[0])
        for start, stop, terms in self.parts:
            matrix = np.zeros((stop - start, len(terms)), self.kind)
            for q, (at, w) in enumerate(self.own[start:stop]):
                matrix[q, np.searchsorted(terms, at)] = w
            on, before, level = np.arange(len(terms)), None, 0
            given = np.zeros(len(m), np.int64)
            while len(on) and level < top:
                maps = block.bitmaps(self.places(level, block.bits, terms[on]))
                if before is not None:
                    maps &= before
                some = maps.any(1)
                on, before = on[some], maps[some]
                # Up to the next power of two, what a count can give beyond the level below.
                now = share((2 << level) - 1, m)
                total[start:stop] += (matrix[:, on] @ before.astype(matrix.dtype)).astype(np.float64) * (now - given)
                given, level = now, level + 1
        return total

    def score(self, block: Block, m: np.ndarray, lookup: np.ndarray, wanted: dict[int, list[int]]) -> Iterator[tuple[int, int, int]]:
        """(query, document, score) for documents and the queries that may find them."""
        counts = np.zeros(len(self.terms), np.int64)
        for d, queries in wanted.items():
            codes, n = block.document(d)
            at = lookup[codes]
            here = at[at >= 0]
            counts[here] = share(n[at >= 0].astype(np.int64), m[d])
            for q in queries:
                mine, w = self.own[q]
                yield q, d, int((w * counts[mine]).sum())
            counts[here] = 0


def search_index(index: DataFrame, queries: list[bytes], k: int = TOP) -> DataFrame:
    """(query, doc_id, score): the best ``k`` of every task for each query, given by its place in the list."""
    spark = index.sparkSession
    wanted = spark.sparkContext.broadcast({t for text in queries for t in terms_of(text)})
    n_docs, n_terms = index.agg(F.sum(F.size("lengths")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    dfs = {bytes(r["term"]): r["df"] for r in index.select("terms", "dfs").mapInArrow(_frequencies(wanted), "term binary, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    wanted.unpersist()
    prepared = Queries(queries, dfs, n_docs or 0, n_terms or 0)
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("doc_id", index.schema["doc_ids"].dataType.elementType), T.StructField("score", T.LongType())])
    return index.mapInArrow(_search(spark.sparkContext.broadcast(prepared), k), schema)


def _frequencies(wanted: Broadcast):
    """In how many documents of each block the wanted terms are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for terms, dfs in zip(batch.column("terms").to_pylist(), batch.column("dfs").to_pylist()):
                for term, df in zip(terms.split(b"\n"), np.frombuffer(dfs, np.int32).tolist()):
                    if term in wanted.value:
                        total[term] += df
        yield pa.record_batch({"term": pa.array(list(total), pa.binary()), "df": pa.array(list(total.values()), pa.int64())})

    return count


def _search(shared: Broadcast, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        best: list[list[tuple]] = [[] for _ in queries.own]
        floor = np.ones(len(best))  # a result scores above 0
        kind = pa.null()
        for batch in batches:
            kind = batch.column("doc_ids").type.value_type
            for i in range(batch.num_rows):
                block = Block({n: batch.column(n)[i].as_py() for n in batch.schema.names})
                m = 75 + 25 * block.lengths * queries.n_docs // queries.n_terms
                bounds = queries.bounds(block, m)
                lookup = np.array([queries.place.get(t, -1) for t in block.terms], np.int64)
                # First the documents with the highest bounds, so that what they score excludes most of the others.
                most = min(k, len(m))
                first = np.zeros(bounds.shape, bool)
                np.put_along_axis(first, np.argpartition(-bounds, most - 1, axis=1)[:, :most], True, axis=1)
                for now in (first, ~first):
                    wanted: dict[int, list[int]] = {}
                    for q, d in zip(*np.nonzero(now & (bounds >= floor[:, None]))):
                        wanted.setdefault(int(d), []).append(int(q))
                    touched = set()
                    for q, d, s in queries.score(block, m, lookup, wanted):
                        if s >= floor[q]:
                            best[q].append((-s, block.doc_ids[d] is None, block.doc_ids[d]))
                            touched.add(q)
                    for q in touched:
                        best[q] = sorted(best[q])[:k]
                        if len(best[q]) == k:
                            floor[q] = -best[q][-1][0]
        out = [(q, d, -s) for q, found in enumerate(best) for s, _, d in found]
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), kind, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "doc_id", "score"])

    return search


def query_blocks(queries: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str | None, bytes]]]:
    """Queries in blocks of at most ``QUERY_BLOCK_BYTES`` of text (a longer one makes a block of its own) and ``QUERY_BLOCK_ROWS``."""
    held, size = [], 0
    rows = queries.where(F.col(text).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    for i, t in rows.toLocalIterator():
        if held and (size + len(t) > QUERY_BLOCK_BYTES or len(held) == QUERY_BLOCK_ROWS):
            yield held
            held, size = [], 0
        held.append((i, bytes(t)))
        size += len(t)
    if held:
        yield held


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each query."""
    spark = docs.sparkSession
    index = build_index(docs, doc_id, text)
    item, found = queries.schema[item_id].dataType, index.schema["doc_ids"].dataType.elementType
    results = []
    for block in query_blocks(queries, item_id, text):
        hits = search_index(index, [t for _, t in block], k)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], "query int, item string")
        ranked = ranked.join(F.broadcast(names), "query")
        results.append(kept(ranked.select(F.col("item").cast(item).alias("item_id"), "rank", "doc_id", "score"), "search-results"))
    if not results:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", item), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", found), T.StructField("score", T.LongType())]))
    paths = [p for r in results for p in r.inputFiles()]
    return results[0] if len(results) == 1 else spark.read.schema(results[0].schema).parquet(*paths)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS a
  FROM documents),
q AS (
  SELECT item_id, t, count(*) AS r
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
  GROUP BY item_id, t),
tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(a) AS t FROM d) GROUP BY doc_id, t),
s AS (SELECT count(*) AS n, CAST(sum(len(a)) AS BIGINT) AS l FROM d WHERE len(a) > 0),
m AS (SELECT doc_id, 100 - 25 + (25 * len(a) * n) // l AS m FROM d, s WHERE len(a) > 0),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s),
score AS (
  SELECT item_id, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN w USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
WHERE rank <= 20
"""
