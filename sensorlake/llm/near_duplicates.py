"""Near-duplicate documents by min-max hashing, links confirmed on full shingle sets, and the classes they form.

Each permutation gives two values of a signature, its minimum and its maximum over the shingles, so ``VALUES`` values take half
as many hash evaluations. Documents with equal shingle sets form one node first, so copies never meet in a bucket. Inside a
bucket nodes are compared with a few centres, not with each other: with one, and where classes stay apart with four, so a node
proposes five pairs per band at most, however large its group. Nodes whose buckets are split even then go through an exact set-similarity join: shingles are put in an order, rare ones first, and two
nodes meet only at a shingle among the first of both, as many as their sizes and the similarity call for, if sizes and places
leave room for enough common ones, their classes differ, and the shingle before it is not common to both as well. So a link is lost only if no band proposes it (at similarity 0.8
about 3 in a million), and no bucket is ever paired with itself. The order comes from a sample; any order gives the same links.

Defined results: a text without words, or null, has an empty set and no links; fewer words than a shingle make one shingle;
a null id never takes part in a class and is its own component (null); rows that repeat an id are one document, with the union
of the links of its rows, and every row is returned. Ids are of any type that has an order. Texts are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.shared import Scratch, perhaps_among, table

BANDS = 24
ROWS = 4
VALUES = BANDS * ROWS
SEED = 20_240_607
CENTRES = (1, 4)  # more would propose more pairs than the exact join, and hardly any link
ORDER_SAMPLE = 2_000  # nodes whose shingles tell which are frequent
CHUNK = 8192
CACHE = 1 << 20

def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; every step can be undone, so different values stay different."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; a bounded cache."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text with A-Z lower-cased.

    On bytes, ``lower`` changes those letters only, and ``split`` cuts at the six white-space characters of the contract.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    n = min(width, len(codes))
    out = np.full(len(codes) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - n + 1 + k])
    return np.unique(out)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    half = VALUES // 2
    draw = lambda: rng.integers(0, 1 << 32, (half, 1), dtype=np.uint32)
    return draw() | np.uint32(1), draw()


def band_keys(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the shingles under each permutation, hashed by band."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(len(a), 0xFFFFFFFF, np.uint32), np.zeros(len(a), np.uint32)
    for at in range(0, len(x), CHUNK):
        values = x[None, at : at + CHUNK] * a + b
        low, high = np.minimum(low, values.min(axis=1)), np.maximum(high, values.max(axis=1))
    # Minima and maxima of one permutation never share a band: bands take one kind each.
    kinds = np.concatenate([low, high]).astype(np.uint64).reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + kinds[:, k])
    return keys.view(np.int64)


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """Per row its id, the size and digest of its set, and its band keys; the sets themselves are not kept."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("n_shingles bigint, set_id string, bands array<bigint>")])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a, b), hashes = _permutations(), WordHashes()
        for batch in batches:
            sizes, names, bands = [], [], []
            for t in batch.column("text"):
                s = shingle_set(t.as_py(), width, hashes)
                sizes.append(len(s))
                names.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                bands.append(band_keys(s, a, b) if len(s) else [])
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.string()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_id", "bands"])

    return rows.mapInArrow(sign, schema)


def full_sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """The sets of the documents that share a bucket, made again from their texts."""
    rows = docs.select(F.col(doc_id).alias("node"), F.col(text).cast("binary").alias("text"))
    rows = rows.filter(perhaps_among(nodes, "node")(F.col("node"))).join(nodes, "node", "left_semi")
    schema = T.StructType([rows.schema["node"], *T.StructType.fromDDL("n_shingles bigint, shingles array<bigint>")])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [shingle_set(t.as_py(), width, hashes).view(np.int64) for t in batch.column("text")]
            columns = [batch.column("node"), pa.array([len(s) for s in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "n_shingles", "shingles"])

    return rows.mapInArrow(sets, schema).dropDuplicates(["node", "n_shingles", "shingles"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose full sets are similar enough. Sizes are compared before sets are fetched."""
    sizes = sets.select("node", "n_shingles")
    near = (
        pairs.join(sizes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na")), "a")
        .join(sizes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb")), "b")
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    )
    side = lambda x: sets.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("shingles").alias(f"s{x}"))
    both = near.join(side("b"), ["b", "nb"]).join(side("a"), ["a", "na"])
    common = both.withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return common.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b").distinct()


def frequent_shingles(sets: DataFrame) -> dict[int, int]:
    """Shingles that several of these sets hold, with their numbers."""
    counts = sets.select(F.explode("shingles").alias("s")).groupBy("s").count().filter("count > 2")
    most = counts.orderBy(F.desc("count"), "s").limit(200_000)
    return {r["s"]: r["count"] for r in most.collect()}


def similar_nodes(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) among ``nodes`` (node, comp), of different classes, that may be similar enough: an exact join by prefixes."""
    held = sets.join(nodes, "node")
    # The sample is drawn among the names, so no other set is moved for it.
    sample = nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(ORDER_SAMPLE)
    often = held.sparkSession.sparkContext.broadcast(frequent_shingles(sets.join(F.broadcast(sample), "node", "left_semi")))
    schema = T.StructType([held.schema["node"], held.schema["comp"], *T.StructType.fromDDL("own bigint, shingle bigint, place bigint, n bigint")])

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array(sorted(often.value), np.int64)
        numbers = np.array([often.value[int(k)] for k in known], np.int64)
        for batch in batches:
            owns, tokens, places, sizes, counts = [], [], [], [], []
            for shingles in batch.column("shingles"):
                s = np.asarray(shingles.values, np.int64)
                rank = np.zeros(len(s), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, numbers[at], 0)
                # A set that shares percent of the union shares one of so many first elements in any order.
                first = len(s) - (percent * len(s) + 99) // 100 + 1
                chosen = s[np.lexsort((s, rank))[:first]]
                owns.append(np.full(len(chosen), xxhash.xxh3_64_intdigest(s.tobytes()), np.uint64).view(np.int64))
                tokens.append(chosen)
                places.append(np.arange(len(chosen)))
                sizes.append(np.full(len(chosen), len(s)))
                counts.append(len(chosen))
            if counts:
                rows = pa.array(np.repeat(np.arange(len(counts)), counts))
                columns = [batch.column(c).take(rows) for c in ("node", "comp")] + [pa.array(np.concatenate(x)) for x in (owns, tokens, places, sizes)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "comp", "own", "shingle", "place", "n"])

    index = held.select("node", "comp", "shingles").mapInArrow(prefixes, schema)
    # Only shingles of several classes bring pairs.
    several = index.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("shingle")
    index = index.join(several, "shingle")
    # Where two sets have the same shingle before this one too, they have met there already.
    index = index.withColumn("prior", F.lag("shingle").over(Window.partitionBy("node", "own").orderBy("place")))
    # Similar sets differ in size by a class of sizes at most, so a shingle of very many nodes is dealt out by size. The larger
    # set of a pair is on the right and goes to the class below its own, too.
    step = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent) + 1e-6)).cast("int")
    left = index.withColumn("size", step)
    right = index.withColumn("size", F.explode(F.array(step, step - 1)))
    renamed = right.select("shingle", "size", *[F.col(c).alias(f"{c}2") for c in ("node", "comp", "place", "n", "prior")])
    needed = percent * (F.col("n") + F.col("n2"))
    room = (100 + percent) * F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    smaller = (F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("node") < F.col("node2")))
    fits = smaller & (F.col("comp") != F.col("comp2")) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (room >= needed)
    fits = fits & (F.col("prior").isNull() | F.col("prior2").isNull() | (F.col("prior") != F.col("prior2")))
    pairs = left.join(renamed, (left["shingle"] == renamed["shingle"]) & (left["size"] == renamed["size"]) & fits)
    return pairs.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp): the smallest node reachable, by contracting every class to its smallest neighbour until no edge is left.

    Each round at least halves the classes that still have edges; labels and edges are written, so lineage stays short.
    """
    edges = scratch.keep(edges.select("a", "b").filter("a <> b").distinct(), "cc-edges")
    labels = scratch.keep(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node")), "cc-labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = scratch.keep(both.groupBy(F.col("a").alias("old")).agg(F.least(F.min("b"), F.first("a")).alias("new")), "cc-parent")
        while True:  # pointer jumping: every class points to its root
            parent = step.select("old", "new")
            up = parent.select(F.col("old").alias("new"), F.col("new").alias("top"))
            jumped = parent.join(up, "new").select("old", F.col("top").alias("new"), (F.col("top") != F.col("new")).alias("moved"))
            step = scratch.keep(jumped, "cc-jump", step)
            if step.filter("moved").isEmpty():
                break
        to = lambda c: step.select(F.col("old").alias(c), F.col("new").alias(f"{c}2"))
        labels = scratch.keep(labels.join(to("comp"), "comp", "left").select("node", F.coalesce("comp2", "comp").alias("comp")), "cc-labels", labels)
        left = edges.join(to("a"), "a").join(to("b"), "b").select(F.col("a2").alias("a"), F.col("b2").alias("b"))
        edges = scratch.keep(left.filter("a <> b").distinct(), "cc-edges", edges)
        scratch.drop(step)
    scratch.drop(edges)
    return labels


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node) of buckets with more than one row."""
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    # Rows are counted, so no names travel; a bucket that one node is in twice has no pairs later.
    shared = members.groupBy("bucket").count().filter("count > 1").select("bucket")
    return members.join(shared, "bucket").distinct()


def links(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Enough confirmed links between the nodes of shared buckets to give the classes of all confirmed links."""
    members = scratch.keep(members.withColumn("comp", F.col("node")), "buckets", members)
    found: list[DataFrame] = []
    for turn, centres in enumerate((*CENTRES, 0)):
        split = members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("bucket")
        open_ = scratch.keep(members.join(split, "bucket"), "open")
        if centres:
            # The first members in an order that changes from turn to turn, but is the same in most buckets of a group.
            order = F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node", "comp") if turn else F.struct("node", "comp")
            heads = open_.select("bucket", order.alias("head"))
            chosen = _first(heads, centres).select("bucket", F.col("head.node").alias("centre"), F.col("head.comp").alias("main"))
            pairs = open_.join(chosen, "bucket").filter("comp <> main").select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
        else:
            pairs = similar_nodes(open_.select("node", "comp").distinct(), sets, percent)
        pairs = scratch.keep(pairs, "pairs")
        new = scratch.keep(confirmed(pairs, sets, percent), "links", pairs, open_)
        found.append(new)
        if centres and not new.isEmpty():
            # Classes are joined by the new links between them.
            named = members.select("node", "comp").distinct()
            between = new.join(named.toDF("a", "ca"), "a").join(named.toDF("b", "cb"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
            labels = components(between, scratch)
            joined = members.join(labels.toDF("comp", "top"), "comp", "left").select("bucket", "node", F.coalesce("top", "comp").alias("comp"))
            members = scratch.keep(joined, "buckets", members, labels)
    scratch.drop(members)
    return reduce(DataFrame.unionByName, found)


def _first(heads: DataFrame, n: int) -> DataFrame:
    """The ``n`` least heads of each bucket; a bucket keeps ``n`` of them at a time, however many nodes it has."""
    if n == 1:
        return heads.groupBy("bucket").agg(F.min("head").alias("head"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("head"))
    return heads.withColumn("place", place).filter(F.col("place") <= n)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per row doc_id, n_shingles, component_id and kept (the smallest id of its class)."""
    scratch = Scratch(docs.sparkSession)
    signed = scratch.keep(signatures(docs, doc_id, text, width), "signatures")
    # One node per distinct set, named by its smallest id. Rows that repeat an id with other words share the node or are linked below.
    groups = signed.filter("set_id is not null and doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    groups = scratch.keep(groups, "nodes")
    # From here on the bands are not needed, which are most of what was written.
    sized = scratch.keep(signed.select("doc_id", "n_shingles", "set_id"), "sizes", signed)
    members = scratch.keep(shared_buckets(groups.select("node", "bands")), "buckets")
    names = scratch.keep(groups.select("set_id", "node"), "names", groups)
    sets = scratch.keep(full_sets(docs, members.select("node").distinct(), doc_id, text, width), "sets")
    found = links(members, sets, percent, scratch)
    member = sized.filter("doc_id is not null").join(names, "set_id").select("doc_id", "node")
    again = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b")
    same_id = member.join(again.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")).filter("a <> b")
    labels = components(found.unionByName(same_id), scratch)
    scratch.drop(sets)
    class_of = names.join(labels, "node", "left").select("set_id", F.coalesce("comp", "node").alias("component_id"))
    out = sized.join(class_of, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def row_name(columns: list[str]) -> Column:
    """128 bits of a row's values and of which of them are null."""
    cells = [F.col(f"`{c}`") for c in columns]
    half = lambda n: F.lpad(F.hex(F.xxhash64(F.lit(n), *cells, *[c.isNull() for c in cells])), 16, "0")
    return F.unhex(F.concat(half(1), half(2)))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class, that of the smallest id (null ids last), whatever ids repeat. Rows without words stay."""
    # Rows are named by all their columns, so equal rows share a name and one of them is kept at the end. The row is carried as one
    # struct, so no name can clash.
    rows = docs.select(row_name(docs.columns).alias("name"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = near_duplicates(rows.select("name", F.col("row.text").alias("text")), "name").filter("n_shingles > 0")
    classes = found.groupBy(F.col("doc_id").alias("name")).agg(F.first("component_id").alias("class"), F.count("*").alias("n"))
    named = classes.join(rows.select("name", F.col("row.doc_id").alias("id")).distinct(), "name")
    best = named.groupBy("class").agg(F.min_by("name", F.struct(F.col("id").isNull(), "id", "name")).alias("best"))
    judged = named.join(best, "class").select("name", (F.col("name") != F.col("best")).alias("gone"), "n")
    judged = Scratch(spark).keep(judged.filter("gone or n > 1").select("name", "gone").distinct(), "near-duplicates")
    # Most rows are of neither kind and stay where they are; the others are joined, in one shuffle.
    rows = rows.withColumn("perhaps", perhaps_among(judged, "name")(F.col("name")))
    joined = rows.filter("perhaps").select("name", "row").join(judged, "name", "left")
    alone = rows.filter("not perhaps").select("row").unionByName(joined.filter("gone is null").select("row"))
    again = joined.filter("not gone").groupBy("name").agg(F.first("row").alias("row")).select("row")
    return alone.unionByName(again).select("row.*")
