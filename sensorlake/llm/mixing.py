"""Mixing sources to target weights by Pfair scheduling of blocks.

With weight w, block j of a source (from 1) is released at floor((j - 1) / w) and due at ceil(j / w). Taking, slot after slot, the
released block with the earliest deadline keeps every source less than one block from its weight. Weights are exact fractions. Release
times and deadlines repeat with their common denominator, so one such period is scheduled on the driver, or the blocks that there are
if they are fewer, in parts of ``PART`` slots, and every row finds its slot by a join with it.

Defined results: no row is dropped; a null source is a source of its own; a source without a weight gets the share of its rows of what
is left (nothing given: all sources weigh alike); rows within a source are shuffled by a hash of the row, equal rows in any order; the
schedule holds until the first source runs out (``on_target``), later slots keep the order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm.shared import kept, table
from sensorlake.session import scratch_dir

BLOCK_ROWS = 16
PART = 100_000
BUCKET_ROWS = 100_000
MAX_SOURCES = 100_000
# The target weights of the given sources, a twentieth each.
WEIGHTS = {f"src{i}": Fraction(1, 20) for i in range(20)}


def exact(weight: float | Fraction) -> Fraction:
    """A weight as it is written: 0.1 is a tenth."""
    return Fraction(str(weight))


def shares(weights: dict[str, float | Fraction], period: int = 1) -> dict[str, int]:
    """Whole slots in the shortest period that gives every source exactly its weight and is a multiple of ``period``."""
    parts = {s: exact(w) for s, w in weights.items()}
    total = sum(parts.values())
    parts = {s: w / total for s, w in parts.items()}
    period = lcm(period, *(w.denominator for w in parts.values()))
    return {s: int(w * period) for s, w in parts.items()}


def deal(slots: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block from 0, release, deadline, slot) of the first ``blocks`` of every source by earliest deadline first; ties by source."""
    period = sum(slots.values())
    due = lambda s, j: -(-(j + 1) * period // slots[s])
    free = lambda s, j: j * period // slots[s]
    waiting = [(0, s, 0) for s in sorted(slots) if blocks[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due(s, j), s, j))
        deadline, s, j = heapq.heappop(ready)
        yield s, j, free(s, j), deadline, slot
        if j + 1 < blocks[s]:
            heapq.heappush(waiting, (free(s, j + 1), s, j + 1))
        slot += 1


def schedule(slots: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period of ``deal``."""
    return list(deal(slots, slots))


def _planned(spark: SparkSession, dealt: Iterator[tuple[str, int, int, int, int]], last: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """The dealt blocks as a table, and the slots of the blocks named in ``last``. Long plans are written in parts."""
    schema = "key string, j bigint, release0 bigint, deadline0 bigint, slot0 bigint"
    path, found = None, {}
    while True:
        part = list(islice(dealt, PART))
        found |= {p[0]: p[4] for p in part if last[p[0]] == p[1]}
        rows = spark.createDataFrame(part, schema)
        if path is None and len(part) < PART:
            return F.broadcast(rows), found
        path = path or scratch_dir(spark, "mix-plan")
        rows.write.mode("append").parquet(path)
        if len(part) < PART:
            return spark.read.schema(schema).parquet(path), found


def mix(docs: DataFrame, weights: dict[str, float | Fraction] | None = None, source: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows as they are, in ``row``, with mix_source, block, release, deadline, slot, place in the block and on_target."""
    spark = docs.sparkSession
    packed = docs.select(
        F.coalesce(F.concat(F.lit("s:"), F.col(f"`{source}`").cast("string")), F.lit("null")).alias("key"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    # Rows are numbered within buckets of a bounded size, so a source with a third of all rows is spread over many tasks.
    counts = {r["key"]: r["n"] for r in packed.groupBy("key").agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if not counts:
        schema = "mix_source string, block bigint, release bigint, deadline bigint, slot bigint, place int, on_target boolean"
        return packed.select("row").join(spark.createDataFrame([], schema))
    given = {("s:" + k if k is not None else "null"): exact(w) for k, w in (weights or {}).items()}
    known = {k: given[k] for k in counts if given.get(k, 0) > 0}
    others = {k: n for k, n in counts.items() if k not in known}
    left = max(1 - sum(known.values()), Fraction(1, 100))
    whole = sum(others.values())
    slots = shares(known | {k: (left * n / whole if known else Fraction(1)) for k, n in others.items()})
    period = sum(slots.values())
    blocks = {k: -(-n // block_rows) for k, n in counts.items()}
    repeats = period <= sum(blocks.values()) + len(blocks)
    if repeats:
        last = {k: blocks[k] % slots[k] for k in counts}
        plan, when = _planned(spark, deal(slots, slots), last)
        first_out = min(blocks[k] // slots[k] * period + when[k] for k in counts)
    else:
        # One block more than there is tells when a source runs out. It finds no rows.
        plan, when = _planned(spark, deal(slots, {k: n + 1 for k, n in blocks.items()}), blocks)
        first_out = min(when.values())
    turns = {k: slots[k] if repeats else blocks[k] + 1 for k in counts}
    sizes = spark.createDataFrame([(k, n, -(-n // BUCKET_ROWS), turns[k]) for k, n in counts.items()], "key string, n bigint, buckets bigint, share bigint")
    split = packed.join(F.broadcast(sizes), "key").withColumn("bucket", F.pmod(F.xxhash64("h"), F.col("buckets")))
    before = split.groupBy("key", "bucket").agg(F.count("*").alias("rows"))
    before = before.withColumn("before", F.sum("rows").over(Window.partitionBy("key").orderBy("bucket")) - F.col("rows")).drop("rows")
    rows = split.join(kept(before, "mix-buckets"), ["key", "bucket"])
    number = F.row_number().over(Window.partitionBy("key", "bucket").orderBy("h")) - 1 + F.col("before")
    rows = rows.withColumn("number", number).withColumn("block", F.floor(F.col("number") / block_rows))
    rows = rows.withColumn("j", F.pmod("block", "share")).withColumn("turn", F.floor(F.col("block") / F.col("share")) * (period if repeats else 0))
    out = rows.join(plan, ["key", "j"])
    return out.select(
        "row", F.when(F.col("key") != "null", F.substring("key", 3, 1 << 30)).alias("mix_source"), "block",
        (F.col("turn") + F.col("release0")).alias("release"), (F.col("turn") + F.col("deadline0")).alias("deadline"),
        (F.col("turn") + F.col("slot0")).alias("slot"), F.pmod("number", F.lit(block_rows)).cast("int").alias("place"),
        (F.col("turn") + F.col("slot0") < first_out).alias("on_target"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs, WEIGHTS).select("row.doc_id", "row.source", "block", "release", "deadline", "slot", "place", "on_target")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their slot and their place in it; order by both to read the mixture. Columns of the documents keep
    their names; where they have one of the stage's, its own gets an underscore more."""
    out = mix(docs, WEIGHTS)

    def added(source: str, name: str) -> Column:
        while name in docs.columns:
            name += "_"
        return F.col(source).alias(name)

    cols = [F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*cols, added("slot", "mix_slot"), added("place", "mix_place"), added("on_target", "mix_on_target"))
