"""Toxicity: a logistic model of words with a counterfactual penalty.

Identity terms in labelled sentences are swapped for other terms of their group; the fit punishes every change of the score that
the swap makes, so naming a group does not count as toxic by itself. The model is fitted on at most ``SAMPLE_ROWS`` labelled texts per
label (chosen by a hash of their ids, whole texts) and has ``DIMENSIONS`` weights. Every text is scored whole.

Defined results: a null or empty text gets the score of no evidence; labels repeated for a document count once (toxic wins), as
do rows with the same id (the least text is learnt from); without
labelled rows of both kinds every score is 0; repeated rows are scored one by one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorlake.llm.shared import fold, table

DIMENSIONS = 1 << 18
SAMPLE_ROWS = 10_000
EPOCHS = 8
BATCH = 128
RATE = 0.05
SPARSITY = 2e-4
PENALTY = 1.0
CHUNK = 1 << 20
WORDS = re.compile(r"[^\W\d_]+")

# Identity terms by group; a swap stays within the group.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["immigrants", "refugees", "locals"],
    ["old", "young"],
    ["deaf", "blind", "disabled"],
]
SWAPS = {w: [x for x in group if x != w] for group in IDENTITY_TERMS for w in group}


def slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & (DIMENSIONS - 1)


def distinct_words(text: str | None) -> set[str]:
    """Words of a whole text, looked for in pieces that end between words."""
    out: set[str] = set()
    text, at = text or "", 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and not text[end].isspace():
            end += 1
        out.update(WORDS.findall(text[at:end].lower()))
        at = end
    return out


def features(text: str | None) -> np.ndarray:
    return np.array(sorted({slot(w) for w in distinct_words(text)}), np.int32)


def swapped(text: str | None) -> np.ndarray:
    """Features of the text with every identity term swapped for another of its group; empty if it has none."""
    words = distinct_words(text)
    if not any(w in SWAPS for w in words):
        return np.empty(0, np.int32)
    other = {SWAPS[w][zlib.crc32(w.encode()) % len(SWAPS[w])] if w in SWAPS else w for w in words}
    return np.array(sorted({slot(w) for w in other}), np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[features(text)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def _sums(rows: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    return np.array([w[r].sum() for r in rows], np.float64)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Adam with a soft threshold: log loss, plus ``PENALTY`` times the squared difference of the scores before and after a swap."""
    # Words of one text only say nothing of other texts, so they stay without weight.
    df = np.bincount(np.concatenate([r[0] for r in rows]), minlength=DIMENSIONS)
    known = df >= 2
    rows = [(x[known[x]], c, y) for x, c, y in rows]
    # Identity terms stay in the model whether known or not: a swap may bring in a term that no label has seen.
    w, m, v = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    share = min(max(np.mean([r[2] for r in rows]), 1e-3), 1 - 1e-3)
    bias, rng, step = float(np.log(share / (1 - share))), np.random.default_rng(7), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for lo in range(0, len(rows), BATCH):
            part = [rows[i] for i in order[lo : lo + BATCH]]
            step += 1
            x = [r[0] for r in part]
            z = bias + _sums(x, w)
            err = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - np.array([r[2] for r in part])
            g = np.bincount(np.concatenate(x), np.repeat(err, [len(r) for r in x]), DIMENSIONS) / len(part)
            for i, (a, b, _y) in enumerate(part):
                if len(b):
                    gap = 2 * PENALTY * (w[a].sum() - w[b].sum()) / len(part)
                    g[a] += gap
                    g[b] -= gap
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            scale = RATE / (np.sqrt(v / (1 - 0.999**step)) + 1e-4)
            w -= scale * m / (1 - 0.9**step)
            w = np.sign(w) * np.maximum(np.abs(w) - SPARSITY * scale, 0)
            bias -= RATE * float(err.mean())
    return Model(w.astype(np.float32), bias)


def chosen(marks: DataFrame) -> DataFrame:
    """At most ``SAMPLE_ROWS`` (doc_id, toxic) of each label, the same ones on every run: those with the least hashes of their ids.

    A bound on the hash, from the number of labels, leaves a few more than that; only those are ranked.
    """
    share = {r["toxic"]: min(1.0, 1.2 * SAMPLE_ROWS / r["count"]) for r in marks.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    bound = F.lit(0)
    for label, part in share.items():
        bound = F.when(F.col("toxic") == label, F.lit(int(part * (1 << 30)))).otherwise(bound)
    near = marks.where(place < bound).withColumn("place", place)
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy("place", "doc_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_ROWS).select("doc_id", "toxic")


def fit(docs: DataFrame, marks: DataFrame) -> Model | None:
    """From texts of ``docs`` and ``marks`` (doc_id and toxic, 0 or 1). Features of the sample are computed in tasks and fitted on the driver."""
    ids = chosen(marks).withColumnRenamed("doc_id", "chosen_id")
    # At most 2 * SAMPLE_ROWS ids go to where the texts are.
    sample = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("chosen_id")).groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(features(t), swapped(t), int(y)) for t, y in zip(batch["text"], batch["toxic"])]
            yield pd.DataFrame(out, columns=["x", "c", "y"])

    got = sample.mapInPandas(featurise, "x array<int>, c array<int>, y int").toLocalIterator()
    rows = [(np.array(r["x"], np.int32), np.array(r["c"], np.int32), r["y"]) for r in got]
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes()))
    return train(rows) if {r[2] for r in rows} == {0, 1} else None


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """doc_id and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            values = [0.0 if m is None else m.score(t if isinstance(t, str) else None) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": values})

    return docs.select("doc_id", F.col(text).alias("text")).mapInPandas(apply, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = table(spark, sf_dir, "labels").filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = fit(docs, marks.filter(fold(F.col("doc_id"), 5) != 0))
    out = score(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
