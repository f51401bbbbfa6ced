"""Language identification: normalised TF-IDF vectors of letter n-grams against several centroids per language, by cosine.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS`` per language, chosen by hash, whole texts); weights and
centroids are computed in Spark tasks, a task per language, and have ``languages * CENTROIDS * DIMENSIONS`` numbers. Every text is
scored whole.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties go to the first language in order; with no
labelled row all texts are ``und``; repeated rows are scored one by one. ``identify`` also rejects: a text farther from every centroid
than nearly all sample texts of the winning language gets ``und`` in ``lang_accepted``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm.shared import bounded_sample, fold, kept, table

DIMENSIONS = 1 << 14
CENTROIDS = 3
SAMPLE_ROWS = 400
REJECT_QUANTILE = 0.001
MAX_LANGUAGES = 1000
CHUNK = 1 << 20
WORDS = re.compile(r"[^\W\d_]+")


def counts_of(text: str | None) -> np.ndarray:
    """Hashed counts of 1- to 3-grams of the letters of a text, words set off by spaces; all of the text, in chunks."""
    out = np.zeros(DIMENSIONS, np.float32)
    if not text:
        return out
    for at in range(0, len(text), CHUNK):
        letters = " " + " ".join(WORDS.findall(text[at : at + CHUNK].lower())) + " "
        c = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(c) < 3:
            continue
        one = c * np.uint32(0x9E3779B1)
        two = one[:-1] ^ (c[1:] * np.uint32(0x85EBCA6B) + np.uint32(2))
        three = two[:-1] * np.uint32(0xC2B2AE35) ^ (c[2:] * np.uint32(0x27D4EB2F) + np.uint32(3))
        for h in (one, two, three):
            out += np.bincount((h ^ (h >> np.uint32(15))) & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
    return out


def vector(text: str | None, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts_of(text)) * idf
    size = np.sqrt(float(v @ v))
    return v / size if size else v


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from rows far from each other, so it is the same on every run."""
    mean = x.mean(axis=0)
    chosen = [x[int(np.argmax(x @ mean))]]
    while len(chosen) < min(k, len(x)):
        nearest = np.max(x @ np.array(chosen).T, axis=1)
        chosen.append(x[int(np.argmin(nearest))])
    c = np.array(chosen)
    for _ in range(10):
        owner = np.argmax(x @ c.T, axis=1)
        c = np.array([x[owner == i].mean(axis=0) if (owner == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


class Model:
    def __init__(self, idf: np.ndarray, langs: list[str], centres: np.ndarray, floors: np.ndarray) -> None:
        self.idf, self.langs, self.centres, self.floors = idf, langs, centres, floors

    def predict(self, text: str | None) -> tuple[str, float, str]:
        """Language, cosine to its nearest centroid, and the language again or und if that is too far."""
        cos = self.centres @ vector(text, self.idf)
        i = int(np.argmax(cos))
        score = float(min(max(cos[i], 0.0), 1.0))
        return self.langs[i], score, self.langs[i] if score >= self.floors[i] else "und"


def fit(labelled: DataFrame) -> Model | None:
    """``labelled``: text and lang, any number of rows; a bounded sample of them is used."""
    rows = labelled.filter("lang is not null and text rlike '\\\\p{L}'").select("text", "lang")
    sample = kept(bounded_sample(rows, "lang", SAMPLE_ROWS, ["text"]), "language-sample")

    def document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for t in batch["text"]:
                seen += counts_of(t) > 0
                n += 1
        yield pd.DataFrame([(n, seen)], columns=["n", "seen"])

    # One row per task of a bounded sample, each of DIMENSIONS numbers, summed by dimension.
    parts = sample.mapInPandas(document_counts, "n bigint, seen array<bigint>")
    summed = parts.select("n", F.posexplode("seen").alias("dim", "seen")).groupBy("dim").agg(F.sum("seen").alias("seen"), F.sum("n").alias("n")).collect()
    if not summed or not summed[0]["n"]:
        return None
    seen = np.zeros(DIMENSIONS)
    for r in summed:
        seen[r["dim"]] = r["seen"]
    idf = (np.log((1 + summed[0]["n"]) / (1 + seen)) + 1).astype(np.float32)

    def centres(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array([vector(t, idf) for t in sorted(pdf["text"])], np.float32)
        c = _centres(x, CENTROIDS)
        floor = float(np.quantile(np.max(x @ c.T, axis=1), REJECT_QUANTILE))
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]] * len(c), "centre": list(c), "floor": [floor] * len(c)})

    got = sample.groupBy("lang").applyInPandas(centres, "lang string, centre array<float>, floor double").limit(MAX_LANGUAGES * CENTROIDS + 1).collect()
    if len(got) > MAX_LANGUAGES * CENTROIDS:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    got.sort(key=lambda r: r["lang"])
    return Model(idf, [r["lang"] for r in got], np.array([r["centre"] for r in got], np.float32), np.array([r["floor"] for r in got]))


def identify(docs: DataFrame, model: Model | None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns with lang_pred, score and lang_accepted."""
    carry = carry if carry is not None else ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    rows = docs.select(*carry, F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("_text"))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            out = [("und", 0.0, "und") if m is None or not isinstance(t, str) else m.predict(t) for t in batch["_text"]]
            yield pd.concat([batch[carry].reset_index(drop=True), pd.DataFrame(out, columns=["lang_pred", "score", "lang_accepted"])], axis=1)

    return rows.mapInPandas(predict, f"{fields}, lang_pred string, score double, lang_accepted string")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(fold(F.col("doc_id"), 3) != 1).select("text", "lang"))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "lang_accepted")
