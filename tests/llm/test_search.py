"""Ranked search against brute force, and its bounds."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sensorlake.llm import search

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score), items in order."""
    counted = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in counted:
            m = 75 + 25 * c.total() * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                found.append((-s, d is None, d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs, items = [[tuple(r) for r in spark.read.parquet(f"{SF}/{n}.parquet").select(c, "text").collect()] for n, c in (("documents", "doc_id"), ("benchmark", "item_id"))]
    assert result(search.op13_search(spark, SF)) == brute(docs, items)


def made(seed=4, n=400):
    rng = random.Random(seed)
    pick = lambda k: " ".join(f"T{int(rng.paretovariate(0.7)) % 900}" for _ in range(k))
    docs = [(i, pick(rng.choice([1, 3, 20, 90, 300]))) for i in range(n)]
    docs += [(1000 + i, "Ä-ö T1 T1 t1") for i in range(40)] + [(2000, pick(30_000)), (2001, None), (2002, ""), (2003, "?! ."), (None, "T1 T7"), (None, "T1 T7")]
    docs += [(7, docs[7][1]), (7, docs[7][1])]
    items = [(i, pick(k)) for i, k in enumerate([1, 2, 5, 30, 200])] + [(3, "t1 T1 T1"), (None, "nowhere T7"), (9, None), (10, ""), (11, "unseen"), (12, "Ä")]
    return docs, items


def frames(spark, docs, items):
    left = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, terms string, rank int")
    right = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id bigint, text string, score int")
    return left.repartition(5), right


@pytest.mark.parametrize("small", [False, True])
def test_made_rows(spark, small, monkeypatch):
    if small:  # many blocks, many of queries too
        monkeypatch.setattr(search, "BLOCK_DOCS", 16)
        monkeypatch.setattr(search, "BUFFER_TERMS", 2000)
        monkeypatch.setattr(search, "QUERY_BLOCK_BYTES", 100)
    docs, items = made()
    assert result(search.ranked_search(*frames(spark, docs, items))) == brute(docs, items)


def test_text_ids_and_other_k(spark):
    docs, items = made(n=60)
    docs, items = [(str(d), t) for d, t in docs if d is not None], [(f"i{i}", t) for i, t in items]
    left = spark.createDataFrame(docs, "doc_id string, text string")
    got = search.ranked_search(left, spark.createDataFrame(items, "item_id string, text string"), k=3)
    assert result(got) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = frames(spark, *made(n=5))
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        assert result(search.ranked_search(a, b)) == []


def test_bounds_hold_and_exclude():
    rng = random.Random(8)
    words = [f"w{i}".encode() for i in range(500)]
    docs = []
    for d in range(200):
        c = Counter(int(rng.paretovariate(0.6)) % 500 for _ in range(rng.choice([5, 50, 400])))
        codes = np.array(sorted(c), np.int64)
        docs.append((d, codes, np.array([c[int(i)] for i in codes])))
    block = search.Block(search.make_block(docs, words))
    df = Counter(words[i] for _, c, _ in docs for i in c)
    total = int(sum(n.sum() for _, _, n in docs))
    texts = [b" ".join(rng.choice(words) for _ in range(12)) for _ in range(20)]
    queries = search.Queries(texts, dict(df), 200, total)
    m = 75 + 25 * block.lengths * 200 // total
    bounds = queries.bounds(block, m)
    lookup = np.array([queries.place.get(t, -1) for t in block.terms], np.int64)
    exact = np.zeros(bounds.shape)
    for q, d, s in queries.score(block, m, lookup, {d: list(range(20)) for d in range(200)}):
        exact[q, d] = s
    assert (bounds >= exact).all()
    best = np.sort(exact, axis=1)[:, -5:-4]
    assert (bounds < best).mean() > 0.5
