"""Substring dedup against brute force, on odd rows, and where the sketch is full."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sensorlake.llm import substrings

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """(doc_id, n_words, n_removed, kept text) per row."""
    owner, out = {}, []
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            if d is not None:
                owner[key] = min(owner.get(key, d), d)
    for d, w in split:
        gone = set()
        for i in range(len(w) - 49):
            if d is not None and owner[tuple(w[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        left = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), " ".join(left)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = sorted((d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in brute(rows))
    assert sorted(map(tuple, substrings.op12_substrings(spark, SF).collect())) == want
    assert any(g for _, _, g, _ in want)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def planted():
    rng = random.Random(3)
    passage, other = words(rng, 70), words(rng, 51)
    rows = [(i, " ".join(words(rng, 40) + passage + words(rng, 30))) for i in range(40)]
    rows += [(100 + i, "\t".join(words(rng, 5) + passage[i % 15 :])) for i in range(30)]
    rows += [(200, " ".join(other)), (201, " ".join(other)), (199, " ".join(other[:50])), (202, " ".join(other[:49]))]
    rows += [(300, "same " * 300), (301, "same " * 120), (302, "same " * 49), (303, "same " * 50 + " ".join(passage))]
    rows += [(400, None), (401, ""), (402, " \n\t"), (None, " ".join(passage)), (None, " ".join(passage)), (None, None)]
    rows += [(500, " ".join(passage[:60])), (500, " ".join(passage[:60])), (500, " ".join(other)), (-7, " ".join(passage[5:60]))]
    rows += [(600, " ".join(words(rng, 60_000, 5000))), (601, "é x y " * 30 + " ".join(other))]
    return rows


def frame(spark, rows):
    extra = [(d, t, 5, "keep", 7) for d, t in rows]
    return spark.createDataFrame(extra, "doc_id bigint, text string, n_words int, kept_text string, row int").repartition(6)


def test_planted_rows(spark):
    rows = planted()
    got = substrings.substring_dedup(frame(spark, rows))
    assert result(got) == brute(rows)
    first = got.first()["row"]
    assert (first["n_words"], first["kept_text"], first["row"]) == (5, "keep", 7)


@pytest.mark.parametrize("full", [0.5, 1.0])
def test_a_full_sketch_loses_nothing(spark, full, monkeypatch):
    rows = planted()
    df = frame(spark, rows)
    ones = zlib.compress(bytes([255]) * (substrings.BLOCK // 8))
    blocks = {(r, b): ones for b in range(int(full * (substrings.CELLS // substrings.BLOCK))) for r in range(substrings.ROWS)}
    share = [(*k, v) for k, v in ({(r, b): v for r, b, v in substrings.sketch_of(df)} | blocks).items()]
    monkeypatch.setattr(substrings, "sketch_of", lambda *_: share)
    assert result(substrings.substring_dedup(df)) == brute(rows)


def test_empty_table(spark):
    assert substrings.substring_dedup(frame(spark, [(1, None)]).limit(0)).collect() == []


def test_stretches_and_least():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 200).astype(np.uint64)
    short, whole = substrings.stretches(h, substrings.TURNS[0], (26, 50))
    assert (len(short), len(whole)) == (175, 151)
    again = substrings.stretches(np.concatenate([h[10:60], h[:5]]), substrings.TURNS[0], (26, 50))
    assert again[1][0] == whole[10] and again[0][0] == short[10]
    low = substrings.least(short, 25)
    assert low.tolist() == [short[i : i + 25].min() for i in range(151)]
    assert len(substrings.stretches(h[:49], substrings.TURNS[0], (50,))[0]) == 0


def test_the_sketch_never_underestimates(spark):
    rows = planted()
    sketch, known = substrings.Sketch(substrings.sketch_of(frame(spark, rows))), substrings.Bytes()
    holders = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i : i + 50]), set()).add(d)
    seen = 0
    for window, docs in holders.items():
        if len(docs) > 1:
            seen += 1
            assert len(substrings.suspects(b" ".join(window), known, sketch)[0]) == 1
    assert seen


def test_word_hashes():
    rng = random.Random(6)
    known = substrings.Bytes()
    text = "\x0b".join([" é ", "a\t\t" + "b" * 64, "c" * 65, "c" * 65, "d" * 300_000, *(rng.choice(["x", "yy", "zzz"]) for _ in range(200_000)), "a"]).encode()
    data, starts, ends = known.words(text)
    words = text.split()
    assert [text[s:e] for s, e in zip(starts.tolist(), ends.tolist())] == words
    for half in (0, 1):
        hashes = known.hashes(data, starts, ends, half)
        assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
        alone = known.words(b"zzz")
        assert known.hashes(*alone, half)[0] in hashes
