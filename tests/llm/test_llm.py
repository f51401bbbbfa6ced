"""The operators for training text against brute force, and on odd input."""

from __future__ import annotations

import base64
import hashlib
import os
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorlake.llm import decontamination, language, licenses, mixing, near_duplicates, personal, quality, queries, toxicity, urls, warc

SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i} of the long text number {i % 97}" for i in range(4000))
COPY = " ".join(f"copy{i}" for i in range(60))
ODD = [
    (1, None, None, None, 0, 7), (2, "", "en", "a", 0, 7), (3, " \t\n ", "en", "a", 3, 7), (4, LONG, "en", "a", len(LONG), 7),
    (5, COPY, "en", "b", 9, 7), (6, COPY, "en", "b", 9, 7), (7, COPY + " more", "en", None, 9, 7), (7, COPY + " more", "en", None, 9, 7),
    (8, "a b c", "fr", "b", 5, 7), (9, "A B C", "fr", "b", 5, 7), (10, "x" * 20000, "de", "b", 5, 7), (11, "7" * 20000, "de", "b", 5, 7),
    (12, "Écrire à jean@exemple.fr, carte 4111 1111 1111 1111, tel +1 (377) 555-0271 ip 10.0.0.255 or 1.2.3.999", "fr", "c", 5, 7),
    (None, "no id here", "en", "c", 5, 7),
]


@pytest.fixture(scope="module")
def odd(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint"
    return spark.createDataFrame(ODD, schema)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd_dir(spark, odd, tmp_path_factory):
    """The odd rows as a data set, with empty tables beside them."""
    folder = str(tmp_path_factory.mktemp("odd"))
    odd.drop("n_words").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, "a b c")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    pages = [(1, None, None), (2, "http://X.org/a", "<p>"), (3, "no scheme", "<p>"), (3, "http://x.com/de/1", ""), (None, "http://casino.x.net", "é")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")
    vectors = [(1, [0.5, 1.0], 0), (2, None, 0), (3, [None, 1.0], 0), (4, [0.5, 1.0], None), (5, [2.0, -1.0], 0), (None, [1.0], 0)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="module")
def empty_dir(spark, odd_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", [*queries.QUERIES, "pipeline"])
def test_odd_and_empty_tables(spark, odd_dir, empty_dir, name):
    run = queries.QUERIES.get(name, corpus_pipeline.run)
    assert run(spark, empty_dir).collect() == []
    rows = run(spark, odd_dir).collect()
    if name == "pipeline":
        # Short and repetitive texts fail the base rule; of the copies the first stays, and a repeated id goes with its class.
        good = [i for i, t, *_ in ODD if (n := quality_counts(t))[0] >= 50 and 100 * n[4] <= 50 * n[0]]
        assert good == [5, 6, 7, 7] and [r["doc_id"] for r in rows] == [5]
    else:
        # Three vectors of one rank; one item with terms, and two documents that hold them.
        counts = {"op2_url_filter": 5, "op10_warc": 5, "op11_whitening": 3, "op13_search": 2}
        assert len(rows) == counts.get(name, len(ODD))


# Quality rules


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(triples)
    covered = {i + k for i, t in enumerate(triples) if often[t] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(spark, documents, odd):
    rows = documents + [(i, t) for i, t, *_ in ODD] + [(100, "a b c a b c a b\nx\ny\nx\n \n"), (101, "a a a a")]
    got = quality.statistics(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == quality_counts(r["text"])


def test_decision_list_finds_planted_rule(spark):
    rows = [(i, float(i % 10), float(i % 7), int(i % 10 > 6 and i % 7 < 3)) for i in range(3000)]
    found = quality.learn(spark.createDataFrame(rows, "doc_id bigint, x double, y double, bad int"), ["x", "y"])
    assert found.rules
    df = spark.createDataFrame(rows, "doc_id bigint, x double, y double, bad int").withColumn("hit", found.first_match().isNotNull())
    assert df.filter(F.col("hit") != (F.col("bad") == 1)).count() == 0


def test_quality_keeps_clean_and_drops_junk(spark):
    out = quality.op3_quality_rules(spark, "/root/testdata/sf0.01").filter("not base_failed")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    n = {(r["quality"], r["kept"]): r["count"] for r in out.join(marks, "doc_id").groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.02 * n[(1, True)]
    assert n.get((0, True), 0) <= 0.2 * n[(0, False)]


# Decontamination


def contamination(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        q = words(t)
        n = min(10, len(q))
        for win in {tuple(q[i : i + n]) for i in range(len(q) - n + 1)} if q else ():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) == win:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("block", [decontamination.QUERY_BLOCK_BYTES, 40])
def test_decontamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "QUERY_BLOCK_BYTES", block)
    items = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "b a"), (10, "B a"), (3, None), (4, "..."), (5, "é one two")]
    rows = [
        (1, "ZERO one two three four five six seven eight nine ten eleven twelve thirteen"), (2, "a b a b a"), (3, None), (4, ""),
        (5, "one two three four five six seven eight nine x ten"), (5, "É é one, two! é"), (6, "b"), (7, "a"), (8, LONG + " b a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = decontamination.contamination(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = sorted((i, *contamination(t, items)) for i, t in rows)
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in got) == want


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x blue"), (2, "red x x x x x blue"), (3, "red"), (4, "blue")], "doc_id bigint, text string")
    got = decontamination.proximity_matches(decontamination.build_index(docs), [("q", "blue red")], slop=4).collect()
    assert {r["doc_id"] for r in got} == {1}


# Personal data


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


SPANS = [
    "a@b.c%x@y.z", "a@b.c_x@y.z", "@@a@b..c a@b.c.", "1.2.3.4.5.6.7.8 1.2.3.256 001.2.3.0000255 1..2.3.4", "4111111111111111 4111-1111-1111-1111-2",
    "12 4111 1111 1111 1111", "4111  1111 1111 1111 11 4111111111111111", "+1 (377) 555-0271.. +12 +1.......9999999999 ++1234567890", "😀 é a@b.cc 😀 1.2.3.4",
    "4111 1111 1111 1111@x.y +4111 1111 1111 1111", "%a.b@c@d.e@f.g",
]


def test_personal_spans(spark, documents):
    big = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts = SPANS + [t for _, t, *_ in ODD] + big
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in personal.add_spans(df).collect():
        got = [(s["start"], s["rank"], s["kind"], s["end"]) for s in r["spans"] if s["rank"] < 4]
        assert got == base_spans(r["text"]), r["text"][:200]


def test_added_kinds_and_redaction(spark):
    text = "bank account GB82WEST12345698765432 not GB82WEST12345698765433; ssn 123-45-6789, part 123-45-6789 end; mail a@b.cc"
    got = personal.redacted(spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string")).collect()
    assert got[1]["text"] is None
    assert "GB82WEST12345698765432" not in got[0]["text"] and "GB82WEST12345698765433" in got[0]["text"]
    assert got[0]["text"].endswith("mail [email]") and "[ssn]" in got[0]["text"]


def test_redaction_of_overlapping_spans(spark):
    texts = {
        "tel +33.1.42.68.53.00 now": "tel [phone] now", "é +33.1.42.68.53.00 and 10.0.0.1, a@b.cc😀": "é [phone] and [ip], [email]😀",
        "4111 1111 1111 1111@x.y": "[card]", "x 1.2.3.4.5.6.7.8": "x [ip].[ip]", "": "", "no data": "no data",
    }
    rows = [(t, t, 1) for t in texts] + [(t, t, 2) for t in SPANS]
    for r in personal.redacted(spark.createDataFrame(rows, "original string, text string, n int")).collect():
        if r["n"] == 1:
            assert r["text"] == texts[r["original"]]
        held = {i for start, _, _, end in base_spans(r["original"]) for i in range(start, end)}
        assert "".join(c for i, c in enumerate(r["original"]) if i not in held) == re.sub(r"\[(email|ip|card|phone)\]", "", r["text"])


# Near duplicates


def classes(rows, width, percent):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + width]) for i in range(max(len(w) - width, 0) + 1)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def test_near_duplicates_against_all_pairs(spark, documents):
    # A chain of near copies, each similar to the next and not to the last, and a group of copies around one text.
    chain = [(10_000 + i, " ".join(f"c{k}" for k in range(4 * i, 4 * i + 60))) for i in range(12)]
    star = [(11_000 + i, " ".join(f"s{i}" if k in (i % 60, (7 * i) % 60) else f"t{k}" for k in range(60))) for i in range(80)]
    rows = documents + chain + star + [(12_000, None), (12_001, ""), (12_002, "A b"), (12_003, "a B")]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=4)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == classes(rows, 4, 80)


def test_prefix_join_loses_no_link(spark, monkeypatch):
    # No centre rounds: everything comes from the join; then a bucket of many classes and one of no links.
    rng = random.Random(6)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for i in range(150):
        words = list(base[: rng.choice([60, 80, 100])])
        for k in rng.sample(range(len(words)), rng.choice([0, 1, 2, 5])):
            words[k] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for centres in ((), (1,), near_duplicates.CENTRES):
        monkeypatch.setattr(near_duplicates, "CENTRES", centres)
        got = near_duplicates.near_duplicates(df, width=2)
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == classes(rows, 2, 80)
    sets = [(i, near_duplicates.shingle_set(t.encode(), 2, near_duplicates.WordHashes()).view("int64").tolist()) for i, t in rows]
    held = spark.createDataFrame([(i, len(s), s) for i, s in sets], "node bigint, n_shingles bigint, shingles array<bigint>")
    own = spark.createDataFrame([(i, i) for i, _ in sets], "node bigint, comp bigint")
    for percent in (50, 80, 95):
        pairs = near_duplicates.similar_nodes(own, held, percent)
        found = {(r["a"], r["b"]) for r in near_duplicates.confirmed(pairs, held, percent).collect()}
        want = {(i, j) for i, a in sets for j, b in sets if i < j and 100 * len(set(a) & set(b)) >= percent * len(set(a) | set(b))}
        # Equal sets are one node before the join is made.
        assert found == want


def test_centre_rounds_propose_few_pairs(spark, monkeypatch):
    # Nodes of three buckets that have no link: rounds of centres must not propose more pairs than a few per node.
    n, proposed = 120, []
    rows = [(i, b) for i in range(n) for b in range(3)]
    sets = spark.createDataFrame([(i, 20, list(range(100 * i, 100 * i + 20))) for i in range(n)], "node bigint, n_shingles bigint, shingles array<bigint>")
    confirm = near_duplicates.confirmed

    def counted(pairs, sets, percent):
        proposed.append(pairs.count())
        return confirm(pairs, sets, percent)

    monkeypatch.setattr(near_duplicates, "confirmed", counted)
    found = near_duplicates.links(spark.createDataFrame(rows, "node bigint, bucket bigint"), sets, 80, near_duplicates.Scratch(spark))
    assert found.count() == 0 and sum(proposed) <= 6 * n


def test_steps_are_removed(spark, tmp_path):
    from sensorlake.llm.shared import Scratch

    scratch = Scratch(spark)
    first = scratch.keep(spark.range(5), "first")
    second = scratch.keep(first.withColumn("x", F.col("id") + 1), "second", first)
    assert second.count() == 5 and first.inputFiles() and len(scratch.paths) == 1
    with pytest.raises(Exception):
        spark.read.parquet(*[f.rsplit("/", 1)[0] for f in first.inputFiles()]).count()


def test_rows_with_nulls_in_other_places_are_two(spark, tmp_path):
    rows = [(1, None, COPY), (1, COPY, None), (2, None, COPY), (3, "a", COPY + " end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").withColumns({"name": F.lit("n"), "row": F.lit("r"), "__key": F.lit("k")})
    got = near_duplicates.stage_near_duplicates(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(map(str, [tuple(r)[:3] for r in got.collect()])) == sorted(map(str, rows[:2]))
    assert {tuple(r)[3:] for r in got.collect()} == {("n", "r", "k")}


def test_clashing_names_keep_their_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["name", "row", "__key", "__text", "__original", "__spans", "mix_slot", "mix_place", "key"]
    docs = spark.createDataFrame([(1, "write to a.b@example.org now", "en", "s")], "doc_id bigint, text string, lang string, source string")
    docs = docs.withColumns({n: F.lit(f"own {n}") for n in names})
    for stage in (decontamination.stage_decontaminate, personal.stage_personal, mixing.stage_mix, near_duplicates.stage_near_duplicates):
        out = stage(spark, docs, str(tmp_path))
        got = out.first()
        assert out.columns[: len(docs.columns)] == docs.columns
        assert [got[n] for n in names] == [f"own {n}" for n in names]
        assert ("example.org" in got["text"]) == (stage is not personal.stage_personal)
    assert mixing.stage_mix(spark, docs, str(tmp_path)).columns[-3:] == ["mix_slot_", "mix_place_", "mix_on_target"]


def test_ids_of_text(spark):
    rows = [("b", COPY), ("a", COPY), ("c", COPY + " more"), (None, COPY), ("d", None)]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string"))
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect() if r["doc_id"]) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d")]


def test_stages_decide_by_row(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string"
    passage = "one two three four five six seven eight nine ten eleven twelve"
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "ZERO " + passage, "a"), (None, "clean without an id", "a"), (1, passage, "a"), (1, "clean with the id", "a"), (2, None, "b")]
    got = decontamination.stage_decontaminate(spark, spark.createDataFrame(rows, schema), str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, (rows[1], rows[3], rows[4])))

    near = COPY + " more"
    other = " ".join(f"other{i}" for i in range(60))
    third = " ".join(f"third{i}" for i in range(60))
    rows = [(None, COPY, "a"), (None, COPY, "b"), (9, near, "a"), (5, COPY, "a"), (5, COPY, "a"), (5, other, "a"), (None, third, "a"), (None, third, "a")]
    rows += [(None, None, "a"), (None, None, "a"), (7, "", "a"), (8, " ", "a")]
    out = near_duplicates.stage_near_duplicates(spark, spark.createDataFrame(rows, schema), str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [rows[4], rows[5], rows[7], *rows[8:]]))


# Mixing


def test_schedule_stays_within_one_block():
    slots = mixing.shares({"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}, 40)
    plan, taken, n = mixing.schedule(slots), Counter(), sum(slots.values())
    assert sorted(p[4] for p in plan) == list(range(n))
    for source, _, release, deadline, slot in plan:
        assert release <= slot < deadline
        taken[source] += 1
        assert all(abs(taken[s] - (slot + 1) * slots[s] / n) < 1 for s in slots)


def test_mixing_keeps_all_rows(spark, odd):
    out = mixing.mix(odd, {"a": 0.7, "b": 0.2}, block_rows=1).collect()
    assert sorted(str(tuple(r["row"])) for r in out) == sorted(str(r) for r in ODD)
    assert len({(r["slot"], r["place"]) for r in out}) == len(ODD)


def test_schedule_holds_given_weights_over_periods(spark):
    from fractions import Fraction

    assert mixing.shares({"a": 0.9, "b": 0.1}) == {"a": 9, "b": 1}
    assert mixing.shares({"a": 0.9999, "b": 0.0001}) == {"a": 9999, "b": 1}
    assert set(mixing.shares({str(i): 1.0 for i in range(21)}).values()) == {1}
    for weights, n in (({"a": 0.9, "b": 0.1}, 3000), ({"a": 2 / 3, "b": 1 / 3}, 3000), ({"a": 0.9997, "b": 0.0003}, 30_000)):
        rows = [(s, i) for s, w in weights.items() for i in range(int(w * n))]
        got = mixing.mix(spark.createDataFrame(rows, "source string, i int"), weights, block_rows=1).filter("on_target").collect()
        total, taken = sum(Fraction(str(w)) for w in weights.values()), Counter()
        assert len(got) >= 0.99 * n - 1
        for at, r in enumerate(sorted(got, key=lambda r: r["slot"])):
            taken[r["mix_source"]] += 1
            assert r["slot"] == at and r["release"] <= at < r["deadline"]
            assert all(abs(taken[s] - (at + 1) * Fraction(str(w)) / total) < 1 for s, w in weights.items())


def test_mixing_long_plans_are_written_in_parts(spark, monkeypatch):
    rows = spark.createDataFrame([(f"src{i % 20}" if i % 7 else None, i) for i in range(2000)], "source string, i int")
    want = sorted(map(str, mixing.mix(rows, mixing.WEIGHTS, block_rows=3).collect()))
    monkeypatch.setattr(mixing, "PART", 50)
    assert sorted(map(str, mixing.mix(rows, mixing.WEIGHTS, block_rows=3).collect())) == want and len(want) == 2000


# Models


def held_out(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_language_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "n_chars")
    rows = language.op9_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect()
    assert all(r["held_out"] == (held_out(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in rows)
    test = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.97 * len(test)


def test_toxicity_sample_is_bounded_and_the_same(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 200)
    marks = spark.range(9000).select(F.col("id").alias("doc_id"), (F.col("id") % 9 == 0).cast("int").alias("toxic"))
    first = toxicity.chosen(marks).collect()
    assert Counter(r["toxic"] for r in first) == {0: 200, 1: 200}
    assert {r["doc_id"] for r in first} == {r["doc_id"] for r in toxicity.chosen(marks.repartition(7)).collect()}
    few = toxicity.chosen(marks.where("doc_id < 100")).collect()
    assert len(few) == 100
    # The rows behind one id are learnt from once.
    docs = spark.createDataFrame([(0, "bad words here")] * 50 + [(i, f"good words {i % 3}") for i in range(1, 9)], "doc_id long, text string")
    assert toxicity.fit(docs, marks.where("doc_id < 9")) is not None


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 10)
    assert toxicity.distinct_words("abc defghijklmnop qrs\ttuv  wxyz") == {"abc", "defghijklmnop", "qrs", "tuv", "wxyz"}


def test_toxicity_on_held_out(spark):
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op1_toxicity(spark, "/root/testdata/sf0.1").join(marks, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert all(held_out(r["doc_id"], 5) == 0 for r in rows)
    assert right >= 0.95 * len(rows)
    assert sum(r["predicted"] for r in rows if r["toxic"]) >= 0.7 * sum(r["toxic"] for r in rows)


def test_counterfactual_penalty():
    """A term that only comes in toxic texts must not make a neutral text toxic."""
    texts = [("you are an idiot muslim", 1)] * 30 + [("a good day for all", 0)] * 30 + [("an idiot said so", 1)] * 30 + [("christian good day", 0)] * 30
    model = toxicity.train([(toxicity.features(t), toxicity.swapped(t), y) for t, y in texts])
    neutral = [model.score(f"{w} good day") for w in ("muslim", "christian", "jewish")]
    assert max(neutral) < 0.5 and max(neutral) - min(neutral) < 0.2 and model.score("idiot") > 0.5


# Licences


def test_licenses(spark):
    rows = [
        (1, "Text before. Licensed under the Apache License, Version 2.0. And after."), (2, "nothing of the kind here at all"), (3, None),
        (4, licenses.TEMPLATES["MIT"].upper() + " " + LONG), (5, "licensed under the apache"),
    ]
    got = {r["doc_id"]: [h["name"] for h in r["licenses"]] for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: ["Apache-2.0"], 2: [], 3: [], 4: ["MIT"], 5: []}


def test_short_license_notices(spark):
    lines = {
        "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0-short": "This text is licensed under CC BY-NC 4.0!",
        "MIT-released": "It was released under the MIT license (see above).", "Apache-2.0": "The code is Licensed under the Apache License, Version 2.0.",
        "GPL-2.0-short": "You find it licensed under the GNU General Public License version 2 only", "CC-BY-SA-4.0-short": "(licensed under: cc-by-sa 4.0)",
        "MIT-short": "All files are licensed under the MIT License", "LGPL-3.0-short": "a library licensed under the GNU Lesser General Public License (version 3)",
    }
    rows = [(name, f"{before} {line} {LONG}") for name, line in lines.items() for before in ("", "some words before it.")]
    rows += [("", "The licence is given under the terms of the university, and the public library released 3 books under 4.0 of them")]
    out = licenses.scan(spark.createDataFrame(rows, "name string, text string")).collect()
    assert [max([(h["score"], h["name"]) for h in r["licenses"]], default=(0, ""))[1] for r in out] == [r["name"] for r in out]


def test_license_windows_start_anywhere(spark):
    import random

    def best(words, grams, length):
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        cuts = [pairs[i : i + length] for i in range(max(len(pairs) - length, 0) + 1)] + [pairs]
        return max(2 * len(set(c) & grams) / (len(set(c)) + len(grams)) for c in cuts)

    rng, rows, want = random.Random(5), [], []
    for name in ("GPL-3.0-or-later", "MIT", "BSD-3-Clause", "MIT-short"):
        words = licenses.template_words(licenses.TEMPLATES[name])
        for k in range(120):
            lost = rng.sample(range(len(words)), k % 5)
            changed = [f"x{i}" if i in lost else w for i, w in enumerate(words)]
            text = [f"a{i}" for i in range(rng.randrange(40))] + changed + [f"b{i}" for i in range(rng.randrange(60))]
            rows.append((len(rows), name, " ".join(text)))
            score = best(text, set(licenses.template_bigrams(licenses.TEMPLATES[name])), len(words) - 1)
            want.append(round(score, 6) if score >= licenses.THRESHOLD else None)
    out = licenses.scan(spark.createDataFrame(rows, "id int, name string, text string")).collect()
    got = {r["id"]: next((h["score"] for h in r["licenses"] if h["name"] == r["name"]), None) for r in out}
    assert [got[i] for i in range(len(rows))] == want and any(want) and None in want


# URLs


def test_url_rules(spark):
    rows = [
        (1, "https://A.Example.org/es/x?y", "a.example.org", "/es/x", "example.org/es/", "block"), (2, "http://x.org/en/1", "x.org", "/en/1", "org/", "allow"),
        (3, "http://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"), (4, "ftp://b.com/fr/", "b.com", "/fr/", "com/fr/", "allow"),
        (5, "http://b.com/de/?q=://z", "b.com", "/de/", "com/de/", "block"), (6, "http://xcom/de/", "xcom", "/de/", None, "allow"), (7, None, "", "", None, "allow"),
        (8, "b.com/de/", "", "", None, "allow"), (9, "http://b.org", "b.org", "", None, "allow"), (10, "http://big-casino.net/a", "big-casino.net", "/a", None, "block"),
    ]
    got = urls.judge(spark.createDataFrame([r[:2] for r in rows], "page_id bigint, url string")).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == sorted((r[0], *r[2:]) for r in rows)


def test_url_families_of_a_few_pages(spark):
    bad = ["ads-track.net", "spam-farm.biz", "adult-x.info", "cheap-pills.net"]
    rows = [(f"http://{h}/a{i}/b", True) for h in bad for i in range(6)] + [("http://one.casino.net/z", True)]
    # Pages without a seed word in the host are blocked by what a few bad ones share, among very many others.
    rows += [(f"http://w{i}.net/buy-now/x{i}", True) for i in range(3)] + [(f"http://poker.w{i}.net/buy-now/", True) for i in range(30)]
    rows += [(f"http://site{i % 50}.net/page/{i}", False) for i in range(20_000)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id bigint, url string")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    assert [got[i]["verdict"] == "block" for i in range(len(rows))] == [b for _, b in rows]
    assert all(got[i]["n_rules"] > 0 for i, (u, b) in enumerate(rows) if b and "one.casino" not in u)
    assert {r["verdict"] for r in urls.judge(pages.limit(30), seeds=[]).collect()} == {"allow"}


# WARC


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "u1", "<p>é"), (2, "u2", "<p>é"), (5, "u5", "<p>é"), (3, None, None), (4, "u\r\n4", ""), (6, "u6", "\r\n\r\n" * 50000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    index = warc.write_archives(warc.with_references(pages), str(tmp_path / "w"))
    got = {r["page_id"]: r for r in warc.read_records(index, carry_payload=True).collect()}
    for page_id, _, text in rows:
        data = (text or "").encode()
        r = got[page_id]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert r["refers_to"] == {1: 5, 2: 5, 3: 4}.get(page_id)
        assert bytes(r["payload"]) == (data if r["record_type"] == "response" else b"")
    assert warc.read_records(index.filter("page_id = 6")).count() == 1


def test_ranges_join_neighbours():
    assert warc.ranges([(0, 10), (10, 5), (10**6, 7)]) == [(0, 15, 2), (10**6, 10**6 + 7, 1)]


def test_steps_leave_no_shuffle_files(spark):
    import glob
    import tempfile

    from sensorlake.llm.shared import kept

    def files():
        return set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))

    before = files()
    step = kept(spark.range(1000).repartition(3).groupBy((F.col("id") % 10).alias("k")).count(), "shuffled")
    assert step.count() == 10 and sum(r["count"] for r in step.collect()) == 1000
    deadline = time.time() + 20
    while files() - before and time.time() < deadline:  # files are removed by messages to the executors
        time.sleep(0.5)
    assert not files() - before


def test_pipeline_keeps_the_last_stage_only(spark, tmp_path, monkeypatch):
    import glob

    import corpus_pipeline

    spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id int, text string").write.parquet(str(tmp_path / "documents.parquet"))
    drop = lambda n: lambda spark, docs, sf_dir: docs.filter(F.col("doc_id") % n != 0)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("tmp_two", drop(2)), ("tmp_three", drop(3))])
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in rows.collect()) == [1, 5, 7, 11, 13, 17, 19]
    folders = glob.glob(spark.conf.get("spark.checkpoint.dir").removeprefix("file:") + "/stage-tmp_*")
    assert len(folders) == 1 and "stage-tmp_three" in folders[0]


def test_decontamination_stage_leaves_no_index(spark, tmp_path, monkeypatch):
    from sensorlake.llm import shared

    steps = []
    monkeypatch.setattr(shared, "scratch_dir", lambda _, label: steps.append(f"{tmp_path}/{label}") or steps[-1])
    passage = " ".join(f"p{k}" for k in range(12))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, f"before {passage} after"), (2, "a clean text"), (3, None)], "doc_id bigint, text string")
    got = decontamination.stage_decontaminate(spark, docs, str(tmp_path))
    assert [os.path.exists(s) for s in steps] == ["contaminated" in s for s in steps] and len(steps) == 2
    assert sorted(r["doc_id"] for r in got.collect()) == [2, 3]


def test_rows_are_named_by_sixteen_bytes(spark):
    rows = spark.createDataFrame([(1, None), (None, 1), (1, 1), (1, 1)], "a bigint, b bigint")
    names = [r[0] for r in rows.select(near_duplicates.row_name(rows.columns)).collect()]
    assert {len(n) for n in names} == {16} and len(set(names)) == 3


def test_shared_buckets_count_rows_only(spark):
    nodes = spark.createDataFrame([("a", [1, 2]), ("b", [2, 3]), ("c", [4]), ("c", [4])], "node string, bands array<bigint>")
    got = near_duplicates.shared_buckets(nodes)
    assert sorted(map(tuple, got.select("bucket", "node").collect())) == [(2, "a"), (2, "b"), (4, "c")]
    # The rows that tell which buckets are shared hold a bucket and a number, no names.
    assert not re.search(r"min\(node|max\(node", got._jdf.queryExecution().optimizedPlan().toString())


def test_filter_passes_all_values_and_few_others(spark):
    from sensorlake.llm.shared import perhaps_among

    names = spark.range(5000).select(F.when(F.col("id") != 7, F.unhex(F.md5(F.col("id").cast("string")))).alias("name"))
    passes = perhaps_among(names.filter(F.crc32("name") % 2 == 0), "name")
    got = {(r[0], r[1]): r[2] for r in names.groupBy((F.crc32("name") % 2 == 0).alias("among"), passes(F.col("name")).alias("p")).count().collect()}
    assert got[(None, False)] == 1 and (True, False) not in got and got.get((False, True), 0) < 10
    assert names.filter(perhaps_among(names.limit(0), "name")(F.col("name"))).count() == 0


def test_near_duplicate_stage_moves_marked_rows_only(spark, tmp_path):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(40)]
    docs = spark.createDataFrame(rows + [(41, rows[1][1]), rows[2], rows[2]], "doc_id bigint, text string")
    got = near_duplicates.stage_near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(40))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == plan.count("Join LeftOuter") + plan.count("Join Inner") and "LeftAnti" not in plan
