"""Repeated passages and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricetide.llm import catalog, fingerprints, substring_dedup
from pricetide.llm.fingerprints import edited_texts, near_pairs
from pricetide.llm.substring_dedup import remove_repeats
from tests.llm.conftest import SF_DIR
from tests.llm.test_near_dedup import brute as brute_near


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(docs, window):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    seen = Counter(tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=str)


def digest(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], sha(r["kept"])) for r in df.collect()), key=str)


def test_whole_table(spark, documents):
    got = sorted(map(tuple, catalog.op10_substrings(spark, SF_DIR).collect()), key=str)
    assert got == brute(documents, 35)
    assert any(r[2] for r in got)


@pytest.mark.parametrize("crowded", [1, 3, 200])
def test_periodic_and_shared_passages(spark, monkeypatch, crowded):
    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)
    monkeypatch.setattr(substring_dedup, "SORTED_WINDOWS", 50)
    draw = random.Random(crowded)
    word = lambda: draw.choice(["a", "b", "The", "é", "xyz"]) + str(draw.randrange(9))
    passage = [word() for _ in range(14)]
    docs = [(0, "The " * 50), (1, "a b a b a b a b a b a b a b"), (2, None), (3, ""), (4, " ".join(passage))]
    for i in range(5, 40):
        own = [word() for _ in range(draw.randrange(30))]
        docs.append((i, "  ".join(own[:9] + passage[draw.randrange(3) :] + own[9:])))
    docs += [(41, docs[4][1]), (41, docs[4][1]), (None, "q w e r t y u i o p"), (None, "q w e r t y u i o p")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert digest(remove_repeats(df, window=6, run=2)) == brute(docs, 6)


def test_odd_rows(odd_rows):
    docs = [(r["doc_id"], r["text"]) for r in odd_rows.collect()]
    assert digest(remove_repeats(odd_rows)) == brute(docs, 35)
    assert remove_repeats(odd_rows.limit(0)).collect() == []


def expected_edits(docs):
    out = []
    for k, (i, text) in enumerate(docs):
        own, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(own) // 2
        out.append((i, len(own), sha(own[: len(own) - half] + after[:half])))
    return out


@pytest.mark.parametrize("part", [5_000, 7])
def test_edited_texts(spark, documents, monkeypatch, part):
    monkeypatch.setattr(fingerprints, "PART_ROWS", part)
    rows = sorted(catalog.op7_fingerprints(spark, SF_DIR).collect(), key=lambda r: r["doc_id"])
    assert [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows] == expected_edits(documents)
    prints = {}
    for r, (_, text) in zip(rows, documents):
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    follow = [r["fingerprint"] for r in rows[1:]] + [rows[0]["fingerprint"]]
    assert fingerprints.likeness([r["fingerprint"] for r in rows], follow) == [r["near_next"] for r in rows]


def test_likeness_follows_jaccard():
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words).encode(), " ".join(words[:200] + [f"v{i}" for i in range(200)]).encode()]
    a, b = fingerprints.fingerprint(texts, fingerprints.MinHash(fingerprints.PERMUTATIONS))
    assert abs(fingerprints.likeness([a], [b])[0] - 196 / 596) < 0.15


def test_fingerprint_odd_rows(spark, odd_rows):
    rows = edited_texts(odd_rows).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(["1", "2", "3", "4", "5", "6", "7", "7", "8", "None", "None"])
    assert edited_texts(odd_rows.limit(0)).collect() == []
    alone = edited_texts(spark.createDataFrame([(1, "abcd")], "doc_id int, text string")).collect()
    assert alone[0]["edited_sha256"] == sha("abab") and alone[0]["near_next"] == 1.0


def test_near_pairs(spark):
    words = [f"w{i}" for i in range(100)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:98] + ["x", "y"])), (3, " ".join(words)), (4, "z " * 30), (5, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert [tuple(r) for r in near_pairs(df).collect()] == [(1, 2)]


def near_words(draw, families, members):
    """Families of texts around a common one, some below the threshold among themselves."""
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    texts = []
    for _ in range(families):
        base = [word() for _ in range(80)]
        for _ in range(members):
            copy = list(base)
            for _ in range(draw.randrange(6)):
                copy[draw.randrange(80)] = word()
            texts.append(" ".join(copy))
    return texts


def test_fingerprint_classes_match_brute_force(spark, documents):
    texts = near_words(random.Random(4), 5, 14)
    rows = [(i if i % 9 else None, t) for i, t in enumerate([*texts, *texts[:20]])] + [(3, texts[-1])]
    found = [(r["doc_id"], r["edited_sha256"], r["fingerprint"], r["class_id"]) for r in
             fingerprints.classified_edits(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert len(found) == len(rows)
    # brute force numbers rows; a class is then the multiset of its documents' ids
    rooted = brute_near([(n, t) for n, (_, t) in enumerate(rows)])
    expected, got = {}, {}
    for (i, _), (_, _, root, _) in zip(rows, rooted):
        expected.setdefault(root, []).append(str(i))
    for i, _, _, name in found:
        got.setdefault(name, []).append(str(i))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_fingerprint_query_has_classes(spark, documents):
    by = {}
    for r in catalog.op7_fingerprints(spark, SF_DIR).collect():
        by.setdefault(("alone", r["doc_id"]) if r["class_id"] is None else r["class_id"], []).append(r["doc_id"])
    expected = {}
    for i, _, root, _ in brute_near(documents):
        expected.setdefault(root, []).append(i)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, expected.values()))


def test_near_pairs_connect_all_of_a_class(spark):
    rows = list(enumerate(near_words(random.Random(4), 5, 14)))
    pairs = near_pairs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    parent = dict.fromkeys(range(len(rows)))
    root = lambda i: i if parent[i] is None else root(parent[i])
    for a, b in map(tuple, pairs):
        if root(a) != root(b):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    # equal texts are one set, represented by the least id
    first = {t: i for i, t in reversed(rows)}
    assert [root(first[t]) for _, t in rows] == [r[2] for r in brute_near(rows)]


def test_many_rows_without_an_id(spark):
    """A third of the rows under the null id, many of them equal, are dealt to several ranges."""
    rows = [(i, f"text number {i} of many") for i in range(400)] + [(None, f"no id {i % 5}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in edited_texts(df).collect())
    tie = {t: h for t, h in df.selectExpr("text", "xxhash64(text)").distinct().collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, tie[r[1]]))
    assert got == sorted((str(i), n, h) for i, n, h in expected_edits(ordered))
    with_edges = fingerprints._edited(df, "doc_id", "text")
    assert with_edges.count() == len(rows)


def test_equal_rows_cost_no_more_than_their_number(spark):
    text = " ".join(f"w{i}" for i in range(40))
    sizes = []
    for n in (10, 40):
        rows = spark.createDataFrame([(None, text)] * n + [(1, "x " + text)], "doc_id bigint, text string")
        named = rows.select(F.xxhash64("text").cast("string").alias("row"), F.col("text").cast("binary").alias("text"))
        sizes.append(substring_dedup.repeated_windows(named).count())
        found = substring_dedup.remove_repeats(rows).collect()
        assert {(r["doc_id"], r["n_removed"]) for r in found} == {(None, 40), (1, 40)}
    assert sizes[1] <= 4 * sizes[0] + 10
