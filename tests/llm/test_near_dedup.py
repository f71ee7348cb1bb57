"""Near-duplicates against brute force."""

import random
import re
import uuid

from pricetide.llm import catalog
from pricetide.llm.decontamination import contamination
from pricetide.llm.near_dedup import near_duplicates, odd_sketches
from pricetide.llm.substring_dedup import remove_repeats
from pricetide.sources import paths
from tests.llm.conftest import SF_DIR


def brute(rows, percent=75):
    def shingles(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        if not words:
            return set()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_whole_table_matches_brute_force(spark, documents):
    assert got(catalog.op5_near_duplicates(spark, SF_DIR)) == brute(documents)


def test_chains_families_and_copies(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    rows = []
    for _ in range(6):
        base = [word() for _ in range(80)]
        for _ in range(12):
            copy = list(base)
            for _ in range(draw.randrange(6)):
                copy[draw.randrange(80)] = word()
            rows.append((len(rows), " ".join(copy)))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(near_duplicates(df)) == brute(sorted(rows))


def test_odd_rows(odd_rows):
    found = {}
    for r in near_duplicates(odd_rows).collect():
        found.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert found[1] == [(0, 1, True)]
    assert found[2] == [(0, 2, True)] and found[3] == [(0, 3, True)]
    assert found[4] == [(1, 4, True)] and found[5] == [(1, 4, False)]
    assert found[6] == [(1, 6, True)]
    assert found[7] == [(3, 7, True)] * 2
    assert sorted(found[None]) == [(0, None, True), (1, None, True)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(df).collect() == []


def test_sketches_of_equal_samples_are_equal():
    import numpy as np

    samples = np.arange(320, dtype=np.uint64).reshape(2, 160)
    sketch = odd_sketches(np.vstack([samples, samples]))
    assert (sketch[:2] == sketch[2:]).all() and (sketch[0] != sketch[1]).any()


def test_rows_of_one_id_count_as_one_document(spark):
    a, b = "one two three four five six", "other words of which none is in the first one"
    rows = [(3, a), (5, a), (5, b), (9, b), (11, "alone in all this, as it has its own words")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in found) == [
        (3, 3, True), (5, 3, False), (5, 3, False), (9, 3, False), (11, 11, True),
    ]


def test_only_the_results_stay_on_disk(spark, monkeypatch, tmp_path, documents):
    monkeypatch.setattr(paths, "scratch_path", lambda spark: str(tmp_path / uuid.uuid4().hex))
    docs = spark.createDataFrame(documents[:80], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, " ".join(documents[0][1].split()[:12]))], "item_id int, text string")
    assert near_duplicates(docs).count() == 80
    assert contamination(docs, items).count() == 80
    assert remove_repeats(docs).count() == 80
    assert len(list(tmp_path.iterdir())) == 3
