"""Line dedup, token files and the pipeline against plain versions."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricetide.llm import bpe, catalog, decontamination, line_dedup, token_counts
from pricetide.llm.line_dedup import like_packed, near_lines, packed_counts, remove_repeated_lines, within
from pricetide.llm.token_counts import count_tokens, write_token_files
from tests.llm.conftest import SF_DIR
from tests.llm.test_near_dedup import brute as brute_near
from tests.llm.test_small_operators import brute_contamination


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(draw, text, edits, letters="abcé"):
    out = list(text)
    for _ in range(edits):
        k = draw.randrange(len(out))
        out[k : k + draw.randrange(2)] = draw.choice([[], [draw.choice(letters)]])
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance(spark, edits):
    draw = random.Random(edits)
    rows = []
    while len(rows) < 300:
        a = "".join(draw.choice("abé") for _ in range(draw.randrange(5, 14)))
        pair = sorted([a, edited(draw, a, draw.randrange(5))], key=len, reverse=True)
        if len(pair[1]) > edits:
            rows.append(tuple(pair))
    df = spark.createDataFrame(rows, "a string, b string")
    near = within(F.col("a"), F.col("b"), edits).alias("near")
    for r in df.select("a", "b", near).collect():
        assert r["near"] == (distance(r["a"], r["b"]) <= edits)


@pytest.mark.parametrize("edits, crowded", [(1, 3), (1, 1000), (2, 5)])
def test_edit_join_loses_nothing(spark, edits, crowded):
    draw = random.Random(edits)
    lines = set()
    for _ in range(3):
        base = "".join(draw.choice("ab") for _ in range(14))
        lines |= {edited(draw, base, draw.randrange(4)) for _ in range(40)}
    lines = sorted(x for x in lines if len(x) > 4)
    df = spark.createDataFrame([(x,) for x in lines + lines[:5]], "text string")
    name = {r["h"]: r["text"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    got = {frozenset((name[r["a"]], name[r["b"]])) for r in near_lines(df, edits, crowded).collect()}
    assert got == {frozenset(p) for p in itertools.combinations(lines, 2) if distance(*p) <= edits}


@pytest.mark.parametrize("edits, crowded", [(1, 3), (2, 5)])
def test_spanning_links_connect_the_same(spark, edits, crowded):
    """Families of like lines and 300 numbered ones: as connected as by all links, by far fewer."""
    draw = random.Random(edits)
    lines = {f"no. {i} of a long list of lines" for i in range(300)}
    for _ in range(3):
        base = "".join(draw.choice("ab") for _ in range(14))
        lines |= {edited(draw, base, draw.randrange(4)) for _ in range(40)}
    lines = sorted(x for x in lines if len(x) > 4)
    df = spark.createDataFrame([(x,) for x in lines], "text string")
    name = {r["h"]: r["text"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    links = [(name[r["a"]], name[r["b"]]) for r in near_lines(df, edits, crowded, spanning=True).collect()]
    all_links = [p for p in itertools.combinations(lines, 2) if abs(len(p[0]) - len(p[1])) <= edits and distance(*p) <= edits]

    def groups(pairs):
        root = {x: x for x in lines}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        return {x: find(x) for x in lines}

    assert {frozenset(p) for p in links} <= {frozenset(p) for p in all_links}
    assert groups(links) == groups(all_links)
    assert len(links) < len(all_links) / 2


def test_family_of_far_lines_takes_one_round(spark, monkeypatch):
    """60 lines with a word of four letters of their own each, four edits or more apart, but for three pairs."""
    draw = random.Random(5)
    words = ["".join(draw.choice("etaoinshr") for _ in range(4)) for _ in range(16)]
    lines = []
    for _ in range(60):
        at = draw.randrange(16)
        lines.append(" ".join([*words[:at], words[at] + "".join(draw.choice("bcdfgklmpuwy") for _ in range(4)), *words[at + 1 :]]))
    lines = sorted({*lines, lines[0] + "x", lines[1][1:], lines[2][:-1] + "qq"})
    rounds = []
    keyed = line_dedup.with_keys
    monkeypatch.setattr(line_dedup, "with_keys", lambda *a: rounds.append(1) or keyed(*a))
    df = spark.createDataFrame([(x,) for x in lines], "text string")
    name = {r["h"]: r["text"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    got = {frozenset((name[r["a"]], name[r["b"]])) for r in near_lines(df, 2, spanning=True).collect()}
    near = {frozenset(p) for p in itertools.combinations(lines, 2) if abs(len(p[0]) - len(p[1])) <= 2 and distance(*p) <= 2}
    assert got == near and len(near) >= 3
    assert len(rounds) == 1


def test_packed_counts_pass_all_similar_pairs(spark):
    draw = random.Random(7)
    base = ["a" * 300, "é q" * 100, "", *("".join(draw.choice("abcxyz 019é") for _ in range(n)) for n in range(10, 60))]
    rows = [(x, edited(draw, x or "b", k, "abz 0é")) for x in base for k in (1, 2)] + [("a" * 256, "a" * 258), ("abc" * 9, "xyz" * 9)]
    a, b = packed_counts(F.col("a")), packed_counts(F.col("b"))
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", like_packed(a, b, 2).alias("like"))
    for r in df.collect():
        assert r["like"] or distance(r["a"], r["b"]) > 2
    assert not df.filter("a LIKE 'abcabc%'").first()["like"]


def brute_lines(rows, min_chars=20):
    """(id, text) -> (id, text left, lines, removed), with rows in the order of their ids."""
    first, distinct = {}, []
    for i, text in rows:
        for line in (text or "").split("\n"):
            if line.strip() and line not in first:
                first[line] = len(first)
                distinct.append(line)
    parent = {x: x for x in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    halves = {}
    for x in (x for x in distinct if len(x) >= min_chars):
        # within one edit the first or the last half, give or take one, is equal
        for shift in (0, 1):
            n = len(x) - shift
            halves.setdefault((n, 0, x[: n // 2]), []).append(x)
            halves.setdefault((n, 1, x[n // 2 + shift :]), []).append(x)
    for group in halves.values():
        for a, b in itertools.combinations(group, 2):
            if abs(len(a) - len(b)) <= 1 and distance(a, b) <= 1:
                a, b = sorted((root(a), root(b)), key=first.get)
                parent[b] = a
    seen, out = set(), []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines, left = text.split("\n"), []
        for line in lines:
            if line.strip():
                if root(line) in seen:
                    continue
                seen.add(root(line))
            left.append(line)
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def test_line_dedup_whole_table(spark, documents):
    df = spark.createDataFrame(documents, "doc_id bigint, text string")
    rows = sorted(tuple(r) for r in remove_repeated_lines(df).collect())
    assert rows == brute_lines(documents)
    assert sum(r[3] for r in rows) > 0
    assert catalog.op9_line_dedup(spark, SF_DIR).count() == len(documents)


def test_near_lines_and_blank_ones(spark):
    line = "a line of more than twenty characters"
    docs = [
        (1, f"{line}\n\n  \nshort"),
        (2, f"{line}!\nshort\nshorT\n\n"),
        (3, f"{line[:-1]}\n{line} and on\nx\n" + "\n".join(f"no. {i} of a long list of lines" for i in range(200))),
        (4, line),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in remove_repeated_lines(df).collect()) == brute_lines(docs)


def test_line_dedup_odd_rows(odd_rows):
    rows = {(r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in remove_repeated_lines(odd_rows).collect()}
    assert (1, 0, 0, None) in rows and (2, 1, 0, "") in rows and (None, 0, 0, None) in rows
    assert (4, 1, 0, "one two three") in rows and (None, 1, 1, "") in rows
    assert remove_repeated_lines(odd_rows).count() == 11
    assert remove_repeated_lines(odd_rows.limit(0)).collect() == []


def test_line_dedup_clashing_names(spark):
    names = ["_row", "_id", "_of", "_gone", "_bits", "given", "id", "row", "at", "line", "text_a", "own_id"]
    line = "a line of more than twenty characters"
    rows = [(1, f"{line}\nx", *["p"] * len(names)), (2, f"{line}!", *["q"] * len(names))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in names))
    found = remove_repeated_lines(df)
    assert found.columns == [*df.columns, "n_lines", "n_removed"]
    got = sorted((r["doc_id"], r["text"], r["n_removed"], *(r[n] for n in names)) for r in found.collect())
    assert got == [(1, f"{line}\nx", 0, *["p"] * len(names)), (2, "", 1, *["q"] * len(names))]


def test_token_counts_query(spark, documents):
    ranks = bpe.read_ranks(public_tokenizers.path(catalog.RANK_FILE))
    encoder = bpe.Encoder(bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    sizes = [len(x) // 4 for x in encoder.encode([t or "" for _, t in documents])]
    rows = catalog.op1_token_counts(spark, SF_DIR).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(sizes)
    at = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["document"])):
        assert r["first_token"] == at.get(r["file"], 0)
        at[r["file"]] = r["first_token"] + r["n_tokens"] + 1


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_documents_across_blocks(spark, tmp_path, block):
    draw = np.random.default_rng(block)
    tokens = draw.integers(0, 4, 200).astype("<u2")
    tokens.tofile(tmp_path / "a.bin")
    np.array([1, 2, 0], dtype="<u2").tofile(tmp_path / "b.bin")
    (tmp_path / "c.bin").write_bytes(b"")
    got = {}
    for r in count_tokens(spark, str(tmp_path), 0, block_tokens=block).collect():
        got.setdefault(r["file"], []).append((r["document"], r["first_token"], r["n_tokens"]))
    expected, begin = [], 0
    for end in [*np.flatnonzero(tokens == 0).tolist(), *([len(tokens)] if tokens[-1] else [])]:
        expected.append((len(expected), begin, end - begin))
        begin = end + 1
    assert sorted(got["a.bin"]) == expected
    assert got["b.bin"] == [(0, 0, 2)] and "c.bin" not in got


def test_token_files_of_odd_ids(spark):
    rows = [(b"",), (None,), (np.array([0xC450 - 1, 0x50C4, 0xFFFF, 10], dtype="<u4").tobytes(),)]
    df = spark.createDataFrame(rows, "ids binary").coalesce(1)
    found = count_tokens(spark, write_token_files(df, 0xC450), 0xC450).orderBy("document").collect()
    assert [r["n_tokens"] for r in found] == [0, 0, 4]
    bad = spark.createDataFrame([(np.array([0xC450], dtype="<u4").tobytes(),)], "ids binary")
    with pytest.raises(Exception, match="fit"):
        write_token_files(bad, 0xC450)
    assert token_counts.FILE_DOCUMENTS > 0


def test_pipeline_against_plain_stages(spark, documents):
    docs = [(i, t) for i, t in documents if t and any(c.isalpha() for c in t)]
    cut = [(i, t) for i, t, n, gone in brute_lines(docs) if t.strip() or not gone]
    kept = {i for i, _, _, stays in brute_near(cut) if stays}
    items = [tuple(r) for r in catalog.table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    clean = {r[0] for r in brute_contamination([(i, t) for i, t in cut if i in kept], items) if not r[-1]}
    ranks = bpe.read_ranks(public_tokenizers.path(catalog.RANK_FILE))
    encoder = bpe.Encoder(bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    expected = {i: zlib.crc32(encoder.encode([t])[0]) for i, t in cut if i in clean}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert all(r["round_trip"] for r in rows)
    assert {r["doc_id"]: zlib.crc32(bytes(r["ids"])) for r in rows} == expected
    assert len(rows) == len(expected)


def test_stages_on_odd_rows(spark, odd_rows):
    docs = odd_rows.select("doc_id", "text", F.col("shard").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"), "shard")
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF_DIR)
        assert out.limit(0).collect() == [] and (name == "tokens" or out.columns == docs.columns)
        assert step(spark, docs.limit(0), SF_DIR).collect() == []
        docs = out
    assert docs.count() > 0


def python_steps(df):
    """Steps of a plan that run in Python; those of one task run side by side, each in a worker of its own."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("ArrowEvalPython") + plan.count("MapInPandas")


def test_stages_use_one_python_worker_per_task(spark, odd_rows):
    docs = odd_rows.withColumn("lang", F.when(F.length("text") > 5, F.col("shard"))).withColumn("source", F.lit("s"))
    items = catalog.table(spark, SF_DIR, "benchmark")
    assert python_steps(corpus_pipeline.known_language(spark, docs, SF_DIR)) == 1
    assert python_steps(corpus_pipeline.tokens(spark, docs, SF_DIR)) == 1
    found = decontamination._judged(docs, items, 10, 0, "doc_id", "text", "item_id", "text")
    assert python_steps(found) == 1
    assert python_steps(catalog.op3_byte_bpe(spark, SF_DIR)) == 1


def test_few_rows_to_go_move_no_texts(spark):
    item = catalog.table(spark, SF_DIR, "benchmark").filter("length(text) > 80").first()["text"]
    text = F.when(F.col("id") % 1000 == 0, F.lit(item)).otherwise(F.format_string("clean text number %s", "id"))
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "4k")
    try:
        out = corpus_pipeline.without_benchmark(spark, docs, SF_DIR)
        assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["doc_id"] for r in out.collect()) == [i for i in range(4000) if i % 1000]
    finally:
        spark.conf.set(name, before)


def test_ids_and_bytes_of_one_worker_equal_those_of_two(spark, odd_rows):
    ranks = bpe.read_ranks(public_tokenizers.path(catalog.RANK_FILE))
    docs = odd_rows.withColumn("ids", F.lit("replaced")).withColumn("_pair", F.lit("kept"))
    two = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    one = bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)
    assert sorted(one.columns) == sorted(two.columns)
    assert sorted(map(tuple, one.select(two.columns).collect()), key=str) == sorted(map(tuple, two.collect()), key=str)


def test_language_stage_fills_null_labels(spark):
    english, german = "the cat sat on the mat and the dog was there", "der hund und die katze sind nicht auf dem dach"
    rows = [(i, (english, german)[i % 2], ("en", "de")[i % 2]) for i in range(40)]
    rows += [(100, english, None), (101, german, None), (None, german, None), (102, english, "de"), (103, "123 --", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = corpus_pipeline.known_language(spark, docs, SF_DIR)
    expected = [(100, english, "en"), (101, german, "de"), (None, german, "de"), (102, english, "de")]
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows[:40] + expected, key=str)


def test_language_stage_without_labels(spark):
    rows = [(1, "some words", None), (2, "日本", None), (None, "x", None), (3, "1 2", None), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = corpus_pipeline.known_language(spark, docs, SF_DIR)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows[:3], key=str)


def test_stages_judge_each_row(spark):
    item = catalog.table(spark, SF_DIR, "benchmark").filter("length(text) > 80").first()["text"]
    clean = [f"{word} text that no benchmark holds" for word in ("first", "second", "third")]
    rows = [(None, item), (None, clean[0]), (7, item + " x"), (7, clean[1]), (8, clean[2])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = corpus_pipeline.without_benchmark(spark, docs, SF_DIR).collect()
    assert sorted(map(tuple, left), key=str) == sorted([rows[1], *rows[3:]], key=str)
    copies = [(None, clean[0]), (None, clean[0]), (None, clean[1]), (7, clean[1]), (7, clean[1]), (7, clean[2]), (None, None), (None, None)]
    one = corpus_pipeline.one_of_each(spark, spark.createDataFrame(copies, "doc_id bigint, text string"), SF_DIR).collect()
    assert sorted(map(tuple, one), key=str) == sorted([copies[0], copies[3], *copies[5:]], key=str)


def test_long_lines_differ_in_two_characters(spark):
    draw = random.Random(8)
    lines = []
    for size in (60, 197, 198, 199, 200, 201, 300, 600):
        base = "".join(draw.choice("abcde fghij") for _ in range(size))
        for edits in (0, 1, 2, 2, 3, 4):
            lines.append(edited(draw, base, edits, "xyzé"))
    lines += ["In the year 1980" + " x" * 120, "In the year 1975" + " x" * 120]
    allowed = lambda a, b: 2 if min(len(a), len(b)) >= 200 else 1
    root = list(range(len(lines)))
    for i, j in itertools.combinations(range(len(lines)), 2):
        a, b = lines[i], lines[j]
        if abs(len(a) - len(b)) <= 2 and distance(a, b) <= allowed(a, b):
            low, high = sorted((root[i], root[j]))
            root = [low if x == high else x for x in root]
    assert root[-1] == root[-2]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    gone = {r["doc_id"]: r["n_removed"] for r in remove_repeated_lines(df).collect()}
    assert gone == {i: int(root[i] != i) for i in range(len(lines))}


def test_pipeline_stages_keep_columns_of_any_name(spark):
    names = ["_row", "_predicted", "_score", "_judged", "_component", "id", "row"]
    rows = [(i, f"some words of text number {i} with letters", "en", "s", 40, *[f"own {i}"] * len(names)) for i in range(6)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        found = out.collect()
        assert found and all(r[name] == f"own {r['doc_id']}" for r in found for name in names)
