"""BPE, URL rules, language, sharding and decontamination against plain versions."""

import base64
import hashlib
import math
import random
import re
import struct
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from pricetide.llm import bpe, catalog, decontamination, language, sharding
from pricetide.llm.decontamination import contamination, find
from pricetide.llm.url_filter import UrlTrie, judge_urls, split_url
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path(catalog.RANK_FILE))


@pytest.fixture(scope="module")
def library(ranks):
    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}
    )


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_bpe_query_equals_the_library(spark, documents, library):
    expected = []
    for i, text in documents:
        ids = library.encode_ordinary(text or "")
        data = np.array(ids, dtype="<u4").tobytes()
        expected.append((i, len(ids), sha(data), sha((text or "").encode())))
    assert sorted(map(tuple, catalog.op3_byte_bpe(spark, SF_DIR).collect())) == expected


def test_bpe_merges_odd_texts_like_the_library(ranks, library):
    draw = random.Random(5)
    texts = ["", "ab" * 3000, " " * 70 + "x", "it's 'S don'T 'll", "日本 😀😀", "\x00\x1c\x85 a"]
    for _ in range(200):
        texts.append("".join(draw.choice(["a", "b", " ", "\n", "'s", ".", "é", "7"]) for _ in range(90)))
        texts.append("".join(chr(draw.randrange(0x3000)) for _ in range(50)))
    encoder = bpe.Encoder(bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode_ordinary(text)


def test_bpe_odd_rows(odd_rows, ranks):
    encoded = bpe.encode(odd_rows, ranks, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, ranks).collect()
    assert len(rows) == 11
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in rows)


RULES = catalog.URL_RULES


def plain_rule(url, rules=RULES):
    host, path = split_url(url)
    best = None
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        fits = host == h or host.endswith("." + h)
        if fits and path.startswith(slash + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


def test_split_url():
    assert split_url("HTTP://EXample.ORG/Es/?q=/x#y") == ("example.org", "/Es/")
    assert split_url("http://a.com?x/y") == ("a.com", "")
    assert split_url("a.com/b") == split_url(None) == split_url("") == ("", "")
    assert split_url("x://ÉA.com/é#") == ("Éa.com", "/é")


def test_trie_matches_plain_rules():
    draw = random.Random(1)
    rules = RULES + [("block", "b.example.org"), ("allow", "b.example.org/en/12"), ("block", "net/a/b/c")]
    hosts = ["org", "example.org", "b.example.org", "xexample.org", "com", "a.com", "", ".org", "net", "q.net"]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/123", "/fr/", "/de/x", "/a/b/cd", "/a/b//"]
    trie = UrlTrie(rules)
    for _ in range(500):
        url = f"http://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(['', '?x', '#/'])}"
        assert trie.match(*split_url(url)) == plain_rule(url, rules), url


def test_judge_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, None, "h"), (2, "", "h"), (3, "http://m.example.org/es/2", "h")], "page_id int, url string, Host string"
    )
    rows = judge_urls(df, RULES).orderBy("page_id").collect()
    assert [tuple(r)[-4:] for r in rows] == [
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("m.example.org", "/es/2", "example.org/es/", "block"),
    ]


def test_language_accuracy_on_held_out_documents(spark):
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = catalog.op6_language(spark, SF_DIR).collect()
    assert len(rows) == len(true)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    judged = [r for r in rows if r["held_out"] and true[r["doc_id"]] and r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == true[r["doc_id"]] for r in judged)
    assert right >= 0.95 * len(judged)


def test_language_odd_rows(odd_rows):
    model = language.fit(odd_rows, label="shard")
    rows = language.predict(odd_rows, model).collect()
    und = {(r["doc_id"], r["lang_pred"]) for r in rows if r["lang_pred"] == "und"}
    assert und == {(1, "und"), (2, "und"), (3, "und"), (None, "und"), (8, "und")}
    assert all(0 <= r["score"] <= 1 for r in rows)
    nothing = language.fit(odd_rows.limit(0), label="shard")
    assert {r["lang_pred"] for r in language.predict(odd_rows, nothing).collect()} == {"und"}


def test_a_text_is_judged_by_itself(spark):
    model = language.LanguageModel(("a", "b"), np.log([0.5, 0.5]), np.log(np.full((language.BUCKETS, 2), 1e-3)))
    assert model.score("x" * (3 * language.PIECE_CHARS)) == ("a", 0.5)


def plain_score(model, text):
    """Multinomial naive Bayes, one n-gram after the other, over letters in lower case."""
    runs = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    if not runs.split():
        return language.UNKNOWN, 0.0
    letters = " " + " ".join(runs.split()) + " "
    total = list(model.log_prior)
    for n in range(1, language.LONGEST + 1):
        for at in range(len(letters) - n + 1):
            h = n
            for c in letters[at : at + n]:
                h = ((h ^ ord(c)) * 0x9E3779B1) & 0xFFFFFFFF
                h ^= h >> 15
            for k, weight in enumerate(model.log_likelihood[h & (language.BUCKETS - 1)]):
                total[k] += weight
    best = max(range(len(total)), key=lambda k: (total[k], -k))
    return model.labels[best], 1 / sum(math.exp(x - total[best]) for x in total)


@pytest.mark.parametrize("cells", [1, 7, language.PRODUCT_CELLS])
def test_batches_score_like_plain_bayes(monkeypatch, documents, cells):
    draw = np.random.default_rng(3)
    weights = draw.random((language.BUCKETS, 3))
    model = language.LanguageModel(("a", "b", "c"), np.log([0.5, 0.2, 0.3]), np.log(weights / weights.sum(axis=0)))
    texts = [text for _, text in documents if text][:12] + ["", None, "7 !", "é", " İx ß", "ab " * 40, "x", "x"]
    if cells < 100:
        texts = [t and t[:60] for t in texts]
    monkeypatch.setattr(language, "PRODUCT_CELLS", cells)
    for size in (50, 1000, 1 << 18):
        monkeypatch.setattr(language, "PIECE_CHARS", size)
        got = model.score_batch(texts)
        for text, (label, score) in zip(texts, got, strict=True):
            want = plain_score(model, text or "")
            assert label == want[0] and abs(score - want[1]) < 2e-6, text


def test_texts_of_one_id_are_drawn_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_PER_LABEL", 50)
    rows = [(1, "x", chr(97 + i // 26) + chr(97 + i % 26)) for i in range(400)]
    model = language.fit(spark.createDataFrame(rows, "doc_id int, lang string, text string"))
    # two letters and the blanks around: nine n-grams a text
    grams = np.exp(model.log_likelihood[:, 0].min() * -1) - language.BUCKETS
    assert 9 * 15 < grams < 9 * 110


@pytest.mark.parametrize("size", [1, 2, 3, 7, 30])
def test_pieces_have_the_grams_of_the_whole(monkeypatch, size):
    codes = np.arange(97, 117, dtype=np.uint32)
    whole = np.concatenate([g for g in language.grams(codes)])
    monkeypatch.setattr(language, "PIECE_CHARS", size)
    cut = np.concatenate([g for piece in language._pieces(codes) for g in language.grams(piece)])
    assert sorted(cut.tolist()) == sorted(whole.tolist())
    assert len(cut) == 20 + 19 + 18


def test_sharding_query(spark, documents):
    rows = catalog.op8_hash_tree(spark, SF_DIR).collect()
    texts = dict(documents)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["grown_shard"] in (r["shard"], catalog.SHARDS)
    for shard in range(catalog.SHARDS):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_weights_and_movement(spark):
    keys = spark.range(30_000).withColumnRenamed("id", "k")
    tree = sharding.grid(13)
    heavy = [s if s.shard != 5 else sharding.Shard(s.region, s.rack, 5, 3.0) for s in tree]
    both = sharding.place(sharding.place(keys, tree, "k", "old"), heavy, "k", "new")
    # rows of other regions and racks come into those of shard 5, and there only
    moved = {r["new"] for r in both.filter("old <> new").select("new").distinct().collect()}
    assert 5 in moved and moved <= set(range(12))
    share = both.filter("new = 5").count() / 30_000
    assert abs(share - 3 / 15) < 0.02


def plain_place(key, tree):
    """The descent for one long key, level by level."""

    def hashed(level, child):
        h = 42
        for data in (struct.pack("<i", level), struct.pack("<i", child), struct.pack("<q", key)):
            h = xxhash.xxh64_intdigest(data, seed=h)
        return h >> 11

    here = tree
    for level, name in enumerate(sharding.LEVELS):
        weight = {}
        for s in here:
            weight[getattr(s, name)] = weight.get(getattr(s, name), 0) + s.weight
        draws = {c: -math.log((hashed(level, c) + 0.5) / 2**53) / w for c, w in weight.items()}
        won = min(draws, key=lambda c: (draws[c], c))
        here = [s for s in here if getattr(s, name) == won]
    return here[0].shard


def test_query_places_like_the_plain_descent(spark):
    tree = sharding.grid(catalog.SHARDS)
    for r in catalog.op8_hash_tree(spark, SF_DIR).collect():
        assert r["shard"] == plain_place(r["doc_id"], tree)
        assert r["grown_shard"] == plain_place(r["doc_id"], sharding.grid(catalog.SHARDS + 1))


def test_a_raised_leaf_moves_rows_into_its_subtrees_alone(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    tree = sharding.grid(24)
    heavy = [s if s.shard != 5 else sharding.Shard(s.region, s.rack, 5, 4.0) for s in tree]
    both = sharding.place(sharding.place(keys, tree, "k", "old"), heavy, "k", "new")
    moved = both.filter("old <> new").groupBy("old", "new").count().collect()
    region, rack = {s.shard: s.region for s in tree}, {s.shard: s.rack for s in tree}
    assert moved
    for r in moved:
        old, new = r["old"], r["new"]
        if region[old] != region[new]:
            assert region[new] == region[5]
        elif rack[old] != rack[new]:
            assert rack[new] == rack[5]
        else:
            assert new == 5
    share = both.filter("new = 5").count() / 20_000
    assert abs(share - 4 / 27) < 0.02


@pytest.mark.parametrize("shards", [1, 5, 13])
def test_one_more_shard_takes_rows_into_itself(spark, shards):
    keys = spark.range(5_000).withColumnRenamed("id", "k")
    tree = sharding.grid(shards)
    both = sharding.place(sharding.place(keys, tree, "k", "old"), sharding.grown(tree), "k", "new")
    assert [r["new"] for r in both.filter("old <> new").select("new").distinct().collect()] == [shards]
    assert abs(both.filter(f"new = {shards}").count() / 5_000 - 1 / (shards + 1)) < 0.03


def test_sharding_odd_rows(odd_rows):
    rows = sharding.shard_documents(odd_rows, 3).collect()
    assert len(rows) == 11
    for shard in range(3):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_documents(odd_rows.limit(0), 3).collect() == []
    named = odd_rows.withColumn("_region", odd_rows["doc_id"]).withColumn("_shard", odd_rows["text"])
    placed = sharding.place(named, sharding.grid(24), "doc_id", "put")
    assert placed.columns == [*named.columns, "put"]
    assert placed.drop("put").exceptAll(named).isEmpty()


def brute_contamination(docs, items, length=10):
    def words(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - length + 1)):
            if w:
                windows.setdefault(tuple(w[i : i + length]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for at in range(len(w) - size + 1):
                if (names := windows.get(tuple(w[at : at + size]))) is not None:
                    hit |= set(range(at, at + size))
                    found |= names
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return sorted(out)


def test_contamination_query(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, catalog.op2_contamination(spark, SF_DIR).collect()))
    assert got == brute_contamination(documents, items)
    assert any(r[5] for r in got)


def test_contamination_small_windows(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SEGMENT_BYTES", 200)
    monkeypatch.setattr(decontamination, "ITEMS_PER_BLOCK", 3)
    draw = random.Random(2)
    text = lambda n: " ".join(draw.choice("a b c dd É".split()) for _ in range(draw.randrange(n)))
    docs = [(i, text(60)) for i in range(60)] + [(60, None), (61, "")]
    items = [(i, text(9)) for i in range(12)] + [(12, None), (13, "."), (14, "a")]
    found = contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id int, text string"),
        length=4,
    ).collect()
    got = sorted(
        (r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), sha(",".join(r["items"]).encode()), r["contaminated"])
        for r in found
    )
    assert got == brute_contamination(docs, items, 4)


def test_proximity():
    lists = [np.array([3, 20]), np.array([5, 40]), np.array([6])]
    assert find(lists).tolist() == []
    assert find(lists, slop=1).tolist() == [4]


def test_only_possible_windows_are_looked_at():
    draw = random.Random(4)
    windows = [np.array([draw.randrange(40) for _ in range(draw.choice([1, 2, 5]))], dtype=np.uint64) for _ in range(200)]
    phrases = decontamination.Phrases({w.tobytes(): [str(k)] for k, w in enumerate(windows)})
    unique = [np.frombuffer(w, dtype=np.uint64) for w in dict.fromkeys(w.tobytes() for w in windows)]
    for size in (0, 1, 10, 30, 40):
        held = np.array(sorted(draw.sample(range(45), size)), dtype=np.uint64)
        segment = SimpleNamespace(
            terms=held.tobytes(),
            list_start=np.arange(size + 1, dtype=np.uint32).tobytes(),
            positions=np.arange(size, dtype=np.uint32).tobytes(),
        )
        at = decontamination.Segment(segment).where(phrases.terms)
        want = [k for k, w in enumerate(unique) if np.isin(w, held).all()]
        assert sorted(phrases.possible(at).tolist()) == want


def test_items_without_an_id_count_one_by_one(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "two")], "doc_id int, text string")
    items = spark.createDataFrame([(None, "one"), (None, "two"), ("", "three"), ("a", "one"), ("a", "two")], "item_id string, text string")
    found = {r["doc_id"]: r["items"] for r in contamination(docs, items).collect()}
    assert found == {1: ["", "", "", "a"], 2: ["", "a"]}


def test_contamination_odd_rows(spark, odd_rows):
    items = spark.createDataFrame([(1, "one two"), (None, "byte é"), (3, None)], "item_id bigint, text string")
    rows = contamination(odd_rows, items).collect()
    assert len(rows) == 11
    assert sorted(str(r["doc_id"]) for r in rows if r["contaminated"]) == ["4", "5", "7", "7", "None"]
    assert contamination(odd_rows.limit(0), items).collect() == []
    assert not any(r["contaminated"] for r in contamination(odd_rows, items.limit(0)).collect())
