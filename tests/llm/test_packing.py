"""Packing against the tokenizer's own ids, and its laws."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pricetide.llm import packing
from pricetide.llm.catalog import DOCUMENT_END, TOKENIZER_FILE, op12_packing
from tests.llm.conftest import SF_DIR

PATH = public_tokenizers.path(TOKENIZER_FILE)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def file_bytes():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def encoder():
    return packing.TextEncoder(file_bytes())


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype="<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=" \n\t\x0b\x1c\x85\u00a0\u3000ab'sé1.<日", max_size=40), chars=st.integers(1, 9))
def test_parts_have_the_ids_of_the_whole(tokenizer, encoder, text, chars):
    whole = tokenizer.encode(text, add_special_tokens=False).ids
    parts = packing.parts_of(text, chars)
    assert "".join(parts) == text
    assert [i for part in parts for i in tokenizer.encode(part, add_special_tokens=False).ids] == whole
    assert ids_of(encoder, text) == whole


def test_every_token_and_special_ones(tokenizer, encoder):
    assert encoder.fast is not None
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", " x<|endoftext|>y  <|endoftext|>"]
    texts += [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    for text in texts:
        assert ids_of(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_kinds_of_tokenizers_do_the_work_themselves():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        data = file.read()
    other = packing.TextEncoder(data)
    assert other.fast is None
    text = "Some words, é 12\n\nmore"
    assert ids_of(other, text) == Tokenizer.from_buffer(data).encode(text, add_special_tokens=False).ids


def plain_assign(lengths, size, quadratic):
    """The rule, written with lists: descending documents, lowest cost that has room, else cut."""
    total = sum(lengths)
    room = [size] * (total // size) + [int(b) << k for k, b in reversed(list(enumerate(bin(total % size)[:1:-1]))) if b == "1"]
    limit, used, pieces = list(room), [0.0] * len(room), []
    for document in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        at = 0
        while at < lengths[document]:
            left = lengths[document] - at
            open_ = [s for s in range(len(room)) if room[s] >= left] or [s for s in range(len(room)) if room[s]]
            s = min(open_, key=lambda s: (used[s], s))
            n = min(left, room[s])
            pieces.append((document, at, n, s, limit[s] - room[s]))
            used[s] += n + quadratic * n * n
            room[s] -= n
            at += n
    assert not any(room)
    return pieces


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=40))
def test_assign_follows_the_rule(lengths):
    assert packing.assign(lengths, 64, 0.25) == plain_assign(lengths, 64, 0.25)


def test_costs_are_balanced():
    rng = np.random.default_rng(3)
    pieces = packing.assign(rng.integers(1, 700, 4_000).tolist())
    costs = defaultdict(float)
    for _, _, length, sequence, _ in pieces:
        costs[sequence] += packing.cost(length)
    full = [costs[s] for s in range(len(packing.capacities(sum(p[2] for p in pieces)))) if costs[s] >= 2_048]
    assert max(full) < 1.1 * min(full)


def check(rows, expected, size):
    """``expected``: [(key, ids)] of the documents, repeated ones included."""
    wanted = defaultdict(int)
    for key, ids in expected:
        wanted[key, len(ids)] += 1
    spans = defaultdict(list)
    sequences = defaultdict(list)
    by_ids = defaultdict(set)
    for key, ids in expected:
        by_ids[key, len(ids)].add(tuple(ids))
    for r in rows:
        spans[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        crcs = {
            zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes())
            for ids in by_ids[r["doc_id"], r["doc_tokens"]]
        }
        assert r["ids_crc32"] in crcs
    assert spans.keys() == wanted.keys()
    for (key, total), parts in spans.items():
        covered = np.zeros(total, dtype=int)
        for start, length in parts:
            covered[start : start + length] += 1
        assert (covered == wanted[key, total]).all()
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= size and end & (end - 1) == 0  # full, or a power of two


def test_query_on_the_whole_table(spark, documents, tokenizer):
    expected = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, DOCUMENT_END]) for i, t in documents]
    rows = op12_packing(spark, SF_DIR).collect()
    check(rows, expected, packing.SEQUENCE_TOKENS)
    assert len({r["sequence_id"] for r in rows}) < sum(len(ids) for _, ids in expected) / 2_048 + 12 * 4


def test_odd_rows_in_many_small_groups(spark, odd_rows, tokenizer):
    from pyspark.sql import functions as F

    docs = odd_rows.withColumns({"ids": F.lit(1), "key": F.lit("x"), "start": F.lit(2)})
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    pieces = packing.pack(docs.repartition(3), file_bytes(), 1, size=16, group_tokens=64)
    assert pieces.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    check(pieces.withColumn("ids_crc32", F.crc32("ids")).collect(), expected, 16)


def test_text_keys_and_no_rows(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, None)], "doc_id string, text string")
    found = packing.pack(docs, file_bytes(), 1)
    assert {r["doc_id"] for r in found.collect()} == {"a", None}
    assert packing.pack(docs.limit(0), file_bytes(), 1).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, file_bytes(), 1, size=1_000)
