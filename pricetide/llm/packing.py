"""Cost-balanced packing of token sequences.

A training sequence costs a linear share for its tokens and a quadratic one for attention within each piece. Whole
windows of a long document are sequences of their own. What remains of the documents is packed in groups of bounded size: a group
opens just as many sequences as its tokens fill, then takes its documents in descending order and gives each
to the sequence of lowest cost that has room for it. Where none has room for all of it, the one of lowest cost
takes what fits and the rest goes on. A group's last tokens, too few for a full sequence, fill sequences
of powers of two, so nothing is padded.

Groups are cut from the rows of a partition as they come. Nothing is shuffled or collected; a task holds one batch
of texts and the tokens of one group.
"""

import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricetide.llm.words import small_batches

SEQUENCE_TOKENS = 2_048
# Tokens of the documents that are balanced together, at least (a task's last group has fewer).
GROUP_TOKENS = 1 << 20
# Cost of a piece of n tokens: n + QUADRATIC * n * n, as for layers of width 1,024.
QUADRATIC = 1 / (6 * 1_024)
# Texts are cut at a safe place after so many characters, so that a long one's ids are not all Python objects at once.
PART_CHARS = 1 << 20
# Fixed value: the pattern of byte-level tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_WORD_START = re.compile(r" (?=\S)")


def cost(tokens, quadratic: float = QUADRATIC):
    """Estimated cost of a piece: linear plus quadratic in its tokens."""
    return tokens + quadratic * tokens * tokens


def parts_of(text: str, chars: int = PART_CHARS) -> list[str]:
    """The text in parts of at least ``chars`` characters, but for the last one.

    It is cut before a blank that something other than white space follows. The pattern never matches across such a
    place, so the ids of the parts are those of the whole.
    """
    parts, begin = [], 0
    while len(text) - begin > chars and (found := _WORD_START.search(text, begin + chars)):
        parts.append(text[begin : found.start()])
        begin = found.start()
    return [*parts, text[begin:]]


def byte_ranks(tokenizer_file: bytes) -> dict[bytes, int] | None:
    """The file's vocabulary as ranks of byte strings, or none if it is not plain byte-level BPE.

    Ranks say the same as the file's merges when the ids rise along the list of merges.
    """
    said = json.loads(tokenizer_file)
    model, cut = said["model"], said["pre_tokenizer"] or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    if model["type"] != "BPE" or not plain or said["normalizer"]:
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    joined = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [model["vocab"][a + b] for a, b in joined]
    if merged != sorted(merged):
        return None
    special = {t["content"] for t in said["added_tokens"]}
    return {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


class TextEncoder:
    """Ids of whole texts as the tokenizer of a file gives them, without special tokens around them.

    For plain byte-level BPE the faster of two libraries does the work, from the same vocabulary; a text that
    spells out one of the file's special tokens goes to the tokenizer itself.
    """

    def __init__(self, tokenizer_file: bytes):
        self.tokenizer = Tokenizer.from_buffer(tokenizer_file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = byte_ranks(tokenizer_file)
        self.fast = None
        if ranks is not None:
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.fast is None or any(token in text for token in self.special):
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            ids = array("I")
            for part in parts_of(text):
                ids.extend(self.fast.encode_ordinary(part))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def capacities(tokens: int, size: int = SEQUENCE_TOKENS) -> list[int]:
    """Lengths of the sequences for so many tokens: full ones, then powers of two."""
    rest = tokens % size
    tail = [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return [size] * (tokens // size) + tail


def assign(lengths: list[int], size: int = SEQUENCE_TOKENS, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of documents of these lengths.

    Longest first, equal ones in the given order; equal costs go to the first sequence. All sequences end full.
    """
    limits = capacities(sum(lengths), size)
    room = np.array(limits, dtype=np.int64)
    used = np.zeros(len(limits))
    pieces = []
    for document in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
        start, left = 0, lengths[document]
        while left:
            fits = room >= left
            if not fits.any():
                fits = room > 0
            chosen = int(np.argmin(np.where(fits, used, np.inf)))
            take = min(left, int(room[chosen]))
            pieces.append((document, start, take, chosen, limits[chosen] - int(room[chosen])))
            room[chosen] -= take
            used[chosen] += cost(take, quadratic)
            start += take
            left -= take
    return pieces


def pack(
    docs: DataFrame,
    tokenizer_file: bytes,
    end: int,
    key: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE_TOKENS,
    quadratic: float = QUADRATIC,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Pieces of all documents in sequences: ``key``, start, length, doc_tokens, sequence_id, offset, ids.

    A document's ids are those of its text and ``end``; null and empty texts have ``end`` alone, so every row
    has a piece and repeated rows have theirs each. ``ids`` are little-endian unsigned 32-bit integers.
    ``sequence_id`` holds the partition in its upper bits. The same partitions give the same result again. Other columns
    are ignored; an empty table has no pieces.
    """
    small_batches(docs.sparkSession)
    if size < 1 or size & (size - 1):
        raise ValueError("sequences need a power of two as their length")
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_file)
    last = end.to_bytes(4, "little")
    kind = docs.select(F.col(f"`{key}`").alias("key")).schema
    names = ["start", "length", "doc_tokens", "sequence_id", "offset"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TextEncoder(shared.value).encode
        numbered = TaskContext.get().partitionId() << 40
        waiting: list = []  # (key, start, doc_tokens, ids) of documents' rests
        held = 0

        def table(rows: list, key_type: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows))
            arrays = [pa.array(columns[0], type=key_type)]
            arrays += [pa.array(column, type=pa.int64()) for column in columns[1:6]]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[6], type=pa.binary())], ["key", *names, "ids"])

        def group() -> list:
            nonlocal numbered, held
            rows = []
            for document, start, length, sequence, offset in assign([len(w[3]) // 4 for w in waiting], size, quadratic):
                name, begin, total, ids = waiting[document]
                piece = ids[4 * start : 4 * (start + length)]
                rows.append((name, begin + start, length, total, numbered + sequence, offset, piece))
            numbered += len(capacities(held, size))
            waiting.clear()
            held = 0
            return rows

        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + last
                total = len(ids) // 4
                for start in range(0, total - size + 1, size):
                    rows.append((name, start, size, total, numbered, 0, ids[4 * start : 4 * (start + size)]))
                    numbered += 1
                start = total // size * size
                if start < total:
                    waiting.append((name, start, total, ids[4 * start :]))
                    held += total - start
                    if held >= group_tokens:
                        rows += group()
            if rows:
                yield table(rows, key_type)
        if waiting:
            yield table(group(), key_type)

    schema = f"key {kind['key'].dataType.simpleString()}, " + ", ".join(f"{n} bigint" for n in names) + ", ids binary"
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(packed, schema).withColumnRenamed("key", key)
