"""Byte-level BPE: ids of whole texts, and the bytes of ids.

A text is cut by a pattern; each match is merged on its own. The merge keeps a segment tree
over the match's byte positions: a leaf holds ``rank * width + position`` of the pair that
starts there, an inner node the least of its children, so the root names the leftmost pair
of least rank. A merge changes the leaves of the pair, of its right half and of the live
neighbour before it, each a walk of log(width) nodes. Short matches of one width are merged
side by side, one numpy row each; a long one alone, in plain lists.
"""

import base64
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.words import lean, small_batches, unused

NONE = np.iinfo(np.int64).max
# Ids of short strings are remembered per Python worker, up to so many; then the memory
# starts afresh. Longer ones are merged each time.
REMEMBERED, REMEMBERED_CHARS = 100_000, 40
# Matches of more bytes are merged one by one.
SIDE_BY_SIDE_BYTES = 64
# Texts are worked off in groups of about this many characters, tree rows of about this many cells.
GROUP_CHARS, GROUP_CELLS = 1 << 17, 1 << 17


def read_ranks(path: str) -> bytes:
    """The bytes of a rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as file:
        return file.read()


def token_ids(rank_file: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in rank_file.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class Vocabulary:
    def __init__(self, rank_file: bytes):
        self.ids = token_ids(rank_file)
        missing = [b for b in range(256) if bytes([b]) not in self.ids]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        self.tokens = {i: token for token, i in self.ids.items()}
        pairs, ranks = array("q"), array("q")
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    ranks.append(rank)
        self._fill_slots(np.array(pairs, dtype=np.int64), np.array(ranks, dtype=np.int64))
        self.of_bytes = self.rank(np.repeat(self.of_byte, 256), np.tile(self.of_byte, 256))

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs ^ pairs >> 29) * 0x1E3779B97F4A7C15 >> 40) & self.mask

    def _fill_slots(self, left: np.ndarray, ranks: np.ndarray) -> None:
        """A hash table with linear probing, for lookups of many pairs at once."""
        self.mask = (1 << (4 * len(left) + 8).bit_length()) - 1
        self.slots = np.full(self.mask + 1, -1)
        self.merged = np.full(self.mask + 1, -1, dtype=np.int32)
        at = self._slot(left)
        while len(left):
            order = np.flatnonzero(self.slots[at] < 0)
            self.slots[at[order]] = left[order]
            own = self.slots[at] == left
            self.merged[at[own]] = ranks[own]
            left, ranks, at = left[~own], ranks[~own], (at[~own] + 1) & self.mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, or -1; a part of -1 joins with nothing."""
        wanted = np.where((left | right) < 0, -2, left << 32 | right)
        at = self._slot(wanted)
        found = self.slots.take(at)
        out = np.where(found == wanted, self.merged.take(at), -1).astype(np.int64)
        rest = np.flatnonzero((found != wanted) & (found >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & self.mask
            found = self.slots.take(at[rest])
            hit = found == wanted[rest]
            out[rest[hit]] = self.merged[at[rest[hit]]]
            rest = rest[(found >= 0) & ~hit]
        return out

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        by_width = defaultdict(list)
        for i, piece in enumerate(pieces):
            if (whole := self.ids.get(piece)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > SIDE_BY_SIDE_BYTES:
                out[i] = self._merge_long(piece)
            elif piece:
                by_width[1 << (len(piece) - 1).bit_length()].append(i)
        for width, rows in by_width.items():
            step = max(1, GROUP_CELLS // width)
            for begin in range(0, len(rows), step):
                part = rows[begin : begin + step]
                for i, ids in zip(part, self._merge_rows([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Flat arrays: cell ``row * side + position``, with ``side`` twice the width."""
        n, end, side = len(pieces), width, 2 * width  # position ``end`` stands for "none"
        padded = b"".join([p.ljust(width, b"\0") for p in pieces])
        text = np.frombuffer(padded, dtype=np.uint8).reshape(n, width).astype(np.int64)
        size = np.array([len(p) for p in pieces])[:, None]
        token = np.full((n, side), -1)
        token[:, :width] = np.where(np.arange(width) < size, self.of_byte[text], -1)
        after = np.tile(np.minimum(np.arange(1, side + 1), end), (n, 1))
        before = np.tile(np.concatenate([[end], np.arange(side - 1)]), (n, 1))
        tree = np.full((n, side), NONE)
        ranks = self.of_bytes[text[:, :-1] * 256 + text[:, 1:]]
        ranks[np.arange(1, width) >= size] = -1
        tree[:, width:-1] = np.where(ranks >= 0, ranks * width + np.arange(width - 1), NONE)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        token, after, before, tree = (x.reshape(-1) for x in (token, after, before, tree))
        base = np.arange(n) * side
        base = base[tree.take(base + 1) < NONE]
        while len(base):
            joined, here = np.divmod(tree.take(base + 1), width)
            right = after.take(base + here)
            beyond, previous = after.take(base + right), before.take(base + here)
            token[base + here], token[base + right] = joined, -1
            after[base + here] = beyond
            before[base + beyond] = here
            first = previous < end
            previous = np.where(first, previous, here)
            other = np.concatenate([token.take(base + beyond), token.take(base + previous)])
            half = len(base)
            rank = self.rank(
                np.concatenate([joined, other[half:]]), np.concatenate([other[:half], joined])
            )
            ahead, behind = rank[:half], rank[half:]
            tree[base + width + right] = NONE
            here_leaf = np.where(ahead >= 0, ahead * width + here, NONE)
            behind_leaf = np.where(behind >= 0, behind * width + previous, NONE)
            tree[base + width + previous] = np.where(first, behind_leaf, here_leaf)
            tree[base + width + here] = here_leaf
            nodes = np.concatenate([right, here, previous]) + width
            bases = np.concatenate([base, base, base])
            for _ in range(width.bit_length() - 1):
                nodes >>= 1
                left = bases + 2 * nodes
                tree[bases + nodes] = np.minimum(tree.take(left), tree.take(left + 1))
            base = base[tree.take(base + 1) < NONE]
        live = token >= 0
        ids = token[live].astype("<u4").tobytes()
        ends = np.cumsum(live.reshape(n, side).sum(axis=1)).tolist()
        return [ids[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]

    def _merge_long(self, piece: bytes) -> bytes:
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        ranks, tokens = self.ids, self.tokens
        token = self.of_byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [NONE] * (2 * width)

        def leaf(position):
            right = after[position]
            rank = ranks.get(tokens[token[position]] + tokens[token[right]]) if right < n else None
            return NONE if rank is None else rank * width + position

        for i in range(n):
            tree[width + i] = leaf(i)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while (best := tree[1]) < NONE:
            joined, here = divmod(best, width)
            right, previous = after[here], before[here]
            token[here], token[right] = joined, -1
            after[here] = beyond = after[right]
            if beyond < n:
                before[beyond] = here
            for position in (right, here, previous):
                if position < 0:
                    continue
                node = width + position
                tree[node] = NONE if position == right else leaf(position)
                while node > 1:
                    node >>= 1
                    left, other = tree[2 * node], tree[2 * node + 1]
                    tree[node] = left if left < other else other
        return np.array([t for t in token if t >= 0], dtype="<u4").tobytes()


class Encoder:
    """Encodes texts with a vocabulary and a pattern that cuts them."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.cut = vocabulary, regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        out, begin = [], 0
        while begin < len(texts):
            until, size = begin, 0
            while until < len(texts) and (until == begin or size + len(texts[until]) <= GROUP_CHARS):
                size += len(texts[until])
                until += 1
            out += self._encode([self.cut(text) for text in texts[begin:until]])
            begin = until
        return out

    def _encode(self, cut: list[list[str]]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = list(set().union(*cut).difference(self.known))
        ids = dict(zip(fresh, self.vocabulary.merge([match.encode() for match in fresh])))
        long = {match: ids.pop(match) for match in fresh if len(match) > REMEMBERED_CHARS}
        self.known.update(ids)
        get = {**self.known, **long}.__getitem__ if long else self.known.__getitem__
        return [b"".join(map(get, matches)) for matches in cut]


_encoders: dict[tuple, Encoder] = {}
_vocabularies: dict[int, Vocabulary] = {}
_tokens: dict[int, dict[int, bytes]] = {}


def _vocabulary(rank_file: bytes) -> Vocabulary:
    """One per Python worker."""
    key = hash(rank_file)
    if key not in _vocabularies:
        _vocabularies[key] = Vocabulary(rank_file)
    return _vocabularies[key]


def _tokens_of(rank_file: bytes) -> dict[int, bytes]:
    """Bytes of each id, one table per Python worker; decoding needs no more of a vocabulary."""
    key = hash(rank_file)
    if key in _vocabularies:
        return _vocabularies[key].tokens
    if key not in _tokens:
        _tokens[key] = {i: token for token, i in token_ids(rank_file).items()}
    return _tokens[key]


def _encoder(rank_file: bytes, pattern: str) -> Encoder:
    """One per Python worker."""
    key = (hash(rank_file), pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(_vocabulary(rank_file), pattern)
    return _encoders[key]


def _bytes_of(column: Iterable[bytes | None], tokens: dict[int, bytes]) -> list[bytes]:
    token = tokens.__getitem__
    return [b"".join(map(token, np.frombuffer(x or b"", dtype="<u4").tolist())) for x in column]


def encode(
    df: DataFrame,
    rank_file: bytes,
    pattern: str,
    text: str = "text",
    out: str = "ids",
) -> DataFrame:
    """Add ``out``: the ids of the whole text as binary, little-endian unsigned 32-bit.

    A null text counts as empty and has no ids. No special tokens. The rank file is
    broadcast; a vocabulary has a fixed size. Rows and other columns stay as they are; an
    existing column ``out`` is replaced.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(rank_file)

    @F.pandas_udf("binary")
    @lean
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(shared.value, pattern)
        for texts in batches:
            yield pd.Series(encoder.encode(texts.fillna("").tolist()), dtype=object)

    return df.withColumn(out, encoded(F.col(f"`{text}`")))


def decode(df: DataFrame, rank_file: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the bytes of ``ids`` as binary (null ids: none); unknown ids raise."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(rank_file)

    @F.pandas_udf("binary")
    @lean
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = _tokens_of(shared.value)
        for column in batches:
            yield pd.Series(_bytes_of(column, tokens), dtype=object)

    return df.withColumn(out, decoded(F.col(f"`{ids}`")))


def encode_and_decode(
    df: DataFrame,
    rank_file: bytes,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    out: str = "decoded",
) -> DataFrame:
    """What `decode` makes of the ids of `encode`, by one Python worker per task in place of two side by side.

    Existing columns ``ids`` and ``out`` are replaced.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(rank_file)

    @F.pandas_udf("ids binary, decoded binary")
    @lean
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared.value, pattern)
        for texts in batches:
            found = encoder.encode(texts.fillna("").tolist())
            yield pd.DataFrame({"ids": found, "decoded": _bytes_of(found, encoder.vocabulary.tokens)}, dtype=object)

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (ids.lower(), out.lower())]
    pair = unused(df, "_pair")
    return df.select(*kept, both(F.col(f"`{text}`")).alias(pair)).select(
        *kept, F.col(f"{pair}.ids").alias(ids), F.col(f"{pair}.decoded").alias(out)
    )


def token_count(ids: str) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
