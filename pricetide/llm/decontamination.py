"""Benchmark decontamination by a distributed positional inverted index.

The corpus is cut into segments of whole documents. Each segment stores, per term, the
sorted positions of all its occurrences; positions run through the segment, with a gap after
each document. A phrase is found by intersecting its terms' lists, each shifted by the term's
offset, from the rarest term of the segment on. The index is a Parquet table of one row per
segment: it depends on the corpus alone, needs no shuffle, and a frequent term is spread
over all segments.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.words import ALPHANUMERIC, hash_words, lean, small_batches
from pricetide.sources.paths import StageScope, stage

# A segment ends with the document that brings it to so many bytes of text.
SEGMENT_BYTES = 4 << 20
# Items searched at once: this bounds what is broadcast.
ITEMS_PER_BLOCK, BYTES_PER_BLOCK = 50_000, 32 << 20

_INDEX = (
    "doc_ids array<bigint>, first array<bigint>, terms binary, list_start binary, positions binary"
)


def _segment(ids: list, docs: list[bytes], gap: int) -> dict:
    hashes, first = hash_words(docs, ALPHANUMERIC, lower=True)
    place = np.arange(len(hashes)) + np.repeat(np.arange(len(docs)) * gap, np.diff(first))
    order = np.argsort(hashes, kind="stable")
    terms, start = np.unique(hashes[order], return_index=True)
    return {
        "doc_ids": ids,
        "first": first.tolist(),
        "terms": terms.tobytes(),
        "list_start": np.append(start, len(hashes)).astype(np.uint32).tobytes(),
        "positions": place[order].astype(np.uint32).tobytes(),
    }


def build_index(docs: DataFrame, gap: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store the postings of all words of all documents; ``gap`` is the longest phrase."""

    @lean
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch["id"], batch["text"]):
                ids.append(None if pd.isna(i) else int(i))
                texts.append(t or b"")
                size += len(texts[-1])
                if size >= SEGMENT_BYTES:
                    yield pd.DataFrame([_segment(ids, texts, gap)])
                    ids, texts, size = [], [], 0
        if ids:
            yield pd.DataFrame([_segment(ids, texts, gap)])

    rows = docs.select(
        F.col(f"`{doc_id}`").cast("decimal(20,0)").alias("id"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    )
    return stage(rows.mapInPandas(build, _INDEX))


class Segment:
    """Postings of one segment."""

    def __init__(self, row):
        self.terms = np.frombuffer(row.terms, dtype=np.uint64)
        self.start = np.frombuffer(row.list_start, dtype=np.uint32)
        self.all = np.frombuffer(row.positions, dtype=np.uint32).astype(np.int64)

    def where(self, wanted: np.ndarray) -> np.ndarray:
        """The list of each wanted term (sorted, unique), -1 where the segment lacks it."""
        at = np.full(len(wanted), -1, dtype=np.int64)
        if len(wanted) and len(self.terms):
            place = np.minimum(np.searchsorted(wanted, self.terms), len(wanted) - 1)
            here = np.flatnonzero(wanted[place] == self.terms)
            at[place[here]] = here
        return at

    def list(self, i: int) -> np.ndarray:
        return self.all[self.start[i] : self.start[i + 1]]


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [begin, end), one range after the other."""
    n = end - begin
    return np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())


class Phrases:
    """Windows of one block of items, each listed under its term that fewest windows have.

    A segment then looks only at windows whose listed term it holds, not at all of them.
    """

    def __init__(self, owners: dict[bytes, list[str]]):
        windows = [np.frombuffer(w, dtype=np.uint64) for w in owners]
        size = np.array([len(w) for w in windows])
        self.names = list(owners.values())
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.terms, slots, n = np.unique(np.concatenate(windows), return_inverse=True, return_counts=True)
        self.slots = slots.astype(np.int32)
        window = np.repeat(np.arange(len(windows)), size)
        key = slots[np.lexsort((n[slots], window))[self.first[:-1]]]
        self.listed = np.argsort(key, kind="stable")
        self.list_start = np.searchsorted(key[self.listed], np.arange(len(self.terms) + 1))

    def possible(self, at: np.ndarray) -> np.ndarray:
        """Windows all of whose terms are there; ``at`` is `Segment.where` of ``terms``."""
        here = np.flatnonzero(at >= 0)
        some = self.listed[_ranges(self.list_start[here], self.list_start[here + 1])]
        if not len(some):
            return some
        begin, end = self.first[some], self.first[some + 1]
        present = at[self.slots[_ranges(begin, end)]] >= 0
        size = end - begin
        return some[np.logical_and.reduceat(present, np.cumsum(size) - size)]


def find(lists: list[np.ndarray], slop: int = 0) -> np.ndarray:
    """Positions where the phrase begins; with ``slop``, each term may stand that far from
    its place relative to the rarest one."""
    by_size = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    begin = lists[by_size[0]] - by_size[0]
    for i in by_size[1:]:
        if not len(begin):
            break
        near = np.searchsorted(lists[i], begin + i - slop)
        hit = np.minimum(near, len(lists[i]) - 1)
        begin = begin[(near < len(lists[i])) & (lists[i][hit] <= begin + i + slop)]
    return begin


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, bytes]]]:
    rows = items.select(
        F.col(f"`{item_id}`").cast("string"), F.col(f"`{text}`").cast("binary")
    ).filter(F.col(f"`{text}`").isNotNull())
    block, size = [], 0
    for row, (i, t) in enumerate(rows.toLocalIterator()):
        # items without an id are told apart by their place
        block.append((f"?{row}" if i is None else f"={i}", bytes(t)))
        size += len(t)
        if len(block) >= ITEMS_PER_BLOCK or size >= BYTES_PER_BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def _windows(block: list[tuple[str, bytes]], length: int) -> dict[bytes, list[str]]:
    """Items by window; a window is the bytes of its term hashes."""
    hashes, first = hash_words([t for _, t in block], ALPHANUMERIC, lower=True)
    owners: dict[bytes, list[str]] = {}
    for (item, _), begin, end in zip(block, first[:-1].tolist(), first[1:].tolist()):
        stops = range(begin + length, end + 1) if end - begin >= length else [end] if end > begin else []
        for stop in stops:
            named = owners.setdefault(hashes[max(begin, stop - length) : stop].tobytes(), [])
            if not named or named[-1] != item:
                named.append(item)
    return owners


def contamination(
    docs: DataFrame,
    items: DataFrame,
    length: int = 10,
    slop: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted ids), spans, contaminated.

    A window is ``length`` consecutive words of an item (all words of a shorter one, none of
    an empty or null one). A word of a document is hit if it lies in an occurrence of a
    window; ``spans`` are [first, end) ranges of hit words, and ``items`` the items with a
    window that occurs. Words are runs of digits, letters and characters beyond ASCII, A-Z in
    lower case. Items of equal id are one item; each item without an id is one of its own, named by an
    empty string. ``slop`` > 0 adds proximity matches (`find`). A null text has no words; rows
    with equal or null ids are documents of their own. Items go to the executors in blocks
    of bounded size; other columns are not read. The result is a written table; the index is deleted.
    """
    with StageScope(docs.sparkSession) as scope:
        return scope.result(_judged(docs, items, length, slop, doc_id, text, item_id, item_text))


def _judged(
    docs: DataFrame, items: DataFrame, length: int, slop: int, doc_id: str, text: str, item_id: str, item_text: str
) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    index = build_index(docs, length + slop, doc_id, text)
    blocks = [
        spark.sparkContext.broadcast(Phrases(owners))
        for block in _blocks(items, item_id, item_text)
        if (owners := _windows(block, length))
    ]

    def search(segment: Segment, phrases: Phrases) -> Iterator[tuple[int, int, str]]:
        at = segment.where(phrases.terms)
        for k in phrases.possible(at).tolist():
            slots = phrases.slots[phrases.first[k] : phrases.first[k + 1]]
            for begin in find([segment.list(i) for i in at[slots].tolist()], slop).tolist():
                for name in phrases.names[k]:
                    yield begin, len(slots), name

    # search and judgement in one step: each step more is another Python worker beside every task
    @lean
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gap = length + slop
        for batch in batches:
            for row in batch.itertuples(index=False):
                first = np.asarray(row.first)
                begins = first[:-1] + np.arange(len(first) - 1) * gap
                sizes = np.diff(first)
                found: dict[int, list] = {}
                segment = Segment(row)
                for at, size, item in (hit for block in blocks for hit in search(segment, block.value)):
                    doc = int(np.searchsorted(begins + sizes, at, side="right"))
                    low = max(0, at - int(begins[doc]) - slop)
                    high = min(int(sizes[doc]), at - int(begins[doc]) + size + slop)
                    found.setdefault(doc, []).append((low, high, item))
                rows = []
                for d, (i, n) in enumerate(zip(row.doc_ids, sizes.tolist())):
                    merged: list[list[int]] = []
                    for low, high, _ in sorted(found.get(d, [])):
                        if merged and low <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], high)
                        else:
                            merged.append([low, high])
                    rows.append(
                        {
                            "doc_id": i,
                            "n_words": n,
                            "n_hit": sum(high - low for low, high in merged),
                            "items": sorted(
                                item[1:] if item[0] == "=" else "" for item in {x[2] for x in found.get(d, [])}
                            ),
                            "spans": [{"first": low, "end": high} for low, high in merged],
                        }
                    )
                yield pd.DataFrame(rows)

    spans = "array<struct<first:bigint,end:bigint>>"
    return index.mapInPandas(
        judge, f"doc_id bigint, n_words bigint, n_hit bigint, items array<string>, spans {spans}"
    ).withColumn("contaminated", F.col("n_hit") > 0)
