"""Repeated passages: windows of words counted exactly in super-k-mer partitions.

A window's minimiser is the least hash of the short word runs inside it. Consecutive windows
of a document that share their minimiser (a super-k-mer) travel together, as one packed
string of their words, to the minimiser's bucket; equal windows have equal minimisers, so a
bucket holds all copies of its windows and sorting them counts them.

Two things keep this within bounds. A minimiser that occurs once in the corpus has no
repeated window, so its strings stay at home: light (minimiser, place) rows are counted
first. And a minimiser with very many strings would fill one task: its windows are dealt by
their own hash and counted with map-side combining instead.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.words import BATCH_ROWS, SPACED, U64, combine, hash_words, mix, small_batches
from pricetide.sources.paths import StageScope, stage

WINDOW_WORDS, RUN_WORDS = 35, 5
# A minimiser with more strings than this is counted window by window.
CROWDED = 200
# Whole buckets are sorted together up to about so many windows.
SORTED_WINDOWS = 100_000


def super_kmers(
    words: np.ndarray, first: np.ndarray, window: int, run: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, minimiser, first window, number of windows) for the words of many documents.

    A super-k-mer has its minimiser at one place (the leftmost of equal ones), so equal
    windows are never in the same one.
    """
    starts = len(words) - window + 1
    if starts <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    least, width = combine(words, run), 1
    place = np.arange(len(least))
    while width < window - run + 1:  # least of ``width`` runs, doubling
        step = min(width, window - run + 1 - width)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        width += step
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.flatnonzero(owner[:starts] == owner[window - 1 :])
    if not len(inside):
        return inside, inside, inside, inside
    new = np.flatnonzero(np.diff(place[inside], prepend=-1))
    begin = inside[new]
    count = np.diff(np.append(new, len(inside)))
    return owner[begin], least[begin].view(np.int64), begin - first[owner[begin]], count


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    for batch in batches:
        for begin in range(0, len(batch), BATCH_ROWS):
            part = batch.iloc[begin : begin + BATCH_ROWS]
            yield part, [t or b"" for t in part["text"]]


def _minimisers(rows: DataFrame, window: int, run: int) -> DataFrame:
    def cut(batches):
        for part, docs in _documents(batches):
            owner, key, begin, count = super_kmers(*hash_words(docs, SPACED), window, run)
            row = part["row"].to_numpy()[owner]
            yield pd.DataFrame({"key": key, "row": row, "begin": begin, "windows": count})

    return rows.mapInPandas(cut, "key bigint, row string, begin int, windows int")


_PACKED = "bucket bigint, row string, begin int, windows int, crowded boolean, packed binary"


def _pack(chosen: DataFrame, window: int) -> DataFrame:
    """One row per chosen super-k-mer: the bucket and its words in one string; one row per
    window, with the window's hash as bucket, where the minimiser is crowded."""
    names = [column.split()[0] for column in _PACKED.split(", ")]

    def pack(batches):
        for part, docs in _documents(batches):
            hashes, first = hash_words(docs, SPACED)
            whole = combine(hashes, window).view(np.int64)
            out = []
            for row, doc, low, *picks in zip(
                part["row"], docs, first.tolist(), part["key"], part["begin"], part["windows"], part["crowded"]
            ):
                words = doc.split()
                for key, begin, count, crowded in zip(*(p.tolist() for p in picks)):
                    if crowded:
                        keys = whole[low + begin : low + begin + count].tolist()
                        out += [(k, row, begin + i, 1, True, None) for i, k in enumerate(keys)]
                    else:
                        packed = b" ".join(words[begin : begin + count + window - 1])
                        out.append((key, row, begin, count, False, packed))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return chosen.mapInPandas(pack, _PACKED)


def _sort_buckets(packed: DataFrame, window: int) -> DataFrame:
    """Windows of ordinary buckets that start at least twice.

    Rows are sorted by bucket within each task; windows of whole buckets are sorted together.
    """

    def count(group: pd.DataFrame) -> pd.DataFrame:
        words, first = hash_words(group["packed"].tolist(), SPACED)
        n = group["windows"].to_numpy()
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        bucket = np.repeat(group["bucket"].to_numpy().view(U64), n)
        key = mix(combine(words, window)[np.repeat(first[:-1], n) + step] ^ bucket, 5)
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = np.zeros(len(key) + 1, dtype=bool)
        same[1:-1] = key[1:] == key[:-1]
        again = order[same[1:] | same[:-1]]
        row = np.repeat(group["row"].to_numpy(), n)
        begin = np.repeat(group["begin"].to_numpy(), n) + step
        return pd.DataFrame({"row": row[again], "begin": begin[again]})

    def sort(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += int(batch["windows"].sum())
            if size < SORTED_WINDOWS:
                continue
            group = pd.concat(held)
            last = group["bucket"] == group["bucket"].iloc[-1]
            if not last.all():
                yield count(group[~last])
            held = [group[last]]
            size = int(held[0]["windows"].sum())
        if held:
            yield count(pd.concat(held))

    return (
        packed.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInPandas(sort, "row string, begin int")
    )


def repeated_windows(rows: DataFrame, window: int = WINDOW_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """(row, begin): every window that starts at least twice, for rows (row: string, text: binary)."""
    places = stage(_minimisers(rows, window, run))
    sizes = places.groupBy("key").count().filter("count > 1")
    seen = stage(sizes.select("key", (F.col("count") > CROWDED).alias("crowded")))
    found = F.struct("key", "begin", "windows", "crowded")
    # sets, since rows of one name give the same places once each: n equal rows cost n times one row
    picks = places.join(seen, "key").groupBy("row").agg(F.collect_set(found).alias("picks"))
    chosen = rows.join(picks, "row").select(
        "row", "text", *(F.col(f"picks.{c}").alias(c) for c in ("key", "begin", "windows", "crowded"))
    )
    packed = stage(_pack(chosen, window))
    ordinary = packed.filter("NOT crowded").select("bucket", "row", "begin", "windows", "packed")
    single = packed.filter("crowded").select("bucket", "row", "begin")
    twice = stage(single.groupBy("bucket").count().filter("count > 1").select("bucket"))
    crowded = single.join(twice, "bucket").select("row", "begin")
    return _sort_buckets(ordinary, window).unionByName(crowded)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW_WORDS,
    run: int = RUN_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (text of the words that stay).

    Words lie between ASCII white space. A word goes if it is covered by a window of
    ``window`` consecutive words of its document whose word sequence starts anywhere else as
    well, in the same document or another; all copies go. Windows are judged on the input.
    ``kept`` joins the other words by one blank. A null or empty text has no words. Rows with
    equal or null ids are documents of their own, so a repeated row repeats all its windows.
    Other columns are not read.
    """
    small_batches(docs.sparkSession)
    content = F.col(f"`{text}`")
    # rows of equal id and text share their name, as all that follows is the same for them
    rows = docs.select(
        F.concat_ws(":", F.col(f"`{doc_id}`").cast("string"), F.hex(F.xxhash64(content))).alias("row"),
        F.col(f"`{doc_id}`").cast("string").alias("doc_id"),
        content.cast("binary").alias("text"),
    )
    with StageScope(docs.sparkSession) as scope:
        repeats = scope.result(repeated_windows(rows.select("row", "text"), window, run))
    begins = repeats.groupBy("row").agg(F.collect_set("begin").alias("begins"))

    def clean(batches):
        for part, texts in _documents(batches):
            out = []
            for i, doc, begins in zip(part["doc_id"], texts, part["begins"]):
                words = doc.split()
                kept = words
                if begins is not None:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    at = np.unique(begins)
                    edge[at] += 1
                    edge[at + window] -= 1
                    kept = [w for w, n in zip(words, np.cumsum(edge).tolist()) if not n]
                out.append((i, len(words), len(words) - len(kept), b" ".join(kept)))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])

    cleaned = rows.join(begins, "row", "left").select("doc_id", "text", "begins").mapInPandas(
        clean, "doc_id string, n_words bigint, n_removed bigint, kept binary"
    )
    return cleaned.select(
        F.col("doc_id").cast(dict(docs.dtypes)[doc_id]).alias("doc_id"),
        "n_words",
        "n_removed",
        F.col("kept").cast("string").alias("kept"),
    )
