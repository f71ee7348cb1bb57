"""Near-duplicate documents: MinHash bands for candidates, odd sketches (of the samples, and of
the whole sets) to check them, full sets to confirm."""

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.components import components, thin_out
from pricetide.llm.words import BATCH_ROWS, MinHash, U64, give_back, lean, mix, shingle_sets, small_batches
from pricetide.sources.paths import StageScope, stage

SHINGLE_WORDS = 5
# A pair of similarity 0.75 shares none of 40 bands of 4 with a chance of 3e-7.
BANDS, BAND_ROWS = 40, 4
SAMPLES = BANDS * BAND_ROWS
SKETCH_WORDS = 8
SKETCH_BITS = 64 * SKETCH_WORDS
# Bits of the parity bitmap of the whole set.
PARITY_WORDS = 16
_SIGNATURE = "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>, sketch array<bigint>, parity array<bigint>"


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps of MinHash samples: each (index, sample) flips one bit."""
    n = len(samples)
    sketch, row = np.zeros((n, SKETCH_WORDS), dtype=U64), np.arange(n)
    for j in range(samples.shape[1]):
        bit = mix(samples[:, j], 100 + j) % U64(SKETCH_BITS)
        sketch[row, (bit >> U64(6)).astype(np.int64)] ^= U64(1) << (bit & U64(63))
    return sketch


def set_parities(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Parity bitmaps of whole sets: each shingle flips one bit."""
    rows, bits = len(starts) - 1, 64 * PARITY_WORDS
    place = np.repeat(np.arange(rows), np.diff(starts)) * bits + (mix(hashes, 300) % U64(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=rows * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(rows, bits), axis=1, bitorder="little").view("<i8")


def set_names(hashes: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Two sums of 64 bits that name each set."""
    named = []
    for salt in (11, 12):
        total = np.zeros(len(hashes) + 1, dtype=U64)
        np.cumsum(mix(hashes, salt), out=total[1:])
        named.append((total[starts[1:]] - total[starts[:-1]]).view(np.int64))
    return named


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: size of its shingle set, 128 bits that name the set, band keys, odd sketch, set parity."""
    small_batches(docs.sparkSession)
    minhash = MinHash(SAMPLES)

    @lean
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), BATCH_ROWS):
                part = batch.iloc[begin : begin + BATCH_ROWS]
                hashes, starts = shingle_sets([t or b"" for t in part["text"]], SHINGLE_WORDS)
                samples = minhash.signatures(hashes, starts)
                named = set_names(hashes, starts)
                keys = np.empty((len(part), BANDS), dtype=U64)
                for band in range(BANDS):
                    key = np.full(len(part), band, dtype=U64)
                    for j in range(BAND_ROWS):
                        key = mix(key ^ samples[:, band * BAND_ROWS + j], 200 + band)
                    keys[:, band] = key
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                        "n_shingles": np.diff(starts),
                        "s1": named[0],
                        "s2": named[1],
                        "bands": list(keys.view(np.int64)),
                        "sketch": list(odd_sketches(samples).view(np.int64)),
                        "parity": list(set_parities(hashes, starts)),
                    }
                )

    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").cast("decimal(20,0)").alias("doc_id"),
        F.col(f"`{text}`").cast("binary").alias("text"),
    )
    return rows.mapInPandas(sign, _SIGNATURE)


def alike(a: str, b: str, percent: int, samples: int = SAMPLES) -> Column:
    """Whether two odd sketches of so many samples leave a similarity of ``percent`` possible.

    Five standard deviations of the estimate below the threshold, a pair is still confirmed
    on full sets.

    Of n bits, z differ when about ``-n/2 * ln(1 - 2z/n)`` samples do, twice the samples
    times (1 - similarity).
    """
    margin = 5 * (0.75 * 0.25 / samples) ** 0.5 + 0.02
    lowest = max(0.0, percent / 100 - margin)
    differing = 2 * samples * (1 - lowest)
    most = SKETCH_BITS / 2 * (1 - np.exp(-2 * differing / SKETCH_BITS)) + 5 * SKETCH_BITS**0.5 / 4
    bits = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_WORDS)]
    return reduce(add, bits) <= int(most)


def close_enough(percent: int) -> Column:
    """Whether two sets (parity_a, n_a; parity_b, n_b) may be alike: their bitmaps differ in no
    more bits than the sets do in shingles, so no link fails this."""
    bits = [F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(PARITY_WORDS)]
    return reduce(add, bits) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)


def similar(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, text_a, text_b: binary) whose full shingle sets are alike enough."""

    @F.pandas_udf("boolean")
    def confirmed(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for begin in range(0, len(left), 500):
            texts = [*left[begin : begin + 500], *right[begin : begin + 500]]
            n = len(texts) // 2
            hashes, starts = shingle_sets(texts, SHINGLE_WORDS)
            for i in range(n):
                x = hashes[starts[i] : starts[i + 1]]
                y = hashes[starts[n + i] : starts[n + i + 1]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * common >= percent * (len(x) + len(y) - common))
        give_back()
        return pd.Series(out)

    return pairs.filter(confirmed("text_a", "text_b")).select("a", "b")


def _side(sets: DataFrame, side: str, *more: Column) -> DataFrame:
    """What is compared of a set, under the names of one side of a pair."""
    return sets.select(
        F.col("rep").alias(side),
        F.col("sketch").alias(f"sketch_{side}"),
        F.col("parity").alias(f"parity_{side}"),
        F.col("n_shingles").alias(f"n_{side}"),
        *more,
    )


def _confirm(
    pairs: DataFrame, sets: DataFrame, docs: DataFrame, percent: int, samples: int, copies: bool
) -> DataFrame:
    """The pairs (a, b) that are links: odd sketches first, then whole texts."""
    likely = stage(
        pairs.join(_side(sets, "a"), "a")
        .join(_side(sets, "b"), "b")
        .filter(close_enough(percent) & alike("sketch_a", "sketch_b", percent, samples))
        .select("a", "b")
    )
    ends = likely.select(F.col("a").alias("end")).union(likely.select("b"))
    wanted = stage(ends.distinct())
    some = thin_out(docs, "id", wanted, "end")
    texts = stage(
        (some.distinct() if copies else some).join(wanted, F.col("id") == F.col("end"), "left_semi")
    )
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return stage(similar(likely.join(left, "a").join(right, "b"), percent).distinct())


def linked(
    sets: DataFrame, docs: DataFrame, percent: int, samples: int = SAMPLES, copies: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Confirmed links (a, b) between sets that share a band, and (node, component) of what they connect.

    ``sets`` (written) has one row per set: rep, n_shingles, bands, sketch of ``samples``
    samples, parity. ``docs`` has the text of each rep under ``id``; with ``copies``, several rows
    of an id hold one text. Steps 2 and 3 of `near_duplicates`.
    """
    entries = sets.select("rep", F.explode("bands").alias("key"))
    buckets = stage(
        entries.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("rep").alias("a"), F.max("rep").alias("b"))
        .filter("a < b")
    )
    crowded = stage(entries.withColumnRenamed("rep", "b").join(buckets.filter("n > 2").select("key", "n"), "key"))
    # the original of a family of copies meets more of them than any copy does
    central = crowded.groupBy(F.col("b").alias("a")).agg(F.sum("n").alias("met"))
    known = crowded.select("key", F.col("b").alias("a")).join(central, "a")
    centres = stage(known.groupBy("key").agg(F.max(F.struct("met", "a"))["a"].alias("a")))
    around = crowded.join(centres, "key").filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    stars = buckets.filter("n = 2").select("a", "b").union(around)
    links = _confirm(stars.distinct(), sets, docs, percent, samples, copies)
    labels = stage(components(links))
    # what is left to compare: members of one bucket in different components
    placed = stage(
        crowded.join(labels, F.col("b") == F.col("node"), "left").select(
            "key", F.col("b").alias("rep"), F.coalesce("component", "b").alias("component")
        )
    )
    open_keys = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("key")
    )
    split = stage(placed.join(open_keys, "key").join(sets.drop("bands"), "rep"))
    if not split.isEmpty():
        left = _side(split, "a", F.col("key").alias("key_a"), F.col("component").alias("in_a"))
        right = _side(split, "b", F.col("key").alias("key_b"), F.col("component").alias("in_b"))
        across = left.join(
            right,
            (F.col("key_a") == F.col("key_b"))
            & (F.col("in_a") < F.col("in_b"))
            & close_enough(percent)
            & alike("sketch_a", "sketch_b", percent, samples),
        ).select("a", "b")
        more = _confirm(across.distinct(), sets, docs, percent, samples, copies)
        if not more.isEmpty():
            links = links.union(more)
            labels = stage(components(links))
    return links, labels


def _with_shared_ids(signed: DataFrame, classes: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, component) that also connects the sets of rows with one doc_id, which count as one document."""
    name = ["n_shingles", "s1", "s2"]
    rows = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", *name)
    several = stage(
        rows.groupBy("doc_id")
        .agg(F.min(F.struct(*name)).alias("low"), F.max(F.struct(*name)).alias("high"))
        .filter("low <> high")
        .select("doc_id")
    )
    if several.isEmpty():
        return labels
    reps = stage(rows.join(several, "doc_id").join(classes, name).select("doc_id", F.col("rep").alias("b")).distinct())
    least = reps.groupBy("doc_id").agg(F.min("b").alias("a"))
    more = reps.join(least, "doc_id").filter("a < b").select("a", "b").distinct()
    return stage(components(links.union(more)))


def near_duplicates(
    docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if ``100 * common >= percent * union`` of their distinct 5-word
    shingles (a shorter text is one shingle). ``component_id`` is the least doc_id that can
    be reached, ``kept`` says that it is the document's own. A text that is null, empty or without words is linked
    with nothing. Rows with equal doc_id count as one document: what is
    linked with one of their texts is linked with all, and they share its fate; rows with
    a null doc_id are kept and linked with nothing. Other columns are not read.

    1. Documents with equal sets collapse to the least doc_id among them.
    2. Bands give buckets of sets. Every set is compared with the most central set of each of
       its buckets: the one whose buckets are the largest together.
    3. Components of these links; then pairs of one bucket that are still in different
       components are compared as well, so that no link is lost.

    The result is a written table; all tables on the way are deleted.
    """
    with StageScope(docs.sparkSession) as scope:
        return scope.result(_judged(docs, percent, doc_id, text))


def _judged(docs: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    signed = stage(signatures(docs, doc_id, text))
    name = ["n_shingles", "s1", "s2"]
    classes = stage(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*name).agg(F.min("doc_id").alias("rep"))
    )
    sets = stage(
        signed.join(classes.withColumnRenamed("rep", "doc_id"), [*name, "doc_id"])
        .dropDuplicates([*name, "doc_id"])
        .select(F.col("doc_id").alias("rep"), "n_shingles", "bands", "sketch", "parity")
    )
    labels = _with_shared_ids(signed, classes, *linked(sets, rows, percent))
    named = stage(
        classes.join(labels, F.col("rep") == F.col("node"), "left").select(
            *name, F.coalesce("component", "rep").alias("component")
        )
    )
    # null doc_ids are excluded from classes; rows without shingles have no class
    keyed = signed.select("doc_id", *name).join(named, name, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return keyed.select(
        "doc_id", "n_shingles", own.alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
