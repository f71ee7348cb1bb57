"""Document fingerprints: MinHash signatures of 5-word shingles, next documents, banded joins
whose pairs are verified on full sets."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.near_dedup import linked, odd_sketches, set_names, set_parities
from pricetide.llm.words import MinHash, mix, shingle_sets, small_batches
from pricetide.sources.paths import StageScope, stage

SHINGLE_WORDS = 5
# 128 permutations, of each 16 bits of the least value: 512 hex digits.
PERMUTATIONS = 128
# A pair of similarity 0.75 shares none of 32 bands of 4 with a chance of 5e-6.
BAND_ROWS = 4
# What `near_sets` needs of a document beside its fingerprint: the hash of its text, and its shingle set.
_SIGNATURE = "tie bigint, n_shingles bigint, s1 bigint, s2 bigint, sketch array<bigint>, parity array<bigint>"
# Documents of one ordered part, about, where the session does not ask for more parts.
PART_ROWS = 20_000
_PRINTS = (
    "doc_id bigint, tie bigint, n_chars bigint, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)
_EDGES = "part int, edge string, text string"


def _digits(samples: np.ndarray) -> np.ndarray:
    return mix(samples, 3).astype("<u2")


def fingerprint(docs: list[bytes], minhash: MinHash) -> list[str]:
    """Hex fingerprint of each text; texts without words share one of their own."""
    hashes, starts = shingle_sets(docs, SHINGLE_WORDS)
    return [row.tobytes().hex() for row in _digits(minhash.signatures(hashes, starts))]


def signed(docs: list[bytes], minhash: MinHash) -> tuple[list[bytes], dict[str, list]]:
    """Fingerprints as by `fingerprint`, but as bytes, and the columns of ``_SIGNATURE`` but for tie."""
    hashes, starts = shingle_sets(docs, SHINGLE_WORDS)
    samples = minhash.signatures(hashes, starts)
    s1, s2 = set_names(hashes, starts)
    more = {
        "n_shingles": np.diff(starts).tolist(),
        "s1": s1.tolist(),
        "s2": s2.tolist(),
        "sketch": list(odd_sketches(samples).view(np.int64)),
        "parity": list(set_parities(hashes, starts)),
    }
    return [row.tobytes() for row in _digits(samples)], more


def _alike(x: np.ndarray, y: np.ndarray) -> list[float]:
    chance = 2.0**-16
    same = (x == y).mean(axis=1)
    return np.clip((same - chance) / (1 - chance), 0, 1).tolist()


def likeness(a: list[str], b: list[str]) -> list[float]:
    """Share of equal values of hex fingerprints, corrected for chance agreement of 16 bits."""
    x = np.frombuffer(bytes.fromhex("".join(a)), dtype="<u2").reshape(len(a), -1)
    y = np.frombuffer(bytes.fromhex("".join(b)), dtype="<u2").reshape(len(b), -1)
    return _alike(x, y)


def _finished(rows: list[tuple], minhash: MinHash) -> pd.DataFrame:
    """The columns of ``_PRINTS`` for rows (doc_id, tie, text, text of the next document)."""
    import hashlib

    edited = []
    for _, _, own, after in rows:
        half = len(own) // 2
        edited.append((own[: len(own) - half] + after[:half]).encode())
    # a text that follows another is mostly the next row's own
    texts = list(dict.fromkeys(t for row in rows for t in row[2:]))
    at = {t: k for k, t in enumerate(texts)}
    hashes, starts = shingle_sets([*(t.encode() for t in texts), *edited], SHINGLE_WORDS)
    digits = _digits(minhash.signatures(hashes, starts))
    own, after = (digits[[at[row[k]] for row in rows]] for k in (2, 3))
    changed = digits[len(texts) :]
    return pd.DataFrame(
        {
            "doc_id": pd.array([row[0] for row in rows], dtype="Int64"),
            "tie": [row[1] for row in rows],
            "n_chars": [len(row[2]) for row in rows],
            "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
            "fingerprint": [row.tobytes() for row in own],
            "edited_fingerprint": [row.tobytes() for row in changed],
            "near_edited": _alike(own, changed),
            "near_next": _alike(own, after),
        }
    )


_COLUMNS = [column.split()[0] for column in f"{_PRINTS}, {_EDGES}".split(", ")]


def _edge(part: int, edge: str, doc_id: int | None, tie: int, text: str) -> pd.DataFrame:
    """A row of a range's border: no fingerprint yet, but the text."""
    known = {"doc_id": doc_id, "tie": tie, "part": part, "edge": edge, "text": text}
    return pd.DataFrame({c: pd.Series([known.get(c)], dtype=object) for c in _COLUMNS})


def edited_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness.

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has the last half of the code points replaced by as many
    first ones of the next document by doc_id (all of a shorter one); the first follows the
    last. Equal ids are ordered by their texts' hashes, null ids come last; a null text counts
    as empty. A table of one document is its own next. Other columns are not read.
    """
    return _shown(_edited(docs, doc_id, text)).drop("tie")


def _shown(prints: DataFrame) -> DataFrame:
    """Fingerprints as hex digits, in lower case."""
    return prints.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def _edited(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`edited_texts` with fingerprints in binary and tie, the hash of the text.

    The texts are shuffled once, into ranges of their order; rows of one id and text differ by a number, so that no id
    has to fit a task. A task knows the follower of all its rows but the last. It hands on its last row and its first text, and
    these few, two for each range, meet in a second step.
    """
    spark = docs.sparkSession
    small_batches(spark)
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), content.alias("text"), F.xxhash64(content).alias("tie")
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + docs.count() // PART_ROWS)
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc(), F.col("salt").asc()]
    ordered = (
        rows.withColumn("salt", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select(F.col("doc_id").cast("string").alias("id"), "tie", "text", F.spark_partition_id().alias("part"))
    )
    minhash = MinHash(PERMUTATIONS)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, part = None, None
        for batch in batches:
            for at in range(0, len(batch), 500):
                piece, ready = batch.iloc[at : at + 500], []
                for i, tie, t, part in zip(*(piece[c] for c in ["id", "tie", "text", "part"])):
                    own = None if i is None else int(i)
                    if held is None:
                        yield _edge(part, "first", own, tie, t)
                    else:
                        ready.append((*held, t))
                    held = (own, tie, t)
                if ready:
                    yield _finished(ready, minhash).assign(part=None, edge=None, text=None)
        if held is not None:
            yield _edge(part, "last", *held)

    walked = stage(ordered.mapInPandas(walk, f"{_PRINTS}, {_EDGES}"))
    # one row for each range: which range with rows comes next, the first after the last
    firsts = walked.filter("edge = 'first'").select("part", F.col("text").alias("following"))
    following = firsts.select(
        "part",
        F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next"),
    )
    lasts = walked.filter("edge = 'last'").select("part", F.col("doc_id").cast("string").alias("id"), "tie", "text")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (None if i is None else int(i), tie, t, f)
                for i, tie, t, f in zip(*(batch[c] for c in ["id", "tie", "text", "following"]))
            ]
            if rows:
                yield _finished(rows, minhash)

    closed = (
        lasts.join(following, "part")
        .join(firsts.withColumnRenamed("part", "next"), "next")
        .select("id", "tie", "text", "following")
        .mapInPandas(close, _PRINTS)
    )
    return walked.filter("edge IS NULL").drop("part", "edge", "text").unionByName(closed)


def bands(print_: str, rows: int = BAND_ROWS) -> Column:
    """Keys of the bands of a binary fingerprint: (band number, its bytes) hashed."""
    size = 2 * rows
    count = PERMUTATIONS // rows
    return F.array(
        *(F.xxhash64(F.lit(i), F.substring(print_, 1 + i * size, size)) for i in range(count))
    )


def near_sets(prints: DataFrame, docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets, links and components of written rows (doc_id, fingerprint, columns of ``_SIGNATURE``).

    ``docs`` has the texts (binary) under ``id``, their tie. A set is named by n_shingles, s1,
    s2 and represented by ``rep``, the least tie of its texts; texts without words have none. Texts
    are taken for equal by 128 bits of their sets, not by fingerprint: those of one fingerprint share
    all bands and are verified like others. So rows of null or repeated ids count each by its text.
    """
    sets = stage(
        prints.filter("n_shingles > 0")
        .groupBy("n_shingles", "s1", "s2")
        .agg(
            F.min("tie").alias("rep"),
            F.min("doc_id").alias("least"),
            # equal in all rows of a set
            *(F.first(c).alias(c) for c in ["fingerprint", "sketch", "parity"]),
        )
        .withColumn("bands", bands("fingerprint"))
        .drop("fingerprint")
    )
    links, labels = linked(sets.drop("s1", "s2", "least"), docs, percent, PERMUTATIONS, copies=True)
    return sets, links, labels


def _texts(docs: DataFrame, text: str) -> DataFrame:
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.xxhash64(content).alias("id"), content.cast("binary").alias("text"))


def classified_edits(
    docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`edited_texts` with class_id: rows have the same if a chain of texts leads from one to the
    other, each of which has a Jaccard similarity of ``percent`` or more with the next.

    Chains run over pairs that share a band; similarity is that of the full shingle sets. A
    class is named by the hash of one of its texts, so rows of null or repeated ids have classes like others;
    a text without words has none.
    """
    with StageScope(docs.sparkSession) as scope:
        prints = stage(_signed_rows(docs, doc_id, text))
        sets, _, labels = near_sets(prints, _texts(docs, text), percent)
        name = ["n_shingles", "s1", "s2"]
        named = sets.join(labels, F.col("rep") == F.col("node"), "left").select(
            *name, F.coalesce("component", "rep").alias("class_id")
        )
        classes = scope.result(prints.select("tie", *name).distinct().join(named, name).select("tie", "class_id"))
    return _shown(_edited(docs, doc_id, text).join(classes, "tie", "left")).drop("tie")


def _signed_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, fingerprint, and the columns of ``_SIGNATURE``."""
    small_batches(docs.sparkSession)
    minhash = MinHash(PERMUTATIONS)

    @F.pandas_udf(f"fingerprint binary, {_SIGNATURE.partition(', ')[2]}")
    def printed(texts: pd.Series) -> pd.DataFrame:
        prints, more = signed([t or b"" for t in texts], minhash)
        return pd.DataFrame({"fingerprint": prints, **more})

    return docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("tie"),
        printed(F.col(f"`{text}`").cast("binary")).alias("signed"),
    ).select("doc_id", "tie", "signed.*")


def near_pairs(docs: DataFrame, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b), a < b: links that connect all documents of one class (see `classified_edits`), each
    of Jaccard similarity ``percent`` or more of the full shingle sets.

    Texts of equal sets are represented by their least doc_id; sets of null ids alone have no pairs.
    """
    sets, links, _ = near_sets(stage(_signed_rows(docs, doc_id, text)), _texts(docs, text), percent)
    left = sets.select(F.col("rep").alias("a"), F.col("least").alias("id_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("least").alias("id_b"))
    return (
        links.join(left, "a").join(right, "b").filter("id_a <> id_b")
        .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
        .distinct()
    )
