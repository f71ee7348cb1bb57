"""Language of texts: multinomial naive Bayes over hashed character n-grams."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.words import lean, small_batches, unused

UNKNOWN = "und"
# Hashed n-grams of one to three characters; log-probabilities per bucket and label.
BUCKETS, LONGEST = 1 << 15, 3
# The classifier is fitted on at most about this many labelled texts per label, taken by
# hash of the id; a model has at most so many labels.
SAMPLE_PER_LABEL, MAX_LABELS = 2_000, 1_000
# Characters worked off at once.
PIECE_CHARS = 1 << 18
# Pairs times labels of one step of a batch's product.
PRODUCT_CELLS = 1 << 21

_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-case code point of every letter, a blank for all else."""
    if not _tables:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for code in range(0x110000):
            if chr(code).isalpha():
                lower = chr(code).lower()
                table[code] = ord(lower) if len(lower) == 1 else code
        _tables.append(table)
    return _tables[0]


def _characters(text: str) -> np.ndarray:
    """Letters in lower case, with one blank between and around runs of them."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    keep = codes != 32
    keep[1:] |= keep[:-1].copy()
    keep[0] = True
    return codes[keep]


def grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all n-grams that begin in the first ``PIECE_CHARS`` characters, one array per n."""
    for n in range(1, LONGEST + 1):
        if len(codes) < n:
            return
        h = np.full(len(codes) - n + 1, n, dtype=np.uint32)
        for j in range(n):
            h = (h ^ codes[j : len(codes) - n + 1 + j]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        yield h[:PIECE_CHARS] & np.uint32(BUCKETS - 1)


def _pieces(codes: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that reach into the next one, so that no n-gram over a border is lost."""
    for begin in range(0, len(codes), PIECE_CHARS):
        yield codes[begin : begin + PIECE_CHARS + LONGEST - 1]


def _counted(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch as sparse counts: text, bucket and count of every pair that occurs, by text and bucket."""
    parts = [
        buckets.astype(np.int64) + row * BUCKETS for row, codes in enumerate(texts) for buckets in grams(codes)
    ]
    pairs, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), return_counts=True)
    return pairs // BUCKETS, pairs % BUCKETS, n


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    log_prior: np.ndarray
    log_likelihood: np.ndarray  # (BUCKETS, labels)

    def _add(self, totals: np.ndarray, rows: list[int], texts: list[np.ndarray]) -> None:
        """Add the product of a batch's sparse counts with the matrix, some pairs at a time."""
        row, bucket, n = _counted(texts)
        step = max(1, PRODUCT_CELLS // max(1, len(self.labels)))
        for begin in range(0, len(row), step):
            cut = slice(begin, begin + step)
            terms = n[cut, None] * self.log_likelihood[bucket[cut]]
            first = np.flatnonzero(np.r_[True, row[cut][1:] != row[cut][:-1]])
            # a text's pairs lie together, and each text of the batch is a row of its own
            totals[np.asarray(rows)[row[cut][first]]] += np.add.reduceat(terms, first, axis=0)

    def score_batch(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(label, its posterior) of each text; the first label in order wins a tie.

        Texts are counted together in batches of about ``PIECE_CHARS`` characters; a longer one takes several,
        with the n-grams over their borders counted once.
        """
        totals = np.tile(self.log_prior, (len(texts), 1))
        known = np.zeros(len(texts), dtype=bool)
        rows: list[int] = []
        waiting: list[np.ndarray] = []
        held = 0
        for i, text in enumerate(texts):
            codes = _characters(text) if text and self.labels else np.zeros(0, dtype=np.uint32)
            known[i] = bool((codes != 32).any())
            if not known[i]:
                continue
            for piece in _pieces(codes):
                # one piece of a text per batch
                if held + len(piece) > PIECE_CHARS + LONGEST or (rows and rows[-1] == i):
                    self._add(totals, rows, waiting)
                    rows, waiting, held = [], [], 0
                rows.append(i)
                waiting.append(piece)
                held += len(piece)
        if rows:
            self._add(totals, rows, waiting)
        out = []
        for i in range(len(texts)):
            if not known[i]:
                out.append((UNKNOWN, 0.0))
                continue
            best = int(np.argmax(totals[i]))
            out.append((self.labels[best], float(round(1 / np.exp(totals[i] - totals[i][best]).sum(), 6))))
        return out

    def score(self, text: str | None) -> tuple[str, float]:
        return self.score_batch([text])[0]


def fit(docs: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id") -> LanguageModel:
    """Learn from rows with a label and a text.

    Label frequencies cover all rows; n-grams come from about ``SAMPLE_PER_LABEL`` whole
    texts per label (all of a rarer one), taken by hash of ``key`` and text. The counts are summed in
    Spark; the driver gets ``BUCKETS`` numbers per label at most.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`")).alias("draw"),
    ).filter("label IS NOT NULL AND text IS NOT NULL")
    listed = rows.groupBy("label").count().orderBy("label").limit(MAX_LABELS + 1).collect()
    if len(listed) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    size = {r["label"]: r["count"] for r in listed}
    labels = tuple(size)
    if not labels:
        return LanguageModel((), np.zeros(0), np.zeros((BUCKETS, 0)))
    share = F.create_map(
        *(F.lit(x) for name in labels for x in (name, min(1.0, SAMPLE_PER_LABEL / size[name])))
    )
    draw = F.pmod("draw", F.lit(1 << 20)) / float(1 << 20)
    sample = rows.filter(draw < share[F.col("label")])

    @lean
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, texts in batch.groupby("label")["text"]:
                seen = np.zeros(BUCKETS, dtype=np.int64)
                for t in texts:
                    for piece in _pieces(_characters(t)):
                        for buckets in grams(piece):
                            seen += np.bincount(buckets, minlength=BUCKETS)
                hit = np.flatnonzero(seen)
                yield pd.DataFrame({"label": name, "bucket": hit, "n": seen[hit]})

    counted = (
        sample.select("label", "text")
        .mapInPandas(count, "label string, bucket int, n bigint")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    table = np.ones((BUCKETS, len(labels)))
    at = {name: i for i, name in enumerate(labels)}
    for r in counted:
        table[r["bucket"], at[r["label"]]] += r["n"]
    total = np.array([size[name] for name in labels], dtype=float)
    return LanguageModel(labels, np.log(total / total.sum()), np.log(table / table.sum(axis=0)))


def predict(
    docs: DataFrame, model: LanguageModel, text: str = "text", label: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Add the predicted label and its posterior; existing columns of these names are replaced.

    A text that is null, empty or without a letter is ``und`` with score 0. The model is
    broadcast: ``BUCKETS`` numbers per label.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("label string, score double")
    @lean
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = shared.value.score_batch([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame(rows, columns=["label", "score"])

    # otherwise a filter on the label is pushed below, and texts are judged twice, by two workers side by side
    judged = judged.asNondeterministic()
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (label.lower(), score.lower())]
    found = unused(docs, "_judged")
    return docs.select(*kept, judged(F.col(f"`{text}`")).alias(found)).select(
        *kept, F.col(f"{found}.label").alias(label), F.col(f"{found}.score").alias(score)
    )


def has_letter(text: str = "text") -> Column:
    """Whether a text has a letter, by the same table as the classifier."""

    @F.pandas_udf("boolean")
    def judged(texts: pd.Series) -> pd.Series:
        return pd.Series([isinstance(t, str) and bool((_characters(t) != 32).any()) for t in texts], dtype=bool)

    return judged(F.col(f"`{text}`"))


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
