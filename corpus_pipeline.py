"""Documents to training tokens: five stages, each written as Parquet and read by the next."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm import bpe, catalog, language
from pricetide.llm.decontamination import contamination
from pricetide.llm.line_dedup import remove_repeated_lines
from pricetide.llm.near_dedup import near_duplicates
from pricetide.llm.words import unused
from pricetide.sources.paths import StageScope, stage

# SQL has neither the classifier nor BPE; tests compare with plain versions.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter, with the predicted language where lang is null.

    A lang that is there stays as it is. Without any label to learn from, a null lang stays too.
    """
    model = language.fit(docs.filter(~language.held_out("doc_id") & F.col("doc_id").isNotNull()))
    if not model.labels:
        return docs.filter(language.has_letter("text"))
    label, score = unused(docs, "_predicted"), unused(docs, "_score")
    judged = language.predict(docs, model, label=label, score=score)
    return judged.filter(F.col(label) != language.UNKNOWN).select(
        *(F.coalesce(F.col(f"`{c}`").cast("string"), label).alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns)
    )


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; documents that had lines and keep none go."""
    cut = remove_repeated_lines(docs)
    left = F.length(F.regexp_replace("text", r"\s+", "")) > 0
    return cut.filter(left | (F.col("n_removed") == 0)).select(
        *(F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in docs.columns)
    )


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a number per row, so that rows of null or repeated ids are told apart, and the
    number's name, which no column has."""
    name = unused(docs, "_row")
    return stage(docs.withColumn(name, F.monotonically_increasing_id())), name


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the least by doc_id (nulls last), then by row."""
    rows, row = numbered(docs)
    grouped = near_duplicates(rows, doc_id=row).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    kept = (
        grouped.join(rows.select(row, "doc_id"), row)
        .groupBy("component_id")
        .agg(F.min(order)[row].alias(row))
        .select(row)
    )
    return rows.join(kept, row, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; each row is judged by its own text.

    The rows to go are written first: by that table's size Spark sees whether whole texts need a shuffle.
    """
    rows, row = numbered(docs)
    judged = contamination(rows, catalog.table(spark, sf_dir, "benchmark"), doc_id=row)
    gone = stage(judged.filter("contaminated").select(F.col("doc_id").alias(row)))
    return rows.join(gone, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (binary, 32-bit little-endian), their count, and whether they decode to the text."""
    ranks = bpe.read_ranks(public_tokenizers.path(catalog.RANK_FILE))
    decoded = bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN, ids="_ids", out="_decoded")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        bpe.token_count("_ids").alias("n_tokens"),
        F.col("_ids").alias("ids"),
        (F.col("_decoded") == text).alias("round_trip"),
    )


STAGES = [
    ("language", known_language),
    ("lines", first_lines),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage wrote on its way is deleted after it."""
    docs = catalog.table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        with StageScope(spark) as scope:
            docs = scope.result(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
