"""Registered queries over the test tables, and SQL twins where SQL can say the same."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm import bpe, language
from pricetide.llm.conversations import Repair, damaged, gaps, text_hashes
from pricetide.llm.decontamination import contamination
from pricetide.llm.fingerprints import classified_edits
from pricetide.llm.line_dedup import remove_repeated_lines
from pricetide.llm.near_dedup import near_duplicates
from pricetide.llm.packing import pack
from pricetide.llm.sharding import shard_documents
from pricetide.llm.substring_dedup import remove_repeats
from pricetide.llm.token_counts import count_tokens, write_token_files
from pricetide.llm.url_filter import judge_urls
from pricetide.llm.whitening import whiten
from pricetide.sources.paths import StageScope

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the task: the URL rules, the number of shards, the rank file.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
SHARDS = 24
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
# The tokenizer of packed documents, and the id after each of these.
TOKENIZER_FILE, DOCUMENT_END = "byte_bpe_50k.json", 1
# The id after each document of a token file; the vocabulary leaves it free.
SEPARATOR = 50_256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as flat 16-bit token files, and the documents found in these."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    docs = table(spark, sf_dir, "documents").select("text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    with StageScope(spark) as scope:
        folder = write_token_files(encoded, SEPARATOR)
        scope.folders.append(folder)
        return scope.result(count_tokens(spark, folder, SEPARATOR))


def op2_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        bpe.token_count("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(~language.held_out("doc_id") & F.col("doc_id").isNotNull()))
    judged = language.predict(docs.select("doc_id", "text"), model)
    return judged.select(
        "doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified_edits(table(spark, sf_dir, "documents"))


def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = bpe.read_ranks(public_tokenizers.path(TOKENIZER_FILE))
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer, DOCUMENT_END)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    hurt = damaged(given)
    repair = Repair(hurt)
    found = (
        repair.summary.join(repair.audits, "chat")
        .join(text_hashes(repair.turns), "chat", "left")
        .join(gaps(hurt, "conv_id", "turn").withColumnRenamed("conv", "_conv"), F.col("conv").eqNullSafe(F.col("_conv")))
    )
    zero = F.lit(0).cast("bigint")
    every = given.select("conv_id").distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *(
            F.coalesce(name, zero).alias(name)
            for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        ),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_contamination": op2_contamination,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_url_filter": op4_url_filter,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_language": op6_language,
    "op7_fingerprints": op7_fingerprints,
    "op8_hash_tree": op8_hash_tree,
    "op9_line_dedup": op9_line_dedup,
    "op10_substrings": op10_substrings,
    "op11_whitening": op11_whitening,
    "op12_packing": op12_packing,
    "op13_conversation_repair": op13_conversation_repair,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULES = ", ".join(
    f"('{verdict}', '{rule}', '{host}', '/{path}')"
    for verdict, rule in URL_RULES
    for host, _, path in [rule.partition("/")]
)

SQL: dict[str, str] = {
    "op4_url_filter": f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
                            ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
        hosts AS (
            SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM parts),
        rules(verdict, rule, h, p) AS (VALUES {_RULES}),
        best AS (
            SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM hosts JOIN rules
              ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM hosts LEFT JOIN best USING (page_id)""",
}
