"""Documents and their token counts in flat token files, by a scan for separators.

A token file is nothing but token ids of fixed width, one after the other, with an
end-of-document id after each document: no index, no header. Files are cut into blocks of
equal size; each block is searched for the separator with one numpy comparison. A prefix
scan over the blocks of a file then stitches documents across borders: the running sum of
separators numbers the documents, the running maximum of separator places says where the
document began that is open at the start of a block.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.sources.paths import scratch_path

BLOCK_TOKENS = 1 << 19
# Documents of one written file; a file is one row when it is read.
FILE_DOCUMENTS = 5_000


def write_token_files(encoded: DataFrame, separator: int, ids: str = "ids", width: int = 2) -> str:
    """Write binary little-endian 32-bit ids as flat files of ``width`` bytes a token; their folder.

    A document of null or no ids leaves a separator alone. Spark's text writer puts the
    bytes down as they are, with the separator's bytes as line end, so any storage that
    Spark writes to will do. Ids that do not fit, or equal the separator, raise.
    """
    kind = np.dtype(f"<u{width}")
    if not 0 <= separator <= np.iinfo(kind).max:
        raise ValueError("the separator does not fit the width")

    @F.pandas_udf("binary")
    def narrow(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            out = []
            for data in column:
                wide = np.frombuffer(data or b"", dtype="<u4")
                if len(wide) and (wide.max() > np.iinfo(kind).max or (wide == separator).any()):
                    raise ValueError("an id does not fit the token file")
                out.append(wide.astype(kind).tobytes())
            yield pd.Series(out, dtype=object)

    folder = scratch_path(encoded.sparkSession)
    (
        encoded.select(narrow(F.col(f"`{ids}`")).cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", separator.to_bytes(width, "little").decode("latin-1"))
        .option("compression", "none")
        .option("maxRecordsPerFile", FILE_DOCUMENTS)
        .text(folder)
    )
    return folder


def count_tokens(
    spark: SparkSession, folder: str, separator: int, width: int = 2, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per document: file, document (0, 1, ... in its file), first_token, n_tokens.

    ``n_tokens`` leaves the separator out. Tokens after a file's last separator are a
    document of their own; an empty document between two separators has 0. A file that does
    not consist of whole tokens raises, an empty one has no documents. Spark reads a file as
    one row, so files must stay below 2 GB.
    """
    kind, size = np.dtype(f"<u{width}"), block_tokens * width
    files = spark.read.format("binaryFile").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "length", "content"
    )
    whole = F.when(F.col("length") % width == 0, F.col("length")).otherwise(
        F.raise_error(F.concat(F.lit("not whole tokens: "), F.col("file")))
    )
    blocks = (
        files.filter("length > 0")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((whole - 1) / size).cast("int"))))
        .select("file", "block", F.substring("content", F.col("block") * size + 1, F.lit(size)).alias("data"))
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.frombuffer(data, dtype=kind) for data in batch["data"]]
            yield pd.DataFrame(
                {
                    "file": batch["file"],
                    "block": batch["block"],
                    "tokens": [len(x) for x in found],
                    "ends": [np.flatnonzero(x == separator) for x in found],
                }
            )

    scanned = blocks.mapInPandas(search, "file string, block int, tokens int, ends array<int>")
    begin = F.col("block").cast("long") * block_tokens
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, begin + F.try_element_at("ends", F.lit(-1)) + 1)
    stitched = scanned.select(
        "file",
        begin.alias("begin"),
        "tokens",
        "ends",
        F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max(last).over(earlier), F.lit(0)).alias("open"),
        F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("final"),
    )
    # the end of a file closes what is open there
    close = F.when(
        F.col("final") & (F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(-1)) + 1 < F.col("tokens")),
        F.array("tokens"),
    ).when(F.col("final") & (F.size("ends") == 0), F.array("tokens")).otherwise(F.array().cast("array<int>"))
    ends = stitched.withColumn("ends", F.when(F.size("ends") > 0, F.concat("ends", close)).otherwise(close))
    one = ends.select("file", "begin", "before", "open", "ends", F.posexplode("ends").alias("at", "end"))
    first = F.when(F.col("at") == 0, F.col("open")).otherwise(
        F.col("begin") + F.get("ends", F.col("at") - 1) + 1
    )
    return one.select(
        "file",
        (F.col("before") + F.col("at")).alias("document"),
        first.alias("first_token"),
        (F.col("begin") + F.col("end") - first).alias("n_tokens"),
    )
