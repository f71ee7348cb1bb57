"""Batches that count once, however often they are delivered.

Every batch has a name that its producer chooses, and a folder of that name. Writing replaces the folder, so
a write that broke off is simply repeated. A ledger lists the batches that are complete: it gets its entry after the write and
is read before the next one, which then does nothing.
"""

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.operators.daily import finish_partials, merge_partials
from pricetide.schema import RAW
from pricetide.sources.paths import table_exists
from pricetide.sources.tables import JSON_TIMESTAMP, read_table

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")
# Below a table's folder; readers of the table pass over names that begin like this.
_LEDGER = "_batches"


class Ledger:
    """Complete batches of the table at a path, one marker each, so entries never conflict."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, f"{path.rstrip('/')}/{_LEDGER}"

    def _entry(self, batch: str) -> str:
        if not _NAME.fullmatch(batch):
            raise ValueError(f"a batch is named by letters, digits, '_', '.' and '-', not {batch!r}")
        return f"{self.folder}/{batch}"

    def __contains__(self, batch: str) -> bool:
        return table_exists(self.spark, self._entry(batch))

    def add(self, batch: str, rows: int) -> None:
        """One small file that says how many rows the batch had."""
        entry = self.spark.range(1).select(F.lit(batch).alias("batch"), F.lit(rows).cast("bigint").alias("rows"))
        entry.coalesce(1).write.mode("overwrite").parquet(self._entry(batch))

    def batches(self) -> DataFrame:
        """batch, rows of every entry."""
        if not table_exists(self.spark, self.folder):
            return self.spark.createDataFrame([], "batch string, rows bigint")
        return self.spark.read.schema("batch string, rows bigint").parquet(f"{self.folder}/[^_.]*")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_raw_once(df: DataFrame, path: str, batch: str) -> bool:
    """Append a batch as JSON lines; False, and no work, if the ledger has it already.

    A batch whose write broke off, or that was written without reaching the ledger, is written
    again in its place.
    """
    ledger = Ledger(df.sparkSession, path)
    if batch in ledger:
        return False
    rows, seen = _counted(df)
    folder = f"{path.rstrip('/')}/batch={batch}"
    rows.write.mode("overwrite").option("timestampFormat", JSON_TIMESTAMP).json(folder)
    ledger.add(batch, seen.get["rows"])
    return True


def _complete(df: DataFrame, ledger: Ledger) -> DataFrame:
    return df.join(ledger.batches().select("batch"), "batch", "left_semi")


def read_raw_once(spark: SparkSession, path: str) -> DataFrame:
    """The rows of complete batches; folders of unfinished ones are passed over."""
    ledger = Ledger(spark, path)
    if ledger.batches().isEmpty():
        return spark.createDataFrame([], RAW)
    schema = T.StructType([*RAW, T.StructField("batch", T.StringType())])
    return _complete(spark.read.schema(schema).json(path), ledger).select(*RAW.names)


def add_partials(partials: DataFrame, path: str, batch: str) -> bool:
    """Store a batch's `daily_partials` beside those of other batches of the same days.

    Nothing stored is read or rewritten: partitions are (date, batch). False, and no work, for a batch in the ledger.
    """
    ledger = Ledger(partials.sparkSession, path)
    if batch in ledger:
        return False
    rows, seen = _counted(partials.withColumn("batch", F.lit(batch)))
    (
        rows.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch")
        .parquet(path)
    )
    ledger.add(batch, seen.get["rows"])
    return True


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """Partial rows of complete batches, with their date and batch."""
    types = {"date": T.DateType(), "batch": T.StringType()}
    found = read_table(spark, path).schema
    fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in found]
    return _complete(spark.read.schema(T.StructType(fields)).parquet(path), Ledger(spark, path))


def merged_daily(spark: SparkSession, path: str) -> DataFrame:
    """Daily rows over all complete batches, as if all their rows had come at once."""
    return finish_partials(merge_partials(read_partials(spark, path).drop("batch")))
