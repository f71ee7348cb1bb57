"""New files of a landing folder into keyed tables, as a stream that stops when it has seen all."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.operators.clean import clean_prices
from pricetide.schema import RAW
from pricetide.sources.paths import StageScope, stage
from pricetide.sources.tables import upsert

# One scrape of one page: a later delivery of the same scrape replaces it.
SCRAPE_KEYS = ["url", "website", "timestamp"]


def scrapes(batch: DataFrame) -> DataFrame:
    """Cleaned observations with their date, one per key; of several in one batch, the greatest row stays."""
    rows = clean_prices(batch)
    rest = [name for name in rows.columns if name not in SCRAPE_KEYS]
    return (
        rows.groupBy(*SCRAPE_KEYS)
        .agg(F.max(F.struct(*rest)).alias("_row"))
        .select(*SCRAPE_KEYS, "_row.*")
        .withColumn("date", F.to_date("timestamp"))
    )


def _usable() -> F.Column:
    known = [F.col(name).isNotNull() for name in SCRAPE_KEYS]
    return known[0] & known[1] & known[2] & F.col("selling_price").isNotNull()


def load_new_files(
    spark: SparkSession,
    landing: str,
    path: str,
    checkpoint: str,
    rejects: str | None = None,
    files_per_batch: int = 1_000,
    after: Callable[[DataFrame], None] | None = None,
) -> int:
    """Upsert the scrapes of files that are new in ``landing`` since the last call; returns the rows read.

    The checkpoint remembers files, so neither the target's newest row nor its history is looked at, and a late row is
    as good as any. A batch that failed is delivered again under its number: the upsert makes that change nothing, and
    ``rejects`` (rows without a price, a key or a date, as Parquet) gets the same folder again. Only the dates of the new rows
    are read and rewritten. ``after`` gets each batch as upserted, for tables that follow.
    """

    def write(batch: DataFrame, number: int) -> None:
        with StageScope(batch.sparkSession):
            rows = stage(scrapes(batch))
            if rejects is not None:
                left_out = rows.filter(~_usable())
                left_out.write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/load={number}")
            done = upsert(rows.filter(_usable()), path, SCRAPE_KEYS)
            if after is not None:
                after(done)

    query = (
        spark.readStream.schema(RAW)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)
