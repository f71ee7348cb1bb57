"""Raw JSON lines, date-partitioned keyed tables, incremental loads.

Keyed tables are Parquet, partitioned by date, for a single writer at a time: an upsert
rewrites the dates in its batch and leaves the others alone, but the final swap of those
folders is no transaction. Catalog tables that support MERGE go through `merge_into`.
"""

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.operators.last_days import KEEP, PRODUCT, last_days, merged_days
from pricetide.operators.quality import assert_unique
from pricetide.schema import ALERT_UPDATES, DAILY_KEYS, RAW
from pricetide.sources.paths import StageScope, partition_folders, stage, table_exists

# JSON text that keeps microseconds and the zone offset.
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# Folders that the products of the newest days are dealt to by hash.
STATE_BUCKETS = 64
# Characters that Hive-style folder names escape as %XX.
_ESCAPED = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{}\[\]^]")


def raw_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Scraped dicts as observations: missing fields become NULL, unknown ones are dropped."""
    return spark.createDataFrame([{n: row.get(n) for n in RAW.names} for row in rows], RAW)


def read_raw(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(RAW).format(fmt).load(path)


@dataclass(frozen=True)
class RawLines:
    """Parsed lines, the text of those that are no JSON object, and how many there were of both."""

    rows: DataFrame
    broken: DataFrame
    counts: dict[str, int]


def read_raw_lines(spark: SparkSession, path: str) -> RawLines:
    """`read_raw` of JSON lines that keeps broken ones apart instead of turning them into NULLs.

    The lines are read and staged once; they are counted on the way. Blank lines are nothing.
    """
    schema = T.StructType([*RAW, T.StructField("_line", T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_line")
    seen = Observation()
    counts = F.count(F.lit(1)).alias("lines"), F.count("_line").alias("broken")
    lines = stage(reader.json(path).observe(seen, *counts))
    broken = lines.filter("_line IS NOT NULL").select(F.col("_line").alias("line"))
    return RawLines(lines.filter("_line IS NULL").drop("_line"), broken, dict(seen.get))


def append_raw(df: DataFrame, path: str) -> None:
    """Append as JSON lines. A replayed batch is appended again."""
    df.write.mode("append").option("timestampFormat", JSON_TIMESTAMP).json(path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """``merge_schema`` also shows columns that only later appends brought in."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def _write_days(df: DataFrame, path: str, day: str) -> None:
    """Replace the dates present in ``df``.

    REBALANCE gathers each date into few files, and AQE cuts a crowded date into several
    tasks instead of leaving it to one.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def _days_of(batch: DataFrame, day: str) -> list:
    """Distinct days of a batch: a calendar bounds them, not the number of rows."""
    days = [row[0] for row in batch.select(day).distinct().collect()]
    if None in days or "" in days:
        raise ValueError(f"rows with a NULL {day}, or an empty one, have no partition of their own")
    return days


def _touched(batch: DataFrame, path: str, day: str, days: list) -> DataFrame | None:
    """The stored rows of the batch's days, with every column that any of their files has.

    Only these days' folders are listed, so the cost follows the batch, not the table. The
    day keeps the batch's type instead of one guessed from folder names.
    """
    spark = batch.sparkSession
    folders = [
        f"{path.rstrip('/')}/{day}={_ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', str(value))}"
        for value in days
    ]
    stored = [folder for folder in folders if table_exists(spark, folder)]
    if not stored:
        return None
    reader = spark.read.option("basePath", path)
    found = reader.option("mergeSchema", True).parquet(*stored).schema
    fields = [batch.schema[day] if field.name == day else field for field in found]
    return spark.read.option("basePath", path).schema(T.StructType(fields)).parquet(*stored)


def _merged(
    target: DataFrame, batch: DataFrame, keys: list[str], update_cols: list[str] | None
) -> DataFrame:
    """All columns of both sides; see `upsert`. Rows with a NULL key pass around the join."""
    known = reduce(and_, [F.col(key).isNotNull() for key in keys])
    keyless = target.filter(~known).unionByName(batch.filter(~known), allowMissingColumns=True)
    target, batch = target.filter(known), batch.filter(known)
    updates = set(batch.columns if update_cols is None else update_cols) | set(keys)
    if updates.issuperset(target.columns):
        untouched = target.join(batch.select(*keys), keys, "left_anti")
        merged = untouched.unionByName(batch, allowMissingColumns=True)
    else:
        merged = _update_columns(target, batch, keys, updates)
    return merged.unionByName(keyless)


def _update_columns(
    target: DataFrame, batch: DataFrame, keys: list[str], updates: set[str]
) -> DataFrame:
    """Matched rows take ``updates`` from the batch, NULLs included, and keep the rest."""
    types = {field.name: field.dataType for side in (batch, target) for field in side.schema}
    old = target.select(F.struct(*target.columns).alias("old"))
    new = batch.select(F.struct(*batch.columns).alias("new"))
    same = reduce(and_, [F.col(f"old.{key}") == F.col(f"new.{key}") for key in keys])
    both = old.join(new, same, "full_outer")
    columns = {"old": target.columns, "new": batch.columns}

    def side(name: str, of: str) -> Column:
        missing = F.lit(None).cast(types[name])
        return F.col(f"{of}.`{name}`") if name in columns[of] else missing

    def pick(name: str) -> Column:
        updated = name in updates and name in columns["new"]
        first, second = ("new", "old") if updated else ("old", "new")
        chosen = F.when(F.col(first).isNotNull(), side(name, first))
        return chosen.otherwise(side(name, second)).alias(name)

    added = [name for name in batch.columns if name not in target.columns]
    return both.select(*[pick(name) for name in [*target.columns, *added]])


def upsert(
    df: DataFrame,
    path: str,
    keys: list[str] = DAILY_KEYS,
    update_cols: list[str] | None = None,
    day: str = "date",
    check_unique: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Insert new keys, replace (or partly update) known ones; returns the batch as staged.

    Keys must be unique in the batch (``check_unique`` verifies it). A NULL key matches
    nothing, so such a row is inserted every time; a NULL or empty ``day`` is refused. ``staged`` says
    that ``df`` is a written table already. Only partitions of days in the batch
    are read and rewritten, and running the same batch twice changes nothing.

    No stored column is lost: a known row keeps its values in columns that the batch lacks, an
    inserted one has NULL there. A column new to the table is NULL in rows that the batch
    does not set; days outside the batch show it under ``read_table(merge_schema=True)``.
    """
    spark = df.sparkSession
    batch = df if staged else stage(df)
    if check_unique:
        assert_unique(batch, keys)
    days = _days_of(batch, day)
    if days:
        target = _touched(batch, path, day, days)
        merged = batch if target is None else _merged(target, batch, keys, update_cols)
        _write_days(merged, path, day)
    elif not table_exists(spark, path):
        _write_days(batch, path, day)
    return batch


def merge_into(
    df: DataFrame, table: str, keys: list[str] = DAILY_KEYS, update_cols: list[str] | None = None
) -> None:
    """The same upsert on a catalog table whose format supports MERGE."""
    same = reduce(and_, [F.col(f"{table}.{key}") == df[key] for key in keys])
    merge = df.mergeInto(table, same)
    if update_cols is None:
        merge = merge.whenMatched().updateAll()
    else:
        merge = merge.whenMatched().update({name: df[name] for name in update_cols})
    merge.whenNotMatched().insertAll().merge()


def write_daily(daily: DataFrame, path: str, state: str | None = None) -> DataFrame:
    """Upsert daily rows: a second run on a day replaces that day's rows of its products.

    With ``state``, the table of each product's newest days at that path follows (`update_last_days`).
    """
    batch = upsert(daily, path)
    if state is not None:
        update_last_days(batch, path, state)
    return batch


def update_last_days(batch: DataFrame, path: str, state: str, keep: int = KEEP, buckets: int = STATE_BUCKETS) -> None:
    """Bring ``state`` up to date after ``batch`` was upserted into the daily table at ``path``.

    A date in the batch takes the place of the stored one; older and back-dated days find their place or
    fall off the end. Only the buckets of the batch's products are read and rewritten, so the cost follows the
    products, not the days behind them. A missing state is built from the whole table, once. Running a batch
    again changes nothing, so a run that failed between both tables is mended by running it again.
    """
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64(*PRODUCT), F.lit(buckets)).cast("int")
    if not table_exists(spark, state):
        whole = last_days(read_table(spark, path), keep).withColumn("bucket", bucket)
        if not whole.isEmpty():
            _write_days(whole, state, "bucket")
        return
    with StageScope(spark):
        fresh = stage(last_days(batch, keep).withColumn("bucket", bucket))
        touched = _days_of(fresh, "bucket")
        if not touched:
            return
        stored = _touched(fresh, state, "bucket", touched)
        sides = fresh.withColumn("_new", F.lit(True))
        if stored is not None:
            sides = sides.unionByName(stored.withColumn("_new", F.lit(False)))
        old, new = (F.max(F.when(F.col("_new") == side, F.col("days"))) for side in (False, True))
        merged = sides.groupBy(*PRODUCT, "bucket").agg(merged_days(old, new, keep).alias("days"))
        _write_days(merged, state, "bucket")


def write_alerts(alerts: DataFrame, path: str, unique: bool = False) -> DataFrame:
    """Upsert alerts, one per key; a table's first batch counts a missing scrape count as 1.

    ``unique`` says that ``alerts`` is a written table with one row per key already: then it is
    neither grouped nor staged again.
    """
    order = ["last_scrape_time"]
    columns = order + [n for n in alerts.columns if n not in DAILY_KEYS + order]
    newest = F.max(F.struct(*columns)).alias("_row")
    one = alerts if unique else (
        alerts.groupBy(*DAILY_KEYS)
        .agg(newest)
        .select(*[name if name in DAILY_KEYS else f"_row.{name}" for name in alerts.columns])
    )
    if not table_exists(alerts.sparkSession, path):
        one = one.withColumn("num_scrapes_day", F.coalesce("num_scrapes_day", F.lit(1)))
    return upsert(one, path, update_cols=ALERT_UPDATES, staged=unique)


def high_water_mark(df: DataFrame, ts_col: str = "timestamp") -> Column | None:
    """``max(ts_col)`` as a literal, or ``None`` for a table without any."""
    is_instant = isinstance(df.schema[ts_col].dataType, T.TimestampType)
    # Microseconds cross the driver exactly; Python datetimes would pass its own time zone.
    newest = F.max(F.unix_micros(ts_col) if is_instant else F.col(ts_col))
    mark = df.agg(newest.alias("mark")).first()["mark"]
    if mark is None:
        return None
    return F.timestamp_micros(F.lit(mark)) if is_instant else F.lit(mark)


def _stored_mark(spark: SparkSession, path: str, ts_col: str, day: str | None) -> Column | None:
    """`high_water_mark` of a stored table; with ``day``, from the newest folder that has one.

    The folders are listed, not their files read; folders without any timestamp are passed. Names that are all
    whole numbers are ordered as numbers, others as text, which is the order of dates.
    """
    if day is None:
        return high_water_mark(spark.read.parquet(path), ts_col)
    names = {folder: folder.rpartition("=")[2] for folder in partition_folders(spark, path, day)}
    numbers = all(re.fullmatch(r"-?[0-9]+", name) for name in names.values())
    order = (lambda f: int(names[f])) if numbers else (lambda f: names[f])
    for folder in sorted(names, key=order, reverse=True):
        mark = high_water_mark(spark.read.parquet(folder), ts_col)
        if mark is not None:
            return mark
    return None


def incremental_append(
    source: DataFrame, path: str, ts_col: str = "timestamp", day: str | None = None
) -> int:
    """Append the rows newer than everything at ``path``; returns how many.

    A missing or empty target takes all rows. The comparison is strict, so late rows stay
    out, and as a literal it reaches the source's Parquet scan. Nothing new, no write.
    With ``day``, a date column that never falls while ``ts_col`` rises, the target is partitioned
    by it, and only the newest partition is read in search of the newest row.
    """
    spark = source.sparkSession
    mark = None
    if table_exists(spark, path):
        mark = _stored_mark(spark, path, ts_col, day)
    fresh = source if mark is None else source.filter(F.col(ts_col) > mark)
    if fresh.isEmpty():
        return 0
    seen = Observation("incremental_append")
    writer = fresh.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if day is not None:
        writer = writer.partitionBy(day)
    writer.parquet(path)
    return seen.get["rows"]
