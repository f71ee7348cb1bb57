"""Find and set apart the keys that are too large for one task."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.sources.paths import stage

# A window partition up to this size is an ordinary task.
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class HotKeys:
    key: str
    keys: DataFrame

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows of ordinary keys, rows of hot keys); a NULL key counts as a key.

        The list is a written table of known size: Spark broadcasts a small one by itself
        and joins a large one by shuffle, where AQE cuts the crowded keys of ``df``.
        """
        match = df[self.key].eqNullSafe(self.keys["_hot"])
        return df.join(self.keys, match, "left_anti"), df.join(self.keys, match, "left_semi")


def find_hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> HotKeys | None:
    """All keys with more than ``hot_rows`` rows, or ``None`` if there are none, the usual case.

    The count reads the key column only and is combined map-side; it runs when this is called.
    At most one key in ``hot_rows`` rows can be hot. The list is written once, so that every later
    branch splits by the same set, and none of it passes through the driver.
    """
    listed = stage(
        df.groupBy(F.col(key).alias("_hot"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select("_hot")
    )
    return None if listed.isEmpty() else HotKeys(key, listed)
