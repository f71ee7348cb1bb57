"""Where layers live, and shared space for intermediate tables."""

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Layer names and their folders below the storage root.
LAYERS = {
    "raw": "Data/raw",
    "processed": "Data/processed/processed_data",
    "gold_alerts": "Data/gold_alerts",
}
# Our own: each product's newest days, and partial daily rows by batch.
LAYERS |= {"last_days": "Data/processed/last_days", "partials": "Data/processed/partials"}


def layer_path(root: str, layer: str, layers: dict[str, str] = LAYERS) -> str:
    """Folder of a layer; ``root`` is any URI Spark can write to."""
    if layer not in layers:
        raise ValueError(f"unknown layer {layer!r}; known are {sorted(layers)}")
    if not layers[layer].strip("/"):
        raise ValueError(f"layer {layer!r} has no folder")
    return f"{root.rstrip('/')}/{layers[layer].strip('/')}/"


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds anything but markers and leftovers of unfinished writes."""
    entries = spark._jvm.org.apache.hadoop.fs.Path(path, "[^_.]*")
    found = entries.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(entries)
    return found is not None and len(found) > 0


def partition_folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Folders of the partitions by ``column``, but for that of NULL; their files are not listed."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path, f"{column}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    folders = [str(status.getPath().toString()) for status in found or []]
    return [f for f in folders if not f.endswith("=__HIVE_DEFAULT_PARTITION__")]


def scratch_path(spark: SparkSession) -> str:
    """A new folder in the shared space named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="pricetide-")
    return f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all in it; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_open = threading.local()


class StageScope:
    """Owns the tables staged while it is open, in this thread, and deletes them when it closes.

        with StageScope(spark) as scope:
            ...                        # stage() as often as needed
            return scope.result(df)    # written once more, for whoever opened the scope around

    A failure deletes them too. Only ``result`` outlives the scope: it belongs to the next scope
    outside, or to the caller. ``hand_over`` leaves all tables to the caller, who calls ``release`` after the last read.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []
        self._handed = False

    def __enter__(self) -> "StageScope":
        _open.scopes = [*getattr(_open, "scopes", []), self]
        return self

    def __exit__(self, kind, error, trace) -> None:
        _open.scopes = [s for s in _open.scopes if s is not self]
        if kind is not None or not self._handed:
            self.release()

    def result(self, df: DataFrame) -> DataFrame:
        inside = _open.scopes
        _open.scopes = inside[: inside.index(self)]
        try:
            return stage(df)
        finally:
            _open.scopes = inside

    def hand_over(self) -> "StageScope":
        self._handed = True
        return self

    def release(self) -> None:
        while self.folders:
            delete_folder(self.spark, self.folders.pop())


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of what is executed inside as soon as each execution ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to shared space once and read it back.

    Later steps then share one result that survives the loss of executors, has exact
    file sizes for join planning, and no longer depends on the tables it came from.
    Inside a `StageScope` the table is deleted when the scope closes. The shuffle files behind it are deleted when
    it is written, since nothing reads them again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession)
    scopes = getattr(_open, "scopes", [])
    if scopes:
        scopes[-1].folders.append(path)
    with _shuffles_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
