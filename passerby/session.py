"""Session settings and the durable cut of a lineage."""

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Live visits hold one open visit per device and venue: keep that off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("passerby")
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    }
    for key, value in {**SETTINGS, **defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; in a local session without one, a new one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="passerby-"))
    return folder or context.getCheckpointDir()


_scopes: list[str] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables that `cut_lineage` writes within are deleted when all has succeeded.

    They lie in one folder of their own; after a failure it stays for a look.
    """
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
    delete_folder(spark, folder)


def run_folder(spark: SparkSession) -> str:
    """A new name for a table or files in the shared folder."""
    return f"{_scopes[-1] if _scopes else shared_folder(spark)}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows as a table in the shared folder: computed once, and every use agrees."""
    path = run_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of whatever store; none if it is not there."""
    system, place = _files(spark, path)
    return sorted(item.getPath().getName() for item in system.listStatus(place)) if system.exists(place) else []


def find_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern with ``*``, by one listing; none if there are none."""
    system, place = _files(spark, pattern)
    return sorted(item.getPath().toUri().getPath() for item in system.globStatus(place) or [])


def delete_folder(spark: SparkSession, path: str) -> None:
    system, place = _files(spark, path)
    system.delete(place, True)
