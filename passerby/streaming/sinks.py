"""Keyed sinks for update-mode streams.

A micro-batch is written once, under its run and its own number, and never
rewrites what earlier ones left: its cost follows the batch and not the table.
Writing a batch again after a failure replaces it. A run is what one checkpoint
feeds: a stream that goes on from its checkpoint goes on with its run, a new
checkpoint begins the next one beside the earlier ones. Readers take the newest
row of each key, by run and batch. `compact` folds closed batches into a table,
so that neither the folders nor what a reader has to take grow without end.
"""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from passerby.operators.keyed import upsert
from passerby.operators.heatmap import add_up
from passerby.schemas import HEAT_MAP, HEAT_MAP_KEYS, HEAT_SKETCHES, LIVE_VISITS, SESSIONS, VISIT_KEYS
from passerby.session import delete_folder, find_paths, list_folder

BatchWriter = Callable[[DataFrame, int], None]
ORDER = ["run", "batch_id"]
_TABLE = "_table"
# What a stream leaves: its layout, and the columns of which the newest row counts.
KINDS = {"visits": (LIVE_VISITS, VISIT_KEYS), "heatmap": (HEAT_MAP, HEAT_MAP_KEYS), "sketches": (HEAT_SKETCHES, [*HEAT_MAP_KEYS, "run"])}


def change_writer(path: str, run: int = 1) -> BatchWriter:
    """For ``foreachBatch``: each micro-batch becomes the partition of its run and number under ``path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={batch_id}")

    return write


def runs(spark: SparkSession, path: str) -> list[int]:
    """The runs that have left anything under ``path``, also in its compacted table."""
    found = {int(name.removeprefix("run=")) for name in list_folder(spark, path) if re.fullmatch(r"run=\d+", name)}
    mark = _mark(spark, path)
    return sorted(found | ({mark[0]} if mark else set()))


def run_of(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The run that ``checkpoint`` feeds under ``path``: its own, or for a new one the next.

    The number lies in the checkpoint. A checkpoint that was begun without one is
    refused, as nothing says which rows under ``path`` are its own.
    """
    known = [name for name in list_folder(spark, checkpoint) if name.startswith("passerby-run=")]
    if known:
        return int(known[0].partition("=")[2])
    if {"offsets", "commits"} & {*list_folder(spark, checkpoint)}:
        raise ValueError(f"{checkpoint} was begun by another writer: name a new one")
    run = max(runs(spark, path), default=0) + 1
    spark.range(0).write.mode("overwrite").parquet(f"{checkpoint}/passerby-run={run}")
    return run


def live_writer(spark: SparkSession, path: str, checkpoint: str) -> BatchWriter:
    """The writer of the run that ``checkpoint`` feeds."""
    return change_writer(path, run_of(spark, path, checkpoint))


def matched_writer(spark: SparkSession, path: str, checkpoint: str, read_history: Callable[[], DataFrame],
                   match: Callable[[DataFrame, DataFrame], DataFrame]) -> BatchWriter:
    """The writer of sightings matched to the access points as ``read_history`` gives them for each micro-batch.

    A dimension that is joined to a stream is read when the stream starts; this
    one is read anew every time. The stream of what is written goes on from
    ``path``, see `read_matched`.
    """
    write = live_writer(spark, path, checkpoint)
    return lambda batch, batch_id: write(match(batch, read_history()), batch_id)


def read_matched(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The stream of what `matched_writer` leaves."""
    return spark.readStream.schema(layout).option("recursiveFileLookup", True).parquet(path)


def jdbc_change_writer(run: int, **options: str) -> BatchWriter:
    """For ``foreachBatch``: appends each micro-batch with its run and number to a database table.

    Repeating a batch repeats equal rows, which readers by newest batch do not notice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
        numbered.write.format("jdbc").mode("append").options(**options).save()

    return write


def newest(changes: DataFrame, keys: list[str], order: list[str] = ORDER) -> DataFrame:
    """The row of each key from the latest run and micro-batch that has one, with both numbers."""
    values = [c for c in changes.columns if c not in keys]
    latest = F.max_by(F.struct(*values), F.struct(*order)).alias("latest")
    return changes.groupBy(*keys).agg(latest).select(*keys, *[f"latest.{c}" for c in values])


def _mark(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Run and number of the last batch in the compacted table."""
    marks = [tuple(map(int, name.split("-"))) for name in list_folder(spark, f"{path}/{_TABLE}")
             if re.fullmatch(r"\d+-\d+", name) and "_SUCCESS" in list_folder(spark, f"{path}/{_TABLE}/{name}")]
    return max(marks, default=None)


def _changes(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The compacted table and all batches after it, with run and batch_id."""
    stored = T.StructType([*layout.fields, T.StructField("run", T.IntegerType()), T.StructField("batch_id", T.LongType())])
    mark = _mark(spark, path)
    rows = spark.createDataFrame([], stored)
    if any(name.startswith("run=") for name in list_folder(spark, path)):
        rows = spark.read.schema(stored).parquet(path)
    if mark is None:
        return rows
    after = (F.col("run") > mark[0]) | ((F.col("run") == mark[0]) & (F.col("batch_id") > mark[1]))
    return rows.filter(after).unionByName(spark.read.schema(stored).parquet(f"{path}/{_TABLE}/{mark[0]}-{mark[1]}"))


def read_live_visits(spark: SparkSession, path: str) -> DataFrame:
    """The visits of the newest run: a run begins with an empty table."""
    last = max(runs(spark, path), default=0)
    return newest(_changes(spark, path, LIVE_VISITS).filter(F.col("run") == last), VISIT_KEYS).drop(*ORDER)


def read_heatmap(spark: SparkSession, path: str) -> DataFrame:
    """The heat map of all runs; a window that several runs counted is as the newest has it."""
    return newest(_changes(spark, path, HEAT_MAP), HEAT_MAP_KEYS).drop(*ORDER)


def read_heatmap_sketches(spark: SparkSession, path: str, unit: str | None = None) -> DataFrame:
    """The heat map added up from stored sketches, by window or by ``unit`` of time.

    Of each run the newest state of a window is taken, and the runs are united:
    a window that several runs counted has the devices of all of them.
    """
    return add_up(newest(_changes(spark, path, HEAT_SKETCHES), [*HEAT_MAP_KEYS, "run"], ["batch_id"]), unit)


def read_closed_visits(spark: SparkSession, path: str) -> DataFrame:
    """The visits that an append-mode stream has closed in its newest run; each comes out once."""
    last = max(runs(spark, path), default=0)
    return _changes(spark, path, SESSIONS).filter(F.col("run") == last).drop(*ORDER)


def fold_changes(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with all changes applied, to be written to a new place."""
    return upsert(target, newest(changes, keys).select(target.columns), keys)


def compact(spark: SparkSession, path: str, kind: str) -> int:
    """Folds the closed batches under ``path`` into its table; ``kind`` is one of `KINDS`. Returns their number.

    Every batch but the newest is closed. A new version of the table is written
    beside the old one, under the number of the last batch in it, which is what
    readers go by. The batches and versions that the version before had replaced
    are deleted, so a reader that began before this one still finds its files.
    """
    layout, keys = KINDS[kind]
    mark = _mark(spark, path)
    finished = (re.search(r"/run=(\d+)/batch_id=(\d+)/_SUCCESS$", found) for found in find_paths(spark, f"{path}/run=*/batch_id=*/_SUCCESS"))
    batches = sorted((int(found[1]), int(found[2])) for found in finished if found)
    closed = [batch for batch in batches[:-1] if mark is None or batch > mark]
    if not closed:
        return 0
    last = closed[-1]
    rows = _changes(spark, path, layout)
    upto = (F.col("run") < last[0]) | ((F.col("run") == last[0]) & (F.col("batch_id") <= last[1]))
    if kind == "visits":
        upto = upto & (F.col("run") == last[0])
    folded = newest(rows.filter(upto), keys, [name for name in ORDER if name not in keys]).repartition(*keys)
    folded.write.mode("overwrite").parquet(f"{path}/{_TABLE}/{last[0]}-{last[1]}")
    if mark is not None:
        for run, number in batches:
            if (run, number) <= mark:
                delete_folder(spark, f"{path}/run={run}/batch_id={number}")
        for name in list_folder(spark, f"{path}/{_TABLE}"):
            if re.fullmatch(r"\d+-\d+", name) and tuple(map(int, name.split("-"))) < mark:
                delete_folder(spark, f"{path}/{_TABLE}/{name}")
    return len(closed)


def start_live(rows: DataFrame, write: BatchWriter, checkpoint: str,
               every: str | None = "30 seconds", mode: str = "update") -> DataStreamWriter:
    """A writer in update mode, or append mode for rows that come out once; ``every`` None takes what is there and stops.

    A new ``checkpoint`` starts from an empty state, and with `live_writer` a new run.
    """
    writer = rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
