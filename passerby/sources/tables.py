"""Readers and writers of stored tables.

Tables are partitioned by file_day and part of the day. A day with few rows is
one part; one with many is cut into as many parts as its rows ask for, by a hash
of the venue, when it is first written. So a venue's day is replaced without the
rest of a large day being read, and small days are not small files by the dozen.
"""

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby import schemas
from passerby.functions.sizes import broadcast_if_small
from passerby.operators.keyed import delete_keys, touched_days
from passerby.session import cut_lineage, delete_folder, list_folder

# A day is cut into parts of about so many of its rows, and into so many parts at most.
PART_ROWS = 4_000_000
MOST_PARTS = 4096


class Touched(NamedTuple):
    """Venue days to be replaced, with a broadcast hint if they are few, and the rows of each of their days."""

    days: DataFrame
    rows: dict[int, int]


def touched(days: DataFrame, rows: DataFrame) -> Touched:
    """Venue days, and how many of ``rows`` each of their days has: one number for every day."""
    days = broadcast_if_small(touched_days(days))
    counts = {row.file_day: 0 for row in days.select("file_day").distinct().collect()}
    counts |= {row.file_day: row["count"] for row in rows.filter(on_days(counts)).groupBy("file_day").count().collect()}
    return Touched(days, counts)


def on_days(days: Iterable[int]) -> Column:
    """Filed on one of some days: a list that the scan is pruned by."""
    return F.col("file_day").isin(sorted(days))


def _part(entityid: str, cuts: dict[int, int]) -> Column:
    """The part of its day that a venue's rows lie in.

    The parts of a day cut into n, a power of two, are numbered from n on, so a
    part's number says how its day is cut.
    """
    cut = F.lit(1)
    for n in sorted({*cuts.values()} - {1}):
        cut = F.when(on_days(day for day, own in cuts.items() if own == n), n).otherwise(cut)
    return (cut + F.pmod(F.hash(entityid), cut)).cast("int")


def _cut(rows: int) -> int:
    wanted = max(1, -(-rows // PART_ROWS))
    return min(1 << (wanted - 1).bit_length(), MOST_PARTS)


def _stored_cuts(spark: SparkSession, path: str, days: Iterable[int]) -> dict[int, int]:
    """How the stored ones of some days are cut."""
    there = {*list_folder(spark, path)} & {f"file_day={day}" for day in days}
    names = {int(day.partition("=")[2]): list_folder(spark, f"{path}/{day}") for day in there}
    parts = {day: [int(name.partition("=")[2]) for name in own if name.startswith("part=")] for day, own in names.items()}
    return {day: 1 << (max(own).bit_length() - 1) for day, own in parts.items() if own}


def _read(spark: SparkSession, path: str, fmt: str, layout: T.StructType) -> DataFrame:
    if fmt == "csv":
        rows = spark.read.schema(layout).option("recursiveFileLookup", True).csv(path)
    else:
        rows = spark.read.schema(schemas.by_day(layout)).format(fmt).load(path)
    return rows.drop("part")


def read_indoor_daily(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, schemas.INDOOR_DAILY)


def read_flow_daily(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, schemas.FLOW_DAILY)


def read_sessions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Published sessions; filter on entityid and file_day to read those days alone."""
    return _read(spark, path, fmt, schemas.SESSIONS)


def read_stored_probes(spark: SparkSession, path: str) -> DataFrame:
    """All probes that `append_probes` stored, with the repeats between runs."""
    return _read(spark, path, "parquet", schemas.PROBES)


def append_probes(increment: DataFrame, path: str, run: str) -> None:
    """Adds the probes of a run to the history; the same run again replaces its own."""
    rows = increment.select("entityid", "file_day", "clientmac", "stime", "flag")
    _replace_partitions(rows.withColumn("run", F.lit(run)), path, ["file_day", "run"], "parquet")


def read_dim(spark: SparkSession, fmt: str = "jdbc", **options) -> DataFrame:
    """A dimension from wherever ``options`` point to.

    For JDBC, ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` split the read. Driver, address and credentials are the
    caller's to give.
    """
    return spark.read.format(fmt).options(**options).load()


def _replace_partitions(df: DataFrame, path: str, partitions: list[str], fmt: str) -> None:
    """Dynamic overwrite; adaptive execution merges small partitions and splits one that is most."""
    (
        df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, "entityid")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).format(fmt).save(path)
    )


def is_stored(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.schema("file_day long").format(fmt).load(path)
        return True
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def write_days(df: DataFrame, path: str, processed: DataFrame | Touched | None = None, fmt: str = "parquet") -> None:
    """Replaces the venue days that ``processed`` names, by default those ``df`` has rows for.

    Only the parts that these venues fall into are read and written again: the
    stored rows of other venues in them are set aside and written with the new
    ones. A part that comes out empty is deleted. ``df`` has no rows outside
    ``processed``. After a failure in between, write the same days again.
    """
    spark = df.sparkSession
    replaced = processed if isinstance(processed, Touched) else touched(df if processed is None else processed, df)
    stored_cuts = _stored_cuts(spark, path, replaced.rows)
    cuts = {day: stored_cuts.get(day) or _cut(n) for day, n in replaced.rows.items()}
    part = _part("entityid", cuts)
    rows = df.withColumn("part", part)
    if not stored_cuts:
        _replace_partitions(rows, path, ["file_day", "part"], fmt)
        return
    parts = replaced.days.filter(on_days(stored_cuts)).select("file_day", part.alias("part")).distinct().collect()
    stored = spark.read.schema(rows.schema).format(fmt).load(path).filter(on_days(stored_cuts))
    if any(cut > 1 for cut in stored_cuts.values()):
        stored = stored.join(broadcast_if_small(spark.createDataFrame(parts, "file_day long, part int")), ["file_day", "part"], "left_semi")
    rows = rows.unionByName(cut_lineage(delete_keys(stored, replaced.days, schemas.DAY_KEYS)))
    folders = [f"{path}/file_day={row.file_day}/part={row.part}" for row in parts]
    with emptied(spark, folders) as gone:
        _replace_partitions(rows, path, ["file_day", "part"], fmt)
    for folder in gone:
        delete_folder(spark, folder)


@contextmanager
def emptied(spark: SparkSession, folders: list[str]) -> Iterator[list[str]]:
    """Those of the ``folders`` that the write within has not replaced, in the list that is given.

    A partition that is overwritten has files of other names; one that came out
    empty keeps the old ones.
    """
    before, gone = {folder: list_folder(spark, folder) for folder in folders}, []
    yield gone
    gone += [folder for folder, names in before.items() if names and list_folder(spark, folder) == names]


def write_new(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Writes to a place that must not exist yet, such as the result of an upsert."""
    df.write.mode("errorifexists").format(fmt).save(path)


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Drops and rebuilds a managed table."""
    writer: DataFrameWriter = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def write_report(report: DataFrame, path: str, row_group: int = 8 << 20) -> None:
    """The report laid out for look-ups: in ranges of venue and device, sorted within, in small row groups.

    The ranges bound the files, the sort the row groups, and a Bloom filter of
    the devices spares a row group whose range has a device but not its rows.
    """
    (
        report.repartitionByRange("entityid", "clientmac").sortWithinPartitions("entityid", "clientmac", "utoday")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#clientmac", True)
        .option("parquet.bloom.filter.max.bytes", 1 << 16)
        .option("parquet.block.size", row_group)
        .option("parquet.block.row.count.limit", max(1_000, row_group // 100))
        .parquet(path)
    )


def visitor_rows(spark: SparkSession, path: str, entityid: int, clientmac: str) -> DataFrame:
    """One visitor's rows of a report that `write_report` has laid out."""
    return spark.read.parquet(path).filter((F.col("entityid") == entityid) & (F.col("clientmac") == clientmac))


def read_processing_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("operType string, processDate string, fileName string").json(path)


def write_processing_log(log: DataFrame, path: str) -> None:
    """JSON sorted by operation and time: one file unless there is more than one can take."""
    log.orderBy("operType", "processDate").write.mode("overwrite").json(path)
