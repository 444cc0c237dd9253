"""What waits to be processed and what was."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passerby.functions.sizes import broadcast_if_small
from passerby.session import cut_lineage
from passerby.sources.probes import file_entity

MEGABYTE = 1024 * 1024
# Fixed value: the name of the operation in the processing log.
PROCESSED = "0-ProcessincFile"


def _numbered(folders: DataFrame) -> DataFrame:
    """``folders`` with their position in name order and their number, without one task for all.

    The sorted rows are kept on reliable storage: parts counted in one pass and
    numbered in another have to be the same parts.
    """
    parts = cut_lineage(folders.orderBy("folder").withColumn("part", F.spark_partition_id()))
    # One row per part: as many as the sort had tasks.
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"),
        F.sum("rows").over(every).alias("total"),
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy("folder"))
    return parts.withColumn("within", within).join(broadcast_if_small(offsets), "part").withColumn(
        "position", F.col("offset") + F.col("within") - 1
    )


def ingest_backlog(files: DataFrame, groups: int = 6) -> DataFrame:
    """Files, folders with and without files, and megabytes per group of folders.

    ``files``: folder, path, length in bytes; a folder without files is a row
    with a null path. Groups are runs of folders in name order, each
    ``folders div groups + 1`` long.
    """
    folders = files.groupBy("folder").agg(
        F.count("path").alias("files"),
        F.coalesce(F.sum(F.when(F.col("path").isNotNull(), F.col("length"))), F.lit(0)).alias("bytes"),
    )
    size = F.floor(F.col("total") / groups) + 1
    return (
        _numbered(folders)
        .groupBy((F.floor(F.col("position") / size) + 1).cast("int").alias("folder_group"))
        .agg(
            F.sum("files").alias("files"),
            F.count(F.when(F.col("files") > 0, 1)).alias("remaining_folders"),
            F.count(F.when(F.col("files") == 0, 1)).alias("processed_folders"),
            F.floor(F.sum("bytes") / MEGABYTE).cast("bigint").alias("megabytes"),
        )
    )


def probe_files_found(spark: SparkSession, root: str, entities: DataFrame) -> DataFrame:
    """``folder, path, length`` of the probe files under ``root``, and a null path for each venue without any.

    The files are listed by tasks, and of each only path and length are read. A
    venue's folder has its number for a name; one that holds no file cannot be
    found by looking for files, so the venues are joined in. Files without a byte
    are none.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    venue = file_entity(F.col("path")).cast("string")
    found = listing.select(venue.alias("folder"), "path", "length").filter(F.col("folder").isNotNull())
    folders = entities.select(F.col("entityid").cast("string").alias("folder")).distinct()
    return found.join(folders, "folder", "full_outer").select("folder", "path", "length")


def probe_file_name(root: str = "/data") -> Column:
    """The file that holds a venue's probes of a day."""
    date = F.date_format(F.timestamp_seconds(F.col("file_day")), "yyyyMMdd")
    return F.concat(F.lit(f"{root}/t_cf_inc/"), F.col("entityid"), F.lit("/t_cf_"), date, F.lit(".txt"))


def processing_log(probes: DataFrame, processed_at: str, file_name: Column | None = None) -> DataFrame:
    """One row per scanned file: ``operType, processDate, fileName``.

    ``processed_at`` is the time of the run as ``yyyy-MM-dd HH:mm:ss``. The
    writer sorts the rows.
    """
    name = probe_file_name() if file_name is None else file_name
    scanned = probes.select("entityid", "file_day").distinct() if file_name is None \
        else probes.select(name.alias("fileName")).distinct()
    return scanned.select(
        F.lit(PROCESSED).alias("operType"),
        F.lit(processed_at).alias("processDate"),
        (name if file_name is None else F.col("fileName")).alias("fileName"),
    )
