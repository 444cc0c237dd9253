"""Probe files: one per venue and day, named by their path."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passerby.functions.text import whole_number
from passerby.functions.time import month_start
from passerby.session import cut_lineage

# Fixed values: <root>/<entity>/t_cf_<yyyyMMdd>.txt; as partitions that Spark wrote, <root>/entityid=<entity>/t_cf=<yyyyMMdd>/<file>
_FILE = r"/(?:entityid=)?(\d+)/t_cf(?:_(?=\d{8}\.)|=(?=\d{8}/))(\d{8})[./][^/]*$"
_TEXT = "clientmac string, stime string, flag string"


def _path_part(path: Column, group: int) -> Column:
    part = F.regexp_extract(path, _FILE, group)
    return F.when(part != "", part)


def file_entity(path: Column) -> Column:
    return whole_number(_path_part(path, 1), "int")


def file_day(path: Column) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(_path_part(path, 2), F.lit("yyyyMMdd")))


def read_probes(spark: SparkSession, path: str, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Probes under ``path`` with the venue, day and month of their file, and the rejects.

    A line gives clientmac, stime and flag; further fields are ignored. A line
    short of one, with a bad number, or in a file of another name, is a reject.
    ``once`` keeps the parsed lines as a table, so that the text is parsed once
    for both.
    """
    typed = _typed(spark.read.schema(_TEXT).option("quote", "").option("recursiveFileLookup", True).csv(path))
    typed = cut_lineage(typed) if once else typed
    return good_probes(typed), bad_probes(typed)


def stream_probe_files(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """The lines of the probe files under ``path`` as a stream that takes each file once, typed, for `good_probes` and `bad_probes`."""
    lines = spark.readStream.schema(_TEXT).options(quote="", recursiveFileLookup=True, maxFilesPerTrigger=files_per_batch).csv(path)
    return _typed(lines)


def _typed(lines: DataFrame) -> DataFrame:
    return lines.select(
        "clientmac", F.col("stime").alias("raw_stime"), F.col("flag").alias("raw_flag"),
        F.col("_metadata.file_path").alias("file_path"),
    ).withColumns({
        "entityid": file_entity(F.col("file_path")),
        "file_day": file_day(F.col("file_path")),
        "stime": whole_number(F.col("raw_stime"), "bigint"),
        "flag": whole_number(F.col("raw_flag"), "int"),
    })


def _is_good() -> Column:
    good = F.lit(True)
    for required in ("clientmac", "stime", "flag", "entityid", "file_day"):
        good = good & F.col(required).isNotNull()
    return good


def good_probes(typed: DataFrame) -> DataFrame:
    return typed.filter(_is_good()).select(
        "entityid", "file_day", month_start(F.col("file_day")).alias("ufirstday"),
        "clientmac", "stime", "flag", "file_path",
    )


def bad_probes(typed: DataFrame) -> DataFrame:
    return typed.filter(~_is_good()).select("file_path", "clientmac", "raw_stime", "raw_flag")

