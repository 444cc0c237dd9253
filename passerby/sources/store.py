"""A keyed store of sessions that a run updates in place, day by day and bucket by bucket.

The table is partitioned by the local day on which a session begins, and each
day is bucketed and sorted by the whole key. A run reads and writes the days
that it has changes for, and no others; within them the stored side of the join
is not shuffled, as its files are the buckets.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passerby.functions.time import day_start
from passerby.schemas import SESSION_KEYS, SESSIONS
from passerby.session import delete_folder
from passerby.sources.tables import emptied, on_days

BUCKETS = 16
_DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def _filed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("file_day", day_start(F.col("etime")))


def create_store(sessions: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> None:
    """A new store under ``path``, registered as the table ``name``, with all of ``sessions``; each key is there once."""
    # Dealt out as the buckets are, so that a bucket of a day is one file.
    rows = _filed(sessions.select(*SESSIONS.names)).repartition(buckets, *SESSION_KEYS)
    rows.write.partitionBy("file_day").bucketBy(buckets, *SESSION_KEYS).sortBy(*SESSION_KEYS).option("path", path).saveAsTable(name)


def open_store(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Registers a store that is there already, in a session whose catalog does not know it."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in SESSIONS.fields)
    keys = ", ".join(SESSION_KEYS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, file_day BIGINT) USING parquet PARTITIONED BY (file_day) "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def read_store(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*SESSIONS.names)


def changed_store(store: DataFrame, upserts: DataFrame, deletes: DataFrame) -> DataFrame:
    """The rows of ``store`` with the changes applied; a key that is in both is put in, one put in twice as its longest row."""
    values = [name for name in SESSIONS.names if name not in SESSION_KEYS]
    put = _filed(upserts.select(*SESSIONS.names)).withColumn("gone", F.lit(False))
    changes = put.unionByName(_filed(deletes.select(*SESSION_KEYS)).withColumn("gone", F.lit(True)), allowMissingColumns=True)
    newest = changes.groupBy(*SESSION_KEYS, "file_day").agg(F.max_by(F.struct("gone", *values), F.struct(~F.col("gone"), *values)).alias("change"))
    met = store.join(newest.withColumnRenamed("file_day", "change_day"), SESSION_KEYS, "full_outer")
    # A row that is only stored has no change, one that is only a change no stored day.
    kept = met.filter(F.col("change").isNull() | ~F.col("change.gone"))
    new = F.col("change").isNotNull()
    return kept.select(
        *[F.when(new, F.col(f"change.{name}")).otherwise(F.col(name)).alias(name) if name in values else F.col(name) for name in SESSIONS.names],
        F.coalesce("change_day", "file_day").alias("file_day"))


def update_store(spark: SparkSession, name: str, upserts: DataFrame, deletes: DataFrame) -> list[int]:
    """Applies changes to the store; returns the days that were written again.

    ``upserts`` are stored or computed cheaply, as their days are looked up first;
    of rows with the same key the longest is put in. After a failure apply the
    same changes again.
    """
    days = sorted(row.file_day for row in _filed(upserts.select("etime").unionByName(deletes.select("etime"))).select("file_day").distinct().collect())
    if not days:
        return []
    merged = changed_store(spark.table(name).filter(on_days(days)), upserts, deletes)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type
    folders = {f"{location}/file_day={day}": day for day in days}
    before = spark.conf.get(_DYNAMIC)
    spark.conf.set(_DYNAMIC, "dynamic")
    try:
        with emptied(spark, [*folders]) as gone:
            merged.select(spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(_DYNAMIC, before)
    for folder in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (file_day = {folders[folder]})")
        # A table whose files are not its own keeps them when a partition goes.
        delete_folder(spark, folder)
    return days
