"""Broadcasting only what has been counted."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSION_ROWS = 100_000
DIMENSION_BYTES = 64 << 20
SALTS = 16
BUSY_SHARE = 0.02


def measured_bytes(rows: DataFrame) -> tuple[int, int]:
    """Number and bytes of ``rows``, summed within each task before one row of sums goes on."""
    width = F.lit(16 + 8 * len(rows.columns)).cast("long")
    for field in rows.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
            width = width + 8 * F.greatest(F.size(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return n, size


def is_small(dimension: DataFrame, max_rows: int | None = None) -> bool:
    """Whether there are at most ``max_rows`` rows, by default `DIMENSION_ROWS`, and `DIMENSION_BYTES`.

    No row is moved for it: every task counts its own.
    """
    if dimension.isStreaming:
        return False
    n, size = measured_bytes(dimension)
    return n <= (DIMENSION_ROWS if max_rows is None else max_rows) and size <= DIMENSION_BYTES


def broadcast_if_small(dimension: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``dimension`` with a broadcast hint when its measured size proves it small.

    A larger one comes back as it was: Spark then shuffles both sides, and
    adaptive execution splits the partitions of a hot key.
    """
    return F.broadcast(dimension) if is_small(dimension, max_rows) else dimension


def busy_keys(rows: DataFrame, key: str, share: float = BUSY_SHARE) -> DataFrame:
    """The values of ``key`` that hold more than ``share`` of all rows: at most 1 / ``share`` of them."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*")).scalar()
    return counts.filter(F.col("n") > share * total).select(key)


def _salted_join(rows: DataFrame, dimension: DataFrame, key: str, how: str) -> DataFrame:
    """Each row of ``dimension`` once per salt; ``rows`` by the salt of the input partition they come from.

    That is the same when a lost task runs again.
    """
    salted = rows.withColumn("salt", F.spark_partition_id() % SALTS)
    repeated = dimension.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return salted.join(repeated, [key, "salt"], how).drop("salt")


def join_dimension(rows: DataFrame, dimension: DataFrame, key: str, how: str = "inner",
                   small: bool | None = None) -> DataFrame:
    """``rows`` with the columns of ``dimension``, however large and however skewed ``key`` is.

    A small dimension is broadcast. Of a large one only the rows of the few busy
    keys are repeated over salts; all other rows meet it in one plain join. The
    rows of a stream cannot be counted first, so all of them are salted.
    """
    if is_small(dimension) if small is None else small:
        return rows.join(F.broadcast(dimension), key, how)
    if rows.isStreaming:
        return _salted_join(rows, dimension, key, how)
    named = [row[0] for row in busy_keys(rows, key).collect()]
    if not named:
        return rows.join(dimension, key, how)
    busy = F.coalesce(F.col(key).isin(named), F.lit(False))
    others = rows.filter(~busy).join(dimension.filter(~busy), key, how)
    return others.unionByName(_salted_join(rows.filter(busy), dimension.filter(busy), key, how))
