"""Set operations on keyed rows: merging, stale keys, deletes and upserts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerby.functions.sizes import broadcast_if_small
from passerby.schemas import DAY_KEYS, SESSION_KEYS


def merge_probes(history: DataFrame, increment: DataFrame) -> DataFrame:
    """Both sets of probes, each distinct row once."""
    return history.unionByName(increment).distinct()


def stale_keys(old: DataFrame, new: DataFrame, keys: list[str] = SESSION_KEYS) -> DataFrame:
    """Keys that were published and are no longer there, each once. No key part is null.

    The distinct combines before the shuffle and leaves rows where an anti join on
    plain equality needs them; ``subtract`` compares null-safely and shuffles again.
    """
    return old.select(*keys).distinct().join(new.select(*keys), keys, "left_anti")


def delete_keys(target: DataFrame, stale: DataFrame, keys: list[str] = SESSION_KEYS) -> DataFrame:
    """``target`` without the rows whose key is in ``stale``."""
    return target.join(stale.select(*keys), keys, "left_anti").select(target.columns)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str] = SESSION_KEYS) -> DataFrame:
    """``target`` with every row of ``updates`` in place of the row of the same key.

    ``updates`` holds a key once. Lazy: write the result to a new place, not
    over what it reads.
    """
    return delete_keys(target, updates, keys).unionByName(updates)


def touched_days(increment: DataFrame) -> DataFrame:
    """The venue days that an increment has any probe for."""
    return increment.select(*DAY_KEYS).distinct()


def of_days(df: DataFrame, days: DataFrame, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Rows of ``df`` filed under one of ``days``.

    The days themselves are few, however many venues they have, and are
    broadcast, so of a table stored by day only their partitions are read; their
    range, known when the scan starts, lets the pruning begin.
    """
    first, last = (days.agg(bound("file_day")).scalar() for bound in (F.min, F.max))
    filed = broadcast_if_small(days.select("file_day").distinct())
    rows = df.filter(F.col("file_day").between(first, last)).join(filed, "file_day", "left_semi")
    return rows if keys == ["file_day"] else rows.join(days.select(*keys), keys, "left_semi")
