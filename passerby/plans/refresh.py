"""The nightly refresh of the days that new probes touch, and the report on all days."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passerby.functions.sizes import broadcast_if_small
from passerby.operators.keyed import delete_keys, of_days, stale_keys, touched_days, upsert
from passerby.operators.recency import visitor_report
from passerby.operators.sessions import flow_daily, indoor_daily, sessionize
from passerby.schemas import DAY_KEYS, SESSION_KEYS, SESSIONS, by_day
from passerby.session import cut_lineage, temporary_tables
from passerby.sources.store import update_store
from passerby.sources.tables import (
    append_probes, is_stored, on_days, read_flow_daily, read_indoor_daily, read_sessions, read_stored_probes,
    touched, write_days,
)


class Refresh(NamedTuple):
    sessions: DataFrame
    indoor_daily: DataFrame
    flow_daily: DataFrame
    tombstones: DataFrame


def refresh_days(history: DataFrame, increment: DataFrame, published: DataFrame,
                 thresholds: DataFrame) -> Refresh:
    """Everything about the touched days, recomputed from history and increment together.

    ``tombstones`` are the keys published for those days that no longer exist.
    Duplicates need no removal first: sessions and flow are the same with them.
    The days and the sessions are computed here, once for all that needs them.
    """
    days = broadcast_if_small(cut_lineage(touched_days(increment)))
    probes = of_days(history, days).unionByName(increment)
    return _recompute(probes, of_days(published, days), thresholds)


def _recompute(probes: DataFrame, published: DataFrame, thresholds: DataFrame) -> Refresh:
    sessions = cut_lineage(sessionize(probes, thresholds))
    return Refresh(
        sessions=sessions,
        indoor_daily=indoor_daily(sessions),
        flow_daily=flow_daily(probes),
        tombstones=stale_keys(published, sessions, SESSION_KEYS),
    )


def publish_refresh(spark: SparkSession, increment: DataFrame, thresholds: DataFrame, root: str,
                    run: str) -> None:
    """Adds an increment to the history under ``root`` and replaces the venue days it touches.

    The tables are t_cf (all probes, each run's own), rec_indoor (sessions),
    indoor and flow; the days and tombstones of a run go to days/<run> and
    tombstones/<run>. After a failure, run the same increment as the same run again.
    """
    append_probes(increment, f"{root}/t_cf", run)
    # From what is stored now, so that the increment is computed once.
    stored = read_stored_probes(spark, f"{root}/t_cf").filter(F.col("run") == run)
    touched_days(stored).write.mode("overwrite").parquet(f"{root}/days/{run}")
    republish_days(spark, spark.read.parquet(f"{root}/days/{run}"), thresholds, root, run)


def republish_days(spark: SparkSession, days: DataFrame, thresholds: DataFrame, root: str,
                   run: str) -> None:
    """Recomputes venue days from the history alone and replaces them.

    Also what repairs a whole day, should the driver be lost while its directory
    is being swapped.
    """
    with temporary_tables(spark):
        history = read_stored_probes(spark, f"{root}/t_cf")
        replaced = touched(days, history)

        def of_these(rows: DataFrame) -> DataFrame:
            return rows.filter(on_days(replaced.rows)).join(replaced.days, DAY_KEYS, "left_semi")

        published = of_these(read_sessions(spark, f"{root}/rec_indoor")) if is_stored(spark, f"{root}/rec_indoor") \
            else spark.createDataFrame([], by_day(SESSIONS))
        fresh = _recompute(of_these(history).drop("run"), published, thresholds)
        fresh.tombstones.write.mode("append").parquet(f"{root}/tombstones/{run}")
        write_days(fresh.sessions, f"{root}/rec_indoor", replaced)
        write_days(fresh.indoor_daily, f"{root}/indoor", replaced)
        write_days(fresh.flow_daily, f"{root}/flow", replaced)


def apply_run(spark: SparkSession, target: DataFrame, root: str, run: str) -> DataFrame:
    """A keyed store of all sessions, brought up to date with one published run.

    Lazy: write it to a new place.
    """
    stale = spark.read.parquet(f"{root}/tombstones/{run}")
    days = broadcast_if_small(spark.read.parquet(f"{root}/days/{run}"))
    sessions = of_days(read_sessions(spark, f"{root}/rec_indoor"), days).select(target.columns)
    return upsert(delete_keys(target, stale), sessions)


def apply_run_in_place(spark: SparkSession, store: str, root: str, run: str) -> list[int]:
    """`apply_run` on a table of `create_store`: only the days with changes are read and written. Returns them."""
    with temporary_tables(spark):
        days = spark.read.parquet(f"{root}/days/{run}")
        replaced = touched(days, read_sessions(spark, f"{root}/rec_indoor"))
        sessions = read_sessions(spark, f"{root}/rec_indoor").filter(on_days(replaced.rows)).join(replaced.days, DAY_KEYS, "left_semi")
        return update_store(spark, store, sessions, spark.read.parquet(f"{root}/tombstones/{run}"))


def daily_report(spark: SparkSession, root: str, as_of_day: int) -> DataFrame:
    """The visitor report over all published days under ``root``."""
    return visitor_report(
        read_flow_daily(spark, f"{root}/flow"), read_indoor_daily(spark, f"{root}/indoor"), as_of_day,
    )
