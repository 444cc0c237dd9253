"""Gap sessions: a stay ends when a device is not seen for the venue's leave time.

All forms share one shape. Sightings of a device that fall into one slot no
longer than the leave time can never be parted by it, so they are first folded
to the slot's first and last second. That is a plain aggregation: it combines
before the shuffle, ignores duplicates, and spreads a device that holds a large
share of all rows over its slots. Only the slots, whose number is bounded by
time span over leave time and not by the number of sightings, go through the
window that finds the gaps.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passerby.functions.sizes import is_small, join_dimension
from passerby.functions.time import day_start, month_start, within_day
from passerby.operators.dimensions import DEFAULT_INDOOR_SECONDS, DEFAULT_LEAVE_SECONDS

# Visits fold sightings to slots of at most this length.
SLOT_SECONDS = 60


def _stays(sightings: DataFrame, keys: list[str], slot: Column, strict_gap: bool) -> DataFrame:
    """Stays by ``keys``, numbered in time order in ``stay``.

    ``sightings`` has ``stime`` and ``leave_seconds``; ``slot`` must not exceed
    the leave time of any sighting with the same keys.
    """
    seen, leave = F.col("stime"), F.col("leave_seconds")
    slots = (
        sightings.filter(seen.isNotNull())
        .groupBy(*keys, "leave_seconds", (seen - F.pmod(seen, slot)).alias("slot"))
        .agg(F.min("stime").alias("first"), F.max("stime").alias("last"))
    )
    in_order = Window.partitionBy(*keys).orderBy("first", "leave_seconds")
    until_now = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    absent = F.col("first") - F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    parted = absent > leave if strict_gap else (absent >= leave) & (absent > 0)
    begins = F.when(absent.isNull() | parted, 1).otherwise(0)
    return (
        slots.withColumn("begins", begins)
        .withColumn("stay", F.sum("begins").over(until_now))
        .groupBy(*keys, "stay")
        .agg(F.min("first").alias("etime"), F.max("last").alias("ltime"))
        .withColumn("seconds", F.col("ltime") - F.col("etime"))
    )


def _with_threshold(rows: DataFrame, thresholds: DataFrame, small: bool, name: str,
                    default: int) -> DataFrame:
    """Each row with one of its venue's thresholds; an unknown venue has the default."""
    joined = join_dimension(rows, thresholds.select("entityid", name), "entityid", "left", small)
    return joined.withColumn(name, F.coalesce(name, F.lit(default).cast("bigint")))


def sessionize(probes: DataFrame, thresholds: DataFrame, edges: str = "keep",
               strict_gap: bool = False, day_scoped: bool = True,
               min_seconds: str | int | None = "threshold") -> DataFrame:
    """Indoor sessions of the probes with flag 1.

    ``edges="drop"`` leaves out the first and the last stay of each device's
    day, valid or not. ``strict_gap`` ends a stay only after more than the leave
    time. ``day_scoped`` looks at each filed day by itself and keeps the stays
    that begin strictly inside it. ``min_seconds`` is the shortest stay kept: a
    number, None for no limit, or each venue's threshold.
    """
    if edges not in ("keep", "drop"):
        raise ValueError(f"edges must be 'keep' or 'drop', not {edges!r}")
    keys = ["entityid", "clientmac"] + (["file_day"] if day_scoped else [])
    small = is_small(thresholds)
    indoor = probes.filter(F.col("flag") == 1) if "flag" in probes.columns else probes
    slot = F.greatest(F.col("leave_seconds") + int(strict_gap), F.lit(1))
    timed = _with_threshold(indoor, thresholds, small, "leave_seconds", DEFAULT_LEAVE_SECONDS)
    stays = _stays(timed, keys, slot, strict_gap)
    if edges == "drop":
        last = F.max("stay").over(Window.partitionBy(*keys))
        stays = stays.withColumn("last", last).filter(
            (F.col("stay") > 1) & (F.col("stay") < F.col("last"))
        )
    stays = stays.filter(F.col("ltime") > 0)
    if min_seconds == "threshold":
        stays = _with_threshold(
            stays, thresholds, small, "indoor_seconds", DEFAULT_INDOOR_SECONDS)
        stays = stays.filter(F.col("seconds") >= F.col("indoor_seconds"))
    elif min_seconds is not None:
        stays = stays.filter(F.col("seconds") >= min_seconds)
    if day_scoped:
        stays = stays.filter(within_day(F.col("etime"), F.col("file_day")))
    return stays.select("clientmac", "entityid", "etime", "ltime", "seconds", *keys[2:])


def indoor_daily(sessions: DataFrame) -> DataFrame:
    """One row per device, venue and day of the sessions filed under each day."""
    return (
        sessions.groupBy("entityid", "clientmac", "file_day", day_start(F.col("etime")).alias("utoday"))
        .agg(
            F.min("etime").alias("etime"),
            F.max("ltime").alias("ltime"),
            F.sum("seconds").alias("seconds"),
        )
        .select("clientmac", "entityid", "etime", "ltime", "seconds", "utoday",
                month_start(F.col("file_day")).alias("ufirstday"), "file_day")
    )


def flow_daily(probes: DataFrame) -> DataFrame:
    """First and last sighting of each device per venue and day, near or far."""
    return (
        probes.filter(within_day(F.col("stime"), F.col("file_day")))
        .groupBy("entityid", "clientmac", "file_day")
        .agg(F.min("stime").alias("etime"), F.max("stime").alias("ltime"))
        .select("clientmac", "entityid", "etime", "ltime",
                day_start(F.col("etime")).alias("utoday"),
                month_start(F.col("file_day")).alias("ufirstday"), "file_day")
    )


def known_sightings(sightings: DataFrame) -> DataFrame:
    """Sightings with venue, device and time; where the leave time is null it is the default one."""
    return sightings.dropna(subset=["entityid", "clientmac", "stime"]).withColumn(
        "leave_seconds", F.coalesce(F.col("leave_seconds").cast("bigint"), F.lit(DEFAULT_LEAVE_SECONDS).cast("bigint")))


def _visits(sightings: DataFrame, strict_gap: bool) -> DataFrame:
    """Stays over all time, with ``done`` 0 for the last, still open, one of each key."""
    keys = ["entityid", "clientmac"]
    timed = known_sightings(sightings).select(*keys, "stime", "leave_seconds")
    # No longer than the shortest leave time there is, known when the query runs.
    shortest = timed.agg(F.min("leave_seconds")).scalar()
    slot = F.greatest(F.least(F.lit(SLOT_SECONDS).cast("bigint"), shortest), F.lit(1).cast("bigint"))
    stays = _stays(timed, keys, slot, strict_gap)
    still_open = F.col("stay") == F.max("stay").over(Window.partitionBy(*keys))
    return stays.withColumn("done", F.when(still_open, 0).otherwise(1))


def _ended(visits: DataFrame, sightings: DataFrame, as_of: Column | int) -> DataFrame:
    """Visits as a clock at ``as_of`` has them: the last of a key is done too once its leave time is over.

    That leave time is the one of the visit's last sighting.
    """
    keys = ["entityid", "clientmac", "stime"]
    last = known_sightings(sightings).select(*keys, "leave_seconds").join(
        visits.filter(F.col("done") == 0).select("entityid", "clientmac", F.col("ltime").alias("stime")).distinct(), keys, "left_semi")
    leave = last.groupBy(*keys).agg(F.min("leave_seconds").alias("leave_seconds")).withColumnRenamed("stime", "ltime")
    over = F.col("ltime") + F.col("leave_seconds") <= as_of
    return visits.join(leave, ["entityid", "clientmac", "ltime"], "left").withColumn(
        "done", F.when((F.col("done") == 1) | over, 1).otherwise(0)).drop("leave_seconds")


def live_visits_batch(sightings: DataFrame, as_of: Column | int | None = None) -> DataFrame:
    """The visits that the live feed leaves behind, from time-ordered sightings.

    ``sightings``: entityid, clientmac, stime, leave_seconds, of any length; a
    null one is the default. With ``as_of``, epoch seconds, visits whose leave
    time is over by then are done though the device has not come back.
    """
    visits = _visits(sightings, False)
    return (visits if as_of is None else _ended(visits, sightings, as_of)).select(
        "clientmac", "entityid", "etime", "ltime", "seconds", "done"
    )


def closed_visits(sightings: DataFrame, floor_seconds: int = 5, as_of: Column | int | None = None) -> DataFrame:
    """Finished visits only, ended by more than the leave time.

    A visit of a single moment counts as ``floor_seconds``. With ``as_of``,
    epoch seconds, those whose leave time is over by then are finished too.
    """
    length = F.when(F.col("etime") == F.col("ltime"), F.lit(floor_seconds)).otherwise(F.col("seconds"))
    visits = _visits(sightings, True)
    return (
        (visits if as_of is None else _ended(visits, sightings, as_of))
        .filter(F.col("done") == 1)
        .select("clientmac", "entityid", "etime", "ltime", length.cast("bigint").alias("seconds"))
    )


def closed_visits_windowed(sightings: DataFrame, delay: str = "10 minutes", strict_gap: bool = True, floor_seconds: int = 5) -> DataFrame:
    """Finished visits by session windows, for a stream in append mode.

    A window is as long as the leave time of each of its sightings reaches, and
    comes out once, when the watermark, ``delay`` behind the newest sighting, has
    passed its end; then its state is gone. Nothing of it leaves the JVM. With
    ``strict_gap`` a visit ends by more than the leave time, else by the leave
    time itself, a microsecond less of a window. Of sightings with different
    leave times it is the earlier one's that counts.

    Let ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
    be true, so that a busy device is folded before the shuffle.
    """
    least = 1e-6
    gap = F.greatest(F.col("leave_seconds").cast("double") - (0 if strict_gap else least), F.lit(least))
    seen = known_sightings(sightings).withColumn("seen", F.timestamp_seconds("stime")).withWatermark("seen", delay)
    span = F.session_window("seen", F.make_interval(secs=gap.cast("decimal(18,6)")))
    length = F.col("ltime") - F.col("etime")
    return (
        seen.groupBy("entityid", "clientmac", span.alias("span"))
        .agg(F.min("stime").alias("etime"), F.max("stime").alias("ltime"))
        .select("clientmac", "entityid", "etime", "ltime", F.when(length == 0, F.lit(floor_seconds).cast("bigint")).otherwise(length).alias("seconds"))
    )
