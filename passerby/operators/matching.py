"""Which venues a sighting belongs to, and which sightings are fresh."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passerby.functions.sizes import join_dimension
from passerby.functions.zones import reaches


def match_access_points(sightings: DataFrame, access_points: DataFrame, inclusive: bool = False,
                        refuse_positive: bool = True) -> DataFrame:
    """Each sighting once for every venue of its access point that it is strong enough for.

    Works on a stream. ``sightings`` has apmac and rssi; the venue's entityid,
    indoor_seconds and leave_seconds are added.
    """
    venues = access_points.select(
        "apmac", F.col("rssi").alias("venue_rssi"), "entityid", "indoor_seconds", "leave_seconds",
    )
    strong = reaches(F.col("rssi"), F.col("venue_rssi"), inclusive, refuse_positive)
    return join_dimension(sightings, venues, "apmac").filter(strong).drop("venue_rssi")


def access_point_history(changes: DataFrame) -> DataFrame:
    """What each access point served in each span of time, from the changes of the dimension.

    ``changes``: the columns of the dimension, ``changed_at`` in epoch seconds,
    and ``removed``, true where the access point stopped serving the venue. The
    result has valid_from and valid_to, null while it still holds. Of several
    changes in one second the removal comes first, so a move within a second counts.
    """
    pair = Window.partitionBy("apmac", "entityid").orderBy("changed_at", F.desc("removed"))
    spans = changes.withColumn("valid_to", F.lead("changed_at").over(pair)).withColumnRenamed("changed_at", "valid_from")
    return spans.filter(~F.col("removed") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))).drop("removed")


def match_as_of(sightings: DataFrame, history: DataFrame, time: str = "stime", inclusive: bool = False,
                refuse_positive: bool = True) -> DataFrame:
    """`match_access_points` with the dimension as it was in the second of each sighting.

    An equality join by access point, in which only the span that holds the
    second is left: neither sorted nor a range join, so an access point with a
    large share of all sightings is no one task's. Works on a stream.
    """
    venues = history.select("apmac", F.col("rssi").alias("venue_rssi"), "entityid", "indoor_seconds", "leave_seconds", "valid_from", "valid_to")
    strong = reaches(F.col("rssi"), F.col("venue_rssi"), inclusive, refuse_positive)
    seen = F.col(time)
    holds = (F.col("valid_from") <= seen) & (F.col("valid_to").isNull() | (seen < F.col("valid_to")))
    return join_dimension(sightings, venues, "apmac").filter(holds & strong).drop("venue_rssi", "valid_from", "valid_to")


def latest_sighting(matched: DataFrame) -> DataFrame:
    """The newest time each device was matched to each venue."""
    return matched.groupBy("mac", "entityid", "indoor_seconds", "leave_seconds").agg(
        F.max("stime").alias("updatingtime")
    )


def fresh_sightings(df: DataFrame, event: str, arrival: str,
                    max_delay: str = "5 minutes") -> DataFrame:
    """Rows that arrived less than ``max_delay`` after they happened. Works on a stream."""
    return df.filter(F.col(event) + F.expr(f"INTERVAL {max_delay}") > F.col(arrival))


def fresh_as_of(df: DataFrame, event: str, now: Column | None = None,
                max_age: str = "5 minutes") -> DataFrame:
    """Rows of the last ``max_age`` before ``now``, both ends excluded. Works on a stream.

    Without ``now`` it is the clock, which a stream reads once per micro-batch.
    """
    now = F.current_timestamp() if now is None else now
    return df.filter((F.col(event) < now) & (F.col(event) > now - F.expr(f"INTERVAL {max_age}")))
