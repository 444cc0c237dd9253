"""Venue thresholds and the access-point dimension."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a threshold of 0 stands for.
DEFAULT_INDOOR_SECONDS = 10
DEFAULT_LEAVE_SECONDS = 300


def indoor_seconds(threshold: Column) -> Column:
    """Shortest stay that counts, in seconds; 0 and null mean the default."""
    unset = F.coalesce(threshold, F.lit(0)) == 0
    return F.when(unset, F.lit(DEFAULT_INDOOR_SECONDS)).otherwise(threshold).cast("bigint")


def leave_seconds(threshold: Column) -> Column:
    """Absence that ends a stay: given in minutes, returned in seconds; 0 and null mean the default."""
    unset = F.coalesce(threshold, F.lit(0)) == 0
    return F.when(unset, F.lit(DEFAULT_LEAVE_SECONDS)).otherwise(threshold * 60).cast("bigint")


def entity_thresholds(entities: DataFrame) -> DataFrame:
    """``entityid, indoor_threshold (s), leave_threshold (min)`` to usable seconds."""
    return entities.select(
        F.col("entityid").cast("int").alias("entityid"),
        indoor_seconds(F.col("indoor_threshold")).alias("indoor_seconds"),
        leave_seconds(F.col("leave_threshold")).alias("leave_seconds"),
    )


def ap_dimension(tvbox: DataFrame, tvbox_ap_rel: DataFrame, tentity: DataFrame,
                 tentity_vbox_rel: DataFrame) -> DataFrame:
    """One row per access point and venue it serves, of live boxes, links and venues.

    ``tvbox``: id, indoorrssi, flag and, where the heat map is wanted, nearbyrssi;
    ``tvbox_ap_rel``: vboxid, apmac, flag; ``tentity``: id, indoor_threshold,
    leave_threshold, flags; ``tentity_vbox_rel``: entityid, vboxid.
    """
    bounds = [F.col("indoorrssi").cast("int").alias("rssi")]
    if "nearbyrssi" in tvbox.columns:
        bounds.append(F.col("nearbyrssi").cast("int").alias("nearbyrssi"))
    boxes = tvbox.filter(F.col("flag") < 90).select(F.col("id").alias("vboxid"), *bounds)
    links = tvbox_ap_rel.filter(F.col("flag") == 1).select("vboxid", F.upper("apmac").alias("apmac"))
    venues = tentity.filter(F.col("flags") < 90).withColumnRenamed("id", "entityid")
    return (
        links.join(boxes, "vboxid")
        .join(tentity_vbox_rel.select("entityid", "vboxid"), "vboxid")
        .join(entity_thresholds(venues), "entityid")
        .select(
            F.col("entityid").cast("int").alias("entityid"),
            *[c for c in ("rssi", "nearbyrssi") if c in boxes.columns],
            "apmac", "indoor_seconds", "leave_seconds",
        )
        .distinct()
    )
