"""Distinct devices inside, far from and near each venue per time window."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerby.functions.sizes import join_dimension
from passerby.functions.zones import ZONES, tagged_device, zone_tests


def zone_sightings(sightings: DataFrame, access_points: DataFrame) -> DataFrame:
    """``entityid, mac, ts`` and one boolean per zone, for each venue of the access point."""
    venues = access_points.select(
        "apmac", "entityid", F.col("rssi").alias("inside"), F.col("nearbyrssi").alias("nearby"),
    )
    tests = zone_tests(F.col("rssi"), F.col("inside"), F.col("nearby"))
    return join_dimension(sightings.select("apmac", "mac", "rssi", "ts"), venues, "apmac").select(
        "entityid", "mac", "ts", *[test.alias(zone) for zone, test in tests.items()]
    )


def _devices(mode: str) -> dict[str, Column]:
    """What is counted in each zone; null where a sighting does not count."""
    if mode not in ("matching", "tagged"):
        raise ValueError(f"mode must be 'matching' or 'tagged', not {mode!r}")
    if mode == "tagged":
        return {zone: tagged_device(F.col("mac"), F.col(zone)) for zone in ZONES}
    return {zone: F.when(F.col(zone), F.col("mac")) for zone in ZONES}


def zone_heatmap(sightings: DataFrame, access_points: DataFrame, window: str = "5 minutes",
                 mode: str = "matching", exact: bool = True, watermark: str | None = None,
                 rsd: float = 0.01) -> DataFrame:
    """``entityid, starttime, indoors, aways, visits`` per venue and window.

    ``mode="matching"`` counts the devices seen in a zone. ``"tagged"`` counts
    the distinct pairs of device and whether it matched, so one seen both in
    and out of a zone counts twice. ``exact=False`` estimates the count with
    relative deviation ``rsd`` and is the form that a stream can run.
    """
    if not exact:
        sketches = zone_sketches(sightings, access_points, window, mode, watermark, rsd)
        return sketches.select("entityid", "starttime", *[F.hll_sketch_estimate(zone).alias(zone) for zone in ZONES])
    _devices(mode)
    if watermark is not None:
        sightings = sightings.withWatermark("ts", watermark)
    seen = zone_sightings(sightings, access_points)
    counted = _exact(seen.withColumn("span", F.window("ts", window)), mode)
    return counted.select("entityid", F.col("span.start").alias("starttime"), *ZONES)


def zone_sketches(sightings: DataFrame, access_points: DataFrame, window: str = "5 minutes", mode: str = "matching",
                  watermark: str | None = None, rsd: float = 0.01) -> DataFrame:
    """The heat map as sketches of devices, which can be added up: over hours and days, and over runs.

    Works on a stream. `add_up` reads them.
    """
    devices, size = _devices(mode), _sketch_size(rsd)
    if watermark is not None:
        sightings = sightings.withWatermark("ts", watermark)
    seen = zone_sightings(sightings, access_points)
    return seen.groupBy("entityid", F.window("ts", window).alias("span")).agg(
        *[F.hll_sketch_agg(device, size).alias(zone) for zone, device in devices.items()]
    ).select("entityid", F.col("span.start").alias("starttime"), *ZONES)


def add_up(sketches: DataFrame, unit: str | None = None) -> DataFrame:
    """Devices per venue and ``unit`` of local time, such as ``hour``, ``day`` or ``month``; without it per window.

    A device that was seen in several of the windows, or by several runs of
    one, counts once: the sketches are united and estimated then.
    """
    start = F.col("starttime") if unit is None else F.date_trunc(unit, "starttime")
    return sketches.groupBy("entityid", start.alias("starttime")).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(zone)).alias(zone) for zone in ZONES])


def _sketch_size(rsd: float) -> int:
    """Log2 of the registers that keep the standard error of a HyperLogLog sketch under ``rsd``.

    A sketch of few devices stays a short list, which matters with millions of
    quiet windows; ``approx_count_distinct`` takes all its registers for each. A
    sketch has at most 2**21 registers, so a smaller ``rsd`` cannot be kept.
    """
    size = max(math.ceil(2 * math.log2(1.04 / rsd)), 4)
    if size > 21:
        raise ValueError(f"rsd {rsd} is smaller than a sketch can keep, {1.04 / 2 ** 10.5:.5f}")
    return size


def _exact(seen: DataFrame, mode: str) -> DataFrame:
    """Counts devices by first reducing each to one row, so a busy window is spread by device."""
    hit, missed = "hit_{}".format, "missed_{}".format
    reduced = [F.max(F.col(z).cast("int")).alias(hit(z)) for z in ZONES]
    if mode == "tagged":
        reduced += [F.max((~F.col(z)).cast("int")).alias(missed(z)) for z in ZONES]
    named = F.when(F.col("mac").isNotNull(), 1).otherwise(0)
    per_device = seen.groupBy("entityid", "span", "mac").agg(*reduced)
    return per_device.groupBy("entityid", "span").agg(*[
        F.sum(named * (F.col(hit(z)) + (F.col(missed(z)) if mode == "tagged" else 0))).alias(z)
        for z in ZONES
    ])
