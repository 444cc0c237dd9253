"""The live heat map, from messages to counts per venue and window."""

from pyspark.sql import Column, DataFrame

from passerby.operators.heatmap import zone_heatmap, zone_sketches
from passerby.operators.matching import fresh_as_of
from passerby.sources.feeds import explode_payload, parse_heat_map_feed


def live_heatmap(messages: DataFrame, access_points: DataFrame, mode: str = "matching",
                 now: Column | None = None, max_age: str | None = "5 minutes", sketches: bool = False) -> DataFrame:
    """Approximate zone counts per five minutes of the messages' fresh sightings, or with ``sketches`` what they are estimated from.

    For a sink in update mode. ``now`` stands in for the clock in tests; with
    ``max_age`` None the clock plays no part.
    """
    sightings = parse_heat_map_feed(explode_payload(messages))
    if max_age:
        sightings = fresh_as_of(sightings, "ts", now, max_age)
    if sketches:
        return zone_sketches(sightings, access_points, mode=mode, watermark="5 minutes")
    return zone_heatmap(sightings, access_points, mode=mode, exact=False, watermark="5 minutes")
