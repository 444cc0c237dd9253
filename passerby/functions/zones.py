"""Signal strength rules. Strength is negative dBm; nearer devices are stronger."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONES = ("indoors", "aways", "visits")


def reaches(rssi: Column, bound: Column, inclusive: bool = False,
            refuse_positive: bool = True) -> Column:
    """Strong enough to count for a venue; a positive strength is a broken reading."""
    strong = rssi >= bound if inclusive else rssi > bound
    return strong & (rssi <= 0) if refuse_positive else strong


def zone_tests(rssi: Column, inside: Column, nearby: Column) -> dict[str, Column]:
    """One boolean per zone, false where the strength is unknown."""
    tests = {
        "indoors": rssi >= inside,
        "aways": rssi < nearby,
        "visits": (rssi >= nearby) & (rssi < inside),
    }
    return {zone: F.coalesce(test, F.lit(False)) for zone, test in tests.items()}


def tagged_device(mac: Column, matches: Column) -> Column:
    return F.concat(mac, F.when(matches, F.lit("|1")).otherwise(F.lit("|0")))
