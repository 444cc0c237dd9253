"""Message feeds: one message holds many lines, a line holds comma-separated fields."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passerby.functions.text import whole_number

# Field positions of the feeds, counted from 0.
RAW_FEED = {"apmac": 1, "mac": 2, "rssi": 3, "ttime": 4, "updatingtime": 5}
HEAT_MAP_FEED = {"apmac": 2, "mac": 3, "rssi": 4, "stime": 5}
MATCHED_FEED = {"entityid": 1, "mac": 2, "updatingtime": 3, "leave_seconds": 5}
# Fixed value: how feeds write a time.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_stream(spark: SparkSession, fmt: str = "kafka", schema=None, **options) -> DataFrame:
    """A stream of messages, such as Kafka with ``startingOffsets="latest"``.

    ``options`` are those of the source, with a path under ``path``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def explode_payload(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per line of each message, in ``value``. Works on a stream."""
    lines = F.explode(F.split(F.col(value).cast("string"), "\n"))
    return df.select(lines.alias(value))


def parse_fields(df: DataFrame, positions: dict[str, int], types: dict[str, str] | None = None,
                 upper: tuple[str, ...] = (), value: str = "value", keep: bool = False) -> DataFrame:
    """Named fields of each line, trimmed. Works on a stream.

    ``types`` names those that are whole numbers or timestamps; a field that is missing or does
    not convert is null. ``upper`` names those to put in upper case. ``keep`` keeps the line itself.
    """
    def field(name: str):
        text = F.trim(F.get("parts", F.lit(positions[name])))
        if name in upper:
            text = F.upper(text)
        if types and name in types:
            kind = types[name]
            text = F.try_to_timestamp(text, F.lit(TIME_FORMAT)) if kind == "timestamp" \
                else whole_number(text, kind)
        return text.alias(name)

    return df.select(F.split(F.col(value), ",").alias("parts"), F.col(value)).select(
        *[field(name) for name in positions], *([value] if keep else [])
    )


# For each feed its fields, their types, those in upper case, and those without which a line is a reject.
_FEEDS = {
    "raw": (RAW_FEED, {"rssi": "int", "updatingtime": "timestamp"}, ("apmac", "mac"),
            ("apmac", "mac", "rssi", "updatingtime")),
    "heatmap": (HEAT_MAP_FEED, {"rssi": "int", "stime": "timestamp"}, (), ("apmac", "mac", "rssi", "stime")),
    "matched": (MATCHED_FEED, {"entityid": "int", "updatingtime": "bigint", "leave_seconds": "bigint"}, ("mac",),
                ("entityid", "mac", "updatingtime")),
}


def parsed_lines(lines: DataFrame, feed: str) -> DataFrame:
    """The fields of a feed's lines beside the lines themselves, in ``value``. Works on a stream."""
    positions, types, upper, _ = _FEEDS[feed]
    return parse_fields(lines, positions, types, upper, keep=True)


def good_lines(feed: str) -> Column:
    """Whether a parsed line has the fields that no row of its feed can do without."""
    good = F.lit(True)
    for name in _FEEDS[feed][3]:
        good = good & F.col(name).isNotNull() & (F.col(name).cast("string") != "")
    return good


def parse_feed(lines: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a feed's good lines, and its other lines as they came, in ``value``. Works on a stream.

    A line is good if it has the fields that no row can do without; together the
    two hold every line once. A matched line without a leave time is good, since
    a venue need not state one.
    """
    parsed, good = parsed_lines(lines, feed), good_lines(feed)
    return parsed.filter(good).drop("value"), parsed.filter(~good).select("value")


def parse_raw_feed(lines: DataFrame) -> DataFrame:
    return parse_feed(lines, "raw")[0]


def parse_heat_map_feed(lines: DataFrame) -> DataFrame:
    """``apmac, mac, rssi, ts`` of the good lines."""
    return parse_feed(lines, "heatmap")[0].withColumnRenamed("stime", "ts")


def parse_matched_feed(lines: DataFrame) -> DataFrame:
    """``entityid, clientmac, stime, leave_seconds`` of the good lines."""
    return parse_feed(lines, "matched")[0].select(
        "entityid", F.col("mac").alias("clientmac"), F.col("updatingtime").alias("stime"),
        "leave_seconds",
    )
