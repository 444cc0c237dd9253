"""What became of each line of a feed, counted in every micro-batch.

A line is a row, a reject, a repeat or late. The first two are counted where
lines are parsed, as observed metrics; repeats and late rows are what the state
of `once` has refused, which Spark reports with the progress of the query.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from passerby.sources.feeds import explode_payload, good_lines, parsed_lines

COUNTS = T.StructType([T.StructField("run", T.IntegerType()), T.StructField("batch_id", T.LongType()),
                       *(T.StructField(name, T.LongType()) for name in ("lines", "rejects", "repeats", "late", "rows"))])


def once(rows: DataFrame, keys: list[str], time: str, within: str = "10 minutes") -> DataFrame:
    """Rows of a stream without those that came before, in whatever micro-batch.

    A row is known by its ``keys`` for as long as ``within`` of the watermark,
    which follows the newest ``time`` by as much; after that its state goes, and
    rows that come as late are dropped. Put before whatever keeps state.
    """
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


def counted_feed(messages: DataFrame, feed: str, time: str, within: str = "10 minutes") -> DataFrame:
    """The good lines of a feed, each once, counted on the way; ``time`` is the field that is a timestamp.

    A line is a repeat if all its fields are those of an earlier one.
    """
    lines = parsed_lines(explode_payload(messages), feed)
    good = good_lines(feed)
    lines = lines.observe("feed_lines", F.count(F.lit(1)).alias("lines"), F.count(F.when(~good, 1)).alias("rejects"))
    rows = lines.filter(good).drop("value")
    return once(rows, rows.columns, time, within).observe("feed_rows", F.count(F.lit(1)).alias("rows"))


def batch_counts(progress: dict, run: int) -> tuple | None:
    """`COUNTS` of one progress report, as Spark writes it in JSON; None for another query or a batch without data."""
    observed = progress.get("observedMetrics") or {}
    if "feed_lines" not in observed:
        return None
    lines, rows = observed["feed_lines"], observed.get("feed_rows") or {}
    state = [operator for operator in progress["stateOperators"] if operator["operatorName"] == "dedupeWithinWatermark"]
    repeats = sum((operator.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0) for operator in state)
    late = sum(operator["numRowsDroppedByWatermark"] for operator in state)
    return run, progress["batchId"], lines["lines"] or 0, lines["rejects"] or 0, repeats, late, rows.get("rows") or 0


class CountLog(StreamingQueryListener):
    """Writes the counts of every micro-batch of a session's counted feeds under ``path``, a row each.

    ``run_of`` says which run a query's name belongs to. Add it with
    ``spark.streams.addListener``; a batch that is repeated replaces its row.
    """

    def __init__(self, spark: SparkSession, path: str, run_of):
        self.spark, self.path, self.run_of = spark, path, run_of

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        counts = batch_counts(progress, self.run_of(event.progress.name))
        if counts is not None and counts[2]:
            write_counts(self.spark, self.path, [counts])

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def write_counts(spark: SparkSession, path: str, counts: list[tuple]) -> None:
    for run, batch_id, *own in counts:
        row = spark.createDataFrame([tuple(own)], T.StructType(COUNTS.fields[2:])).coalesce(1)
        row.write.mode("overwrite").json(f"{path}/run={run}/batch_id={batch_id}")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COUNTS).json(path)
