"""The jobs as a command line for spark-submit.

    jobs.py refresh --probes PATH --entities PATH --root PATH --run ID
    jobs.py ingest --probes PATH --entities PATH --root PATH --checkpoint PATH [--name NAME] [--every SPAN]
    jobs.py report --root PATH --as-of yyyy-MM-dd --table NAME [--flow NAME] [--indoor NAME] [--profile NAME]
                   [--by changes|days] [--path PATH]
    jobs.py visits --out PATH --checkpoint PATH [--feed raw|matched] [--access-points PATH] [--rule RULE]
                   [--delay SPAN] [--max-age SPAN] [--rejects PATH] SOURCE...
    jobs.py heatmap --access-points PATH --out PATH --checkpoint PATH [--mode MODE] [--store counts|sketches]
                    [--max-age SPAN] [--rejects PATH] SOURCE...
    jobs.py compact --out PATH --kind visits|heatmap|sketches|report

``ingest`` takes each probe file once, publishes it and brings the stored report
up to date with what it changes; ``report --by changes`` reads that report, and
``--path`` lays it out for look-ups as well. With ``--delay`` visits end by time.

SOURCE is the format of the feed and its options, as in ``kafka
kafka.bootstrap.servers=... subscribe=...``; a schema is given as ``schema=DDL``.
``--entities-format`` and ``--access-points-format`` name the format of a
dimension, ``--dim-option key=value`` its options; parquet without.

Live visits are those of the last run: a new checkpoint begins a new one. A rule
decides which sightings count:

- ``current`` and ``latest``: stronger than the venue's bound and not positive, at ``updatingtime``;
- ``trigger``: at least the bound, at ``ttime``, arrived less than five minutes after it.

Nothing is dropped for its age by the clock unless ``--max-age`` asks for it.
"""

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passerby.operators.dimensions import entity_thresholds
from passerby.operators.ingest import processing_log
from passerby.operators.matching import fresh_as_of, fresh_sightings, match_access_points
from passerby.operators.recency import client_profile, recency_flow, recency_indoor
from passerby.plans.refresh import daily_report, publish_refresh
from passerby.plans.visitors import compact_visitors, read_visitor_report, update_visitors
from passerby.session import temporary_tables
from passerby.sources.feeds import TIME_FORMAT, explode_payload, parse_feed, parse_matched_feed, parse_raw_feed, read_stream
from passerby.sources.probes import read_probes
from passerby.sources.tables import read_dim, read_flow_daily, read_indoor_daily, write_processing_log, write_report, write_table
from passerby.streaming.expiring import expiring_visits
from passerby.streaming.files import ingest_files
from passerby.streaming.heatmap import live_heatmap
from passerby.streaming.live import live_visits
from passerby.streaming.sinks import compact, live_writer, start_live

# Fixed value: how long after its time a sighting may arrive under the trigger rule.
TRIGGER_DELAY = "5 minutes"


def refresh(spark: SparkSession, probes: str, entities: DataFrame, root: str, run: str) -> None:
    """Takes in the probe files under ``probes``; bad lines go to rejects/<run>."""
    with temporary_tables(spark):
        good, rejects = read_probes(spark, probes, once=True)
        publish_refresh(spark, good, entity_thresholds(entities), root, run)
        rejects.write.mode("overwrite").json(f"{root}/rejects/{run}")
    days = spark.read.parquet(f"{root}/days/{run}")
    now = datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    write_processing_log(processing_log(days, now), f"{root}/log/{run}")


def ingest(spark: SparkSession, probes: str, entities: DataFrame, root: str, checkpoint: str, name: str = "files", every: str | None = None):
    """Publishes the probe files that no earlier run has taken, and brings the stored report up to date after each batch."""
    limits = entity_thresholds(entities)
    return ingest_files(spark, probes, limits, root, checkpoint, every=every, name=name, then=lambda run: update_visitors(spark, root, run)).start()


def report(spark: SparkSession, root: str, as_of: str, table: str, flow: str | None = None,
           indoor: str | None = None, profile: str | None = None, by: str = "days", path: str | None = None) -> None:
    """Rebuilds the visitor report and, where named, the statistics of flow and stays and the client profiles."""
    if by not in ("changes", "days"):
        raise ValueError(f"by must be changes or days, not {by!r}")
    as_of_day = spark.range(1).select(F.unix_timestamp(F.lit(as_of), "yyyy-MM-dd")).first()[0]
    if flow:
        write_table(recency_flow(read_flow_daily(spark, f"{root}/flow")), flow)
    if indoor:
        write_table(recency_indoor(read_indoor_daily(spark, f"{root}/indoor"), as_of_day), indoor)
    write_table((read_visitor_report if by == "changes" else daily_report)(spark, root, as_of_day), table)
    if path:
        write_report(spark.table(table), path)
    if profile:
        write_table(client_profile(spark.table(table)), profile)


def open_feed(spark: SparkSession, source: list[str]) -> DataFrame:
    options = dict(option.split("=", 1) for option in source[1:])
    schema = options.pop("schema", None)
    return read_stream(spark, source[0], schema, **options)


def raw_sightings(messages: DataFrame, access_points: DataFrame, rule: str) -> DataFrame:
    """The raw feed's sightings that count under ``rule``, matched to venues."""
    raw = parse_raw_feed(explode_payload(messages))
    time, trigger = ("ttime", True) if rule == "trigger" else ("updatingtime", False)
    if trigger:
        raw = raw.withColumn("ttime", F.try_to_timestamp("ttime", F.lit(TIME_FORMAT)))
        raw = fresh_sightings(raw, "ttime", "updatingtime", TRIGGER_DELAY)
    matched = match_access_points(raw, access_points, inclusive=trigger, refuse_positive=not trigger)
    return matched.select("entityid", F.col("mac").alias("clientmac"), F.col(time).alias("at"), "leave_seconds")


def keep_rejects(messages: DataFrame, kind: str, path: str, checkpoint: str, every: str | None):
    """Starts a stream of the lines that a feed's parser refuses to ``path``."""
    lines = parse_feed(explode_payload(messages), kind)[1]
    writer = lines.writeStream.format("json").option("path", path).option("checkpointLocation", f"{checkpoint}-rejects")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def visits(spark: SparkSession, source: list[str], out: str, checkpoint: str, access_points: DataFrame | None = None,
           feed: str = "raw", rule: str = "current", delay: str | None = None, max_age: str | None = None,
           rejects: str | None = None, every: str | None = "30 seconds"):
    """Live visits from the raw feed, matched to venues on the way, or from the matched feed; with ``delay`` they end by time."""
    messages = open_feed(spark, source)
    if feed == "matched":
        seen = parse_matched_feed(explode_payload(messages)).withColumn("at", F.timestamp_seconds("stime"))
    else:
        if access_points is None:
            raise ValueError("the raw feed needs access points")
        seen = raw_sightings(messages, access_points, rule)
    if max_age:
        seen = fresh_as_of(seen, "at", max_age=max_age)
    matched = seen.select("entityid", "clientmac", F.unix_timestamp("at").alias("stime"), "leave_seconds")
    if rejects:
        keep_rejects(messages, feed, rejects, checkpoint, every)
    changed = expiring_visits(matched, rule, delay) if delay else live_visits(matched, rule)
    return start_live(changed, live_writer(spark, out, checkpoint), checkpoint, every).start()


def heatmap(spark: SparkSession, source: list[str], out: str, checkpoint: str, access_points: DataFrame,
            mode: str = "matching", store: str = "counts", max_age: str | None = "5 minutes", rejects: str | None = None,
            every: str | None = "5 minutes"):
    """The live heat map from its feed, as counts of its windows or as sketches that can be added up."""
    if store not in ("counts", "sketches"):
        raise ValueError(f"store must be counts or sketches, not {store!r}")
    messages = open_feed(spark, source)
    rows = live_heatmap(messages, access_points, mode, max_age=max_age, sketches=store == "sketches")
    if rejects:
        keep_rejects(messages, "heatmap", rejects, checkpoint, every)
    return start_live(rows, live_writer(spark, out, checkpoint), checkpoint, every).start()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    missing = argparse.SUPPRESS

    def add(job: str, required: tuple[str, ...], optional: tuple[str, ...] = (), dims: tuple[str, ...] = ()):
        one = jobs.add_parser(job)
        for name in required:
            one.add_argument(f"--{name}", required=True)
        for name in optional:
            one.add_argument(f"--{name}", default=missing)
        for name in dims:
            one.add_argument(f"--{name}-format", default="parquet")
            one.add_argument("--dim-option", action="append", default=[])
        return one

    add("refresh", ("probes", "entities", "root", "run"), dims=("entities",))
    add("ingest", ("probes", "entities", "root", "checkpoint"), ("name", "every"), dims=("entities",))
    add("report", ("root", "as-of", "table"), ("flow", "indoor", "profile", "by", "path"))
    add("visits", ("out", "checkpoint"), ("access-points", "feed", "rule", "delay", "max-age", "rejects"),
        ("access-points",)).add_argument("source", nargs="+")
    add("heatmap", ("access-points", "out", "checkpoint"), ("mode", "store", "max-age", "rejects"),
        ("access-points",)).add_argument("source", nargs="+")
    add("compact", ("out", "kind"))
    options = vars(parser.parse_args(argv))
    job = options.pop("job")
    spark = SparkSession.builder.appName(f"passerby {job}").getOrCreate()
    more = dict(option.split("=", 1) for option in options.pop("dim_option", []))
    for name in ("entities", "access_points"):
        fmt = options.pop(f"{name}_format", None)
        if name in options:
            options[name] = read_dim(spark, fmt, **{"path": options[name], **more})
    if job == "compact":
        if options["kind"] == "report":
            compact_visitors(spark, options["out"])
        else:
            compact(spark, options["out"], options["kind"])
        return
    query = {"refresh": refresh, "ingest": ingest, "report": report, "visits": visits, "heatmap": heatmap}[job](spark, **options)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main()
