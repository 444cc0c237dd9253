"""The registered queries: every operator on the given tables."""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passerby.functions.time import month_start
from passerby.operators import dimensions, heatmap, ingest, keyed, matching, recency, sessions
from passerby.plans.refresh import apply_run, apply_run_in_place, daily_report, publish_refresh, refresh_days
from passerby.plans.tables import Tables
from passerby.schemas import SESSION_KEYS
from passerby.plans.visitors import compact_visitors, read_visitor_report, update_visitors
from passerby.session import cut_lineage, run_folder
from passerby.sources.feeds import explode_payload, parse_feed, parse_fields, read_stream
from passerby.sources.probes import read_probes
from passerby.sources.store import create_store, read_store, update_store
from passerby.sources.tables import (
    read_processing_log, read_sessions, write_processing_log, write_report, write_table,
)
from passerby.streaming.counts import batch_counts, counted_feed, once, read_counts, write_counts
from passerby.streaming.expiring import expiring_visits
from passerby.streaming.files import ingest_files
from passerby.streaming.live import live_visits as live_visits_of
from passerby.streaming.sinks import (
    live_writer, matched_writer, read_closed_visits, read_heatmap, read_heatmap_sketches, read_live_visits, read_matched,
    run_of, start_live,
)

SESSION = ["clientmac", "entityid", "etime", "ltime", "seconds"]
LONG_STAY = 2 * 60 * 60
STAYED = ("F", "O")
AS_OF_DAY = 996624000  # 2001-08-01, the last day of the orders
NOW = "2024-01-15 12:00:00"
PROCESSED_AT = "2024-02-01 03:00:00"

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def _query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build):
        return lambda spark, folder: build(Tables(spark, folder))

    return {name: bound(build) for name, build in REGISTRY.items()}


@_query
def probe_dedup(t: Tables) -> DataFrame:
    return t.probes().distinct().withColumn("ufirstday", month_start(F.col("file_day")))


@_query
def payload_parse(t: Tables) -> DataFrame:
    fields = {"kind": 0, "event_id": 1, "apmac": 2, "mac": 3, "rssi": 4, "stime": 5}
    return parse_fields(
        explode_payload(t.payloads()), fields, {"event_id": "bigint", "rssi": "int"},
        upper=("apmac", "mac"),
    )


@_query
def entity_thresholds(t: Tables) -> DataFrame:
    return t.thresholds()


@_query
def ap_dimension(t: Tables) -> DataFrame:
    return dimensions.ap_dimension(**t.access_point_sources())


@_query
def indoor_sessions(t: Tables) -> DataFrame:
    return sessions.sessionize(t.probes(), t.thresholds()).select(SESSION)


@_query
def indoor_sessions_interior(t: Tables) -> DataFrame:
    return sessions.sessionize(t.probes(), t.thresholds(), edges="drop").select(SESSION)


@_query
def indoor_daily(t: Tables) -> DataFrame:
    return sessions.indoor_daily(sessions.sessionize(t.probes(), t.thresholds())).drop("file_day")


@_query
def flow_daily(t: Tables) -> DataFrame:
    return sessions.flow_daily(t.probes()).drop("file_day")


@_query
def ingest_merge(t: Tables) -> DataFrame:
    """Two overlapping shares of the probes are all of them again."""
    rows = t.probe_rows()
    history = rows.filter(F.col("event_id") % 3 < 2).drop("event_id")
    increment = rows.filter(F.col("event_id") % 3 > 0).drop("event_id")
    return keyed.merge_probes(history, increment)


@_query
def day_refresh(t: Tables) -> DataFrame:
    """Sessions published from a part of the probes, refreshed with the rest."""
    rows = t.probe_rows()
    history = rows.filter(F.col("event_id") % 2 == 0).drop("event_id")
    increment = rows.filter(F.col("event_id") % 2 == 1).drop("event_id")
    published = cut_lineage(sessions.sessionize(history, t.thresholds()))
    refreshed = refresh_days(history, increment, published, t.thresholds())
    kept = keyed.delete_keys(published, refreshed.tombstones)
    return keyed.upsert(kept, refreshed.sessions).select(SESSION)


def _long_stays(t: Tables) -> tuple[DataFrame, DataFrame]:
    every = cut_lineage(sessions.sessionize(t.probes(), t.thresholds()).select(SESSION))
    return every, every.filter(F.col("seconds") >= LONG_STAY)


@_query
def stale_keys(t: Tables) -> DataFrame:
    return keyed.stale_keys(*_long_stays(t), SESSION_KEYS)


@_query
def session_delete(t: Tables) -> DataFrame:
    every, long = _long_stays(t)
    return keyed.delete_keys(every, keyed.stale_keys(every, long))


@_query
def session_upsert(t: Tables) -> DataFrame:
    """Long stays grow by a minute, and each is followed by a new one a day later."""
    every, long = _long_stays(t)
    minute, day = F.lit(60), F.lit(86400)
    grown = long.withColumns({"ltime": F.col("ltime") + minute, "seconds": F.col("seconds") + minute})
    following = long.withColumns({"etime": F.col("ltime") + day, "ltime": F.col("ltime") + day,
                                  "seconds": F.lit(0).cast("bigint")})
    return keyed.upsert(every, grown.unionByName(following))


@_query
def recency_flow(t: Tables) -> DataFrame:
    return recency.recency_flow(t.flow_days())


@_query
def recency_indoor(t: Tables) -> DataFrame:
    return recency.recency_indoor(t.indoor_days(), AS_OF_DAY)


@_query
def footfall_report(t: Tables) -> DataFrame:
    """Some days have no stay: those of the orders still in process."""
    return recency.visitor_report(t.flow_days(), t.indoor_days(STAYED), AS_OF_DAY)


@_query
def footfall_report_joined(t: Tables) -> DataFrame:
    return recency.footfall_report(recency_flow(t), recency.recency_indoor(t.indoor_days(STAYED), AS_OF_DAY))


@_query
def client_profile(t: Tables) -> DataFrame:
    return recency.client_profile(footfall_report(t))


@_query
def signal_match(t: Tables) -> DataFrame:
    return _matched(t).select(MATCHED)


@_query
def signal_match_inclusive(t: Tables) -> DataFrame:
    return _matched(t, inclusive=True, refuse_positive=False).select(MATCHED)


MATCHED = ["event_id", "apmac", "mac", "rssi", "stime", "entityid", "indoor_seconds", "leave_seconds"]


def _matched(t: Tables, **rule: bool) -> DataFrame:
    return matching.match_access_points(t.sightings(), t.access_points(), **rule)


@_query
def latest_sighting(t: Tables) -> DataFrame:
    return matching.latest_sighting(_matched(t))


@_query
def fresh_sightings(t: Tables) -> DataFrame:
    delay = F.make_dt_interval(mins=F.col("event_id") % 10)
    arriving = t.sightings().withColumn("arrival", F.col("ts") + delay)
    return matching.fresh_sightings(arriving, "ts", "arrival").select(
        "event_id", "apmac", "mac", "rssi", "stime"
    )


@_query
def fresh_asof(t: Tables) -> DataFrame:
    now = F.lit(NOW).cast("timestamp")
    return matching.fresh_as_of(t.sightings(), "ts", now, "1 day").select(
        "event_id", "apmac", "mac", "rssi", "stime"
    )


def _heat_map(t: Tables, **options) -> DataFrame:
    return heatmap.zone_heatmap(t.sightings(), t.access_points(), **options).withColumn(
        "starttime", F.unix_timestamp("starttime")
    )


@_query
def zone_heatmap(t: Tables) -> DataFrame:
    return _heat_map(t)


@_query
def zone_heatmap_tagged(t: Tables) -> DataFrame:
    return _heat_map(t, mode="tagged")


@_query
def zone_heatmap_approx(t: Tables) -> DataFrame:
    return _heat_map(t, exact=False)


@_query
def live_visits(t: Tables) -> DataFrame:
    return sessions.live_visits_batch(t.indoor_sightings())


@_query
def closed_visits(t: Tables) -> DataFrame:
    return sessions.closed_visits(t.indoor_sightings())


@_query
def ingest_backlog(t: Tables) -> DataFrame:
    return ingest.ingest_backlog(t.files())


@_query
def processing_log(t: Tables) -> DataFrame:
    return ingest.processing_log(t.probes(), PROCESSED_AT)


def _streamed(t: Tables, rows_of: Callable[[Tables], DataFrame], slices: list[DataFrame], place: str, name: str = "state",
              mode: str = "update") -> str:
    """Feeds a stream slice by slice, each in a run of its own from the same checkpoint; returns where its changes are.

    So every slice but the first is met by state that is read back.
    """
    for part in slices:
        part.write.mode("append").parquet(f"{place}/{name}-feed")
        rows = rows_of(t.as_stream(f"{place}/{name}-feed"))
        checkpoint = f"{place}/{name}"
        writer = live_writer(t.spark, f"{place}/changes", checkpoint)
        start_live(rows, writer, checkpoint, every=None, mode=mode).start().awaitTermination()
    return f"{place}/changes"


def _visits_of(rule: str = "current") -> Callable[[Tables], DataFrame]:
    return lambda stream: live_visits_of(stream.indoor_sightings(), rule)


def _heat_map_of(t: Tables) -> Callable[[Tables], DataFrame]:
    return lambda stream: heatmap.zone_heatmap(stream.sightings(), t.access_points(), exact=False, watermark="5 minutes")


def _heat_map_at(t: Tables, changes: str) -> DataFrame:
    return read_heatmap(t.spark, changes).withColumn("starttime", F.unix_timestamp("starttime"))


@_query
def live_visits_stream(t: Tables) -> DataFrame:
    """The state machine itself, fed with the probes as a stream in three runs."""
    return read_live_visits(t.spark, _streamed(t, _visits_of(), t.event_slices(), run_folder(t.spark)))


@_query
def live_visits_late(t: Tables) -> DataFrame:
    """The first span of time comes last: sightings older than an open visit's end are ignored."""
    first, second, third = t.event_slices()
    return read_live_visits(t.spark, _streamed(t, _visits_of(), [second, third, first], run_folder(t.spark)))


@_query
def live_visits_restarted(t: Tables) -> DataFrame:
    """All events, then those of the later spans under a new checkpoint: the second run alone counts."""
    place, slices = run_folder(t.spark), t.event_slices()
    _streamed(t, _visits_of(), slices, place, "first")
    return read_live_visits(t.spark, _streamed(t, _visits_of(), slices[1:], place, "second"))


@_query
def closed_visits_stream(t: Tables) -> DataFrame:
    rows = _streamed(t, _visits_of("trigger"), t.event_slices(), run_folder(t.spark))
    return read_live_visits(t.spark, rows).drop("done")


@_query
def zone_heatmap_stream(t: Tables) -> DataFrame:
    return _heat_map_at(t, _streamed(t, _heat_map_of(t), t.event_slices(), run_folder(t.spark)))


@_query
def zone_heatmap_late(t: Tables) -> DataFrame:
    """The first span of time comes last: its windows end before the watermark and are refused."""
    first, second, third = t.event_slices()
    return _heat_map_at(t, _streamed(t, _heat_map_of(t), [second, third, first], run_folder(t.spark)))


@_query
def zone_heatmap_restarted(t: Tables) -> DataFrame:
    """Two spans of time under two checkpoints: the heat map keeps both runs."""
    place, slices = run_folder(t.spark), t.event_slices(2)
    _streamed(t, _heat_map_of(t), slices[:1], place, "first")
    return _heat_map_at(t, _streamed(t, _heat_map_of(t), slices[1:], place, "second"))


@_query
def feed_rejects(t: Tables) -> DataFrame:
    """Good and refused lines of the raw feed; together they are all lines."""
    good, rejects = parse_feed(t.feed_lines(), "raw")
    time = F.unix_timestamp("updatingtime").alias("stime")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("apmac", "string"), ("mac", "string"), ("rssi", "int"), ("stime", "long"))]
    return good.select(F.lit("good").alias("kind"), F.lit(None).cast("string").alias("value"), "apmac", "mac", "rssi", time).unionByName(
        rejects.select(F.lit("reject").alias("kind"), "value", *nothing))


@_query
def live_visits_short_leave(t: Tables) -> DataFrame:
    return sessions.live_visits_batch(t.short_leave_sightings())


def _published(t: Tables) -> tuple[str, DataFrame]:
    """The probes published in two runs, and the sessions as the first left them."""
    root, rows = run_folder(t.spark), t.probe_rows()
    publish_refresh(t.spark, rows.filter(F.col("event_id") % 2 == 0).drop("event_id"), t.thresholds(), root, "r1")
    first = cut_lineage(read_sessions(t.spark, f"{root}/rec_indoor"))
    publish_refresh(t.spark, rows.filter(F.col("event_id") % 2 == 1).drop("event_id"), t.thresholds(), root, "r2")
    return root, first


def _as_files(probes: DataFrame, folder: str) -> None:
    """Probes as text, a folder for each venue and day."""
    day = F.date_format(F.timestamp_seconds("file_day"), "yyyyMMdd").alias("t_cf")
    probes.select("entityid", day, F.concat_ws(",", "clientmac", "stime", "flag").alias("line")).repartition("entityid", "t_cf").write.mode(
        "append").partitionBy("entityid", "t_cf").text(folder)


@_query
def probe_files(t: Tables) -> DataFrame:
    """The probes written as the files that venues send, and read from them."""
    folder = run_folder(t.spark)
    _as_files(t.probes().distinct(), folder)
    return read_probes(t.spark, folder)[0].select("entityid", "file_day", "ufirstday", "clientmac", "stime", "flag")


@_query
def day_publish(t: Tables) -> DataFrame:
    root, _ = _published(t)
    return read_sessions(t.spark, f"{root}/rec_indoor").select(SESSION)


@_query
def published_report(t: Tables) -> DataFrame:
    """The report from the days as they are stored."""
    root, _ = _published(t)
    return daily_report(t.spark, root, AS_OF_DAY)


@_query
def applied_run(t: Tables) -> DataFrame:
    """A keyed store left by the first run, brought up to date with the second."""
    root, first = _published(t)
    return apply_run(t.spark, first.select(SESSION), root, "r2")


@_query
def live_visits_expiring(t: Tables) -> DataFrame:
    """Visits that end by time: those whose leave time the watermark has passed are done."""
    rows = _streamed(t, lambda stream: expiring_visits(stream.indoor_sightings(), slots=SLOTS), t.event_slices(), run_folder(t.spark))
    return read_live_visits(t.spark, rows)


SLOTS = 16


@_query
def closed_visits_windowed(t: Tables) -> DataFrame:
    """Ended visits by session windows in append mode, without Python."""
    rows = _streamed(t, lambda stream: sessions.closed_visits_windowed(stream.indoor_sightings()), t.event_slices(), run_folder(t.spark), mode="append")
    return read_closed_visits(t.spark, rows)


def _sketches_of(t: Tables) -> Callable[[Tables], DataFrame]:
    return lambda stream: heatmap.zone_sketches(stream.sightings(), t.access_points(), watermark="5 minutes")


def _sketched(t: Tables, changes: str, unit: str | None) -> DataFrame:
    return read_heatmap_sketches(t.spark, changes, unit).withColumn("starttime", F.unix_timestamp("starttime"))


@_query
def zone_heatmap_hours(t: Tables) -> DataFrame:
    """Devices per hour, added up from the stored sketches of five minutes."""
    return _sketched(t, _streamed(t, _sketches_of(t), t.event_slices(), run_folder(t.spark)), "hour")


@_query
def zone_heatmap_days(t: Tables) -> DataFrame:
    return _sketched(t, _streamed(t, _sketches_of(t), t.event_slices(), run_folder(t.spark)), "day")


@_query
def zone_heatmap_parted(t: Tables) -> DataFrame:
    """Every other event under a checkpoint of its own: each window is counted by two runs and has the devices of both."""
    place, even = run_folder(t.spark), F.col("event_id") % 2 == 0
    _streamed(t, _sketches_of(t), [t.read("events").filter(even)], place, "first")
    return _sketched(t, _streamed(t, _sketches_of(t), [t.read("events").filter(~even)], place, "second"), None)


@_query
def live_visits_redelivered(t: Tables) -> DataFrame:
    """Every event twice, in different micro-batches, under the rule that a late sighting moves a visit's end back."""
    def rows(stream: Tables) -> DataFrame:
        seen = stream.indoor_sightings().withColumn("seen", F.timestamp_seconds("stime"))
        return live_visits_of(once(seen, ["entityid", "clientmac", "stime"], "seen", REDELIVERY), "latest")

    return read_live_visits(t.spark, _streamed(t, rows, _twice(t), run_folder(t.spark)))


def _twice(t: Tables) -> list[DataFrame]:
    """Each span of the events in two micro-batches, the second time two later."""
    first, second, third = t.event_slices()
    return [first, second, first.unionByName(third), second, third]


REDELIVERY = "60 days"


@_query
def zone_heatmap_redelivered(t: Tables) -> DataFrame:
    def rows(stream: Tables) -> DataFrame:
        seen = once(stream.sightings(), ["apmac", "mac", "rssi", "ts"], "ts", REDELIVERY)
        return heatmap.zone_sketches(seen, t.access_points())

    return _sketched(t, _streamed(t, rows, _twice(t), run_folder(t.spark)), None)


@_query
def report_by_change(t: Tables) -> DataFrame:
    """The report brought up to date after each of two published runs, by what each has changed."""
    root, rows = run_folder(t.spark), t.probe_rows()
    for run, share in (("r1", 0), ("r2", 1)):
        publish_refresh(t.spark, rows.filter(F.col("event_id") % 2 == share).drop("event_id"), t.thresholds(), root, run)
        update_visitors(t.spark, root, run)
    return read_visitor_report(t.spark, root, AS_OF_DAY)


@_query
def report_compacted(t: Tables) -> DataFrame:
    """The same after the versions of three spans of time were folded into one."""
    root = run_folder(t.spark)
    for number, part in enumerate(t.event_slices()):
        probes = t.of_events(part).probes()
        publish_refresh(t.spark, probes, t.thresholds(), root, f"r{number}")
        update_visitors(t.spark, root, f"r{number}")
    compact_visitors(t.spark, root)
    return read_visitor_report(t.spark, root, AS_OF_DAY)


@_query
def store_upsert(t: Tables) -> DataFrame:
    """`session_upsert` on a stored table, of which only the days with changes are read and written."""
    place = run_folder(t.spark)
    name = f"store_{place.rsplit('/', 1)[1]}"
    every, long = _long_stays(t)
    minute, day = F.lit(60), F.lit(86400)
    grown = long.withColumns({"ltime": F.col("ltime") + minute, "seconds": F.col("seconds") + minute})
    following = long.withColumns({"etime": F.col("ltime") + day, "ltime": F.col("ltime") + day, "seconds": F.lit(0).cast("bigint")})
    create_store(every, name, place)
    update_store(t.spark, name, cut_lineage(grown.unionByName(following)), t.spark.createDataFrame([], every.schema))
    return read_store(t.spark, name)


@_query
def store_applied_run(t: Tables) -> DataFrame:
    """`applied_run` in a bucketed table."""
    root, first = _published(t)
    name = f"store_{root.rsplit('/', 1)[1]}"
    create_store(first.select(SESSION), name, f"{root}/store")
    apply_run_in_place(t.spark, name, root, "r2")
    return read_store(t.spark, name)


@_query
def store_delete(t: Tables) -> DataFrame:
    """Sessions other than long stays deleted from a stored table; days left without any go."""
    place = run_folder(t.spark)
    name = f"store_{place.rsplit('/', 1)[1]}"
    every, long = _long_stays(t)
    create_store(every, name, place)
    update_store(t.spark, name, t.spark.createDataFrame([], every.schema), cut_lineage(keyed.stale_keys(every, long)))
    return read_store(t.spark, name)


@_query
def file_ingest(t: Tables) -> DataFrame:
    """Sessions published from a growing folder of probe files, each file taken once."""
    place = run_folder(t.spark)
    for part in t.event_slices(2):
        _as_files(t.of_events(part).probes(), f"{place}/in")
        ingest_files(t.spark, f"{place}/in", t.thresholds(), f"{place}/out", f"{place}/checkpoint").start().awaitTermination()
    return read_sessions(t.spark, f"{place}/out/rec_indoor").select(SESSION)


@_query
def moved_access_points(t: Tables) -> DataFrame:
    """Half of the access points move to the next venue in the middle of the time; sightings count where they were."""
    return matching.match_as_of(t.sightings(), matching.access_point_history(t.access_point_changes())).select(MATCHED)


@_query
def moved_access_points_stream(t: Tables) -> DataFrame:
    """The same while the stream runs: the dimension is read for each micro-batch, and learns of the move after the first."""
    place, changes = run_folder(t.spark), t.access_point_changes()
    known = [changes.filter(F.col("valid_at_start")), changes]

    def write_dimension(rows: DataFrame) -> None:
        matching.access_point_history(rows.drop("valid_at_start")).write.mode("overwrite").parquet(f"{place}/dimension")

    for rows, part in zip(known, t.event_slices(2), strict=True):
        write_dimension(rows)
        part.write.mode("append").parquet(f"{place}/feed")
        writer = matched_writer(t.spark, f"{place}/changes", f"{place}/state", lambda: t.spark.read.parquet(f"{place}/dimension"),
                                lambda batch, history: matching.match_as_of(batch, history).select(MATCHED))
        start_live(t.as_stream(f"{place}/feed").sightings(), writer, f"{place}/state", every=None, mode="append").start().awaitTermination()
    return t.spark.read.parquet(f"{place}/changes").select(MATCHED)


@_query
def counted_lines(t: Tables) -> DataFrame:
    """What became of the lines of the raw feed, each given twice, by run: rows, rejects and repeats are all of them."""
    place, lines = run_folder(t.spark), t.feed_lines()
    first = lines.select(F.concat_ws("\n", "value", "value").alias("value"))
    first.write.parquet(f"{place}/feed")
    messages = read_stream(t.spark, "parquet", first.schema, path=f"{place}/feed")
    run = run_of(t.spark, f"{place}/changes", f"{place}/state")
    writer = live_writer(t.spark, f"{place}/changes", f"{place}/state")
    query = start_live(counted_feed(messages, "raw", "updatingtime", REDELIVERY), writer, f"{place}/state", every=None, mode="append").start()
    query.awaitTermination()
    counts = [batch_counts(json.loads(progress.json), run) for progress in query.recentProgress]
    write_counts(t.spark, f"{place}/counts", [own for own in counts if own and own[2]])
    return read_counts(t.spark, f"{place}/counts").groupBy("run").agg(*[F.sum(name).alias(name) for name in ("lines", "rejects", "repeats", "late", "rows")])


@_query
def probe_backlog(t: Tables) -> DataFrame:
    """The backlog of a folder of probe files; a fifth of the venues have sent none."""
    folder = run_folder(t.spark)
    _as_files(t.probes().distinct().filter(F.col("entityid") % 5 != 0), folder)
    files = ingest.probe_files_found(t.spark, folder, t.entities().select("entityid"))
    return ingest.ingest_backlog(files)


@_query
def stored_report(t: Tables) -> DataFrame:
    """The report as laid out for look-ups, read back."""
    path = run_folder(t.spark)
    write_report(footfall_report(t), path)
    return t.spark.read.parquet(path)


@_query
def report_table(t: Tables) -> DataFrame:
    """The report as a managed table, built twice."""
    name = f"report_{run_folder(t.spark).rsplit('/', 1)[1]}"
    for _ in range(2):
        write_table(footfall_report(t), name)
    return t.spark.table(name)


@_query
def stored_log(t: Tables) -> DataFrame:
    """The processing log as written, in its order."""
    path = run_folder(t.spark)
    write_processing_log(processing_log(t), path)
    return read_processing_log(t.spark, path)
