"""Stored sketches: hours and days from five minutes, windows that several runs counted, repeats."""

import json
import random

from pyspark.sql import functions as F

from helpers import frame, rows
from passerby.operators.heatmap import add_up, zone_heatmap, zone_sketches
from passerby.sources.feeds import read_stream
from passerby.streaming.counts import CountLog, batch_counts, counted_feed, once, read_counts, write_counts
from passerby.streaming.sinks import compact, live_writer, read_heatmap_sketches, run_of, start_live

AP = "apmac string, entityid int, rssi int, nearbyrssi int"
SEEN = "apmac string, mac string, rssi int, ts timestamp"


def seen_by(spark, *items):
    return frame(spark, "apmac string, mac string, rssi int, at string", *[("p", *item) for item in items]).select(
        "apmac", "mac", "rssi", F.to_timestamp(F.concat(F.lit("2024-01-15 "), "at")).alias("ts"))


def points(spark):
    return frame(spark, AP, ("p", 1, -20, -60))


def counts(df):
    return [(str(start)[11:16], *own) for _, start, *own in rows(df)]


def test_hours_and_days_count_a_device_once(spark):
    seen = seen_by(spark, ("A", -10, "10:01:00"), ("A", -10, "10:58:00"), ("B", -10, "10:30:00"), ("A", -10, "11:02:00"), ("A", -70, "10:02:00"))
    sketches = zone_sketches(seen, points(spark))
    assert counts(add_up(sketches)) == counts(zone_heatmap(seen, points(spark)))
    assert counts(add_up(sketches, "hour")) == [("10:00", 2, 1, 0), ("11:00", 1, 0, 0)]
    assert counts(add_up(sketches, "day")) == [("00:00", 2, 1, 0)]
    tagged = zone_sketches(seen, points(spark), mode="tagged")
    assert counts(add_up(tagged, "day")) == [("00:00", 3, 3, 2)]


def test_many_devices_within_the_stated_error(spark):
    seen = spark.range(400_000).select(
        F.lit("p").alias("apmac"), F.concat(F.lit("d"), F.col("id") % 60_000).alias("mac"), F.lit(-10).alias("rssi"),
        F.timestamp_seconds(F.lit(1_705_312_800) + F.col("id") % 21_600).alias("ts"))
    day = add_up(zone_sketches(seen, points(spark)), "day").first()
    # Three standard errors of one per cent.
    assert abs(day.indoors - 60_000) < 0.03 * 60_000 and day.aways == 0


def streamed(spark, tmp_path, batches, state="one", within=None):
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / f"feed-{state}"))
        rows_in = read_stream(spark, "parquet", SEEN, path=str(tmp_path / f"feed-{state}"))
        rows_in = once(rows_in, ["apmac", "mac", "rssi", "ts"], "ts", within) if within else rows_in
        sketches = zone_sketches(rows_in, points(spark), watermark=None if within else "5 minutes")
        checkpoint = str(tmp_path / f"state-{state}")
        query = start_live(sketches, live_writer(spark, str(tmp_path / "out"), checkpoint), checkpoint, every=None).start()
        query.awaitTermination()
    return query


def test_a_window_counted_by_two_runs_has_both_halves(spark, tmp_path):
    first = seen_by(spark, ("A", -10, "10:01:00"), ("B", -10, "10:02:00"))
    second = seen_by(spark, ("B", -10, "10:03:00"), ("C", -10, "10:04:00"))
    streamed(spark, tmp_path, [first], "one")
    streamed(spark, tmp_path, [second], "two")
    path = str(tmp_path / "out")
    assert counts(read_heatmap_sketches(spark, path)) == [("10:00", 3, 0, 0)]
    third = seen_by(spark, ("D", -10, "10:04:30"), ("E", -10, "11:00:00"))
    streamed(spark, tmp_path, [third], "two")
    expected = [("10:00", 4, 0, 0), ("11:00", 1, 0, 0)]
    assert counts(read_heatmap_sketches(spark, path)) == expected and counts(read_heatmap_sketches(spark, path, "day")) == [("00:00", 5, 0, 0)]
    assert compact(spark, path, "sketches") > 0
    assert counts(read_heatmap_sketches(spark, path)) == expected


def test_repeats_change_nothing_and_their_state_is_bounded(spark, tmp_path):
    first = seen_by(spark, ("A", -10, "10:01:00"), ("B", -10, "10:02:00"))
    query = streamed(spark, tmp_path, [first, first, seen_by(spark, ("C", -10, "18:00:00")), seen_by(spark, ("D", -10, "23:00:00"))], within="1 hour")
    assert counts(read_heatmap_sketches(spark, str(tmp_path / "out"))) == [("10:00", 2, 0, 0), ("18:00", 1, 0, 0), ("23:00", 1, 0, 0)]
    state = [o for o in json.loads(query.lastProgress.json)["stateOperators"] if o["operatorName"] == "dedupeWithinWatermark"]
    assert state[0]["numRowsTotal"] <= 1


def test_every_line_is_a_row_a_reject_a_repeat_or_late(spark, tmp_path):
    rng = random.Random(3)
    folder, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def line(i, hour):
        time = f"2024-01-15 {hour:02}:{i % 60:02}:00"
        return rng.choice([f"r,ap,m{i},-5,{time},{time}"] * 5 + ["broken", f"r,ap,m{i},x,{time},{time}"])

    early = [line(i, 8) for i in range(40)]
    batches = [early + early[:10], [line(i, 20) for i in range(30)] + ["r,ap,a,-5,t,2024-01-15 20:00:00"], early[:5] + ["r,ap,z,-5,t,2024-01-15 23:00:00"]]
    run = run_of(spark, path, checkpoint)
    for batch in batches:
        frame(spark, "value string", ("\n".join(batch),)).write.mode("append").parquet(folder)
        feed = counted_feed(read_stream(spark, "parquet", "value string", path=folder), "raw", "updatingtime", "1 hour")
        query = start_live(feed, live_writer(spark, path, checkpoint), checkpoint, every=None, mode="append").start()
        query.awaitTermination()
        write_counts(spark, str(tmp_path / "log"), [own for report in query.recentProgress for own in [batch_counts(json.loads(report.json), run)] if own and own[2]])
    log = read_counts(spark, str(tmp_path / "log")).orderBy("batch_id").collect()
    assert [row.lines for row in log] == [len(batch) for batch in batches]
    assert all(row.lines == row.rejects + row.repeats + row.late + row.rows for row in log)
    assert all(row.rejects == sum(text == "broken" or ",x," in text for text in batch) for row, batch in zip(log, batches, strict=True))
    assert log[0].repeats > 0 and log[2].late > 0 and log[0].late == log[1].late == 0
    assert spark.read.parquet(path).count() == sum(row.rows for row in log)


def test_a_listener_writes_the_counts_of_every_batch(spark, tmp_path):
    import time

    folder, log = str(tmp_path / "in"), str(tmp_path / "log")
    listener = CountLog(spark, log, lambda name: int(name.rpartition("-")[2]))
    spark.streams.addListener(listener)
    try:
        frame(spark, "value string", ("r,ap,m,-5,t,2024-01-15 20:00:00\nbroken",)).write.parquet(folder)
        feed = counted_feed(read_stream(spark, "parquet", "value string", path=folder), "raw", "updatingtime")
        start_live(feed, live_writer(spark, str(tmp_path / "out"), str(tmp_path / "s")), str(tmp_path / "s"), every=None, mode="append").queryName(
            "counted-7").start().awaitTermination()
        for _ in range(100):
            if list((tmp_path / "log").glob("run=*/batch_id=*/_SUCCESS")):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert rows(read_counts(spark, log), "run", "batch_id", "lines", "rejects", "repeats", "late", "rows") == [(7, 0, 2, 1, 0, 0, 1)]
