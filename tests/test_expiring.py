"""Visits that end by time: by timers over slots of devices, and by session windows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows
from passerby.operators.sessions import closed_visits, closed_visits_windowed, live_visits_batch
from passerby.sources.feeds import read_stream
from passerby.streaming.expiring import expiring_visits
from passerby.streaming.sinks import live_writer, read_closed_visits, read_live_visits, start_live

SCHEMA = "entityid int, clientmac string, stime long, leave_seconds long"
VISIT = ("clientmac", "entityid", "etime", "ltime", "seconds")


def fed(spark, tmp_path, batches, rows_of, name="out", mode="update"):
    """Each batch in a run of its own from the same checkpoint; returns the last query's progress reports."""
    reports = []
    for batch in batches:
        frame(spark, SCHEMA, *batch).coalesce(1).write.mode("append").parquet(str(tmp_path / f"{name}-feed"))
        stream = rows_of(read_stream(spark, "parquet", SCHEMA, path=str(tmp_path / f"{name}-feed")))
        checkpoint = str(tmp_path / f"{name}-state")
        query = start_live(stream, live_writer(spark, str(tmp_path / name), checkpoint), checkpoint, every=None, mode=mode).start()
        query.awaitTermination()
        reports += [json.loads(report.json) for report in query.recentProgress]
    return reports


def chance_feed(seed, leaves=(300,)):
    """Sightings in order of time, cut into batches between seconds, and the second that a clock 60 behind shows."""
    rng = random.Random(seed)
    leave = {entity: rng.choice(leaves) for entity in (1, 2, 30)}
    events = sorted((rng.randrange(0, 9000), rng.choice([1, 2, 30]), rng.choice("ABCDE")) for _ in range(160))
    events = [(entity, mac, 1_000_000 + t, leave[entity]) for t, entity, mac in events]
    cuts = sorted({0, len(events), rng.randrange(40, 120)})
    cuts = [c for c in cuts if c in (0, len(events)) or events[c][2] != events[c - 1][2]]
    return [events[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], events, events[-1][2] - 60


@pytest.mark.parametrize("seed, slots", [(1, 4)])
def test_a_feed_in_order_gives_the_batch_result_as_of_the_clock(spark, tmp_path, seed, slots):
    batches, events, clock = chance_feed(seed, (0, 30, 300, 2000))
    whole = frame(spark, SCHEMA, *events)
    fed(spark, tmp_path, batches, lambda s: expiring_visits(s, delay="60 seconds", slots=slots))
    expected = rows(live_visits_batch(whole, as_of=clock), *VISIT, "done")
    assert rows(read_live_visits(spark, str(tmp_path / "out")), *VISIT, "done") == expected
    assert {done for *_, done in expected} == {0, 1}
    fed(spark, tmp_path, batches, lambda s: expiring_visits(s, "trigger", "60 seconds", slots), "closed")
    expected = rows(closed_visits(whole, as_of=clock), *VISIT)
    assert rows(read_live_visits(spark, str(tmp_path / "closed")), *VISIT) == expected
    fed(spark, tmp_path, batches, lambda s: closed_visits_windowed(s, "60 seconds"), "windowed", "append")
    assert rows(read_closed_visits(spark, str(tmp_path / "windowed")), *VISIT) == expected


def test_a_visit_ends_though_the_device_stays_away_and_no_state_is_left(spark, tmp_path):
    batches = [[(1, "a", 1000, 300), (1, "b", 1000, 300), (1, "b", 1250, 300)], [(2, "z", 1400, 300)], [(2, "y", 9000, 300)]]
    reports = fed(spark, tmp_path, batches, lambda s: expiring_visits(s, delay="10 seconds", slots=64))
    assert rows(read_live_visits(spark, str(tmp_path / "out")), *VISIT, "done") == [
        ("a", 1, 1000, 1000, 0, 1), ("b", 1, 1000, 1250, 250, 1), ("y", 2, 9000, 9000, 0, 0), ("z", 2, 1400, 1400, 0, 1)]
    # Each change as its batch had it: a ends in the second run, when the clock has passed 1300.
    changes = spark.read.parquet(str(tmp_path / "out"))
    assert rows(changes.filter("clientmac = 'a'").orderBy("batch_id"), "done") == [(0,), (1,)]
    left = [operator["numRowsTotal"] for report in reports for operator in report["stateOperators"]]
    # One slot for each device that may come back, none for those that are done.
    assert max(left) <= 3 and left[-1] == 1


def test_late_sightings_are_dropped_and_a_new_visit_begins_after_the_end(spark, tmp_path):
    batches = [[(1, "a", 1000, 300), (1, "b", 5000, 300)], [(1, "a", 900, 300), (1, "c", 4000, 300), (1, "a", 4995, 300)], [(1, "a", 5100, 300)]]
    reports = fed(spark, tmp_path, batches, lambda s: expiring_visits(s, delay="10 seconds", slots=2))
    assert rows(read_live_visits(spark, str(tmp_path / "out")), *VISIT, "done") == [
        ("a", 1, 1000, 1000, 0, 1), ("a", 1, 4995, 5100, 105, 0), ("b", 1, 5000, 5000, 0, 0)]
    assert sum(operator["numRowsDroppedByWatermark"] for report in reports for operator in report["stateOperators"]) == 2


def test_a_longer_leave_time_does_not_open_an_ended_visit_again(spark, tmp_path):
    batches = [[(1, "a", 1000, 100), (1, "b", 1200, 100)], [(1, "a", 1250, 900)], [(1, "a", 1300, 900)]]
    fed(spark, tmp_path, batches, lambda s: expiring_visits(s, delay="10 seconds", slots=1))
    assert rows(read_live_visits(spark, str(tmp_path / "out")), *VISIT, "done") == [
        ("a", 1, 1000, 1000, 0, 1), ("a", 1, 1250, 1300, 50, 0), ("b", 1, 1200, 1200, 0, 0)]


def test_slots_hold_many_devices(spark, tmp_path):
    first = [(e, f"{d:03}", 1000 + d, 300) for e in (1, 2) for d in range(150)]
    second = [(e, mac, t + 299 + e, leave) for e, mac, t, leave in first]
    fed(spark, tmp_path, [first, second], lambda s: expiring_visits(s, delay="1 hour", slots=3))
    found = rows(read_live_visits(spark, str(tmp_path / "out")).groupBy("entityid", "done").count())
    # A gap of 300 ends a visit, also when both lie in one slot.
    assert found == [(1, 0, 150), (1, 1, 150), (2, 0, 150), (2, 1, 150)]


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        expiring_visits(frame(spark, SCHEMA), "latest")


def test_session_windows_need_no_python(spark, tmp_path):
    seen = frame(spark, SCHEMA, (1, "a", 1000, 300), (1, "a", 1300, 300), (1, "a", 1700, None), (1, "b", 5, 0), (1, "b", 5, 0), (1, "b", 6, -4), (1, "c", None, 9))
    plan = closed_visits_windowed(seen)._jdf.queryExecution().toString()
    assert "SessionWindow" in plan.replace("session_window", "SessionWindow") and "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert rows(closed_visits_windowed(seen), *VISIT) == [
        ("a", 1, 1000, 1300, 300), ("a", 1, 1700, 1700, 5), ("b", 1, 5, 5, 5), ("b", 1, 6, 6, 5)]
    # A gap as long as the leave time parts visits where the gap is not strict.
    assert rows(closed_visits_windowed(seen, strict_gap=False), *VISIT)[:2] == [("a", 1, 1000, 1000, 5), ("a", 1, 1300, 1300, 5)]


def test_state_of_session_windows_goes_with_the_watermark(spark, tmp_path):
    batches = [[(1, f"d{i}", 1000 + i, 60) for i in range(50)], [(1, "late", 90_000, 60)], [(1, "d1", 1001, 60), (1, "x", 200_000, 60)]]
    reports = fed(spark, tmp_path, batches, lambda s: closed_visits_windowed(s, "1 minute"), mode="append")
    state = [operator["numRowsTotal"] for report in reports for operator in report["stateOperators"]]
    assert max(state) >= 50 and state[-1] == 1
    assert read_closed_visits(spark, str(tmp_path / "out")).count() == 51
    assert read_closed_visits(spark, str(tmp_path / "out")).filter(F.col("clientmac") == "d1").count() == 1


def test_as_of_takes_the_leave_time_of_the_last_sighting(spark):
    seen = frame(spark, SCHEMA, (1, "a", 100, 500), (1, "a", 200, 150), (1, "b", 200, None))
    assert rows(live_visits_batch(seen, as_of=349), "clientmac", "done") == [("a", 0), ("b", 0)]
    assert rows(live_visits_batch(seen, as_of=350), "clientmac", "done") == [("a", 1), ("b", 0)]
    assert rows(closed_visits(seen, as_of=500), "clientmac", "seconds") == [("a", 100), ("b", 5)]


@pytest.mark.parametrize("provider", ["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"])
def test_any_state_store_will_do(spark, tmp_path, provider):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, f"org.apache.spark.sql.execution.streaming.state.{provider}")
    try:
        batches = [[(1, "a", 1000, 300), (1, "b", 1000, 300)], [(1, "b", 1250, 300), (2, "z", 1400, 300)]]
        fed(spark, tmp_path, batches, lambda s: expiring_visits(s, delay="10 seconds", slots=2))
    finally:
        spark.conf.set(name, before)
    assert rows(read_live_visits(spark, str(tmp_path / "out")), *VISIT, "done") == [
        ("a", 1, 1000, 1000, 0, 1), ("b", 1, 1000, 1250, 250, 0), ("z", 2, 1400, 1400, 0, 0)]
