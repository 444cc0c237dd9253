import random

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows, sightings
from passerby.functions import sizes
from passerby.operators.sessions import closed_visits, live_visits_batch
from passerby.schemas import VISIT_KEYS
from passerby.sources.feeds import explode_payload, parse_matched_feed, read_stream
from passerby.streaming.heatmap import live_heatmap
from passerby.streaming.live import live_visits
from passerby.streaming.sinks import (
    change_writer, compact, fold_changes, live_writer, newest, read_heatmap, read_live_visits, run_of, start_live,
)

SPAN = ("etime", "ltime", "seconds", "done")


def feed(tmp_path, batches, name="feed"):
    """One text file per micro-batch, each holding one message per line."""
    folder = tmp_path / f"in-{name}"
    folder.mkdir(exist_ok=True)
    for i, lines in enumerate(batches):
        (folder / f"{i:03}.txt").write_text("".join(line + "\n" for line in lines))
        stamp = 1_700_000_000 + i
        import os
        os.utime(folder / f"{i:03}.txt", (stamp, stamp))
    return str(folder)


def run_visits(spark, tmp_path, batches, rule="current", name="out", state=None):
    lines = [[f"m,{e},{mac},{t},10,{'' if leave is None else leave}" for e, mac, t, leave in b] for b in batches]
    source = feed(tmp_path, lines, state or "feed")
    messages = read_stream(spark, "text", path=source, maxFilesPerTrigger=1)
    visits = live_visits(parse_matched_feed(explode_payload(messages)), rule)
    path, checkpoint = str(tmp_path / name), str(tmp_path / (state or f"{name}-state"))
    query = start_live(visits, live_writer(spark, path, checkpoint), checkpoint, every=None).start()
    query.awaitTermination()
    return read_live_visits(spark, path)


ARRIVALS = [[(1, "a", t, 300)] for t in (1000, 1100, 1050, 1400, 1350, 2000, 3000)]


@pytest.mark.parametrize("rule, expected", [
    ("current", [(1000, 1100, 100, 1), (1400, 1400, 0, 1), (2000, 2000, 0, 1), (3000, 3000, 0, 0)]),
    ("latest", [(1000, 1050, 50, 1), (1400, 1350, -50, 1), (2000, 2000, 0, 1), (3000, 3000, 0, 0)]),
    ("trigger", [(1000, 1400, 400, 1), (2000, 2000, 5, 1)]),
])
def test_rules_by_arrival(spark, tmp_path, rule, expected):
    assert rows(run_visits(spark, tmp_path, ARRIVALS, rule), *SPAN) == expected


def test_any_split_of_ordered_input_is_the_batch_result(spark, tmp_path):
    rng = random.Random(5)
    events = sorted((rng.randrange(0, 20000), rng.choice([1, 10, 100]), rng.choice("AB")) for _ in range(250))
    batches, left = [], list(events)
    while left:
        n = rng.randrange(1, 90)
        while n < len(left) and left[n][0] == left[n - 1][0]:
            n += 1
        batches.append([(e, mac, t, 300) for t, e, mac in left[:n]])
        left = left[n:]
    whole = frame(spark, "entityid int, clientmac string, stime long, leave_seconds long",
                  *[(e, mac, t, 300) for t, e, mac in events])
    live = run_visits(spark, tmp_path, batches)
    assert rows(live, "clientmac", "entityid", *SPAN) == \
        rows(live_visits_batch(whole), "clientmac", "entityid", *SPAN)
    closed = run_visits(spark, tmp_path, batches, "trigger", "closed")
    assert rows(closed, "clientmac", "entityid", "etime", "ltime", "seconds") == \
        rows(closed_visits(whole), "clientmac", "entityid", "etime", "ltime", "seconds")


def test_order_inside_a_batch_and_repeats_do_not_matter(spark, tmp_path):
    mixed = [(1, "a", t, 300) for t in (1400, 1000, 1100, 1000, 1400, 3000, 2000)]
    assert rows(run_visits(spark, tmp_path, [mixed]), *SPAN) == [
        (1000, 1100, 100, 1), (1400, 1400, 0, 1), (2000, 2000, 0, 1), (3000, 3000, 0, 0)]


def test_only_the_newest_of_a_batch_counts_under_the_latest_rule(spark, tmp_path):
    batches = [[(1, "a", 1000, 300), (1, "a", 1010, 300)], [(1, "a", 1020, 300), (1, "a", 1200, 300)]]
    assert rows(run_visits(spark, tmp_path, batches, "latest"), *SPAN) == [(1010, 1200, 190, 0)]


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        live_visits(sightings(spark, [1]), "other")


def test_a_new_checkpoint_starts_a_new_run_beside_the_earlier(spark, tmp_path):
    first = [[(1, mac, 1000, 300)] for mac in "ABC"]
    assert rows(run_visits(spark, tmp_path, first, state="one"), "clientmac") == [("A",), ("B",), ("C",)]
    second = [[(1, "Z", 5000, 300)], [(1, "Z", 5100, 300)]]
    assert rows(run_visits(spark, tmp_path, second, state="two"), "clientmac", *SPAN) == [("Z", 5000, 5100, 100, 0)]
    every = spark.read.parquet(str(tmp_path / "out"))
    assert rows(every.select("run", "clientmac").distinct()) == [(1, "A"), (1, "B"), (1, "C"), (2, "Z")]


def test_a_checkpoint_goes_on_with_its_run(spark, tmp_path):
    batches = [[(1, "a", 1000, 300)]]
    run_visits(spark, tmp_path, batches, state="one")
    assert rows(run_visits(spark, tmp_path, [*batches, [(1, "a", 1100, 300)]], state="one"), *SPAN) == [(1000, 1100, 100, 0)]
    assert spark.read.parquet(str(tmp_path / "out")).select("run").distinct().count() == 1


def test_a_checkpoint_of_another_writer_is_refused(spark, tmp_path):
    (tmp_path / "old" / "offsets").mkdir(parents=True)
    with pytest.raises(ValueError):
        run_of(spark, str(tmp_path / "out"), str(tmp_path / "old"))


def test_no_leave_time_is_the_default(spark, tmp_path):
    assert rows(run_visits(spark, tmp_path, [[(1, "a", 1000, None), (1, "a", 1299, None)], [(1, "a", 1599, None)]]), *SPAN) == [
        (1000, 1299, 299, 1), (1599, 1599, 0, 0)]


@pytest.mark.parametrize("steps", [1, 2, 4])
def test_compaction_changes_no_row(spark, tmp_path, steps):
    out = str(tmp_path / "out")
    seen = []
    for step in range(steps):
        batches = [[(1, mac, 1000 + 150 * i, 300)] for i, mac in enumerate("ABABCA"[:step + 3])]
        state = f"run{step // 2}"
        expected = rows(run_visits(spark, tmp_path, batches, state=state), "clientmac", *SPAN)
        assert compact(spark, out, "visits") >= 0
        assert rows(read_live_visits(spark, out), "clientmac", *SPAN) == expected
        seen.append(expected)
        assert compact(spark, out, "visits") == 0
    import os
    left = [name for run in os.listdir(out) if run.startswith("run=") for name in os.listdir(f"{out}/{run}") if name.startswith("batch_id=")]
    assert len(left) <= 7 and seen[-1]


@pytest.mark.parametrize("dimension_rows", [100_000, 0])
def test_live_heatmap(spark, tmp_path, monkeypatch, dimension_rows):
    monkeypatch.setattr(sizes, "DIMENSION_ROWS", dimension_rows)

    def line(mac, rssi, time):
        return f"0,1,p,{mac},{rssi},2024-01-15 {time}"

    source = feed(tmp_path, [
        [line("A", -10, "12:00:00"), line("A", -70, "12:00:01"), line("B", -50, "12:00:02")],
        [line("C", -80, "12:04:59"), line("D", -10, "12:05:00"), line("E", -10, "11:00:00"), "broken"],
    ])
    ap = frame(spark, "apmac string, entityid int, rssi int, nearbyrssi int", ("p", 1, -20, -60))
    messages = read_stream(spark, "text", path=source, maxFilesPerTrigger=1)
    now = F.lit("2024-01-15 12:06:00").cast("timestamp")
    for mode, first in (("matching", (1, 2, 1)), ("tagged", (4, 4, 3))):
        path = str(tmp_path / mode)
        start_live(live_heatmap(messages, ap, mode, now, "10 minutes"), change_writer(path),
                   str(tmp_path / f"{mode}-state"), every=None).start().awaitTermination()
        got = [(str(r[1])[11:], *r[2:]) for r in rows(read_heatmap(spark, path))]
        assert got[0] == ("12:00:00", *first)
        assert got[1] == ("12:05:00", 1, 0, 0) if mode == "matching" else ("12:05:00", 1, 1, 1)
        assert len(got) == 2


def test_repeating_a_micro_batch_changes_nothing(spark, tmp_path):
    visits = frame(spark, "clientmac string, entityid int, etime long, ltime long, seconds long, done int",
                   ("a", 1, 5, 9, 4, 0))
    closed = visits.withColumn("done", F.lit(1))
    write = change_writer(str(tmp_path / "log"))
    write(visits, 0)
    write(closed, 1)
    write(closed, 1)
    assert rows(read_live_visits(spark, str(tmp_path / "log")), "etime", "done") == [(5, 1)]
    assert rows(newest(spark.read.parquet(str(tmp_path / "log")), VISIT_KEYS), "etime", "done") == [(5, 1)]
    raw = spark.read.parquet(str(tmp_path / "log"))
    assert raw.count() == 2
    other = visits.withColumn("etime", F.lit(1).cast("long"))
    assert rows(fold_changes(visits.unionByName(other), raw, VISIT_KEYS), "etime", "done") == [(1, 0), (5, 1)]
