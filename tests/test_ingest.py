"""Probe files taken in once each, access points that move, the backlog of a folder, the report's look-ups, parts of days."""

import pytest
from pyspark.sql import functions as F

from helpers import frame, physical, probes, rows, thresholds
from passerby.operators import sessions
from passerby.operators.ingest import ingest_backlog, probe_files_found
from passerby.operators.matching import access_point_history, match_as_of
from passerby.functions import sizes
from passerby.sources import tables
from passerby.sources.feeds import read_stream
from passerby.sources.tables import (
    read_processing_log, read_sessions, read_stored_probes, visitor_rows, write_days, write_processing_log, write_report,
)
from passerby.streaming.files import ingest_files
from passerby.streaming.sinks import live_writer, matched_writer, read_matched, start_live


def send(folder, entity, date, text):
    (folder / str(entity)).mkdir(parents=True, exist_ok=True)
    (folder / str(entity) / f"t_cf_{date}.txt").write_text(text)


def stay(mac, first, last):
    return f"{mac},{first},1\n{mac},{last},1\n"


def test_each_file_is_taken_once_also_after_a_failure(spark, tmp_path):
    source, root, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    limits, runs, fail = thresholds(spark, entity=7), [], [False]

    def then(run):
        runs.append(run)
        if fail[0]:
            raise RuntimeError("lost between the write and the commit")

    def take():
        ingest_files(spark, str(source), limits, root, checkpoint, files_per_batch=1, then=then).start().awaitTermination()

    def published():
        return rows(read_sessions(spark, f"{root}/rec_indoor"), "clientmac", "etime", "ltime")

    day = 1705276800
    send(source, 7, "20240115", stay("a", day + 100, day + 200) + "broken,line\n")
    send(source, 7, "20240116", stay("a", day + 86500, day + 86600))
    take()
    assert published() == [("a", day + 100, day + 200), ("a", day + 86500, day + 86600)] and len(runs) == 2
    take()
    assert len(runs) == 2
    send(source, 7, "20240117", stay("b", day + 2 * 86400 + 5, day + 2 * 86400 + 65))
    fail[0] = True
    with pytest.raises(Exception, match="lost between"):
        take()
    fail[0] = False
    take()
    # The file came again as the same run, which replaced what it had left.
    assert runs[2] == runs[3] and len(runs) == 4
    assert published()[2:] == [("b", day + 2 * 86400 + 5, day + 2 * 86400 + 65)]
    stored = read_stored_probes(spark, f"{root}/t_cf")
    assert stored.count() == 6 and stored.select("run").distinct().count() == 3
    assert spark.read.json(f"{root}/rejects/{runs[0]}").count() + spark.read.schema("raw_stime string").json(f"{root}/rejects/{runs[1]}").count() == 1


CHANGES = "apmac string, entityid int, rssi int, indoor_seconds long, leave_seconds long, changed_at long, removed boolean"
SEEN = "apmac string, mac string, rssi int, stime long"


def moves(spark):
    return frame(spark, CHANGES, ("p", 1, -50, 10, 300, 0, False), ("p", 1, -50, 10, 300, 1000, True), ("p", 2, -50, 20, 600, 1000, False),
                 ("p", 3, -50, 10, 300, 500, False), ("q", 1, -50, 10, 300, 100, False), ("q", 1, -90, 10, 300, 200, False), ("q", 1, -90, 10, 300, 200, True))


@pytest.mark.parametrize("dimension_rows", [100_000, 0])
def test_a_sighting_counts_where_its_access_point_was(spark, monkeypatch, dimension_rows):
    monkeypatch.setattr(sizes, "DIMENSION_ROWS", dimension_rows)
    seen = frame(spark, SEEN, *[("p", f"m{t}", -10, t) for t in (0, 499, 500, 999, 1000, 5000)], ("q", "a", -60, 150), ("q", "b", -10, 150), ("q", "c", -10, 200), ("r", "d", -10, 1))
    found = match_as_of(seen, access_point_history(moves(spark)))
    assert rows(found, "mac", "entityid", "leave_seconds") == sorted([
        ("m0", 1, 300), ("m499", 1, 300), ("m500", 1, 300), ("m500", 3, 300), ("m999", 1, 300), ("m999", 3, 300),
        ("m1000", 2, 600), ("m1000", 3, 300), ("m5000", 2, 600), ("m5000", 3, 300), ("b", 1, 300), ("c", 1, 300)])


def test_one_access_point_with_most_sightings_is_no_one_tasks(spark, monkeypatch):
    plan = physical(match_as_of(frame(spark, SEEN, ("p", "a", -10, 1)), access_point_history(moves(spark))))
    # Only the history is sorted, by its windows, not the sightings.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Window") == 1


def test_the_stream_reads_the_dimension_anew(spark, tmp_path):
    dimension, feed, path, state = (str(tmp_path / name) for name in ("dimension", "feed", "out", "state"))
    known = [moves(spark).filter("changed_at < 1000"), moves(spark)]
    for n, changes in enumerate(known):
        frame(spark, SEEN, ("p", f"m{n}", -10, 900 + 200 * n)).write.mode("append").parquet(feed)
        writer = matched_writer(spark, path, state, lambda changes=changes: access_point_history(changes), match_as_of)
        start_live(read_stream(spark, "parquet", SEEN, path=feed), writer, state, every=None, mode="append").start().awaitTermination()
    assert rows(spark.read.parquet(path), "mac", "entityid") == [("m0", 1), ("m0", 3), ("m1", 2), ("m1", 3)]
    layout = match_as_of(frame(spark, SEEN), access_point_history(moves(spark))).schema
    query = start_live(read_matched(spark, path, layout).groupBy("entityid").count(), live_writer(spark, str(tmp_path / "counts"), str(tmp_path / "s2")),
                       str(tmp_path / "s2"), every=None).start()
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "counts")), "entityid", "count") == [(1, 1), (2, 1), (3, 2)]


def test_backlog_of_a_folder(spark, tmp_path):
    send(tmp_path, 7, "20240115", "x" * 100)
    send(tmp_path, 7, "20240116", "y" * 50)
    send(tmp_path, 9, "20240116", "")
    (tmp_path / "8").mkdir()
    (tmp_path / "7" / "notes.txt").write_text("no probes")
    # A file without a byte has no probes to wait for.
    entities = frame(spark, "entityid int", (7,), (8,), (10,))
    found = probe_files_found(spark, str(tmp_path), entities)
    assert sorted((r.folder, (r.path or "").rsplit("/", 1)[-1], r.length) for r in found.collect()) == [
        ("10", "", None), ("7", "t_cf_20240115.txt", 100), ("7", "t_cf_20240116.txt", 50), ("8", "", None)]
    scan = physical(found)
    assert "content" not in scan[scan.index("ReadSchema"):].split("\n")[0]
    assert rows(ingest_backlog(found, 1)) == [(1, 2, 1, 2, 0)]


def scanned_rows(df):
    """How many rows the scan gave on, as Spark's own metric has it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.getClass().getName() else plan
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_one_visitor_is_found_in_a_few_row_groups(spark, tmp_path):
    report = spark.range(200_000).select(
        (F.col("id") % 5).cast("int").alias("entityid"), F.md5((F.col("id") % 20_000).cast("string")).alias("clientmac"), F.col("id").alias("utoday"))
    path = str(tmp_path / "report")
    write_report(report.repartition(7), path, row_group=100_000)
    device = report.filter("id = 4321" if "id" in report.columns else "utoday = 4321").first()
    found = visitor_rows(spark, path, device.entityid, device.clientmac)
    assert found.count() == 10 and scanned_rows(found) <= 2_000
    # A device that was never there, within the range of others, is refused by the Bloom filters.
    assert scanned_rows(visitor_rows(spark, path, device.entityid, "8" + "0" * 31)) == 0


def test_log_is_read_as_it_was_written(spark, tmp_path):
    log = frame(spark, "operType string, processDate string, fileName string", ("b", "2", "x"), ("a", "1", "y"))
    write_processing_log(log, str(tmp_path / "log"))
    assert [tuple(r) for r in read_processing_log(spark, str(tmp_path / "log")).collect()] == [("a", "1", "y"), ("b", "2", "x")]


def test_a_large_day_is_cut_by_venue_and_parts_left_empty_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PART_ROWS", 4)
    path, limits = tmp_path / "rec", thresholds(spark, indoor=0)
    venues = [sessions.sessionize(probes(spark, ("a", 5, 1), ("a", 25, 1), entity=e), limits) for e in range(1, 17)]
    whole = venues[0]
    for more in venues[1:]:
        whole = whole.unionByName(more)
    write_days(whole, str(path))
    names = lambda: {str(f.relative_to(path)) for f in path.rglob("*.parquet")}
    before = names()
    assert {name.split("/")[1] for name in before} <= {f"part={n}" for n in range(4, 8)} and len(before) > 1
    # The cut stays as it was begun with, however many rows there are.
    monkeypatch.setattr(tables, "PART_ROWS", 1)
    write_days(sessions.sessionize(probes(spark, ("b", 9, 1), ("b", 29, 1), entity=3), limits), str(path))
    assert len(before - names()) == 1 == len(names() - before)
    assert rows(read_sessions(spark, str(path)), "entityid", "clientmac") == sorted((e, "b" if e == 3 else "a") for e in range(1, 17))
    every = frame(spark, "entityid int, file_day long", *[(e, 0) for e in range(1, 17)])
    write_days(whole.filter("entityid = 3"), str(path), every)
    assert rows(read_sessions(spark, str(path)), "entityid") == [(3,)] and len(names()) == 1
    write_days(whole.filter("false"), str(path), every)
    assert names() == set() and rows(read_sessions(spark, str(path))) == []
