"""A keyed store in buckets: joins without a shuffle of it, and only the days with changes written again."""

import re

import pytest

from helpers import frame, physical, rows
from passerby.sources.store import changed_store, create_store, open_store, read_store, update_store
from passerby.sources.tables import on_days

DAY = 86400
SESSION = "clientmac string, entityid int, etime long, ltime long, seconds long"


def sessions(spark, *items):
    return frame(spark, SESSION, *[(mac, entity, etime, etime + seconds, seconds) for mac, entity, etime, seconds in items])


@pytest.fixture
def store(spark, tmp_path):
    name = "kept"
    every = sessions(spark, *[(f"m{i}", i % 3, d * DAY + i, 10) for d in range(4) for i in range(1, 60)])
    create_store(every, name, str(tmp_path / "kept"), buckets=4)
    yield name, tmp_path / "kept"
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_changes_touch_their_days_alone(spark, store):
    name, path = store
    before, old = files(path), rows(read_store(spark, name))
    put = sessions(spark, ("m1", 1, DAY + 1, 99), ("new", 7, DAY + 5, 1))
    gone = frame(spark, "entityid int, clientmac string, etime long", (2, "m2", DAY + 2), (9, "none", 5 + DAY))
    assert update_store(spark, name, put, gone) == [DAY]
    after = files(path)
    same = {file for file in before if before[file] == after.get(file)}
    assert {file.split("/")[0] for file in same} == {f"file_day={d * DAY}" for d in (0, 2, 3)}
    assert {file.split("/")[0] for file in before.keys() ^ after.keys()} == {f"file_day={DAY}"}
    expected = {row for row in old if row[2] not in (DAY + 1, DAY + 2)} | {("m1", 1, DAY + 1, DAY + 100, 99), ("new", 7, DAY + 5, DAY + 6, 1)}
    assert rows(read_store(spark, name)) == sorted(expected)
    # A bucket of a day is one file, before and after.
    assert all(n <= 4 for n in [sum(file.startswith(f"file_day={d * DAY}/") for file in after) for d in range(4)])
    # Again, as after a failure.
    update_store(spark, name, put, gone)
    assert rows(read_store(spark, name)) == sorted(expected)


def test_the_store_is_not_shuffled(spark, store):
    name, _ = store
    put = sessions(spark, ("m1", 1, DAY + 1, 99))
    gone = frame(spark, "entityid int, clientmac string, etime long", (2, "m2", DAY + 2))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(changed_store(spark.table(name).filter(on_days([DAY])), put, gone))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = plan.index("FileScan parquet")
    above = plan[:scan].splitlines()
    depth = len(re.match(r"[^A-Za-z*]*", plan[:scan].splitlines()[-1] + plan[scan:].splitlines()[0])[0])
    # Going up from the scan, the first operator with two inputs comes before any exchange.
    for line in reversed(above):
        own = len(re.match(r"[^A-Za-z*]*", line)[0])
        if own < depth and "Join" in line:
            break
        assert not (own < depth and "Exchange" in line), plan
        depth = min(depth, own) if own < depth else depth
    assert "SelectedBucketsCount: 4 out of 4" in plan and "PartitionFilters: [isnotnull(file_day" in plan


def test_a_day_left_without_rows_goes(spark, store):
    name, path = store
    gone = read_store(spark, name).filter(f"etime BETWEEN {2 * DAY} AND {3 * DAY - 1}").select("entityid", "clientmac", "etime")
    nothing = sessions(spark)
    assert update_store(spark, name, nothing, frame(
        spark, "entityid int, clientmac string, etime long", *[tuple(r) for r in gone.collect()])) == [2 * DAY]
    assert read_store(spark, name).count() == 3 * 59 and read_store(spark, name).filter(f"etime DIV {DAY} = 2").count() == 0
    assert update_store(spark, name, nothing, frame(spark, "entityid int, clientmac string, etime long")) == []


def test_another_session_opens_the_store(spark, store):
    name, path = store
    open_store(spark, "again", str(path), buckets=4)
    try:
        update_store(spark, "again", sessions(spark, ("x", 1, 9 * DAY, 3)), frame(spark, "entityid int, clientmac string, etime long"))
        assert spark.table("again").count() == 4 * 59 + 1
    finally:
        spark.sql("DROP TABLE again")


def test_a_key_in_both_is_put_in(spark, store):
    name, _ = store
    update_store(spark, name, sessions(spark, ("m1", 1, DAY + 1, 5)), frame(spark, "entityid int, clientmac string, etime long", (1, "m1", DAY + 1)))
    assert rows(read_store(spark, name).filter(f"etime = {DAY + 1}"), "seconds") == [(5,)]


@pytest.mark.parametrize("lengths", [(0, 60), (60, 0)])
def test_a_key_put_in_twice_is_kept_as_its_longest_row(spark, store, lengths):
    name, _ = store
    put = sessions(spark, *[("m1", 1, DAY + 1, seconds) for seconds in lengths]).coalesce(1)
    update_store(spark, name, put, frame(spark, "entityid int, clientmac string, etime long"))
    assert rows(read_store(spark, name).filter(f"etime = {DAY + 1} AND clientmac = 'm1'"), "ltime", "seconds") == [(DAY + 61, 60)]
