"""The visits of a slot of devices against those of each device by itself, and what a slot costs."""

import json
import random

import pandas as pd
import pytest

from helpers import frame, rows
from passerby.sources.feeds import read_stream
from passerby.streaming.live import live_visits
from passerby.streaming.sinks import live_writer, read_live_visits, start_live
from passerby.streaming.slots import advanced, distinct_seconds, shown

SCHEMA = "entityid int, clientmac string, stime long, leave_seconds long"
NONE = pd.DataFrame({"entityid": [], "clientmac": [], "etime": [], "ltime": [], "leave_seconds": []})


def one_by_one(rule, batches):
    """Changes of each batch, by a plain loop over the seconds of each device."""
    open_visits, out = {}, []
    for batch in batches:
        changes, seconds = set(), {}
        for venue, mac, second, leave in batch:
            own = seconds.setdefault((venue, mac), {})
            own[second] = min(leave, own.get(second, leave))
        for key, own in seconds.items():
            for second in [max(own)] if rule == "latest" else sorted(own):
                begun, end = open_visits.get(key, (None, None))
                if end is not None and rule != "latest" and second <= end:
                    continue
                if end is not None and not (second - end > own[second] if rule == "trigger" else second - end >= own[second]):
                    changes.discard((key, begun, end, 0))
                    open_visits[key] = (begun, second)
                else:
                    if end is not None:
                        changes.discard((key, begun, end, 0))
                        changes.add((key, begun, end, 1))
                    open_visits[key] = (second, second)
                changes.add((key, *open_visits[key], 0))
        if rule == "trigger":
            changes = {change for change in changes if change[3]}
        out.append(sorted((mac, venue, begun, end, (end - begun) or (5 if rule == "trigger" else 0), done) for (venue, mac), begun, end, done in changes))
    return out


@pytest.mark.parametrize("rule", ["current", "latest", "trigger"])
def test_a_slot_gives_what_its_devices_give_one_by_one(rule):
    rng = random.Random(rule)
    for _ in range(30):
        leaves = {venue: rng.choice([1, 30, 300]) for venue in (1, 2, 30)}
        batches = [[(venue, mac, 1000 * step // 2 + rng.randrange(900), leaves[venue]) for _ in range(rng.randrange(1, 60))
                    for venue, mac in [(rng.choice([1, 2, 30]), rng.choice("ABC"))]] for step in range(4)]
        held, out = NONE, []
        for batch in batches:
            seen = pd.DataFrame(batch, columns=["entityid", "clientmac", "stime", "leave_seconds"])
            visits = advanced(held, distinct_seconds([seen[:7], seen[7:]], rule == "latest"), rule)
            held = visits[visits["done"] == 0][NONE.columns]
            changed = visits[(visits["fresh"] == 1) | (visits["done"] == 1)]
            out.append(sorted(map(tuple, shown(changed, rule, 5).values.tolist())))
        assert out == one_by_one(rule, batches)


def test_seconds_are_folded_as_they_come():
    part = pd.DataFrame({"entityid": 1, "clientmac": "a", "stime": range(60_000), "leave_seconds": 9})
    found = distinct_seconds([part, part, part.assign(leave_seconds=4), part])
    assert len(found) == 60_000 and set(found["leave_seconds"]) == {4}
    assert distinct_seconds([part, part], latest=True).values.tolist() == [[1, "a", 59_999, 9]]


def test_live_visits_hold_a_state_for_each_slot_and_not_for_each_device(spark, tmp_path):
    first = [(e, f"{d:03}", 1000 + d, 300) for e in (1, 2) for d in range(150)]
    second = [(e, mac, t + 298 + e, leave) for e, mac, t, leave in first]
    state = []
    for batch in (first, second):
        frame(spark, SCHEMA, *batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
        visits = live_visits(read_stream(spark, "parquet", SCHEMA, path=str(tmp_path / "feed")), slots=3)
        checkpoint = str(tmp_path / "state")
        query = start_live(visits, live_writer(spark, str(tmp_path / "out"), checkpoint), checkpoint, every=None).start()
        query.awaitTermination()
        state += [operator["numRowsTotal"] for report in query.recentProgress for operator in json.loads(report.json)["stateOperators"]]
    # A gap of 299 goes on, one of 300 parts.
    found = rows(read_live_visits(spark, str(tmp_path / "out")).groupBy("entityid", "done").count())
    assert found == [(1, 0, 150), (2, 0, 150), (2, 1, 150)] and max(state) == 3
