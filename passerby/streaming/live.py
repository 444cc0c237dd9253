"""Live visits: one open visit per device and venue, kept in Spark's state store.

Before the shuffle each Arrow batch is reduced to one row per device, venue and
second, so a device that sends a large share of a micro-batch is mostly folded
where it is read. The state handler, see `slots`, then holds the distinct seconds
of one slot of devices in one micro-batch and never its sightings.
"""

from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

from passerby.operators.sessions import known_sightings
from passerby.streaming.slots import OUTPUT, SLOTS, STATE, advanced, dealt, distinct_seconds, held_visits, hold, shown

RULES = ("current", "latest", "trigger")


def fold_batches(sightings: DataFrame, latest: bool) -> DataFrame:
    """Each Arrow batch's devices, venues and seconds once; with ``latest`` the newest second of each device and venue."""
    keys = ["entityid", "clientmac"] if latest else ["entityid", "clientmac", "stime"]
    measures = [("stime", "max"), ("leave_seconds", "min")] if latest else [("leave_seconds", "min")]
    names = keys + [f"{column}_{how}" for column, how in measures]

    def fold(batches):
        import pyarrow as pa

        for batch in batches:
            grouped = pa.Table.from_batches([batch]).group_by(keys, use_threads=False)
            folded = grouped.aggregate(measures)
            folded = folded.select(names).rename_columns(keys + [column for column, _ in measures])
            yield from folded.to_batches()

    columns = sightings.select(*keys, *[column for column, _ in measures])
    return columns.mapInArrow(fold, columns.schema)


def live_visits(sightings: DataFrame, rule: str = "current", floor_seconds: int = 5, slots: int = SLOTS) -> DataFrame:
    """Visits changed by each micro-batch, for a streaming sink in update mode.

    ``sightings`` streams entityid, clientmac, stime and leave_seconds. A row
    ``clientmac, entityid, etime, ltime, seconds, done`` replaces the earlier
    one of the same device, venue and etime. Rules:

    - ``current``: a gap of the leave time or more ends a visit, and a sighting
      not newer than the visit's end is ignored.
    - ``latest``: the same gap, but only the newest sighting of a micro-batch
      counts, and one older than the visit's end moves that end back.
    - ``trigger``: a gap of more than the leave time ends a visit, older
      sightings are ignored, and only ended visits come out, those of a single
      moment ``floor_seconds`` long.

    A sighting without a leave time has the default one. One without a venue,
    device or time belongs to no visit: the feed's rejects hold it.

    State is kept for every device and venue seen since the start. A new
    checkpoint location starts with none; starting anew each night keeps the
    state to a day's devices. ``slots`` is fixed by the first checkpoint: some
    for every core.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")

    def advance(key, frames, state):
        visits = advanced(held_visits(state), distinct_seconds(frames, rule == "latest"), rule)
        hold(state, visits[visits["done"] == 0])
        out = shown(visits[(visits["fresh"] == 1) | (visits["done"] == 1)], rule, floor_seconds)
        if len(out):
            yield out

    return (
        dealt(fold_batches(known_sightings(sightings), rule == "latest"), slots)
        .groupBy("slot")
        .applyInPandasWithState(advance, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)
    )
