"""Live visits that end by time, with state that ends with them.

Where the watermark passes a visit's end plus its leave time, no sighting that
is still accepted can go on with it: an event-time timeout of its slot closes
it, and its state is gone. The state is that of `slots`, so no state store of a
certain kind is asked for.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from passerby.operators.sessions import known_sightings
from passerby.streaming.live import fold_batches
from passerby.streaming.slots import OUTPUT, SLOTS, STATE, advanced, dealt, distinct_seconds, held_visits, hold, shown

RULES = ("current", "trigger")


def expiring_visits(sightings: DataFrame, rule: str = "current", delay: str = "10 minutes", slots: int = SLOTS,
                    floor_seconds: int = 5) -> DataFrame:
    """Visits changed by each micro-batch, for a streaming sink in update mode, as `live_visits` gives them.

    Beside it, a visit ends as soon as the watermark, which follows the newest
    sighting by ``delay``, has passed its last sighting by that one's leave time,
    though the device does not come back; then no state is left of it. Sightings
    that come when the watermark has passed them are dropped. Rules are
    ``current`` and ``trigger``, the latter with ended visits alone; after its
    ``delay`` a feed that is in order gives the visits that `live_visits` gives.

    ``slots`` is fixed by the first checkpoint: some for every core.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")

    def advance(key, frames, state):
        import pandas as pd

        watermark = state.getCurrentWatermarkMs()

        def over(visits):
            """Which visits have ended, as no sighting that is still accepted can go on with them."""
            return (visits["ltime"] + visits["leave_seconds"]) * 1000 <= watermark

        held, timed_out = held_visits(state), state.hasTimedOut
        gone = over(held)
        changed, held = [held[gone].assign(done=1)], held[~gone]
        if not timed_out:
            visits = advanced(held, distinct_seconds(frames), rule)
            visits["done"] = visits["done"].where(~over(visits), 1)
            changed.append(visits[(visits["fresh"] == 1) | (visits["done"] == 1)])
            held = visits[visits["done"] == 0]
        if len(held):
            hold(state, held)
            # Fires when the watermark has reached the end, as timeouts do that lie before it.
            state.setTimeoutTimestamp(int((held["ltime"] + held["leave_seconds"]).min()) * 1000 - 1)
        elif state.exists:
            state.remove()
        out = shown(pd.concat(changed), rule, floor_seconds)
        if len(out):
            yield out

    folded = fold_batches(known_sightings(sightings), latest=False)
    return (
        dealt(folded, slots).withColumn("seen", F.timestamp_seconds("stime"))
        .withWatermark("seen", delay)
        .groupBy("slot")
        .applyInPandasWithState(advance, OUTPUT, STATE, "update", GroupStateTimeout.EventTimeTimeout)
    )
