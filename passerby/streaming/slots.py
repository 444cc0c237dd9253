"""Visits of many devices at once, for the state handlers of live visits.

Devices are dealt over slots, and the state of a slot is one table of its
devices' last visits, as bytes. So a micro-batch costs one Python call for each
slot, whatever the number of devices, and the visits of all devices of a slot
are found together. Any state store will do.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 256
KEYS = ["entityid", "clientmac"]
STATE = "visits binary"
OUTPUT = "clientmac string, entityid int, etime bigint, ltime bigint, seconds bigint, done int"
_HELD = {"entityid": "int64", "clientmac": "object", "etime": "int64", "ltime": "int64", "leave_seconds": "int64"}


def dealt(sightings: DataFrame, slots: int) -> DataFrame:
    """Sightings with the ``slot`` of their device and venue."""
    return sightings.withColumn("slot", F.pmod(F.xxhash64(*KEYS), F.lit(slots)).cast("int"))


def held_visits(state):
    """The table that a slot's state holds; without state an empty one."""
    import pandas as pd
    import pyarrow as pa

    if not state.exists:
        return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in _HELD.items()})
    return pa.ipc.open_stream(state.get[0]).read_pandas()


def hold(state, visits) -> None:
    import pyarrow as pa

    table = pa.Table.from_pandas(visits[[*_HELD]], preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    state.update((sink.getvalue().to_pybytes(),))


def distinct_seconds(frames: Iterable, latest: bool = False):
    """Each second of a device once, with its shortest leave time; with ``latest`` a device's newest second alone.

    Folded while the frames come, so that no more than these and a share of the sightings are held.
    """
    import pandas as pd

    def folded(parts):
        seconds = pd.concat(parts, ignore_index=True).groupby([*KEYS, "stime"], as_index=False)["leave_seconds"].min()
        return seconds.drop_duplicates(KEYS, keep="last") if latest else seconds

    parts, kept, waiting = [], 0, 0
    for frame in frames:
        parts.append(frame[[*KEYS, "stime", "leave_seconds"]])
        waiting += len(frame)
        if waiting > max(kept, 100_000):
            parts, waiting = [folded(parts)], 0
            kept = len(parts[0])
    return folded(parts)


def advanced(held, seconds, rule: str):
    """The visits of a slot's devices: those held, carried on by new seconds, and those that begin.

    In order of device and time, with ``done`` 0 for the last of a device and 1
    for the others, and ``fresh`` 1 where a new second counts.
    """
    import numpy as np
    import pandas as pd

    new = seconds.rename(columns={"stime": "etime"}).assign(ltime=seconds["stime"], fresh=1)
    both = pd.concat([held.assign(fresh=0), new], ignore_index=True) if len(held) else new
    both = both.sort_values([*KEYS, "fresh", "etime"], kind="stable", ignore_index=True)

    def columns():
        names = both["clientmac"].to_numpy(object)
        venues, etime, ltime, leave, fresh = (both[name].to_numpy(np.int64) for name in ("entityid", "etime", "ltime", "leave_seconds", "fresh"))
        first = np.append(True, (venues[1:] != venues[:-1]) | (names[1:] != names[:-1]))[:len(names)]
        return names, venues, etime, ltime, leave, fresh, first

    names, venues, etime, ltime, leave, fresh, first = columns()
    if len(held) and rule != "latest":
        # A sighting that is not newer than the visit's end is ignored; what is held comes first of a device.
        opening = np.flatnonzero(first)
        known = (fresh[opening] == 0)[np.cumsum(first) - 1]
        end = ltime[opening][np.cumsum(first) - 1]
        both = both[(fresh == 0) | ~known | (etime > end)]
        names, venues, etime, ltime, leave, fresh, first = columns()
    gap = np.append(0, etime[1:] - ltime[:-1])[:len(names)]
    begins = np.flatnonzero(first | (gap > leave if rule == "trigger" else gap >= leave))
    ends = np.append(begins[1:], len(names))[:len(begins)] - 1
    return pd.DataFrame({
        "entityid": venues[begins], "clientmac": names[begins], "etime": etime[begins], "ltime": ltime[ends], "leave_seconds": leave[ends],
        "fresh": np.maximum.reduceat(fresh, begins) if len(begins) else fresh,
        "done": np.where(np.append(first[begins][1:], True)[:len(begins)], 0, 1),
    })


def shown(visits, rule: str, floor_seconds: int):
    """The output's rows of visits; under the trigger rule of ended ones alone, those of a moment ``floor_seconds`` long."""
    seconds = visits["ltime"] - visits["etime"]
    if rule == "trigger":
        seconds = seconds.where(seconds != 0, floor_seconds)
    out = visits.assign(seconds=seconds)[["clientmac", "entityid", "etime", "ltime", "seconds", "done"]]
    return (out[out["done"] == 1] if rule == "trigger" else out).astype({"entityid": "int32", "done": "int32"})
