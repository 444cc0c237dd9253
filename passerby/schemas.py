"""Row layouts, in file column order.

Times are epoch seconds; a day or a month is the epoch second of its local
midnight in ``spark.sql.session.timeZone``. ``file_day`` is the day a row is
filed under and is a partition column, so it is in no file layout.
"""

from pyspark.sql import types as T


def _layout(**columns: str) -> T.StructType:
    layout = T.StructType()
    for name, kind in columns.items():
        layout.add(name, kind)
    return layout


def by_day(layout: T.StructType) -> T.StructType:
    """The layout with venue and day, as stored by day."""
    stored = T.StructType(list(layout.fields))
    for name, kind in (("entityid", "integer"), ("file_day", "long")):
        if name not in layout.names:
            stored.add(name, kind)
    return stored


PROBES = _layout(clientmac="string", stime="long", flag="integer")
SESSIONS = _layout(clientmac="string", entityid="integer", etime="long", ltime="long", seconds="long")
INDOOR_DAILY = _layout(
    clientmac="string", entityid="integer", etime="long", ltime="long", seconds="long",
    utoday="long", ufirstday="long",
)
FLOW_DAILY = _layout(
    clientmac="string", entityid="integer", etime="long", ltime="long",
    utoday="long", ufirstday="long",
)

LIVE_VISITS = _layout(
    clientmac="string", entityid="integer", etime="long", ltime="long", seconds="long", done="integer",
)
HEAT_MAP = _layout(entityid="integer", starttime="timestamp", indoors="long", aways="long", visits="long")
HEAT_SKETCHES = _layout(entityid="integer", starttime="timestamp", indoors="binary", aways="binary", visits="binary")

SESSION_KEYS = ["entityid", "clientmac", "etime"]
DAY_KEYS = ["entityid", "file_day"]
VISIT_KEYS = ["clientmac", "entityid", "etime"]
HEAT_MAP_KEYS = ["entityid", "starttime"]
