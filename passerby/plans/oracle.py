"""The registered queries as plain SQL over the same tables, to check the results against."""

from passerby.plans.catalog import AS_OF_DAY, LONG_STAY, NOW, PROCESSED_AT

# Inputs, as in plans.tables, one common table expression each.
_CTE = {
    "entities": """
        SELECT CAST(100000 + n_nationkey AS INTEGER) AS entityid, n_nationkey,
               CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE 20 END AS indoor_threshold,
               CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE 360 END AS leave_threshold
        FROM nation""",
    "thresholds": """
        SELECT entityid,
               CAST(CASE WHEN indoor_threshold = 0 THEN 10 ELSE indoor_threshold END AS BIGINT)
                 AS indoor_seconds,
               CAST(CASE WHEN leave_threshold = 0 THEN 300 ELSE leave_threshold * 60 END AS BIGINT)
                 AS leave_seconds
        FROM entities""",
    "probe_rows": """
        SELECT CAST(100000 + user_id % 25 AS INTEGER) AS entityid,
               CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS file_day,
               lpad(CAST(user_id AS VARCHAR), 12, '0') AS clientmac,
               CAST(floor(epoch(ts)) AS BIGINT) AS stime,
               CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS INTEGER) AS flag
        FROM events""",
    "probes": "SELECT DISTINCT * FROM probe_rows",
    "indoor_probes": "SELECT DISTINCT entityid, file_day, clientmac, stime FROM probes WHERE flag = 1",
    "gaps": """
        SELECT p.*, indoor_seconds, leave_seconds,
               stime - lag(stime) OVER (PARTITION BY entityid, clientmac, file_day ORDER BY stime) AS gap
        FROM indoor_probes p JOIN thresholds USING (entityid)""",
    "numbered": """
        SELECT *, sum(CASE WHEN gap IS NULL OR gap >= leave_seconds THEN 1 ELSE 0 END)
                    OVER (PARTITION BY entityid, clientmac, file_day ORDER BY stime) AS stay
        FROM gaps""",
    "stays": """
        SELECT entityid, clientmac, file_day, stay, min(stime) AS etime, max(stime) AS ltime,
               max(stime) - min(stime) AS seconds, any_value(indoor_seconds) AS indoor_seconds
        FROM numbered GROUP BY entityid, clientmac, file_day, stay""",
    "sessions": """
        SELECT clientmac, entityid, etime, ltime, seconds, file_day, stay
        FROM stays
        WHERE seconds >= indoor_seconds AND etime > file_day AND etime < file_day + 86400""",
    "long": f"SELECT * FROM sessions WHERE seconds >= {LONG_STAY}",
    "timeline": """
        SELECT DISTINCT entityid, clientmac, stime, leave_seconds,
               stime - lag(stime) OVER (PARTITION BY entityid, clientmac ORDER BY stime) AS gap
        FROM (SELECT DISTINCT entityid, clientmac, stime FROM indoor_probes)
        JOIN thresholds USING (entityid)""",
    "visit_numbers": """
        SELECT *, sum(CASE WHEN gap IS NULL OR gap >= leave_seconds THEN 1 ELSE 0 END)
                    OVER (PARTITION BY entityid, clientmac ORDER BY stime) AS visit
        FROM timeline""",
    "strict_numbers": """
        SELECT *, sum(CASE WHEN gap IS NULL OR gap > leave_seconds THEN 1 ELSE 0 END)
                    OVER (PARTITION BY entityid, clientmac ORDER BY stime) AS visit
        FROM timeline""",
    "access_points": """
        SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS apmac, entityid,
               -20 - s_suppkey % 10 AS inside, -60 - s_suppkey % 10 AS nearby,
               indoor_seconds, leave_seconds
        FROM supplier JOIN thresholds ON entityid = 100000 + s_nationkey""",
    "sightings": """
        SELECT lpad(CAST(event_id % (SELECT count(*) FROM supplier) AS VARCHAR), 12, '0') AS apmac,
               lpad(CAST(user_id AS VARCHAR), 12, '0') AS mac,
               CAST(-floor(value) AS INTEGER) AS rssi, ts,
               CAST(floor(epoch(ts)) AS BIGINT) AS stime, event_id
        FROM events""",
    "zones": """
        SELECT entityid, mac, CAST(epoch(time_bucket(INTERVAL 5 MINUTE, ts)) AS BIGINT) AS starttime,
               rssi >= inside AS indoor, rssi < nearby AS away,
               rssi >= nearby AND rssi < inside AS visit
        FROM sightings JOIN access_points USING (apmac)""",
    "flow_days": """
        SELECT DISTINCT CAST(100000 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 2 AS INTEGER)
                 AS entityid,
               lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS clientmac,
               CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS utoday,
               CAST(epoch(date_trunc('month', o_orderdate)) AS BIGINT) AS ufirstday
        FROM orders""",
    "indoor_days": """
        SELECT CAST(100000 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 2 AS INTEGER) AS entityid,
               lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS clientmac,
               CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS utoday,
               CAST(epoch(date_trunc('month', o_orderdate)) AS BIGINT) AS ufirstday,
               CAST(sum(l_quantity * 60) AS BIGINT) AS seconds
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE o_orderstatus <> 'P' GROUP BY 1, 2, 3, 4""",
    # The spans of time in which events come to the streams.
    "span": """
        SELECT CAST(min(floor(epoch(ts))) AS BIGINT) AS low, CAST(max(floor(epoch(ts))) AS BIGINT) AS high FROM events""",
    "cut": "SELECT (low + (high - low) // 3) // 300 * 300 AS cut FROM span",
    "late_probes": """
        SELECT * FROM indoor_probes p, cut
        WHERE stime >= cut OR NOT EXISTS (
            SELECT 1 FROM indoor_probes q WHERE (q.entityid, q.clientmac) = (p.entityid, p.clientmac) AND q.stime >= cut)""",
    "later_probes": "SELECT * FROM indoor_probes, cut WHERE stime >= cut",
    "short_leave": """
        SELECT DISTINCT entityid, clientmac, stime,
               CASE CAST(clientmac AS BIGINT) % 4 WHEN 0 THEN 0 WHEN 2 THEN 30 ELSE 300 END AS leave_seconds
        FROM indoor_probes""",
    "published_flow": """
        SELECT DISTINCT entityid, clientmac, file_day AS utoday,
               CAST(epoch(date_trunc('month', to_timestamp(file_day) AT TIME ZONE 'UTC')) AS BIGINT) AS ufirstday
        FROM probes WHERE stime > file_day AND stime < file_day + 86400""",
    "published_indoor": """
        SELECT entityid, clientmac, file_day AS utoday, CAST(sum(seconds) AS BIGINT) AS seconds,
               CAST(epoch(date_trunc('month', to_timestamp(file_day) AT TIME ZONE 'UTC')) AS BIGINT) AS ufirstday
        FROM sessions GROUP BY entityid, clientmac, file_day""",
}
# What the clock of a stream shows after all events: ten minutes before the newest sighting.
_CTE["clock"] = "SELECT max(stime) - 600 AS clock FROM indoor_probes"
# The second span of time begins at a whole five minutes; half of the access points move then.
_CTE["middle"] = "SELECT (low + (high - low) // 2) // 300 * 300 AS middle FROM span"
_CTE["moved_points"] = """
        SELECT apmac, a.entityid, inside, indoor_seconds, leave_seconds, 0 AS valid_from,
               CASE WHEN CAST(apmac AS BIGINT) % 2 = 0 THEN middle END AS valid_to FROM access_points a, middle
        UNION ALL
        SELECT apmac, t.entityid, inside, t.indoor_seconds, t.leave_seconds, middle, NULL
        FROM access_points a, middle, thresholds t
        WHERE CAST(apmac AS BIGINT) % 2 = 0 AND t.entityid = 100000 + (a.entityid - 99999) % 25"""
_CTE["all_indoor_days"] = _CTE["indoor_days"].replace("WHERE o_orderstatus <> 'P' ", "")
for _name, _from in (("late", "late_probes"), ("later", "later_probes")):
    _CTE[f"{_name}_timeline"] = _CTE["timeline"].replace("FROM indoor_probes)", f"FROM {_from})")
    _CTE[f"{_name}_visits"] = _CTE["visit_numbers"].replace("FROM timeline", f"FROM {_name}_timeline")
_CTE["short_timeline"] = """
        SELECT *, stime - lag(stime) OVER (PARTITION BY entityid, clientmac ORDER BY stime) AS gap FROM short_leave"""
_CTE["short_visits"] = _CTE["visit_numbers"].replace("FROM timeline", "FROM short_timeline")
# Of each span of time the newest sighting of a device, as the rule "latest" takes it.
_CTE["newest_probes"] = """
        SELECT entityid, clientmac, max(stime) AS stime FROM indoor_probes, span
        GROUP BY entityid, clientmac, (stime >= (low + (high - low) // 3) // 300 * 300)::INT + (stime >= (low + (high - low) * 2 // 3) // 300 * 300)::INT"""
_CTE["newest_timeline"] = _CTE["timeline"].replace("FROM indoor_probes)", "FROM newest_probes)")
_CTE["newest_visits"] = _CTE["visit_numbers"].replace("FROM timeline", "FROM newest_timeline")
_CTE["late_zones"] = """
        SELECT * FROM zones, cut WHERE starttime >= cut"""
# Rows less than 30 and 7 days before count, which is 29 and 6 days in seconds.
for _stem, _days in (("visit", "flow_days"), ("indoor", "indoor_days")):
    _CTE[f"{_stem}_months"] = f"""
        SELECT entityid, clientmac, ufirstday,
               lag(count(*)) OVER (PARTITION BY entityid, clientmac ORDER BY ufirstday) AS previous
        FROM {_days} GROUP BY entityid, clientmac, ufirstday"""
    _CTE[f"{_stem}_recency"] = f"""
        SELECT d.*, coalesce(previous, 0) AS {_stem}sPrevMonth,
               count(*) OVER (PARTITION BY entityid, clientmac ORDER BY utoday
                              RANGE BETWEEN 2505600 PRECEDING AND CURRENT ROW) AS {_stem}s30,
               count(*) OVER (PARTITION BY entityid, clientmac ORDER BY utoday
                              RANGE BETWEEN 518400 PRECEDING AND CURRENT ROW) AS {_stem}s7,
               min(utoday) OVER (PARTITION BY entityid, clientmac) AS First{_stem.capitalize()},
               max(utoday) OVER (PARTITION BY entityid, clientmac) AS Last{_stem.capitalize()},
               count(*) OVER (PARTITION BY entityid, clientmac) AS {_stem}s
        FROM {_days} d JOIN {_stem}_months USING (entityid, clientmac, ufirstday)"""

_FLOW = "visits30, visits7, FirstVisit, LastVisit, visits, visitsPrevMonth"
_INDOOR = "indoors30, indoors7, FirstIndoor, LastIndoor, indoors, indoorsPrevMonth"
_CTE["indoor_as_of"] = f"""
        SELECT *, seconds AS secondsbyday,
               CAST(sum(CASE WHEN ({AS_OF_DAY} - utoday) / 86400.0 < 7 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY entityid, clientmac) AS BIGINT) AS r_indoors7,
               CAST(sum(CASE WHEN ({AS_OF_DAY} - utoday) / 86400.0 < 30 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY entityid, clientmac) AS BIGINT) AS r_indoors30
        FROM indoor_recency"""
_CTE["report"] = f"""
        SELECT f.entityid, f.clientmac, f.utoday, f.ufirstday,
               {", ".join(f"coalesce(i.{c}, 0) AS {c}" for c in
                          ("secondsbyday, " + _INDOOR + ", r_indoors7, r_indoors30").split(", "))},
               {_FLOW}
        FROM visit_recency f LEFT JOIN indoor_as_of i
          ON f.entityid = i.entityid AND f.clientmac = i.clientmac AND f.utoday = i.utoday"""


def _with(names: str, select: str, **instead: str) -> str:
    """A query over the named inputs; ``instead`` names another input to take under a name."""
    return "WITH " + ",\n".join(f"{name} AS ({_CTE[instead.get(name, name)]})" for name in names.split()) + "\n" + select


_BASE = "entities thresholds"
_PROBES = "probe_rows probes"
_SESSIONS = f"{_BASE} {_PROBES} indoor_probes gaps numbered stays sessions"
_TIMELINE = f"{_BASE} {_PROBES} indoor_probes timeline"
_SIGHTED = f"{_BASE} access_points sightings"
_SESSION = "clientmac, entityid, etime, ltime, seconds"
_REPORT = ("flow_days indoor_days visit_months visit_recency indoor_months indoor_recency "
           "indoor_as_of report")
_MATCHED = "event_id, apmac, mac, rssi, stime, entityid, indoor_seconds, leave_seconds"
_VISIT = "clientmac, entityid, min(stime) AS etime, max(stime) AS ltime"


def _counted(indoor: str, away: str, visit: str) -> str:
    return (f"SELECT entityid, starttime, count(DISTINCT {indoor}) AS indoors, "
            f"count(DISTINCT {away}) AS aways, count(DISTINCT {visit}) AS visits "
            f"FROM zones GROUP BY entityid, starttime")


def oracle_sql() -> dict[str, str]:
    sessions = _with(_SESSIONS, f"SELECT {_SESSION} FROM sessions")
    stale = ("SELECT entityid, clientmac, etime FROM sessions "
             "EXCEPT SELECT entityid, clientmac, etime FROM long")
    visits = f"""SELECT {_VISIT}, max(stime) - min(stime) AS seconds,
               CAST(CASE WHEN visit = max(visit) OVER (PARTITION BY entityid, clientmac)
                    THEN 0 ELSE 1 END AS INTEGER) AS done
        FROM visit_numbers GROUP BY entityid, clientmac, visit"""
    live = _with(f"{_TIMELINE} visit_numbers", visits)
    closed = _with(
        f"{_TIMELINE} strict_numbers",
        f"""SELECT clientmac, entityid, etime, ltime,
               CASE WHEN etime = ltime THEN 5 ELSE ltime - etime END AS seconds
        FROM (SELECT {_VISIT}, visit,
                     max(visit) OVER (PARTITION BY entityid, clientmac) AS last_visit
              FROM strict_numbers GROUP BY entityid, clientmac, visit)
        WHERE visit < last_visit""")
    expired = _with(f"{_TIMELINE} visit_numbers clock", f"""SELECT {_VISIT}, max(stime) - min(stime) AS seconds,
               CAST(CASE WHEN visit = max(visit) OVER (PARTITION BY entityid, clientmac)
                          AND max(stime) + min(leave_seconds) > (SELECT clock FROM clock) THEN 0 ELSE 1 END AS INTEGER) AS done
        FROM visit_numbers GROUP BY entityid, clientmac, visit""")
    windowed = _with(f"{_TIMELINE} strict_numbers clock", f"""
        SELECT clientmac, entityid, etime, ltime, CASE WHEN etime = ltime THEN 5 ELSE ltime - etime END AS seconds
        FROM (SELECT {_VISIT}, min(leave_seconds) AS leave FROM strict_numbers
              GROUP BY entityid, clientmac, visit), clock
        WHERE ltime + leave <= clock""")
    moved = _with(f"{_SIGHTED} span middle moved_points", f"""
        SELECT {_MATCHED} FROM sightings JOIN moved_points USING (apmac)
        WHERE rssi > inside AND rssi <= 0 AND stime >= valid_from AND (valid_to IS NULL OR stime < valid_to)""")
    published = _with(f"{_SESSIONS} {_REPORT}", "SELECT * FROM report", flow_days="published_flow", indoor_days="published_indoor")

    def sketched(seconds: int) -> str:
        return _with(f"{_SIGHTED} zones", _counted("CASE WHEN indoor THEN mac END", "CASE WHEN away THEN mac END", "CASE WHEN visit THEN mac END").replace(
            "FROM zones", f"FROM (SELECT * REPLACE (starttime // {seconds} * {seconds} AS starttime) FROM zones)"))

    matching = _with(f"{_SIGHTED} zones", _counted(
        "CASE WHEN indoor THEN mac END", "CASE WHEN away THEN mac END", "CASE WHEN visit THEN mac END"))
    every = {
        "probe_dedup": _with(_PROBES, """
            SELECT *, CAST(epoch(date_trunc('month', to_timestamp(file_day) AT TIME ZONE 'UTC')) AS BIGINT)
              AS ufirstday FROM probes"""),
        "payload_parse": _with("sightings", """
            SELECT 'r' AS kind, event_id, upper('a' || apmac) AS apmac, upper('b' || mac) AS mac, rssi,
                   strftime(ts, '%Y-%m-%d %H:%M:%S') AS stime FROM sightings
            UNION ALL SELECT 's', event_id, apmac, mac, NULL, NULL FROM sightings"""),
        "entity_thresholds": _with(_BASE, "SELECT * FROM thresholds"),
        "ap_dimension": _with(_BASE, """
            SELECT DISTINCT t.entityid, CAST(-20 - s_suppkey % 10 AS INTEGER) AS rssi,
                   'AB' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS apmac,
                   indoor_seconds, leave_seconds
            FROM supplier, entities e, thresholds t
            WHERE s_suppkey % 100 < 90 AND s_suppkey % 7 <> 0 AND n_nationkey * 4 < 90
              AND t.entityid = e.entityid
              AND n_nationkey IN (s_nationkey, (s_nationkey + 1) % 25)"""),
        "indoor_sessions": sessions,
        "indoor_sessions_interior": _with(_SESSIONS, f"""
            SELECT {_SESSION} FROM sessions s
            WHERE stay > 1 AND EXISTS (
                SELECT 1 FROM stays t WHERE t.entityid = s.entityid AND t.clientmac = s.clientmac
                  AND t.file_day = s.file_day AND t.stay > s.stay)"""),
        "indoor_daily": _with(_SESSIONS, """
            SELECT clientmac, entityid, min(etime) AS etime, max(ltime) AS ltime,
                   CAST(sum(seconds) AS BIGINT) AS seconds, file_day AS utoday,
                   CAST(epoch(date_trunc('month', to_timestamp(file_day) AT TIME ZONE 'UTC')) AS BIGINT)
                     AS ufirstday
            FROM sessions GROUP BY entityid, clientmac, file_day"""),
        "flow_daily": _with(_PROBES, """
            SELECT clientmac, entityid, min(stime) AS etime, max(stime) AS ltime, file_day AS utoday,
                   CAST(epoch(date_trunc('month', to_timestamp(file_day) AT TIME ZONE 'UTC')) AS BIGINT)
                     AS ufirstday
            FROM probes WHERE stime > file_day AND stime < file_day + 86400
            GROUP BY entityid, clientmac, file_day"""),
        "ingest_merge": _with(_PROBES, "SELECT * FROM probes"),
        "day_refresh": sessions,
        "stale_keys": _with(f"{_SESSIONS} long", stale),
        "session_delete": _with(f"{_SESSIONS} long", f"SELECT {_SESSION} FROM long"),
        "session_upsert": _with(f"{_SESSIONS} long", f"""
            SELECT {_SESSION} FROM sessions s WHERE NOT EXISTS (
                SELECT 1 FROM long l WHERE (l.entityid, l.clientmac) = (s.entityid, s.clientmac)
                  AND s.etime IN (l.etime, l.ltime + 86400))
            UNION ALL SELECT clientmac, entityid, etime, ltime + 60, seconds + 60 FROM long
            UNION ALL SELECT clientmac, entityid, ltime + 86400, ltime + 86400, 0 FROM long"""),
        "recency_flow": _with("flow_days visit_months visit_recency",
                              f"SELECT entityid, clientmac, utoday, ufirstday, {_FLOW} FROM visit_recency"),
        "recency_indoor": _with(
            "indoor_days indoor_months indoor_recency indoor_as_of",
            f"""SELECT entityid, clientmac, utoday, ufirstday, secondsbyday, {_INDOOR},
                   r_indoors7, r_indoors30 FROM indoor_as_of""", indoor_days="all_indoor_days"),
        "footfall_report": _with(_REPORT, "SELECT * FROM report"),
        "footfall_report_joined": _with(_REPORT, "SELECT * FROM report"),
        "client_profile": _with(_REPORT, """
            SELECT entityid, clientmac,
                   CAST(to_timestamp(FirstVisit) AT TIME ZONE 'UTC' AS DATE) AS FirstVisit,
                   CAST(to_timestamp(LastVisit) AT TIME ZONE 'UTC' AS DATE) AS LastVisit,
                   visits, visitsPrevMonth, visits30, visits7,
                   CAST(to_timestamp(nullif(FirstIndoor, 0)) AT TIME ZONE 'UTC' AS DATE) AS FirstIndoor,
                   CAST(to_timestamp(nullif(LastIndoor, 0)) AT TIME ZONE 'UTC' AS DATE) AS LastIndoor,
                   indoors, indoorsPrevMonth, indoors30, indoors7, secondsbyday
            FROM report r WHERE utoday = LastVisit"""),
        "signal_match": _with(_SIGHTED, f"""
            SELECT {_MATCHED} FROM sightings JOIN access_points USING (apmac)
            WHERE rssi > inside AND rssi <= 0"""),
        "signal_match_inclusive": _with(_SIGHTED, f"""
            SELECT {_MATCHED} FROM sightings JOIN access_points USING (apmac) WHERE rssi >= inside"""),
        "latest_sighting": _with(_SIGHTED, """
            SELECT mac, entityid, indoor_seconds, leave_seconds, max(stime) AS updatingtime
            FROM sightings JOIN access_points USING (apmac)
            WHERE rssi > inside AND rssi <= 0
            GROUP BY mac, entityid, indoor_seconds, leave_seconds"""),
        "fresh_sightings": _with("sightings", """
            SELECT event_id, apmac, mac, rssi, stime FROM sightings WHERE event_id % 10 < 5"""),
        "fresh_asof": _with("sightings", f"""
            SELECT event_id, apmac, mac, rssi, stime FROM sightings
            WHERE ts < TIMESTAMP '{NOW}' AND ts > TIMESTAMP '{NOW}' - INTERVAL 1 DAY"""),
        "zone_heatmap": matching,
        # A sketch of as few devices as a window of the tables has is exact.
        "zone_heatmap_approx": matching,
        "zone_heatmap_stream": matching,
        "zone_heatmap_tagged": _with(f"{_SIGHTED} zones", _counted(
            "(mac || CASE WHEN indoor THEN '|1' ELSE '|0' END)",
            "(mac || CASE WHEN away THEN '|1' ELSE '|0' END)",
            "(mac || CASE WHEN visit THEN '|1' ELSE '|0' END)")),
        "zone_heatmap_restarted": matching,
        "zone_heatmap_late": _with(f"{_SIGHTED} zones span cut late_zones", _counted(
            "CASE WHEN indoor THEN mac END", "CASE WHEN away THEN mac END", "CASE WHEN visit THEN mac END").replace(
            "FROM zones", "FROM late_zones")),
        "live_visits": live,
        "live_visits_stream": live,
        "live_visits_late": _with(f"{_BASE} {_PROBES} indoor_probes span cut late_probes late_timeline late_visits",
                                  visits.replace("FROM visit_numbers", "FROM late_visits")),
        "live_visits_restarted": _with(f"{_BASE} {_PROBES} indoor_probes span cut later_probes later_timeline later_visits",
                                       visits.replace("FROM visit_numbers", "FROM later_visits")),
        "live_visits_short_leave": _with(f"{_PROBES} indoor_probes short_leave short_timeline short_visits",
                                         visits.replace("FROM visit_numbers", "FROM short_visits")),
        "feed_rejects": _with("sightings", """
            SELECT 'good' AS kind, NULL AS value, apmac, mac, rssi, stime FROM sightings
            WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0
            UNION ALL
            SELECT 'reject', CASE WHEN event_id % 13 = 0 THEN 'cut,' || apmac ELSE
                     concat_ws(',', 'r', apmac, mac, CASE WHEN event_id % 7 = 0 THEN 'x' ELSE CAST(rssi AS VARCHAR) END,
                               CASE WHEN event_id % 11 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END,
                               CASE WHEN event_id % 11 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END) END,
                   NULL, NULL, NULL, NULL
            FROM sightings WHERE event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0"""),
        "probe_files": _with(_PROBES, """
            SELECT *, CAST(epoch(date_trunc('month', to_timestamp(file_day) AT TIME ZONE 'UTC')) AS BIGINT)
              AS ufirstday FROM probes"""),
        "day_publish": sessions,
        "applied_run": sessions,
        "store_applied_run": sessions,
        "published_report": published,
        "report_by_change": published,
        "report_compacted": published,
        "live_visits_expiring": expired,
        "live_visits_redelivered": _with(f"{_BASE} {_PROBES} indoor_probes span newest_probes newest_timeline newest_visits",
                                         visits.replace("FROM visit_numbers", "FROM newest_visits")),
        "closed_visits_windowed": windowed,
        "zone_heatmap_hours": sketched(3600),
        "zone_heatmap_days": sketched(86400),
        "zone_heatmap_parted": matching,
        "zone_heatmap_redelivered": matching,
        "store_delete": _with(f"{_SESSIONS} long", f"SELECT {_SESSION} FROM long"),
        "file_ingest": sessions,
        "moved_access_points": moved,
        "moved_access_points_stream": moved,
        "counted_lines": _with("sightings", """
            SELECT 1 AS run, CAST(2 * count(*) AS BIGINT) AS lines, CAST(2 * (count(*) - count(*) FILTER (good)) AS BIGINT) AS rejects,
                   CAST(2 * count(*) FILTER (good) - count(DISTINCT (apmac, mac, rssi, stime)) FILTER (good) AS BIGINT) AS repeats,
                   CAST(0 AS BIGINT) AS late, CAST(count(DISTINCT (apmac, mac, rssi, stime)) FILTER (good) AS BIGINT) AS rows
            FROM (SELECT *, event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AS good FROM sightings)"""),
        "probe_backlog": _with(f"{_BASE} {_PROBES}", """
            SELECT CAST(position // (folders // 6 + 1) + 1 AS INTEGER) AS folder_group, CAST(sum(files) AS BIGINT) AS files,
                   count(bytes) AS remaining_folders, count(*) - count(bytes) AS processed_folders, CAST(floor(coalesce(sum(bytes), 0) / 1048576) AS BIGINT) AS megabytes
            FROM (SELECT *, row_number() OVER (ORDER BY folder) - 1 AS position, count(*) OVER () AS folders FROM (
                SELECT CAST(e.entityid AS VARCHAR) AS folder, count(DISTINCT file_day) AS files,
                       sum(length(clientmac || ',' || stime || ',' || flag) + 1) AS bytes
                FROM entities e LEFT JOIN (SELECT * FROM probes WHERE entityid % 5 <> 0) p ON e.entityid = p.entityid GROUP BY e.entityid))
            GROUP BY 1"""),
        "stored_report": _with(_REPORT, "SELECT * FROM report"),
        "report_table": _with(_REPORT, "SELECT * FROM report"),
        "closed_visits": closed,
        "closed_visits_stream": closed,
        "ingest_backlog": """
            WITH folders AS (
                SELECT source, count(*) AS files, sum(n_chars) AS bytes,
                       row_number() OVER (ORDER BY source) - 1 AS position,
                       count(*) OVER () AS folders
                FROM documents GROUP BY source)
            SELECT CAST(position // (folders // 6 + 1) + 1 AS INTEGER) AS folder_group,
                   CAST(sum(files) AS BIGINT) AS files, count(*) AS remaining_folders,
                   CAST(0 AS BIGINT) AS processed_folders,
                   CAST(floor(sum(bytes) / 1048576) AS BIGINT) AS megabytes
            FROM folders GROUP BY 1""",
        "processing_log": _with(_PROBES, f"""
            SELECT DISTINCT '0-ProcessincFile' AS operType, '{PROCESSED_AT}' AS processDate,
                   '/data/t_cf_inc/' || entityid || '/t_cf_'
                     || strftime(to_timestamp(file_day) AT TIME ZONE 'UTC', '%Y%m%d') || '.txt' AS fileName
            FROM probes"""),
    }
    return every | {"store_upsert": every["session_upsert"], "stored_log": every["processing_log"]}
