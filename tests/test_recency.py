from datetime import date, datetime, timezone

from helpers import frame, rows, shuffles
from passerby.operators.recency import (
    client_profile, footfall_report, recency_as_of, recency_flow, recency_indoor, visitor_report,
)

DAYS = ["2024-01-01", "2024-01-07", "2024-01-08", "2024-01-30", "2024-01-31", "2024-03-01"]


def epoch(day):
    return int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp())


def daily(spark, days, mac="a", entity=1, seconds=60):
    return frame(
        spark,
        "clientmac string, entityid int, etime long, ltime long, seconds long, utoday long, ufirstday long",
        *[(mac, entity, epoch(d) + 5, epoch(d) + 65, seconds, epoch(d), epoch(d[:8] + "01")) for d in days],
    )


def test_rolling_counts_and_previous_month(spark):
    flow = recency_flow(daily(spark, DAYS))
    got = rows(flow, "utoday", "visits7", "visits30", "visitsPrevMonth", "visits")
    assert [r[1] for r in got] == [1, 2, 2, 1, 2, 1]
    assert [r[2] for r in got] == [1, 2, 3, 4, 4, 1]
    assert [r[3] for r in got] == [0, 0, 0, 0, 0, 5]
    assert {r[4] for r in got} == {6}
    assert rows(flow.select("FirstVisit", "LastVisit").distinct()) == [(epoch(DAYS[0]), epoch(DAYS[-1]))]


def test_counts_as_of_a_day(spark):
    indoor = recency_indoor(daily(spark, DAYS), epoch("2024-02-28"))
    assert rows(indoor.select("r_indoors7", "r_indoors30").distinct()) == [(1, 3)]
    assert indoor.columns == [
        "entityid", "clientmac", "utoday", "ufirstday", "secondsbyday", "indoors30", "indoors7",
        "FirstIndoor", "LastIndoor", "indoors", "indoorsPrevMonth", "r_indoors7", "r_indoors30",
    ]


def test_days_stay_whole_over_a_clock_change(spark):
    """A day of 23 hours must not shift which days the last seven are."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        days = frame(spark, "clientmac string, entityid int, d string",
                     *[("a", 1, f"2024-{d}") for d in ("03-26", "04-01", "04-02")])
        days = days.selectExpr("clientmac", "entityid", "unix_timestamp(d, 'yyyy-MM-dd') utoday",
                               "unix_timestamp(trunc(d, 'MM')) ufirstday")
        assert [r[1] for r in rows(recency_flow(days), "utoday", "visits7")] == [1, 2, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_visitors_are_apart(spark):
    both = daily(spark, DAYS).union(daily(spark, DAYS[:1], mac="b")).union(daily(spark, DAYS[:2], entity=2))
    assert rows(recency_flow(both).select("entityid", "clientmac", "visits").distinct()) == \
        [(1, "a", 6), (1, "b", 1), (2, "a", 2)]


def test_report_and_profile(spark):
    flow = recency_flow(daily(spark, DAYS[:3]))
    indoor = recency_indoor(daily(spark, DAYS[:2]), epoch("2024-01-10"))
    report = footfall_report(flow, indoor)
    assert len(report.columns) == 19
    straight = visitor_report(daily(spark, DAYS[:3]), daily(spark, DAYS[:2]), epoch("2024-01-10"))
    assert straight.columns == report.columns and rows(straight) == rows(report)
    assert rows(report, "utoday", "secondsbyday", "indoors", "r_indoors7", "visits") == [
        (epoch(DAYS[0]), 60, 2, 1, 3), (epoch(DAYS[1]), 60, 2, 1, 3), (epoch(DAYS[2]), 0, 0, 0, 3),
    ]
    assert rows(client_profile(report), "clientmac", "FirstVisit", "LastVisit", "FirstIndoor", "visits") == \
        [("a", date(2024, 1, 1), date(2024, 1, 8), None, 3)]


def test_as_of_can_name_flow_columns(spark):
    flow = recency_as_of(recency_flow(daily(spark, DAYS)), epoch("2024-01-31"), stem="visit")
    assert rows(flow.select("r_visits7", "r_visits30").distinct()) == [(3, 5)]


def test_one_shuffle_serves_all_windows(spark):
    stored = daily(spark, DAYS)
    assert shuffles(recency_flow(stored)) == 1
    assert shuffles(recency_indoor(stored, 0)) == 1
    assert shuffles(client_profile(visitor_report(stored, stored, 0))) == 1


def test_report_where_stays_skip_months(spark):
    """Months with visits but no stay are not the previous month of stays."""
    days = ["2024-01-03", "2024-02-05", "2024-03-01", "2024-03-02", "2024-05-09"]
    stays = daily(spark, ["2024-01-03", "2024-03-02", "2024-05-09"])
    flow = daily(spark, days)
    as_of = epoch("2024-05-10")
    straight = visitor_report(flow, stays, as_of)
    assert rows(straight) == rows(footfall_report(recency_flow(flow), recency_indoor(stays, as_of)))
    assert [r[1] for r in rows(straight, "utoday", "indoorsPrevMonth")] == [0, 0, 0, 1, 1]
    assert [r[1] for r in rows(straight, "utoday", "visitsPrevMonth")] == [0, 1, 1, 1, 2]
