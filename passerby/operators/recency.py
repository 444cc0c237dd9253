"""Rolling visit counts, first and last days, previous month, and the visitor report.

Input rows are daily: one per venue, device and day. A window by venue and
device thus never holds more rows than there are days. All windows share that
one distribution, so a table is shuffled once.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passerby.functions.time import day_number, local_date

DAY_SECONDS = 24 * 60 * 60
VISITOR = ["entityid", "clientmac"]


def rolling_counts(rows: DataFrame, counted: dict[str, Column]) -> DataFrame:
    """Adds how many of a visitor's rows each stem's condition counts in the 30 and 7 days that end with the row's ``day``."""
    by_day = Window.partitionBy(*VISITOR).orderBy("day")
    return rows.withColumns({
        f"{stem}s{days}": F.count(F.when(condition, 1)).over(by_day.rangeBetween(1 - days, Window.currentRow))
        for stem, condition in counted.items() for days in (30, 7)
    })


def _statistics(daily: DataFrame, counted: dict[str, Column]) -> DataFrame:
    """Adds the statistics of each stem over the rows of a visitor that its condition counts."""
    visitor = Window.partitionBy(*VISITOR)
    by_month = visitor.orderBy("ufirstday")
    this_month = by_month.rangeBetween(Window.currentRow, Window.currentRow)
    months_before = by_month.rangeBetween(Window.unboundedPreceding, -1)

    def count(stem: str, window) -> Column:
        return F.count(F.when(counted[stem], 1)).over(window)

    def each(columns) -> dict[str, Column]:
        return {name: column for stem in counted for name, column in columns(stem).items()}

    def month(stem: str) -> dict[str, Column]:
        return {f"{stem}_month": F.when(counted[stem], count(stem, this_month))}

    def previous_month(stem: str) -> dict[str, Column]:
        # The last counted row before this month lies in the previous active one.
        before = F.last(f"{stem}_month", ignorenulls=True).over(months_before)
        return {f"{stem}sPrevMonth": F.coalesce(before, F.lit(0).cast("bigint"))}

    def ever(stem: str) -> dict[str, Column]:
        day, title = F.when(counted[stem], F.col("utoday")), stem.capitalize()
        return {
            f"First{title}": F.min(day).over(visitor),
            f"Last{title}": F.max(day).over(visitor),
            f"{stem}s": count(stem, visitor),
        }

    rows = daily.withColumn("day", day_number(F.col("utoday")))
    for step in (month, previous_month):
        rows = rows.withColumns(each(step))
    return rolling_counts(rows, counted).withColumns(each(ever))


def recency(daily: DataFrame, stem: str) -> DataFrame:
    """Visit statistics beside each daily row, named after ``stem`` ("visit" or "indoor").

    30-day and 7-day counts end with the row's own day. The previous month is
    the last earlier month with any row, and 0 where there is none.
    """
    title = stem.capitalize()
    seconds = [F.col("seconds").alias("secondsbyday")] if "seconds" in daily.columns else []
    return _statistics(daily, {stem: F.lit(True)}).select(
        *VISITOR, "utoday", "ufirstday", *seconds, f"{stem}s30", f"{stem}s7",
        f"First{title}", f"Last{title}", f"{stem}s", f"{stem}sPrevMonth",
    )


def recency_as_of(daily_with_recency: DataFrame, as_of_day: int | Column, stem: str = "indoor",
                  counted: Column | None = None) -> DataFrame:
    """Adds how many of a visitor's days are less than 7 and 30 days before ``as_of_day``.

    Days after ``as_of_day`` count too.
    """
    age = F.lit(as_of_day) - F.col("utoday")
    counted = F.lit(True) if counted is None else counted
    visitor = Window.partitionBy(*VISITOR)
    return daily_with_recency.withColumns({
        f"r_{stem}s{days}": F.count(F.when(counted & (age < days * DAY_SECONDS), 1)).over(visitor)
        for days in (7, 30)
    })


def recency_flow(daily: DataFrame) -> DataFrame:
    """Ten-column visit statistics of the daily flow."""
    return recency(daily.select(*VISITOR, "utoday", "ufirstday"), "visit")


def recency_indoor(daily: DataFrame, as_of_day: int | Column) -> DataFrame:
    """Thirteen-column stay statistics of the daily indoor rows."""
    rows = daily.select(*VISITOR, "utoday", "ufirstday", "seconds")
    return recency_as_of(recency(rows, "indoor"), as_of_day)


INDOOR_MEASURES = ["secondsbyday", "indoors30", "indoors7", "FirstIndoor", "LastIndoor", "indoors",
                   "indoorsPrevMonth", "r_indoors7", "r_indoors30"]
FLOW_MEASURES = ["visits30", "visits7", "FirstVisit", "LastVisit", "visits", "visitsPrevMonth"]


def footfall_report(flow_recency: DataFrame, indoor_recency: DataFrame) -> DataFrame:
    """Every visitor day with its stay statistics, 0 where the visitor stayed outside."""
    key = [*VISITOR, "utoday"]
    return (
        flow_recency.join(indoor_recency.select(*key, *INDOOR_MEASURES), key, "left")
        .select(*VISITOR, "utoday", "ufirstday", *[
            F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(c)
            for c in INDOOR_MEASURES + FLOW_MEASURES
        ])
    )


def visitor_report(flow: DataFrame, indoor: DataFrame, as_of_day: int | Column) -> DataFrame:
    """The same report straight from the daily tables, with one shuffle and no join.

    Flow and indoor days of a visitor meet in the same windows; the stay of a
    day is what a window over that one day holds.
    """
    stayed = F.col("seconds").isNotNull()
    key = [*VISITOR, "utoday", "ufirstday"]
    days = flow.select(*key, F.lit(None).cast("bigint").alias("seconds")).unionByName(
        indoor.select(*key, F.col("seconds").cast("bigint").alias("seconds"))
    )
    counted = recency_as_of(
        _statistics(days, {"visit": ~stayed, "indoor": stayed}), as_of_day, counted=stayed,
    )
    today = Window.partitionBy(*VISITOR).orderBy("day").rangeBetween(0, 0)
    with_stay = counted.withColumn("secondsbyday", F.sum("seconds").over(today)).filter(~stayed)
    here = F.col("secondsbyday").isNotNull()
    return with_stay.select(
        *key,
        *[F.when(here, F.col(c)).otherwise(F.lit(0).cast("bigint")).alias(c) for c in INDOOR_MEASURES],
        *FLOW_MEASURES,
    )


def client_profile(report: DataFrame) -> DataFrame:
    """The latest report row of each visitor, first and last days as dates.

    Every row of the report states the visitor's last day, so the latest is
    found by a filter.
    """
    def date_or_none(c: str) -> Column:
        return local_date(F.when(F.col(c) != 0, F.col(c))).alias(c)

    return report.filter(F.col("utoday") == F.col("LastVisit")).select(
        *VISITOR,
        date_or_none("FirstVisit"), date_or_none("LastVisit"),
        "visits", "visitsPrevMonth", "visits30", "visits7",
        date_or_none("FirstIndoor"), date_or_none("LastIndoor"),
        "indoors", "indoorsPrevMonth", "indoors30", "indoors7", "secondsbyday",
    )
