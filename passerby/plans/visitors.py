"""The visitor report, kept up to date by what each run changes.

A run's probes touch some days of some visitors. Of these visitors alone, and
only from the first touched day on, what the change reaches is computed again:
the rows whose 30 days hold a touched day, the rows of the next month with any
row after a touched month, and the visitor's months, from which first, last and
all days follow. It is written as a version of its own beside the earlier ones;
readers take the newest row of each visitor and day. Nothing else is read or
written: the touched visitors' earlier months come from their stored totals.

Stored under ``<root>/visitors``: ``days/version=<n>``, by month, one row for
each visitor and day with flow; ``totals/version=<n>``, one row for each visitor.
A version counts when its totals, which are written last, are complete.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.functions.sizes import broadcast_if_small
from passerby.functions.time import day_number, month_start
from passerby.operators.recency import DAY_SECONDS, FLOW_MEASURES, INDOOR_MEASURES, VISITOR, rolling_counts
from passerby.session import cut_lineage, delete_folder, list_folder, temporary_tables
from passerby.sources.tables import read_flow_daily, read_indoor_daily, read_stored_probes

#: A day counts in the 30 days that begin with it.
REACH = 29


def _days_layout() -> T.StructType:
    layout = T.StructType().add("entityid", "integer").add("clientmac", "string").add("utoday", "long").add("secondsbyday", "long")
    for name in ("visits30", "visits7", "visitsPrevMonth", "indoors30", "indoors7", "indoorsPrevMonth"):
        layout.add(name, "long")
    return layout.add("version", "integer").add("ufirstday", "long")


def _month_layout() -> T.StructType:
    layout = T.StructType()
    for name in ("month", "visits", "first_visit", "last_visit", "indoors", "first_indoor", "last_indoor"):
        layout.add(name, "long")
    return layout


def _totals_layout() -> T.StructType:
    return T.StructType().add("entityid", "integer").add("clientmac", "string").add("months", T.ArrayType(_month_layout())).add("version", "integer")


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the complete versions."""
    place = f"{root}/visitors/totals"
    names = [name for name in list_folder(spark, place) if re.fullmatch(r"version=\d+", name)]
    return sorted(int(name.partition("=")[2]) for name in names if "_SUCCESS" in list_folder(spark, f"{place}/{name}"))


def _stored(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The rows of all complete versions."""
    layout = _days_layout() if kind == "days" else _totals_layout()
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], layout)
    place = f"{root}/visitors/{kind}"
    return spark.read.schema(layout).option("basePath", place).parquet(*[f"{place}/version={n}" for n in known])


def touched_visitors(probes: DataFrame) -> DataFrame:
    """Visitors with the numbers of their touched days, ``days`` in order, the ``touched_months`` of these, and the first of both."""
    day = F.col("file_day")
    return probes.select(*VISITOR, "file_day").distinct().groupBy(*VISITOR).agg(
        F.array_sort(F.collect_set(day_number(day))).alias("days"),
        F.array_sort(F.collect_set(month_start(day))).alias("touched_months"),
        F.min("file_day").alias("first_day"),
        F.min(month_start(day)).alias("first_month"),
    )


def _months(rows: DataFrame) -> DataFrame:
    """``fresh``: each visitor's months with the days of flow and stays in them."""
    stayed = F.col("seconds").isNotNull()
    visit, stay = F.when(~stayed, F.col("utoday")), F.when(stayed, F.col("utoday"))
    monthly = rows.groupBy(*VISITOR, F.col("ufirstday").alias("month")).agg(
        F.count(visit).alias("visits"), F.min(visit).alias("first_visit"), F.max(visit).alias("last_visit"),
        F.count(stay).alias("indoors"), F.min(stay).alias("first_indoor"), F.max(stay).alias("last_indoor"))
    names = _month_layout().names
    return monthly.groupBy(*VISITOR).agg(F.array_sort(F.collect_list(F.struct(*names))).alias("fresh"))


def _previous(stem: str) -> Column:
    """Days of the last month before the row's that has any."""
    earlier = F.filter("months", lambda m: (m["month"] < F.col("ufirstday")) & (m[f"{stem}s"] > 0))
    return F.coalesce(F.get(earlier, F.size(earlier) - 1)[f"{stem}s"], F.lit(0).cast("bigint"))


def _reached(stem: str) -> Column:
    """Whether a touched month can be the last one before the row's with any row of the stem, or hide it."""
    touched = F.array_max(F.filter("touched_months", lambda m: m < F.col("ufirstday")))
    others = F.filter("months", lambda m: (m["month"] < F.col("ufirstday")) & (m[f"{stem}s"] > 0) & ~F.array_contains("touched_months", m["month"]))
    last = F.array_max(F.transform(others, lambda m: m["month"]))
    return touched.isNotNull() & (last.isNull() | (touched > last))


def update_visitors(spark: SparkSession, root: str, run: str) -> int:
    """Brings the stored report under ``root`` up to date with a published run; returns the version's number.

    Runs are applied one after the other, each after `publish_refresh`; after a
    failure apply the run again. Applying one twice changes nothing.
    """
    with temporary_tables(spark):
        number = max(versions(spark, root), default=0) + 1
        probes = read_stored_probes(spark, f"{root}/t_cf").filter(F.col("run") == run)
        touched = cut_lineage(touched_visitors(probes))
        first = touched.agg(F.min("first_day")).first()[0]
        if first is None:
            return number - 1
        _compute(spark, root, touched, first).write(number)
        return number


class _Version:
    def __init__(self, root: str, days: DataFrame, totals: DataFrame):
        self.root, self.days, self.totals = root, days, totals

    def write(self, number: int) -> None:
        self.days.hint("rebalance", "ufirstday").write.mode("overwrite").partitionBy("ufirstday").parquet(f"{self.root}/visitors/days/version={number}")
        self.totals.write.mode("overwrite").parquet(f"{self.root}/visitors/totals/version={number}")


def _compute(spark: SparkSession, root: str, touched: DataFrame, first: int) -> _Version:
    """What ``touched`` days change; no day before the month of ``first``, and 29 days before it, is read."""
    # Rows carry the first touched day and month alone; the lists meet them once, at the end.
    firsts = ["first_day", "first_month"]
    known = broadcast_if_small(touched.select(*VISITOR, day_number(F.col("first_day")).cast("int").alias("first_day"), "first_month"))
    # The bound prunes the scan; a day more on account of clock changes.
    bound = F.least(month_start(F.lit(first)), F.lit(first - (REACH + 1) * DAY_SECONDS))
    day = F.col("day")
    needed = (F.col("ufirstday") >= F.col("first_month")) | (day >= F.col("first_day") - REACH)

    def of_these(rows: DataFrame, seconds: Column) -> DataFrame:
        filed = rows.filter(F.col("file_day") >= bound).select(
            *VISITOR, "utoday", "ufirstday", seconds.cast("bigint").alias("seconds"), day_number(F.col("utoday")).alias("day"))
        return filed.join(known, VISITOR).filter(needed)

    rows = cut_lineage(of_these(read_flow_daily(spark, f"{root}/flow"), F.lit(None)).unionByName(
        of_these(read_indoor_daily(spark, f"{root}/indoor"), F.col("seconds"))))
    stored = _stored(spark, root, "totals").join(known.select(*VISITOR), VISITOR, "left_semi")
    before = stored.groupBy(*VISITOR).agg(F.max_by("months", "version").alias("before"))
    none = F.array().cast(T.ArrayType(_month_layout()))
    earlier = F.filter(F.coalesce("before", none), lambda m: m["month"] < F.col("first_month"))
    fresh = _months(rows.filter(F.col("ufirstday") >= F.col("first_month")))
    every = cut_lineage(touched.join(before, VISITOR, "left").join(fresh, VISITOR, "left").select(
        *VISITOR, F.concat(earlier, F.coalesce("fresh", none)).alias("months"), "days", "touched_months"))

    stayed = F.col("seconds").isNotNull()
    counted = rolling_counts(rows, {"visit": ~stayed, "indoor": stayed})
    # A day's stay beside its flow: one row of each at most.
    daily = counted.groupBy(*VISITOR, "utoday", "ufirstday", "day", *firsts).agg(
        F.sum("seconds").alias("secondsbyday"), F.max(~stayed).alias("seen"),
        *[F.max(name).alias(name) for name in ("visits30", "visits7", "indoors30", "indoors7")]).filter("seen")
    within = F.exists("days", lambda c: (day >= c) & (day <= c + REACH))
    reached = daily.filter(day >= F.col("first_day")).join(broadcast_if_small(every), VISITOR).filter(within | _reached("visit") | _reached("indoor"))
    days = reached.withColumns({"visitsPrevMonth": _previous("visit"), "indoorsPrevMonth": _previous("indoor")})
    return _Version(root, days.select(*_days_layout().names[:-2], "ufirstday"), every.select(*VISITOR, "months"))


def read_visitor_report(spark: SparkSession, root: str, as_of_day: int) -> DataFrame:
    """The report of `daily_report` from what `update_visitors` has stored.

    The newest row of each visitor and day, with the visitor's totals; all of it
    on one distribution by visitor.
    """
    stored = _stored(spark, root, "days").repartition(*VISITOR)
    values = [name for name in _days_layout().names if name not in (*VISITOR, "utoday", "version")]
    days = stored.groupBy(*VISITOR, "utoday").agg(F.max_by(F.struct(*values), "version").alias("row")).select(*VISITOR, "utoday", "row.*")
    totals = _stored(spark, root, "totals").repartition(*VISITOR).groupBy(*VISITOR).agg(F.max_by("months", "version").alias("months"))
    here = F.col("secondsbyday").isNotNull()
    age = F.lit(as_of_day) - F.col("utoday")
    visitor = Window.partitionBy(*VISITOR)
    days = days.withColumns({f"r_indoors{n}": F.count(F.when(here & (age < n * DAY_SECONDS), 1)).over(visitor) for n in (7, 30)})

    def every(name: str, fold) -> Column:
        return fold(F.transform("months", lambda m: m[name]))

    def total(name: str) -> Column:
        return F.aggregate("months", F.lit(0).cast("bigint"), lambda n, m: n + m[name])

    known = totals.select(
        *VISITOR, every("first_visit", F.array_min).alias("FirstVisit"), every("last_visit", F.array_max).alias("LastVisit"), total("visits").alias("visits"),
        every("first_indoor", F.array_min).alias("FirstIndoor"), every("last_indoor", F.array_max).alias("LastIndoor"), total("indoors").alias("indoors"))
    return days.join(known, VISITOR).select(
        *VISITOR, "utoday", "ufirstday",
        *[F.when(here, F.col(c)).otherwise(F.lit(0).cast("bigint")).alias(c) for c in INDOOR_MEASURES], *FLOW_MEASURES)


def compact_visitors(spark: SparkSession, root: str) -> None:
    """Folds all versions into one, so that readers and the folders do not grow with the runs.

    The versions before are deleted when the new one is complete.
    """
    known = versions(spark, root)
    if len(known) < 2:
        return
    names = _days_layout().names
    values = [name for name in names if name not in (*VISITOR, "utoday", "version")]
    days = _stored(spark, root, "days").groupBy(*VISITOR, "utoday").agg(F.max_by(F.struct(*values), "version").alias("row"))
    totals = _stored(spark, root, "totals").groupBy(*VISITOR).agg(F.max_by("months", "version").alias("months"))
    _Version(root, days.select(*VISITOR, "utoday", "row.*").select(*names[:-2], "ufirstday"), totals).write(known[-1] + 1)
    for number in known:
        for kind in ("totals", "days"):
            delete_folder(spark, f"{root}/visitors/{kind}/version={number}")
