"""The operators' inputs, derived from the given test tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passerby.operators.dimensions import entity_thresholds
from passerby.sources.feeds import read_stream


class Tables:
    """Each method reads whole tables under ``folder`` and gives one operator input.

    The tables hold times without a zone, read here as UTC.
    """

    def __init__(self, spark: SparkSession, folder: str, feed: str | None = None, events: DataFrame | None = None):
        self.spark, self.folder, self.feed = spark, folder, feed
        self._frames: dict[str, DataFrame] = {} if events is None else {"events": events}
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    def read(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def as_stream(self, feed: str) -> "Tables":
        """The same inputs with the events as a stream of what comes to ``feed``."""
        return Tables(self.spark, self.folder, feed)

    def of_events(self, events: DataFrame) -> "Tables":
        """The same inputs with some of the events."""
        return Tables(self.spark, self.folder, events=events)

    def events(self) -> DataFrame:
        if self.feed is None:
            return self.read("events")
        return read_stream(self.spark, "parquet", self.read("events").schema, path=self.feed)

    def event_cuts(self, parts: int = 3) -> list[int]:
        """Where the events are cut into ``parts`` equal spans of time: whole five minutes."""
        low, high = self.read("events").agg(F.min(_epoch("ts")), F.max(_epoch("ts"))).first()
        return [(low + (high - low) * i // parts) // 300 * 300 for i in range(1, parts)]

    def event_slices(self, parts: int = 3) -> list[DataFrame]:
        """The events in ``parts`` equal spans of time, in order."""
        seconds, ends = _epoch("ts"), [None, *self.event_cuts(parts), None]
        return [self.read("events").filter((F.lit(True) if a is None else seconds >= a) & (F.lit(True) if b is None else seconds < b))
                for a, b in zip(ends, ends[1:], strict=False)]

    def entities(self) -> DataFrame:
        unset = F.col("n_nationkey") % 5 == 0
        return self.read("nation").select(
            (100000 + F.col("n_nationkey")).cast("int").alias("entityid"),
            F.when(unset, 0).otherwise(20).alias("indoor_threshold"),
            F.when(unset, 0).otherwise(360).alias("leave_threshold"),
        )

    def thresholds(self) -> DataFrame:
        return entity_thresholds(self.entities())

    def probe_rows(self) -> DataFrame:
        """Probes as they come, with the event they come from."""
        return self.events().select(
            (100000 + F.col("user_id") % 25).cast("int").alias("entityid"),
            _midnight("ts").alias("file_day"),
            _device(F.col("user_id")).alias("clientmac"),
            _epoch("ts").alias("stime"),
            F.when(F.col("event_type") == "error", 0).otherwise(1).alias("flag"),
            "event_id",
        )

    def probes(self) -> DataFrame:
        return self.probe_rows().drop("event_id")

    def indoor_sightings(self) -> DataFrame:
        """Probes with flag 1 and the leave time of their venue, as the live feed has them."""
        known = self.thresholds().select("entityid", "leave_seconds")
        return self.probes().filter(F.col("flag") == 1).join(known, "entityid").select(
            "entityid", "clientmac", "stime", "leave_seconds"
        )

    def access_points(self) -> DataFrame:
        bounds = self.read("supplier").select(
            _device(F.col("s_suppkey")).alias("apmac"),
            (100000 + F.col("s_nationkey")).cast("int").alias("entityid"),
            (-20 - F.col("s_suppkey") % 10).cast("int").alias("rssi"),
            (-60 - F.col("s_suppkey") % 10).cast("int").alias("nearbyrssi"),
        )
        return bounds.join(self.thresholds(), "entityid").select(
            "apmac", "entityid", "rssi", "nearbyrssi", "indoor_seconds", "leave_seconds"
        )

    def access_point_changes(self) -> DataFrame:
        """The access points since ever; at the middle of the events those of even suppliers move to the next venue."""
        middle = F.lit(self.event_cuts(2)[0]).cast("bigint")
        start = self.access_points().withColumns({"changed_at": F.lit(0).cast("bigint"), "removed": F.lit(False), "valid_at_start": F.lit(True)})
        moving = start.filter(F.col("apmac").cast("bigint") % 2 == 0).withColumns({"changed_at": middle, "valid_at_start": F.lit(False)})
        left = moving.withColumn("removed", F.lit(True))
        new = moving.withColumn("entityid", (100000 + (F.col("entityid") - 99999) % 25).cast("int")).drop("indoor_seconds", "leave_seconds").join(
            self.thresholds(), "entityid").select(start.columns)
        return start.unionByName(left).unionByName(new)

    def access_point_sources(self) -> dict[str, DataFrame]:
        """The four tables behind the access-point dimension; a box serves two venues."""
        suppliers, nations = self.read("supplier"), self.read("nation")
        box = F.col("s_suppkey")
        venues = [F.col("s_nationkey"), (F.col("s_nationkey") + 1) % 25]
        return {
            "tvbox": suppliers.select(
                box.alias("id"), (-20 - box % 10).alias("indoorrssi"), (box % 100).alias("flag"),
            ),
            "tvbox_ap_rel": suppliers.select(
                box.alias("vboxid"),
                F.concat(F.lit("ab"), F.lpad(box.cast("string"), 10, "0")).alias("apmac"),
                F.when(box % 7 == 0, 0).otherwise(1).alias("flag"),
            ),
            "tentity": self.entities().join(
                nations.select(
                    (100000 + F.col("n_nationkey")).cast("int").alias("entityid"),
                    (F.col("n_nationkey") * 4).alias("flags"),
                ), "entityid",
            ).withColumnRenamed("entityid", "id"),
            "tentity_vbox_rel": suppliers.select(
                F.explode(F.array(*venues)).alias("nation"), box.alias("vboxid"),
            ).select((100000 + F.col("nation")).cast("int").alias("entityid"), "vboxid"),
        }

    def sightings(self) -> DataFrame:
        """Raw sightings, each at one of the suppliers' access points."""
        boxes = self.read("supplier").agg(F.count(F.lit(1))).scalar()
        return self.events().select(
            _device(F.col("event_id") % boxes).alias("apmac"),
            _device(F.col("user_id")).alias("mac"),
            (-F.floor(F.col("value"))).cast("int").alias("rssi"),
            F.col("ts").cast("timestamp").alias("ts"),
            _epoch("ts").alias("stime"),
            "event_id",
        )

    def payloads(self) -> DataFrame:
        """Each sighting as a message of two lines: in the raw feed's and the matched feed's layout."""
        raw = F.concat_ws(
            ",", F.lit("r"), F.col("event_id"), F.concat(F.lit(" a"), F.col("apmac")),
            F.concat(F.lit("b"), F.col("mac"), F.lit(" ")), F.col("rssi"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        )
        # The second line has no sixth field.
        short = F.concat_ws(",", F.lit("s"), F.col("event_id"), F.col("apmac"), F.col("mac"), F.lit("x"))
        return self.sightings().select(
            F.concat_ws("\n", raw, short).cast("binary").alias("value")
        )

    def flow_days(self) -> DataFrame:
        return self.read("orders").select(*_order_day()).distinct()

    def indoor_days(self, statuses: tuple[str, ...] = ("F", "O", "P")) -> DataFrame:
        """Days with a stay: those of the orders in one of ``statuses``."""
        spent = self.read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sum(F.col("l_quantity") * 60).alias("spent")
        )
        return (
            self.read("orders").filter(F.col("o_orderstatus").isin(*statuses))
            .join(spent, "o_orderkey")
            .groupBy(*_order_day())
            .agg(F.sum("spent").cast("bigint").alias("seconds"))
        )

    def feed_lines(self) -> DataFrame:
        """The sightings as lines of the raw feed; some have a bad signal, no time or too few fields."""
        number = F.col("event_id")
        signal = F.when(number % 7 == 0, "x").otherwise(F.col("rssi").cast("string"))
        time = F.when(number % 11 == 0, "").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        whole = F.concat_ws(",", F.lit("r"), "apmac", "mac", signal, time, time)
        return self.sightings().select(F.when(number % 13 == 0, F.concat(F.lit("cut,"), F.col("apmac"))).otherwise(whole).alias("value"))

    def short_leave_sightings(self) -> DataFrame:
        """Indoor sightings with a leave time by device: 0, none, 30 or 300 seconds."""
        kind = F.col("clientmac").cast("long") % 4
        leave = F.when(kind == 0, 0).when(kind == 2, 30).when(kind == 3, 300).cast("bigint")
        return self.probes().filter(F.col("flag") == 1).select("entityid", "clientmac", "stime", leave.alias("leave_seconds"))

    def files(self) -> DataFrame:
        return self.read("documents").select(
            F.col("source").alias("folder"), F.col("doc_id").cast("string").alias("path"),
            F.col("n_chars").alias("length"),
        )


def _device(number: Column) -> Column:
    return F.lpad(number.cast("string"), 12, "0")


def _epoch(column: str) -> Column:
    return F.unix_timestamp(F.col(column).cast("timestamp"))


def _midnight(column: str) -> Column:
    return F.unix_timestamp(F.date_trunc("day", F.col(column).cast("timestamp")))


def _order_day() -> list[Column]:
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    return [
        (100000 + priority % 2).cast("int").alias("entityid"),
        _device(F.col("o_custkey")).alias("clientmac"),
        _midnight("o_orderdate").alias("utoday"),
        F.unix_timestamp(F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))).alias("ufirstday"),
    ]
