from pyspark.sql import functions as F


def frame(spark, ddl, *rows):
    return spark.createDataFrame([tuple(row) for row in rows], ddl)


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted(tuple(row) for row in chosen.collect())


def probes(spark, *items, day=0, entity=1):
    """(clientmac, stime, flag) as probes of one venue and day."""
    df = frame(spark, "clientmac string, stime long, flag int", *items)
    return df.select(F.lit(entity).alias("entityid"), F.lit(day).cast("long").alias("file_day"), "*")


def thresholds(spark, indoor=10, leave=300, entity=1):
    return frame(spark, "entityid int, indoor_seconds long, leave_seconds long", (entity, indoor, leave))


def sightings(spark, times, leave=300, entity=1, mac="a"):
    return frame(spark, "entityid int, clientmac string, stime long, leave_seconds long",
                 *[(entity, mac, t, leave) for t in times])


def physical(df):
    """The physical plan without adaptive execution."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.adaptive.enabled", "true")


def shuffles(df):
    return physical(df).count("Exchange hashpartitioning")
