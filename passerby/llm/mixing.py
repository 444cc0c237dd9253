"""Mixing sources to target weights by repeating documents."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passerby.functions.sizes import broadcast_if_small
from passerby.llm.rows import WORD, carry, put_down
from passerby.session import cut_lineage

#: No source is repeated more often than this on average, so no document more often either.
MOST = 3.0
#: Weights of the sources in the order of their names, over and over.
WEIGHTS = (1, 2, 3)
DRAW_BITS = 52


def numbered(names: DataFrame, column: str) -> DataFrame:
    """``names`` with ``number``, from 0 by code point, nulls last.

    Ranges of names are numbered side by side; only the count of each range is
    added up in one place.
    """
    ordered = cut_lineage(names.orderBy(F.col(column).asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    counts = ordered.groupBy("part").count()
    before = F.expr("coalesce(sum(count) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col(column).asc_nulls_last())) - 1
    return (ordered.withColumn("within", within)
            .join(broadcast_if_small(counts.select("part", before.alias("before"))), "part")
            .withColumn("number", F.col("before") + F.col("within")).drop("part", "within", "before"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """Each source's target: ``sizes`` has source and source_size, one row for each source.

    The total is shared by weight. A source stops at ``most`` times its size and
    the others share what it leaves, until none is above. All sources that are
    not stopped get the same amount for each unit of weight, so that amount is
    all that has to be found: each round counts the stopped sources again, and
    the rounds end when their number stays. A round is one aggregation over the
    sources; nothing but its sums comes to the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    weighed = cut_lineage(numbered(sizes, "source").withColumn("weight", weight))
    limit = F.lit(most) * F.col("source_size")
    per_unit, stopped = 0.0, -1
    while True:
        held = limit <= F.lit(per_unit) * F.col("weight")
        held = held & F.lit(stopped >= 0)
        n, total, taken, free = weighed.agg(
            F.count(F.when(held, 1)), F.sum("source_size"), F.sum(F.when(held, limit)), F.sum(F.when(~held, F.col("weight")))).first()
        if n == stopped or not free:
            break
        stopped, per_unit = n, (total - (taken or 0.0)) / free
    share = F.lit(per_unit) * F.col("weight")
    return weighed.select("source", "source_size", F.least(limit, share).alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the document's id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("double") / F.lit(float(1 << DRAW_BITS))


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with size, the number of words, 0 for a null text."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def plan(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, seed: str = "mix") -> DataFrame:
    """``docs``, which have a size, with source_size, target and copies, replacing columns of these names.

    A document is taken floor(rate) times, rate being target over source size,
    and once more if its own draw is below the fraction. Null is a source of its
    own. A source without words has target 0, and its documents are taken 0 times, as
    nothing of them could come near any target. Repeated rows and rows without
    an id are drawn alike. A source of any share of the rows is no burden: sizes
    are summed before the shuffle, and the few targets go to where the rows are.
    """
    kept = docs.drop("source_size", "target", "copies")
    sizes = cut_lineage(kept.groupBy("source").agg(F.sum("size").alias("source_size")))
    goal = broadcast_if_small(cut_lineage(targets(sizes, weights, most))).withColumnRenamed("source", "goal_source")
    joined = kept.join(goal, F.col("source").eqNullSafe(F.col("goal_source")), "left").drop("goal_source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    copies = F.floor(rate) + F.when(draw(F.col("doc_id"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("int"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, seed: str = "mix") -> DataFrame:
    """The documents themselves, each as often as the plan takes it, with the columns of ``docs``."""
    needed = ("doc_id", "text", "source")
    planned = plan(sized(carry(docs, *needed)), weights, most, seed).filter("copies > 0")
    return put_down(planned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs, *needed)


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of every document."""
    sizes = cut_lineage(sized(docs.select("doc_id", "source", "text")).drop("text"))
    return plan(sizes).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS number
  FROM sized GROUP BY source),
weighed AS (SELECT *, (number % 3 + 1)::DOUBLE AS weight, 3.0 * source_size AS most FROM sizes),
-- Sources in the order in which a growing amount per weight stops them; k of them are stopped.
steps AS (
  SELECT most / weight AS stops_at,
         (SELECT sum(source_size) FROM weighed) AS total,
         coalesce(sum(most) OVER (ORDER BY most / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (ORDER BY most / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM weighed),
level AS (SELECT arg_min((total - held) / free, stops_at) AS per_unit FROM steps WHERE (total - held) / free < stops_at),
targets AS (
  SELECT source, source_size, least(most, coalesce(per_unit, most / weight) * weight) AS target FROM weighed, level),
rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END AS rate,
         CAST('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13) AS BIGINT) / 4503599627370496.0 AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target,
       (size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
