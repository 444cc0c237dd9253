"""Connected components of a graph whose edges are a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerby.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node and component, the smallest node that can be reached, for every node of an edge (a, b).

    Each round a node takes the smallest component among its neighbours, then
    that of the node this names, so that long chains shorten by half; it ends
    when nothing changes. A round is two joins on the table of nodes, written
    to the shared folder; a node with very many edges is combined before the
    shuffle.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    known = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        near = both.join(known, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = known.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("via"))
        ahead = known.select(F.col("node").alias("via"), F.col("component").alias("further"))
        stepped = cut_lineage(hooked.join(ahead, "via").select("node", "old", F.least("via", "further").alias("component")))
        moved = stepped.filter("component <> old").count()
        known = stepped.drop("old")
        if not moved:
            return known
