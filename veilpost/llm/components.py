"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import save

HOPS = 2


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b), component being its least reachable node.

    Every node carries the least number it has heard of.  In a round it first takes over what that node
    has heard of, which halves the depth of chains, and then hears from its neighbours.  Neighbours
    are heard with partial minima, so a node that a third of the graph hangs on is not gathered
    anywhere.  Each round is written out and ends the lineage; a round without a change is the last.
    """
    both = save(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b"), "edges")
    labels = save(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        ahead = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        heard = labels.join(ahead, "component").select("node", F.least("component", "further").alias("component"), F.col("component").alias("was"))
        for _ in range(HOPS):
            told = both.join(heard, both["a"] == heard["node"]).select(both["b"].alias("node"), "component", F.lit(None).cast("long").alias("was"))
            heard = told.union(heard).groupBy("node").agg(F.min("component").alias("component"), F.max("was").alias("was"))
        result = save(heard, "labels")
        if result.where("component <> was").isEmpty():
            return result.select("node", "component")
        labels = result.select("node", "component")
