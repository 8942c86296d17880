"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every end of ``edges(a, b)``; component = smallest id reachable.

    Each round points every node at its smallest neighbour, follows the pointers
    twice, and replaces the ends of the edges by what they point at; edges inside
    a component vanish, so rounds are few. The driver sees one count a round.
    Each round is written to the shared folder (a written table has
    its true size, which a checkpoint's plan statistics have not). No edges: no rows.
    """
    e = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph-edges")
    labels = e.select(F.col("a").alias("id")).union(e.select("b")).distinct().withColumn("component", F.col("id"))
    while not e.isEmpty():
        to = (e.select(F.col("b").alias("x"), F.col("a").alias("y"))
              .groupBy("x").agg(F.min("y").alias("p")))          # only ends that have a smaller neighbour
        for _ in range(2):
            up = to.select(F.col("x").alias("p"), F.col("p").alias("q"))
            to = to.join(up, "p", "left").select("x", F.coalesce("q", "p").alias("p"))
        to = stored(to, "graph-pointers")
        labels = stored(labels.join(to.withColumnRenamed("x", "component"), "component", "left")
                        .select("id", F.coalesce("p", "component").alias("component")), "graph-labels")
        one = to.select(F.col("x").alias("a"), F.col("p").alias("pa"))
        two = to.select(F.col("x").alias("b"), F.col("p").alias("pb"))
        e = stored(e.join(one, "a", "left").join(two, "b", "left")
                   .select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")).where("a <> b")
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph-edges")
    return labels
