"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b``, of any one sortable type).

    In each round a node takes the least of itself and its neighbours, and edges
    go over to what their ends took. A node that isn't the least of its
    neighbourhood vanishes, so at least half of those with edges do, and the
    rounds are few. Minima combine before they are shuffled, and joins are inner
    or left ones whose hot keys Spark splits. Edges with a NULL end are ignored.
    """
    edges = stage(edges.filter("a < b or a > b").select("a", "b").distinct(), "edges")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stage(labels.withColumn("root", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("to"))
        least = stage(least.select("at", F.least("at", "to").alias("to")), "least")
        labels = stage(
            labels.join(least, labels.root == least["at"], "left").select(
                "node", F.coalesce("to", "root").alias("root")
            ),
            "labels",
        )
        from_a = least.select(F.col("at").alias("a"), F.col("to").alias("new_a"))
        from_b = least.select(F.col("at").alias("b"), F.col("to").alias("new_b"))
        moved = edges.join(from_a, "a").join(from_b, "b").filter("new_a != new_b")
        edges = stage(
            moved.select(
                F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")
            ).distinct(),
            "edges",
        )
    return labels
