"""Connected components over an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.session import discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of the edges (a, b); component is the smallest id reached.

    Each round every id takes the smallest label of its neighbours and then the
    label of that label, so distances halve. Labels are written between rounds;
    hot ids are combined on the map side or split as skewed join keys.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    # every id points to its smallest neighbour, and so do its other neighbours: many edges become the same
    least = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least"))
    edges = edges.join(least, edges["a"] == least["id"]).select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = last = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, labels["id"] == near["a"]).select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        step = stored(step, "step")
        upper = step.select(F.col("id").alias("of"), F.col("component").alias("top"))
        jumped = stored(step.join(upper, step["component"] == upper["of"]).select("id", "old", F.col("top").alias("component")), "labels")
        discard(step, last)
        labels, last = jumped.select("id", "component"), jumped
        if jumped.where("old <> component").isEmpty():
            discard(both)
            return labels
