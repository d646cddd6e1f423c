"""Connected components by contraction, for any number of links.

Each round gives every vertex the smallest of itself and its neighbours and rewrites the links between the new names;
links inside a name vanish. A round is one aggregation that combines on the map side and two joins that Spark can
split at hot vertices. Stars vanish in one round, others in a logarithmic number. Every round is a written table, so
lost executors cost no more than the round; only the question whether links are left comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written


def components(links: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``links`` (columns a, b): the smallest vertex that can be reached.

    Null ends are ignored, repeated links and loops allowed; a vertex with only a loop is its own root. No links give no rows.
    """
    clean = links.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    edges = written(clean, "links")
    steps: list[DataFrame] = []
    while True:
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
                                      ).alias("e")).select("e.a", "e.b")
        step = written(both.groupBy(F.col("a").alias("vertex")).agg(F.min(F.least("a", "b")).alias("root")), "roots")
        steps.append(step)
        left = step.select(F.col("vertex").alias("va"), F.col("root").alias("ra"))
        right = step.select(F.col("vertex").alias("vb"), F.col("root").alias("rb"))
        renamed = written(edges.join(left, edges.a == left.va).select("ra", "b"), "renamed")
        renamed = renamed.join(right, renamed.b == right.vb).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        edges = written(renamed.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "links")
        if edges.isEmpty():
            break
    found = steps[0]
    for step in steps[1:]:
        nxt = step.select(F.col("vertex").alias("v"), F.col("root").alias("r"))
        found = found.join(nxt, found.root == nxt.v, "left").select("vertex", F.coalesce("r", "root").alias("root"))
    return found
