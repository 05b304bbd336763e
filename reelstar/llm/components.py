"""Connected components with DataFrame operations only.

Every round hooks each node to its smallest neighbour (an aggregate that
combines on the map side, so a hub with millions of edges is no hot group),
shortens the parent chains twice, and contracts the edges.  Half of the
non-final nodes at least disappear per round, so the tables shrink
geometrically and the number of rounds is logarithmic.  The per-round maps are
composed backwards at the end.  Edge and node tables stay distributed; only
one count per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has an edge to another node;
    ``component`` is the smallest node of its component.

    Edges have no direction; repeated edges, loops and edges with a null end
    are allowed (the last two are ignored).  No edges: no rows.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a <> b")
    e = settled(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes_type = e.schema["a"].dataType
    maps: list[DataFrame] = []
    while e.limit(1).count():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        parent = settled(hook.select("node", F.least("node", "m").alias("to")))
        for _ in range(2):
            up = parent.select(F.col("node").alias("to"), F.col("to").alias("next"))
            parent = parent.join(up, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        parent = settled(parent)
        maps.append(parent)
        as_a = parent.select(F.col("node").alias("a"), F.col("to").alias("x"))
        as_b = parent.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = e.join(as_a, "a").join(as_b, "b").filter("x <> y")
        e = settled(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("a").alias("component").cast(nodes_type))
    total = maps.pop()
    while maps:
        later = total.select(F.col("node").alias("to"), F.col("to").alias("last"))
        total = maps.pop().join(later, "to", "left").select("node", F.coalesce("last", "to").alias("to"))
    return total.withColumnRenamed("to", "component")
