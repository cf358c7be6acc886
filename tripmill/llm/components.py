"""Connected components by alternating stars.

Edges are a table in the shared folder; nothing but whether a step is needed
reaches the driver. A round links every neighbour of a node that is larger than it
to the smallest one (large star), and then the smaller neighbours of a node, and
itself, to the smallest of those (small star). Neither changes what is connected or
makes more edges, and the distance of a chain's ends to its smallest node about
halves, so the number of rounds follows the logarithm of the longest chain in any
order of its nodes (a test counts them). The work ends when every node has one
smaller neighbour and those have none: stars around the smallest node of each
component.

Smallest neighbours are aggregated before they are shuffled and joined back by plain
exchanges, which adaptive execution splits where a node is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import Tables


def _smallest(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the smallest of u's neighbours and u itself."""
    least = edges.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("v_min")).select("of", F.least("of", "v_min").alias("m"))
    return edges.join(least, edges["u"] == least["of"]).select("u", "v", "m")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u."""
    if not edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return False
    inner = edges.select(F.col("u").alias("inner"))
    return edges.join(inner, edges["v"] == inner["inner"], "left_semi").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", tables: Tables | None = None) -> DataFrame:
    """node, component (the smallest node reachable) of all nodes that have an edge.

    edges: pairs of one type in either order; repeated ones and loops do no
    harm, rows with a null are left out.
    """
    tables = tables or Tables(edges.sparkSession)
    x, y = F.col(a), F.col(b)
    down = edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    now = tables.write(down, "edges")
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = tables.write(large, "large")
        linked = _smallest(large).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = tables.write(linked.select("e.u", "e.v").where("u <> v").distinct(), "stars")
        tables.drop(now, large)
        now = small
    centres = now.select("v").distinct()
    named = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres.select(F.col("v").alias("node"), F.col("v").alias("component")))
    labels = tables.write(named, "labels")
    tables.drop(now)
    return labels
