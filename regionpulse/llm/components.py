"""Connected components of a graph of links, by alternating large and small stars.

Every step is a grouping and a join of tables in the shared folder, so no task and no driver gets a component.  The
number of rounds grows with the logarithm of the longest path.  Nodes can be of any orderable type; the label of a
component is its smallest node.  A step has no more edges than the one before it, so each is written in as many files
as the edges need and not in one for every shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionpulse.session import stage


def _star(edges: DataFrame, small: bool, rows: int) -> DataFrame:
    if small:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        sides = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # A table of its own: both sides of the join are then dealt out by the join, which splits crowded nodes.
    least = stage(sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), rows=2 * rows)
    joined = sides.join(least, "u")
    if small:
        out = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    else:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return stage(out.where("u <> v").distinct(), rows=rows)


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none: stars around the smallest nodes of their components."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select("v", F.lit(0), F.lit(1)))
    roles = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).count() == 0


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``node`` and ``label`` of every node of ``links`` (columns a and b, of one type) that is linked to a smaller one.

    Nodes without a row are alone or the smallest of their component.  Links of a node to itself, repeated ones and
    either direction are allowed; links with a null are left out.  ``rows`` bounds their number, where it is known.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), rows=rows)
    n = edges.count()
    while not _settled(edges):
        edges = _star(_star(edges, False, n), True, n)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
