"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGES = 1 << 15  # edges of one checkpoint file


def _shape(edges: DataFrame) -> tuple[int, int]:
    """Number of edges (v, u), u the smaller one, and of nodes at which they are not stars yet."""
    ends = edges.select(F.explode(F.expr("array(struct(v AS x, 1 AS up, 0 AS down), struct(u AS x, 0 AS up, 1 AS down))")).alias("end"))
    nodes = ends.select("end.*").groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    row = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if(F.expr("up > 1 OR up = 1 AND down > 0"))).first()
    return row[0], row[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges`` but the components themselves; the component is its smallest node.

    Each round points the larger neighbours of every node at its smallest
    neighbour, then does the same with the smaller ones. Only minima per node
    are grouped (partial aggregation takes care of nodes with very many
    edges), lists of neighbours are never collected. Every round is cut with a
    reliable checkpoint, in files as many as the edges before it need (a round
    doesn't add any). It ends when the edges are stars around smallest nodes,
    which a round would not change: a count per node shows that, no last round
    is spent on it.
    """
    now = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct().checkpoint()
    )
    held, tangled = _shape(now)
    while tangled:
        both = now.select(F.col("v").alias("x"), F.col("u").alias("y")).union(now.select("u", "v"))
        least = both.groupBy("x").agg(F.least(F.first("x"), F.min("y")).alias("m"))
        large = both.where("y > x").join(least, "x").where("y <> m").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        now = small.union(least.select("v", F.col("m").alias("u"))).distinct().coalesce(1 + held // EDGES).checkpoint()
        held, tangled = _shape(now)
    return now.select(F.col("v").alias("node"), F.col("u").alias("component"))
