"""Connected components of an edge table by alternating star contraction.

Every round is two group-by / join pairs over the edges; no vertex's
neighbours are ever gathered in one row. Partial minima are combined before
each shuffle, and the joins back to a hub vertex can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import saved


def _star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex, and for the small star the
    vertex itself, to the vertex's least neighbour."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # written, so that the join deals both sides anew and a hub's edges can be split
    least = saved(least.select("a", F.least("a", "m").alias("m")), "least")
    return edges.join(least, "a")


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``(node, component)`` for every vertex of ``edges(a, b)`` (both long);
    the component is named by its least vertex. Edges with a null end and
    loops are left out; repeated edges do not matter."""
    cur = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur = saved(cur, "edges")
    seen = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .filter("a <> b").distinct()
        # small star: among the smaller neighbours, all link to the least
        tied = _star(large)
        small = tied.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").filter("a <> b").distinct()
        cur = saved(small, "edges")
        state = cur.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if seen[0] == 0:
        return cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
