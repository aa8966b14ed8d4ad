"""Connected components of a link table by repeated minimum hooking and
pointer jumping, a constant number of shuffles a round; labels and links stay
distributed and every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import written


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp): ``comp`` is the smallest id reachable over ``links``.

    Rounds alternate two steps on the edges: every vertex's larger neighbours
    are re-hung on its smallest neighbour (large star), then every vertex's
    smaller neighbours (small star).  A hub's edges are first reduced by a
    map-side minimum, so a hub is no single task's group.  Ends when nothing
    changes; edges then form stars around the smallest id of each component.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = written(edges, "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: neighbours above u hang on the least of u and its neighbours
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: neighbours below u hang, with u, on the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.when(F.col("v") == F.col("m"), F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v"))))
                      .otherwise(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).alias("e")).select("e.*")
        fresh = written(small.filter("u != v").distinct(), "edges")
        old = edges
        edges = fresh
        if _same(old, fresh):
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def _same(x: DataFrame, y: DataFrame) -> bool:
    """Equal edge tables, by count and order-free digest."""
    s = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                        F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(s(x)) == tuple(s(y))
