"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges(u, v)``; ``comp`` is the
    smallest node of its component.

    Each round links every node's larger neighbours to its smallest neighbour
    (large star), then its smaller neighbours likewise (small star), until
    nothing changes.  The minimum is a map-side combined aggregate and the
    join on it lets Spark split a node with very many edges.
    """
    cur = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                  .filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        sig = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sig[0] == 0 or sig == seen:
            break
        seen = sig
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small_low.select("u", F.col("m").alias("v"))).distinct())
        cur = written(small, "edges")
    nodes = cur.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return nodes.union(cur.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()
