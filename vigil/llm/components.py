"""Connected components by alternating large and small stars (each round is a few groupBys and joins).

A hub with very many edges is only ever a join key (split by AQE) or a partially aggregated minimum; nothing is
gathered per node. Every round is written to the shared folder, so lineage stays short and lost executors cost one
round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: any orderable type; nulls, loops and repeats are ignored) -> (node, root): every node that has
    an edge, with the least node that it reaches."""
    e = save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())
        before = state
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e = save(large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small).distinct(), "edges")
