"""Connected components of a distributed graph, by alternating large and small stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each round is a
map-side combined minimum and a join that Spark may split where a node has very many
neighbours; edges stay in the cluster, and each round's edges are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import forget, materialize, release


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of edges (a long, b long) but the roots; root is the component's least id."""
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        old, e = e, materialize(small.select("e.*").filter("u <> v").distinct())
        forget(edges.sparkSession, old, large)
        after = state(e)
        if after == before:
            break
        before = after
    release(edges.sparkSession)
    return e.select(F.col("u").alias("id"), F.col("v").alias("root"))
