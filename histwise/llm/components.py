"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histwise.llm.common import stored


def _star(edges: DataFrame, keep) -> DataFrame:
    """Tie each node's neighbours to the smallest of them. A node's minimum is combined before
    the shuffle; the join is a plain one, whose large partitions Spark can split."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("w", "m").alias("m"))
    return edges.join(low, F.col("u") == F.col("w")).where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of the component) for all nodes of ``edges`` (u, v: long) that
    are not roots themselves. Rounds: logarithmic in the components' size; each is written to
    the shared folder, so a lost executor costs one round at most."""
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = stored(pairs, "links")
    state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).where("u <> v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        own = large.groupBy("u").agg(F.min("v").alias("v"))
        small = _star(large, F.col("v") != F.col("m")).unionByName(own)
        pairs = stored(small.where("u <> v").distinct(), "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
