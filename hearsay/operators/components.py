"""Connected components by alternating star contraction (Kiveris et al. 2014)."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.workspace import Rounds


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to its smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.filter("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    siblings = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return siblings.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (u, v); the component is its smallest node."""
    work = Rounds(edges.sparkSession, "components")
    state = work.write(edges.select("u", "v").filter("u <> v").distinct(), "edges0")
    mark = None
    for i in itertools.count(1):
        state = work.write(_small_star(_large_star(state)), f"edges{i}")
        work.drop(f"edges{i - 1}")
        now = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            roots = state.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return state.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
        mark = now
