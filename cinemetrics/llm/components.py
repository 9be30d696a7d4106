"""Connected components of an edge list, by alternating large-star and small-star steps.

Each step connects the neighbours of a node to the smallest of them (Kiveris et al.,
"Connected Components in MapReduce and Beyond", 2014). Every step is joins and partial
aggregates over the edge list; the driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle


def _signature(edges: DataFrame) -> tuple:
    h = F.xxhash64("_u", "_v")
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(low), F.sum(high)).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge: component is the smallest node reachable.

    Loops and repeated edges are allowed; an edge with a null end is ignored. Nodes are longs.
    """
    both = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = settle(both.select(F.greatest(a, b).alias("_u"), F.least(a, b).alias("_v")).distinct())
    before = _signature(e)
    while before[0]:
        sym = e.unionByName(e.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        low = sym.groupBy("_u").agg(F.least(F.col("_u"), F.min("_v")).alias("_m"))
        large = (
            sym.join(low, "_u")
            .where(F.col("_v") > F.col("_u"))
            .select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
            .distinct()
        )
        low = large.groupBy("_u").agg(F.min("_v").alias("_m"))
        ends = F.array(F.struct("_u", F.col("_m").alias("_v")), F.struct(F.col("_v").alias("_u"), F.col("_m").alias("_v")))
        small = large.join(low, "_u").select(F.inline(ends)).where(F.col("_u") != F.col("_v")).distinct()
        e = settle(small)
        now = _signature(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("_v").alias("node"), F.col("_v").alias("component")).distinct()
    return e.select(F.col("_u").alias("node"), F.col("_v").alias("component")).unionByName(roots)
