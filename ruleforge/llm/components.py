"""Connected components of a link table, in rounds of alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, discard, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in ``links``; component is the smallest id reachable.

    Each round joins edges to the smallest neighbour of a node, first over all neighbours, then over
    smaller ones; the number of rounds grows with the logarithm of the longest chain. The links of a hub stay spread over the tasks. Only two
    numbers a round reach the driver. Links with a null end and self links count for nothing; no links give no rows.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "edges",
    )
    seen = _state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "low")
        large = attach(both, low, "u", 2 * seen[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = materialize(large, "large")
        down = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "down")
        small = attach(large, down, "u", 2 * seen[0])
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        new = materialize(small, "edges")
        now = _state(new)
        discard(edges), discard(large), discard(low), discard(down)
        edges = new
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))
