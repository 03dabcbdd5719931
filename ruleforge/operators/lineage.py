"""The graph of rules and parents, and the nearest valid relatives of each rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import materialize, shuffled


def edges(rules: DataFrame, key: str = "id", parents: str = "parents") -> DataFrame:
    """(src, dst) from children to parents and back, without self references."""
    up = rules.select(F.col(key).alias("src"), F.explode(parents).alias("dst")).filter("src != dst")
    return up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def _nearest(labels: DataFrame, most: int) -> DataFrame:
    """Of each node its ``most`` sources of least (depth, source)."""
    nth = F.row_number().over(Window.partitionBy("node").orderBy("depth", "source"))
    return labels.groupBy("node", "source").agg(F.min("depth").alias("depth")).withColumn("_nth", nth).filter(F.col("_nth") <= most).drop("_nth")


def contracted(graph: DataFrame, valid: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(core, removed): the weighted graph (src, dst, d) without most of the nodes that are not valid and have two neighbours or fewer, and those nodes by round.

    A round takes nodes out of which no two are neighbours, those of least hash, so at least a third of a chain on average; a node of two neighbours leaves an edge between them, as long as both together.
    So distances between the nodes that stay don't change, and a chain or a tree is gone after rounds in proportion to the logarithm of its size. The rounds end once they take out less than an eighth of the nodes.
    removed has (node, near: array of (dst, d)), two at most a node.
    """
    removed: list[DataFrame] = []
    while True:
        nodes = graph.groupBy("src").agg(F.count("*").alias("n")).join(shuffled(valid.select(F.col("node").alias("src"), F.lit(True).alias("valid"))), "src", "left")
        nodes = materialize(nodes.select("src", (F.col("valid").isNull() & (F.col("n") <= 2)).alias("small"), F.xxhash64("src", F.lit(len(removed))).alias("h")))
        small = nodes.filter("small").select("src", "h")
        met = graph.join(shuffled(small), "src").join(shuffled(small.select(F.col("src").alias("dst"), F.col("h").alias("other"))), "dst", "left")
        first = F.col("other").isNull() | (F.struct("h", "src") < F.struct("other", "dst"))
        out = met.groupBy("src").agg(F.bool_and(first).alias("first"), F.collect_list(F.struct("dst", "d")).alias("near"))
        out = materialize(out.filter("first").select(F.col("src").alias("node"), "near"))
        if 8 * out.count() < nodes.count() or out.isEmpty():
            return graph, removed
        removed.append(out)
        gone = out.select(F.col("node").alias("src"))
        rest = graph.join(shuffled(gone), "src", "left_anti").join(shuffled(gone.withColumnRenamed("src", "dst")), "dst", "left_anti").select("src", "dst", "d")
        ends = lambda i, j: F.struct(F.col("near")[i]["dst"].alias("src"), F.col("near")[j]["dst"].alias("dst"), (F.col("near")[0]["d"] + F.col("near")[1]["d"]).alias("d"))
        across = out.filter("size(near) = 2").select(F.explode(F.array(ends(0, 1), ends(1, 0))).alias("e")).select("e.*")
        graph = materialize(rest.unionByName(across).groupBy("src", "dst").agg(F.min("d").alias("d")))


def relatives(rules: DataFrame, valid: DataFrame, wanted: int = 2, key: str = "id", parents: str = "parents") -> DataFrame:
    """(id, relatives): up to ``wanted`` valid rules reached first over parents and children, by depth, then id.

    Chains and trees of rules without a valid image set are contracted first, so a lineage of n steps takes rounds in proportion to log n. Over what is left valid rules spread by
    steps of the edges' lengths. A node keeps its ``wanted`` + 1 first ones, itself counted if valid: what it drops is also too far for its neighbours. Then the
    contracted nodes come back, the last first, each with the best of its neighbours. A round moves rows in proportion to the edges, and each is written, so plans stay short
    and a lost executor costs one round at most.
    """
    most = wanted + 1
    sources = materialize(valid.select(F.col(key).alias("node")).filter("node is not null").distinct())
    graph, removed = contracted(materialize(edges(rules, key, parents).withColumn("d", F.lit(1))), sources)
    front = labels = materialize(sources.select("node", F.col("node").alias("source"), F.lit(0).alias("depth")))
    while not front.isEmpty():
        step = front.join(shuffled(graph), front.node == graph.src).select(F.col("dst").alias("node"), "source", (F.col("depth") + F.col("d")).alias("depth"))
        known = labels.select("node", "source", F.col("depth").alias("before"))
        new = materialize(_nearest(labels.unionByName(step), most).join(shuffled(known), ["node", "source"], "left"))
        labels = new.drop("before")
        front = new.filter("before is null or depth < before").drop("before")
    for out in reversed(removed):
        near = out.select("node", F.explode("near").alias("x")).select(F.col("node").alias("_node"), F.col("x.dst").alias("node"), "x.d")
        back = near.join(shuffled(labels), "node").select(F.col("_node").alias("node"), "source", (F.col("depth") + F.col("d")).alias("depth"))
        labels = labels.unionByName(materialize(_nearest(back, most)))
    others = labels.filter("node != source").withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy("depth", "source"))).filter(F.col("nth") <= wanted)
    best = others.groupBy("node").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "source"))), lambda x: x["source"]).alias("relatives"))
    return rules.select(F.col(key).alias("id")).join(shuffled(best), F.col("id") == F.col("node"), "left").select("id", F.coalesce("relatives", F.array().cast("array<long>")).alias("relatives"))
