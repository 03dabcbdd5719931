"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree.

The documents of a source are dealt by hash into blocks of some thousand. A target of r times the source's words
takes every block floor(r) times and, of one more permuted pass, the first blocks that the rest of the target holds; the
block in which the target ends is cut between two documents. The block instances of all sources are then split among the
output shards: a node of the tree splits its shards in two halves and draws the left half's blocks from the sources'
quotas without replacement. So each shard's share of each source is exact in sum and random as a plain shuffle would make it.
A shard takes the next run of the source's permuted instances and orders its documents by hash. There is a shard for every SHARD_WORDS words of the mixture.

Only one row a source and its quotas reach the driver. No step gathers the documents of a source in one task: sums are taken by block
first, and documents are ordered only inside the one block a source that is cut.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, n_words_col

WEIGHTS, CAP, BLOCK_DOCS, SEED = (1, 2, 3), 3, 2048, 20240229
#: Blocks of a source, at most: beyond that blocks grow, as the blocks of a source are ordered in one task.
MAX_BLOCKS = 65_536
#: Words of a shard, and bounds on the number of shards: the driver holds a number for each shard and source.
SHARD_WORDS, SHARDS, MAX_SHARDS, MAX_CELLS = 2_000_000, 4, 65_536, 20_000_000
#: Tasks that write a shard, each a shuffled part of it.
PARTS = 8
#: The driver holds one row a source: more sources than this are an error.
MAX_SOURCES = 100_000


def targets(sizes: list[int], weights: list[int], cap: int = CAP) -> list[Fraction]:
    """Shares of the sum of sizes by weight; none above cap times its size, the excess reshared by weight."""
    out, left, rest = [Fraction(0)] * len(sizes), Fraction(sum(sizes)), [i for i, s in enumerate(sizes) if s]
    while rest:
        total = sum(weights[i] for i in rest)
        full = [i for i in rest if left * weights[i] > cap * sizes[i] * total]
        if not full:
            for i in rest:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = Fraction(cap * sizes[i])
        left -= sum(out[i] for i in full)
        rest = [i for i in rest if i not in set(full)]
    return out


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """shards x sources: how many blocks of each source each shard gets; columns sum to the quotas, rows are even."""
    if shards == 1:
        return quotas[None]
    left = shards // 2
    total = int(quotas.sum())
    take = total * left // shards
    drawn = _draw(quotas, take, rng)
    return np.concatenate((splitting_tree(drawn, left, rng), splitting_tree(quotas - drawn, shards - left, rng)))


def _draw(quotas: np.ndarray, take: int, rng: np.random.Generator) -> np.ndarray:
    """A multivariate hypergeometric draw, source by source."""
    out, rest = np.zeros_like(quotas), int(quotas.sum())
    for i, q in enumerate(quotas.tolist()):
        rest -= q
        out[i] = rng.hypergeometric(q, rest, take) if take and q else 0
        take -= int(out[i])
    return out


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source, source_size, target, taken, shards (one for each copy taken), key (a hash of the row).

    docs needs doc_id, text and source. size is the number of words (null text: 0). Sources, by code point and the null source last, get the
    weights in turn, repeating. A source without words has target 0 and gives nothing. Rows of a repeated doc_id are documents of
    their own. The result depends on the rows and the seed alone. ``shards`` is their number, by default one for each SHARD_WORDS words, SHARDS at least. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = materialize(docs.select("doc_id", "source", n_words_col(F.col("text")).alias("size"), key.alias("key")), "sizes")
    # Named apart from null: the hash join of null sources needs a value.
    named = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("s")
    sized = sized.select("doc_id", "source", "size", "key", named)
    found = sized.groupBy("s").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    rows = found.orderBy("s").take(MAX_SOURCES + 1)
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    aims = targets([r.words for r in rows], [weights[i % len(weights)] for i in range(len(rows))], cap)
    plan = []
    for r, aim in zip(rows, aims, strict=True):
        whole = int(aim // r.words) if r.words else 0
        plan.append(((r.s.none, r.s.name), r.words, float(aim), whole, float(aim - whole * r.words), min(MAX_BLOCKS, -(-r.docs // BLOCK_DOCS))))
    if shards is None:
        shards = max(SHARDS, min(MAX_SHARDS, MAX_CELLS // max(1, len(rows)), int(sum(aims)) // SHARD_WORDS))
    kind = "s struct<none:boolean,name:string>, source_size long, target double, whole int, extra double, n_blocks int"
    sources = F.broadcast(spark.createDataFrame(plan, kind))  # MAX_SOURCES rows at most

    placed = sized.join(sources, "s").withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("key")), F.col("n_blocks")).cast("int"))
    order = Window.partitionBy("s").orderBy("at", "block")
    blocks = placed.groupBy("s", "block", "extra", "whole").agg(F.sum("size").alias("words")).withColumn("at", F.xxhash64(F.lit(seed + 2), F.col("s.name"), F.col("block")))
    blocks = blocks.withColumn("until", F.sum("words").over(order)).withColumn("since", F.col("until") - F.col("words"))
    blocks = materialize(blocks.select("s", "block", "whole", (F.col("extra") - F.col("since")).alias("room"), (F.col("since") < F.col("extra")).alias("more")), "blocks")

    counts = {(r.s.none, r.s.name): r.n for r in blocks.groupBy("s").agg(F.sum(F.col("whole") + F.col("more").cast("int")).alias("n")).collect()}
    names = [p[0] for p in plan]
    split = splitting_tree(np.array([counts.get(n, 0) for n in names], np.int64), shards, np.random.default_rng(seed)) if names else np.zeros((shards, 0), np.int64)
    ends = spark.createDataFrame([(n, np.cumsum(split[:, i]).tolist()) for i, n in enumerate(names)], "s struct<none:boolean,name:string>, ends array<long>")
    copies = blocks.filter("more or whole > 0").select("s", "block", F.explode(F.sequence(F.lit(1), F.col("whole") + F.col("more").cast("int"))).alias("copy"))
    nth = F.row_number().over(Window.partitionBy("s").orderBy(F.xxhash64(F.lit(seed + 3), F.col("s.name"), F.col("block"), F.col("copy")), "block", "copy"))
    dealt = copies.withColumn("nth", nth).join(F.broadcast(ends), "s").withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("nth"))))
    dealt = dealt.groupBy("s", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("shards"))
    of_block = blocks.join(dealt, ["s", "block"], "left").select("s", "block", "room", "more", F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))

    joined = placed.join(of_block, ["s", "block"]).select("doc_id", "source", "size", "key", "s", "source_size", "target", "whole", "block", "room", "more", "shards")
    joined = materialize(joined, "placed")
    edge = blocks.filter("more").groupBy("s").agg(F.min("room").alias("room"))  # the room left is least in the last block taken
    cut = joined.join(edge, ["s", "room"], "left_semi").filter("more")
    in_block = Window.partitionBy("s", "block")
    until = F.sum("size").over(in_block.orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = cut.withColumn("in_", until <= F.col("room"))
    # Of the documents left, the one that fills the gap best goes in too.
    gap = F.col("room") - F.sum(F.when(F.col("in_"), F.col("size")).otherwise(0)).over(in_block)
    off = F.abs(F.col("gap") - F.col("size"))
    best = F.row_number().over(in_block.orderBy("in_", off, "key", "doc_id")) == 1
    cut = cut.withColumn("gap", gap).withColumn("in_", F.col("in_") | (best & (off < F.col("gap")))).drop("gap")
    rest = joined.join(edge, ["s", "room"], "left_anti").withColumn("in_", F.col("more"))
    every = cut.unionByName(rest)
    n = F.col("whole") + F.col("in_").cast("int")
    return every.select("doc_id", "size", "source", "source_size", "target", (F.col("size") * n).cast("long").alias("taken"), F.slice("shards", F.lit(1), n).alias("shards"), "key")


def mixed(docs: DataFrame, shards: int | None = None, seed: int = SEED, **options) -> DataFrame:
    """The mixture itself: a row for each copy taken, with the columns of ``docs``, then ``_copy`` and ``_shard``, dealt by shard and shuffled inside.

    Rows are found again by a hash of doc_id and text, so that rows of a repeated doc_id keep their own share; rows alike in both are taken as often as
    all of them together. Null and empty texts have no words and come along with their block. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("_copy", "_shard")]
    plan = mix_plan(docs.select("doc_id", "source", "text"), shards=shards, seed=seed, **options)
    taken = plan.select(F.col("key").alias("_key"), F.explode("shards").alias("_shard")).groupBy("_key").agg(F.sort_array(F.collect_list("_shard")).alias("_shards"))
    # Equal rows: the first of them carries the copies of all.
    rows = docs.select(F.xxhash64(F.lit(seed), "doc_id", "text").alias("_key"), F.struct(*names).alias("_row"))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy("_key"))).filter("_nth = 1").drop("_nth")
    rows = rows.join(taken, "_key").select("_key", "_row", F.posexplode("_shards").alias("_copy", "_shard"))
    count = 1 + (plan.agg(F.max(F.array_max("shards"))).first()[0] or 0)
    # A shard is dealt in PARTS, so that few shards, or some that meet in one task, leave none with much more than its share.
    rows = rows.withColumn("_at", F.xxhash64(F.lit(seed + 4), "_key", "_copy")).repartition(count * PARTS, "_shard", F.pmod("_at", F.lit(PARTS)))
    return rows.sortWithinPartitions("_shard", "_at").select("_row.*", "_copy", "_shard")
