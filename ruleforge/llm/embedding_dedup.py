"""Near-duplicate vectors by range search in a flat proximity graph.

Vectors with equal components and label meet once, with their number. The vectors of a label are dealt to shards by their nearest
pivots: a shard above SHARD vectors is split by pivots far apart, and each vector goes to its nearest pivot, which owns it, and
to up to OVERLAP - 1 more that are nearly as near. A large shard is dealt in pieces of CHUNK vectors, each with a copy of the pivots, so neither a
label nor a shard that holds most vectors fills a task. Each shard builds a robust-pruned graph (as in DiskANN) of its members; their candidates come
from one product of the shard's vectors, as for SHARD vectors at most no search is cheaper. The
adjacency lists, back links included, that a vector has in several shards are united. Each vector is then searched once, in the shard that owns
it: greedily from the shard's medoid and its own node, then by expanding every node within twice the range. Neighbours outside the
shard that the united lists name are verified by a join. Cosines are taken in double precision.

A shard of more than SHARD vectors that pivots can't part (they all lie close together) is compared in full, by pairs of
blocks over many tasks, as there nearly all pairs are links. No step emits a row for each link inside a shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import attach, discard, materialize, prepare, runs
from .components import connected_components

COSINE, SHARD, PIVOTS, SAMPLE, OVERLAP, MARGIN = 0.98, 2048, 32, 512, 3, 0.1
CANDIDATES, DEGREE, ALPHA, BEAM, LEVELS = 64, 24, 1.2, 16, 8
#: Pivots closer than this count as one.
APART = 0.9
#: Vectors of a large shard that are dealt together, and queries of an audit.
CHUNK, AUDITED = 8192, 10_000


def robust_pruned(x: np.ndarray) -> list[np.ndarray]:
    """For unit rows: neighbours of each row, nearest first, without those that a nearer neighbour is ALPHA times closer to."""
    n = len(x)
    k = min(CANDIDATES, n - 1)
    if k < 1:
        return [np.zeros(0, np.int64)] * n
    out = []
    for s in range(0, n, 256):
        sims = x[s : s + 256] @ x.T
        rows = np.arange(len(sims))
        sims[rows, s + rows] = -2
        c = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        c = np.take_along_axis(c, np.argsort(-np.take_along_axis(sims, c, 1), axis=1, kind="stable"), 1)
        far = 2 - 2 * np.take_along_axis(sims, c, 1)
        alive = np.ones(c.shape, bool)
        taken = np.zeros(len(c), np.int64)
        for r in range(k):
            use = alive[:, r] & (taken < DEGREE)
            alive[~use, r] = False
            taken += use
            at = np.flatnonzero(use)
            if len(at) and r + 1 < k:
                between = 2 - 2 * np.einsum("ij,ikj->ik", x[c[at, r]], x[c[at, r + 1 :]])
                alive[at, r + 1 :] &= ALPHA**2 * between > far[at, r + 1 :]
        out += [c[i][alive[i]] for i in rows]
    return out


def with_back_links(lists: list[np.ndarray]) -> list[np.ndarray]:
    """Each list with those that list its owner: in a crowd of like vectors some are among the nearest of none."""
    owner = np.repeat(np.arange(len(lists)), [len(a) for a in lists])
    to = np.concatenate(lists) if lists else owner
    a, b = np.r_[owner, to], np.r_[to, owner]
    pairs = np.unique(a * max(len(lists), 1) + b)
    cuts = np.searchsorted(pairs, np.arange(len(lists) + 1) * len(lists))
    return [pairs[s:t] % len(lists) for s, t in zip(cuts[:-1], cuts[1:], strict=True)]


def range_search(x: np.ndarray, adjacent: list[np.ndarray], medoid: int, q: int, limit: float = COSINE) -> np.ndarray:
    """Nodes other than q with cosine of ``limit`` or more to it, found along the graph."""
    v = x[q]
    wide = 1 - 4 * (1 - limit)  # twice the distance
    seen = np.zeros(len(x), bool)
    front = np.unique(np.array([medoid, q]))
    seen[front] = True
    ids, cos = front, x[front] @ v
    done = np.zeros(0, np.int64)
    while True:  # greedy, by the BEAM nearest nodes that are not expanded yet
        best = ids[np.argsort(-cos, kind="stable")[:BEAM]]
        front = np.setdiff1d(best, done)
        if not len(front):
            break
        done = np.r_[done, front]
        new = np.unique(np.concatenate([adjacent[i] for i in front]))
        new = new[~seen[new]]
        seen[new] = True
        ids, cos = np.r_[ids, new], np.r_[cos, x[new] @ v]
    front = np.setdiff1d(ids[cos >= wide], done)
    while len(front):  # the range around q
        new = np.unique(np.concatenate([adjacent[i] for i in front]))
        new = new[~seen[new]]
        seen[new] = True
        c = x[new] @ v
        ids, cos = np.r_[ids, new], np.r_[cos, c]
        front = new[c >= wide]
    return ids[(cos >= limit) & (ids != q)]


def _matrix(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _groups(batch, key: str = "cell"):
    cells = np.array(batch.column(key).to_pylist(), object)
    new = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    for a, b in zip(new, np.r_[new[1:], len(cells)], strict=True):
        yield batch.slice(int(a), int(b - a))


def _pivots(key, rows):
    import pandas as pd

    x = np.stack(rows.sort_values("rep")["v"].to_numpy())
    chosen = [0]
    nearest = x @ x[0]
    while len(chosen) < PIVOTS and nearest.min() < APART:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return pd.DataFrame({"cell": [key[0]], "pivots": [x[chosen].ravel()], "n_pivots": [len(chosen)], "n": [rows["n"].iloc[0]]})


def _dealt(batches):
    """From rows sorted by cell and piece, the pivots of a piece before its vectors: each vector in the cells of its nearest pivots."""
    import pyarrow as pa

    place, pivots = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cells, pieces, kinds = (batch.column(c).to_pylist() for c in ("cell", "piece", "kind"))
        keys = list(zip(cells, pieces, strict=True))
        new = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
        for a, b in zip(new, [*new[1:], len(keys)], strict=True):
            if kinds[a] == 0:
                count = batch.column("rep")[a].as_py()
                place, pivots = keys[a], batch.column("v").slice(a, 1).flatten().to_numpy().reshape(count, -1)
                a += 1
            if a == b or keys[a] != place:  # pivots at the end of a batch, or a cell that pivots can't part
                continue
            g = batch.slice(a, b - a)
            sims = _matrix(g.column("v")) @ pivots.T
            order = np.argsort(-sims, axis=1, kind="stable")[:, :OVERLAP]
            near = np.take_along_axis(sims, order, 1)
            row, nth = np.nonzero(near >= near[:, :1] - MARGIN)
            took = g.take(pa.array(row))
            owned = took.column("owned").to_numpy(zero_copy_only=False).astype(bool) & (nth == 0)
            yield pa.RecordBatch.from_arrays([pa.array([f"{cells[b - 1]}/{i}" for i in order[row, nth]]), took.column("rep"), took.column("v"), took.column("m"), pa.array(owned)], ["cell", "rep", "v", "m", "owned"])


def _built(batches):
    import pyarrow as pa

    kind = pa.list_(pa.struct([("id", pa.int64()), ("cos", pa.float64())]))
    for batch in runs(batches, ["cell"]):
        for g in _groups(batch):
            x, ids = _matrix(g.column("v")), g.column("rep").to_numpy()
            lists = [[{"id": int(ids[j]), "cos": float(x[i] @ x[j])} for j in a] for i, a in enumerate(with_back_links(robust_pruned(x)))]
            yield pa.RecordBatch.from_arrays([g.column("rep"), pa.array(lists, kind)], ["rep", "near"])


def _joined(pairs: list[tuple[int, np.ndarray]], ids: np.ndarray):
    """One link from each node to the least node that it reaches here."""
    root = np.arange(len(ids))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, found in pairs:
        for j in found.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
    ends = np.array([find(i) for i in range(len(ids))])
    at = np.flatnonzero(ends != np.arange(len(ids)))
    return ids[at], ids[ends[at]]


def _searched(limit: float):
    wide = 1 - 4 * (1 - limit)

    def run(batches):
        import pyarrow as pa

        for batch in runs(batches, ["cell"]):
            for g in _groups(batch):
                g = g.take(pa.array(np.argsort(g.column("rep").to_numpy(), kind="stable")))
                x, ids, m = _matrix(g.column("v")), g.column("rep").to_numpy(), g.column("m").to_numpy()
                owned = np.array(g.column("owned").to_pylist(), bool)
                near, begin = g.column("near").flatten(), g.column("near").offsets.to_numpy() - g.column("near").offsets[0].as_py()
                to, cos = (near.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                at = np.minimum(np.searchsorted(ids, to), len(ids) - 1)
                here = ids[at] == to
                adjacent = [at[a:b][here[a:b]] for a, b in zip(begin[:-1], begin[1:], strict=True)]
                beyond = [to[a:b][~here[a:b] & (cos[a:b] >= wide)] for a, b in zip(begin[:-1], begin[1:], strict=True)]
                medoid = int(np.argmax(x @ x.sum(axis=0)))
                pairs, counts, outside = [], [], []
                for q in np.flatnonzero(owned).tolist():
                    found = range_search(x, adjacent, medoid, q, limit)
                    pairs.append((q, found))
                    counts.append((ids[q], int(m[found].sum())))
                    far = np.unique(np.concatenate([beyond[i] for i in (q, *found.tolist())]))
                    outside += [(ids[q], o) for o in far.tolist()]
                a, b = _joined(pairs, ids)
                kinds = np.r_[np.zeros(len(counts), np.int32), np.ones(len(a), np.int32), np.full(len(outside), 2, np.int32)]
                first = np.r_[np.array([c[0] for c in counts], np.int64), a, np.array([o[0] for o in outside], np.int64)]
                second = np.r_[np.array([c[1] for c in counts], np.int64), b, np.array([o[1] for o in outside], np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(first), pa.array(second)], ["kind", "a", "b"])

    return run


def _compared(limit: float):
    """All pairs of two blocks of a shard that can't be split: counts of links, and links enough to keep nodes connected."""

    def run(batches):
        import pyarrow as pa

        for batch in runs(batches, ["cell", "i", "j"]):
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "i", "j")), strict=True))
            new = [k for k in range(len(keys)) if not k or keys[k] != keys[k - 1]]
            for s, t in zip(new, [*new[1:], len(keys)], strict=True):
                g = batch.slice(s, t - s)
                g = g.take(pa.array(np.argsort(g.column("rep").to_numpy(), kind="stable")))
                x, ids, m, block, own = _matrix(g.column("v")), g.column("rep").to_numpy(), g.column("m").to_numpy(), g.column("block").to_numpy(), np.array(g.column("owned").to_pylist(), bool)
                i, j = keys[s][1:]
                n, pairs = np.zeros(len(ids), np.int64), []
                for a, b in {(i, j), (j, i)}:
                    rows, cols = np.flatnonzero((block == a) & own), np.flatnonzero(block == b)
                    for k in range(0, len(rows), 256):
                        r = rows[k : k + 256]
                        hit = x[r] @ x[cols].T >= limit
                        hit &= r[:, None] != cols[None]
                        n[r] += hit @ m[cols]
                        pairs += [(int(p), cols[h]) for p, h in zip(r, hit, strict=True)]
                a, b = _joined(pairs, ids)
                yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.zeros(len(ids), np.int32), np.ones(len(a), np.int32)]), pa.array(np.r_[ids, a]), pa.array(np.r_[n, b])], ["kind", "a", "b"])

    return run


def _cosine(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def shards(reps: DataFrame, shard: int = SHARD) -> DataFrame:
    """(cell, rep, v, m, owned, n, whole): the members of each shard; whole is false for a large one that pivots can't part."""
    rows = materialize(reps.select("cell", "rep", "v", "m", F.lit(True).alias("owned")), "cells")
    done = []
    pieces = F.ceil(F.col("n") / CHUNK).cast("int")
    for _ in range(LEVELS):
        rows, total = _sized(rows)
        done.append(rows.filter(F.col("n") <= shard).withColumn("whole", F.lit(True)))
        large = rows.filter(F.col("n") > shard)
        nth = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("rep"), "rep"))
        sample = large.withColumn("nth", nth).filter(F.col("nth") <= SAMPLE).select("cell", "rep", "v", "n")
        pivots = materialize(sample.groupBy("cell").applyInPandas(_pivots, "cell string, pivots array<double>, n_pivots int, n long"), "pivots")
        if pivots.isEmpty():
            return _united(done)
        done.append(attach(large.drop("n"), pivots.filter("n_pivots < 2").select("cell", "n"), "cell", total).select(*rows.columns, F.lit(False).alias("whole")))
        vectors = large.select("cell", F.pmod(F.xxhash64("rep"), pieces).alias("piece"), F.lit(1).alias("kind"), "rep", "v", "m", "owned")
        heads = pivots.filter("n_pivots > 1").select("cell", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"), F.lit(0).alias("kind"), F.col("n_pivots").cast("long").alias("rep"), F.col("pivots").alias("v"), F.lit(0).cast("long").alias("m"), F.lit(False).alias("owned"))
        parted = vectors.unionByName(heads).repartition("cell", "piece").sortWithinPartitions("cell", "piece", "kind", "rep")
        rows = materialize(parted.mapInArrow(_dealt, "cell string, rep long, v array<double>, m long, owned boolean"), "cells")
    done.append(_sized(rows)[0].withColumn("whole", F.col("n") <= shard))
    return _united(done)


def _sized(rows: DataFrame) -> tuple[DataFrame, int]:
    """(rows with the size of their cell in ``n``, number of rows)."""
    sizes = materialize(rows.groupBy("cell").agg(F.count("*").alias("n")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return materialize(attach(rows, sizes, "cell", total).select(*rows.columns, "n"), "sized"), total


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialize(out, "shards")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, shard: int = SHARD) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    vectors needs vec_id (long), embedding (array of numbers) and label. Vectors are linked when label and number of components
    are equal and their cosine reaches ``cosine``. A null label or embedding, an empty or zero vector and one with null or non-finite
    components is linked with nothing; all other vectors count, however long or short. n_links counts other rows. Rows of a repeated vec_id are vectors of their own under one component. A
    null vec_id gives a row without links. An empty table gives no rows.
    """
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"), F.col("label").cast("string").alias("label"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = lambda e: F.array_max(F.transform(e, lambda x: F.abs(x)))
    fit = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("e") > 0) & finite & (most("e") > 0), F.lit(False))
    rows = materialize(rows.withColumn("fit", fit).withColumn("key", F.struct("label", "e")), "vectors")
    groups = rows.filter("fit").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    groups = groups.select("key", "key.label", "key.e", "rep", "m").withColumn("most", most("e"))
    # By the largest component first, so that no finite vector is too long or too short for its square.
    groups = groups.withColumn("v", F.transform("e", lambda x: x / F.col("most")))
    groups = groups.withColumn("norm", F.sqrt(_cosine(F.col("v"), F.col("v")))).withColumn("v", F.transform("v", lambda x: x / F.col("norm"))).drop("most", "norm")
    # One vec_id may stand for two different vectors; the search needs names of its own. The label is written so that it can't look like a part of a path.
    groups = materialize(groups.withColumn("cell", F.concat_ws("/", F.hex("label"), F.size("e").cast("string"))), "groups")
    unique = groups.groupBy("rep").count().filter("count > 1").isEmpty()
    reps = groups.withColumn("name", F.col("rep") if unique else F.xxhash64("label", "e", "rep"))
    named = reps.select("cell", F.col("name").alias("rep"), "v", "m")

    every = shards(named, shard)
    split = every.filter("whole").select("cell", "rep", "v", "m", "owned")
    built = split.repartition("cell").sortWithinPartitions("cell", "rep").mapInArrow(_built, "rep long, near array<struct<id:long,cos:double>>")
    united = materialize(built.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "adjacency")
    searched = split.join(united, "rep").select("cell", "rep", "v", "m", "owned", "near").repartition("cell").sortWithinPartitions("cell", "rep").mapInArrow(_searched(cosine), "kind int, a long, b long")

    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    full = every.filter("not whole").withColumn("blocks", F.ceil(F.col("n") / shard).cast("int")).withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    full = full.select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "v", "m", "owned")
    compared = full.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(_compared(cosine), "kind int, a long, b long")
    found = materialize(searched.unionByName(compared), "found")

    vec = lambda c: named.select(F.col("rep").alias(c), F.col("v").alias(f"v{c}"), F.col("m").alias(f"m{c}"))
    outside = found.filter("kind = 2").select("a", "b").distinct().join(vec("a"), "a").join(vec("b"), "b").filter(_cosine(F.col("va"), F.col("vb")) >= cosine).select("a", "b", F.col("mb").alias("n"))
    outside = materialize(outside, "outside")
    links = found.filter("kind = 0").select("a", F.col("b").alias("n")).unionByName(outside.select("a", "n")).groupBy("a").agg(F.sum("n").alias("n"))
    graph = connected_components(found.filter("kind = 1").select("a", "b").unionByName(outside.select("a", "b")))

    # From names back to rows, then rows of one vec_id together.
    placed = reps.select("key", "name", "rep", F.col("m").alias("n")).join(links.select("a", F.col("n").alias("linked")), F.col("name") == F.col("a"), "left").join(graph, F.col("name") == F.col("id"), "left")
    placed = placed.select("key", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "name").alias("component"), "n")
    fits = rows.filter("fit").select("vec_id", "key")
    total = fits.count()
    own = materialize(attach(fits, materialize(placed, "found"), "key", total).select("vec_id", "n_links", "component"), "placed")
    least = materialize(own.groupBy("component").agg(F.min("vec_id").alias("least"), F.count("*").alias("n")), "least")
    own = attach(own, least, "component", total).select("vec_id", "n_links", F.col("least").alias("component_id"))
    rest = rows.filter("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    discard(every), discard(united)
    return own.unionByName(rest).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def audit(vectors: DataFrame, cosine: float = COSINE, every: int = 50, shard: int = SHARD) -> dict[str, float]:
    """Recall of links against brute force: the rows whose vec_id is divisible by ``every``, AUDITED of them at most by a hash, against all rows."""
    rows = vectors.filter("label is not null and embedding is not null").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).orderBy(F.xxhash64("vec_id"), "vec_id").limit(AUDITED)
    q = F.broadcast(materialize(asked.select(F.col("vec_id").alias("q"), F.col("label").alias("l"), F.col("e").alias("f")), "asked"))
    near = near_vectors(vectors, cosine, shard).join(q.select(F.col("q").alias("vec_id")).distinct(), "vec_id", "left_semi").agg(F.sum("n_links")).first()[0] or 0
    length = lambda c: F.sqrt(_cosine(F.col(c), F.col(c)))
    true = rows.join(q, (F.col("label") == F.col("l")) & (F.col("vec_id") != F.col("q"))).filter(_cosine(F.col("e"), F.col("f")) >= F.lit(cosine) * length("e") * length("f")).count()
    return {"links": float(true), "found": float(near), "recall": near / true if true else 1.0}


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (SELECT vec_id, label, e, list_max(list_transform(e, lambda x: abs(x))) AS x FROM v),
r AS (SELECT vec_id, label, list_transform(e, lambda y: y / x) AS e FROM s WHERE x > 0),
u AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS n FROM r),
w AS (SELECT vec_id, label, list_transform(e, lambda x: x / n) AS e FROM u WHERE n > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM w a JOIN w b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a), deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings LEFT JOIN deg ON deg.a = vec_id JOIN comp ON comp.a = vec_id
"""
