"""Near-duplicate documents by SetSketch registers (Ertl, "SetSketch: Filling the Gap between MinHash and HyperLogLog", 2021).

A document's set holds the distinct hashes of its 5-word shingles. Register i keeps
``clip(floor(1 - log_b(min x_i)), 0, q + 1)`` of exponential variates x_i of the set's members, so registers
of a union are the elementwise maxima, and with b near 1 two registers agree about as often as the sets do.
Bands of registers give candidates; the joint likelihood of the registers that are larger, smaller and equal
screens them; both whole sets confirm each link.

Groups: documents with equal sets meet once, under their smallest id. Rows of a digest or bucket that holds more than a thousandth of all
rows are joined where they are (``common.attach``). In a bucket every member is first compared with
the smallest id only. Where that leaves a bucket in several components, registers are compared in blocks of bounded
size, first for the best partner of each member, then for all pairs that are still apart, and only pairs that the
likelihood lets through leave a block. So a group of n near copies costs about n exact comparisons, not n squared.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SIMILARITY, attach, discard, materialize, mix64, prepare, release_shuffles, runs, shingle_sets, string_buffer, text_chunks
from .components import connected_components

#: Registers, those of them in bands, band width, base, rate and largest register value. 32 bands of 4 miss a pair at 0.75 once in 200,000.
#: All registers are computed only for documents that share a band with another one.
REGISTERS, BANDED, BAND, BASE, RATE, TOP = 1024, 128, 4, 1.001, 20.0, (1 << 16) - 2
#: Standard deviations below the limit at which the likelihood estimate still lets a pair through to the exact test.
MARGIN = 4.5
#: Members of a bucket that meet in one block.
BLOCK = 1024

_RNG = np.random.default_rng(20210101)
_MUL = (_RNG.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)


def registers(hashes: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """The first ``count`` SetSketch registers (uint16) of a set of 64-bit hashes; all zero for the empty set."""
    if not len(hashes):
        return np.zeros(count, np.uint16)
    low = np.full(count, 0xFFFFFFFF, np.uint32)
    h32 = (hashes >> np.uint64(32)).astype(np.uint32)
    for s in range(0, len(h32), 512):
        np.minimum(low, (h32[s : s + 512, None] * _MUL[:count] + _ADD[:count]).min(axis=0), out=low)
    x = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)


def joint_estimate(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity, given how many registers are larger and smaller and the set sizes."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    same = REGISTERS - larger - smaller

    def likelihood(j):
        p, q = _share(np.maximum(u - v * j, 1e-12)), _share(np.maximum(v - u * j, 1e-12))
        return larger * np.log(p) + smaller * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    g = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = hi - g * (hi - lo), lo + g * (hi - lo)
        up = likelihood(c) < likelihood(d)
        lo, hi = np.where(up, c, lo), np.where(up, hi, d)
    return (lo + hi) / 2


def _banded(batches):
    import pyarrow as pa
    import xxhash

    for batch in text_chunks(batches):
        sizes, digests, bands = [], [], []
        for s in shingle_sets(batch.column("text")):
            sizes.append(len(s))
            digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            bands.append(band_keys(registers(s, BANDED)[None])[0].view(np.int64) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column("own"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["own", "doc_id", "n_shingles", "digest", "bands"])


def _sketched(batches):
    import pyarrow as pa

    for batch in text_chunks(batches):
        sets = list(shingle_sets(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([registers(s).tobytes() for s in sets], pa.binary())], ["doc_id", "n_shingles", "sketch"])


def band_keys(r: np.ndarray) -> np.ndarray:
    """For rows of registers: a hash of each band and its number."""
    keys = np.tile(np.arange(BANDED // BAND, dtype=np.uint64), (len(r), 1))
    bands = r[:, :BANDED].reshape(len(r), -1, BAND).astype(np.uint64)
    for i in range(BAND):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return keys


def _let_through(x: np.ndarray, y: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, limit: float) -> np.ndarray:
    """The estimates of pairs, negative where a pair cannot reach the limit."""
    j = joint_estimate((x > y).sum(axis=-1), (x < y).sum(axis=-1), n_a, n_b)
    ok = (j >= limit - MARGIN * math.sqrt(limit * (1 - limit) / REGISTERS)) & (np.minimum(n_a, n_b) >= limit * np.maximum(n_a, n_b) - 1e-9)
    return np.where(ok, j, -1.0)


def _registers_of(column) -> np.ndarray:
    raw, offs = string_buffer(column)
    return raw[offs[0] : offs[-1]].view(np.uint16).reshape(-1, REGISTERS)


def _screened(limit: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
            ok = _let_through(_registers_of(batch.column("sketch_a")), _registers_of(batch.column("sketch_b")), n_a, n_b, limit) >= 0
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok))

    return run


def _compared(limit: float, best: int | None):
    """Pairs of different components in each block (key, i, j) that the likelihood lets through; the best of each member only, if asked."""

    def pairs(own, a, b, ids, comp, n, reg, key):
        i, j = np.nonzero((comp[a][:, None] != comp[b][None]) & ((ids[a][:, None] < ids[b][None]) if own else True))
        i, j = a[i], b[j]
        for s in range(0, len(i), 1 << 13):
            p, q = i[s : s + (1 << 13)], j[s : s + (1 << 13)]
            # a pair counts in the first band alone in which it agrees
            same = (reg[p, :BANDED].reshape(len(p), -1, BAND) == reg[q, :BANDED].reshape(len(p), -1, BAND)).all(axis=2)
            first = same.argmax(axis=1)
            mine = same.any(axis=1) & (band_keys(reg[p])[np.arange(len(p)), first].view(np.int64) == key)
            p, q = p[mine], q[mine]
            e = _let_through(reg[p], reg[q], n[p], n[q], limit)
            yield p[e >= 0], q[e >= 0], e[e >= 0]

    def run(batches):
        import pyarrow as pa

        for batch in runs(batches, ["key", "i", "j"]):
            ids, comp, key, bi, bj, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "component", "key", "i", "j", "block"))
            n, reg = batch.column("n_shingles").to_numpy(zero_copy_only=False).astype(float), _registers_of(batch.column("sketch"))
            new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])])
            out = []
            for s, t in zip(new, np.r_[new[1:], len(key)], strict=True):
                at = np.arange(s, t)
                a, b = at[block[s:t] == bi[s]], at[block[s:t] == bj[s]]
                found = list(pairs(bi[s] == bj[s], a, b, ids, comp, n, reg, key[s]))
                p, q, e = (np.concatenate([f[x] for f in found]) if found else np.zeros(0, np.int64) for x in range(3))
                if best and len(p):
                    order = np.argsort(-e, kind="stable")
                    p, q = p[order], q[order]
                    rank = np.minimum(_nth(p), _nth(q))
                    p, q = p[rank < best], q[rank < best]
                out.append((np.minimum(ids[p], ids[q]), np.maximum(ids[p], ids[q])))
            x, y = (np.concatenate([o[k] for o in out]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return run


def _nth(x: np.ndarray) -> np.ndarray:
    """How many equal values stand before each value."""
    order = np.argsort(x, kind="stable")
    first = np.flatnonzero(np.r_[True, x[order][1:] != x[order][:-1]])
    out = np.empty(len(x), np.int64)
    out[order] = np.arange(len(x)) - np.repeat(first, np.diff(np.r_[first, len(x)]))
    return out


def _verified(percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in text_chunks(batches, columns=("text_a", "text_b")):
            ok = []
            for s, t in zip(shingle_sets(batch.column("text_a")), shingle_sets(batch.column("text_b")), strict=True):
                both = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs (a, b), those whose whole sets reach the similarity."""
    text = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    both = pairs.join(text("b"), "b").join(text("a"), "a").select("a", "b", "text_a", "text_b")
    return materialize(both.mapInArrow(_verified(round(100 * similarity)), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    docs needs doc_id (long) and text; other columns are not read. Two documents are linked when the Jaccard
    similarity of their sets of distinct 5-word shingles reaches ``similarity`` (sets are of 64-bit hashes of
    the shingles). Fewer words than 5 make one shingle. A null, empty or blank text has an empty set, n_shingles
    0 and is linked with nothing. Rows that repeat a doc_id share one component, and the links of all their texts count. A null doc_id
    gives a row with null component_id, kept true. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    mark = F.xxhash64("text")
    several = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(mark).alias("x"), F.max(mark).alias("y")).filter("x < y").select("doc_id", F.lit(True).alias("several"))
    several = materialize(several, "several")
    if several.isEmpty():
        return _flagged(_classes(docs.withColumn("name", F.col("doc_id")), None, similarity))
    # Texts of one doc_id get names of their own, tied to the doc_id by a link each.
    named = docs.join(several, "doc_id", "left").withColumn("name", F.when(F.col("several"), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id")))
    ties = materialize(named.filter("several").select(F.col("name").alias("a"), F.col("doc_id").alias("b")).distinct(), "ties")
    rows = materialize(_classes(named.select("name", "doc_id", "text"), ties, similarity), "classes")
    # A component may be called after a name that is no doc_id.
    least = materialize(rows.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "least")
    placed = attach(rows, least, "component", rows.count()).select("doc_id", "n_shingles", F.col("least").alias("component"))
    return _flagged(placed.unionByName(rows.filter("component is null").select("doc_id", "n_shingles", "component")))


def _flagged(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _classes(docs: DataFrame, ties: DataFrame | None, similarity: float) -> DataFrame:
    """(doc_id, n_shingles, component) for each row of ``docs`` (name, doc_id, text), where a name has one text; ``ties`` (a, b) are links besides."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").alias("own"), F.col("name").alias("doc_id"), "text")
    prepared = materialize(docs.mapInArrow(_banded, "own long, doc_id long, n_shingles long, digest binary, bands array<long>"), "banded")
    sets = prepared.filter("digest is not null and doc_id is not null")
    low = sets.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("most"), F.count("*").alias("n")).filter("rep < most").select("digest", "rep", "n")
    low = materialize(low, "low")
    total = low.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    copies = attach(sets.select("digest", "doc_id"), low, "digest", total).filter("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    copies = materialize(copies, "copies")
    reps = sets.join(copies.select(F.col("b").alias("doc_id")).hint("merge"), "doc_id", "left_anti").dropDuplicates(["doc_id"])

    banded = materialize(reps.select("doc_id", F.explode("bands").alias("key")), "keys")
    buckets = materialize(banded.groupBy("key").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).filter("n > 1"), "buckets")
    total = buckets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    members = materialize(attach(banded, buckets, "key", total).select("key", "low", "n", "doc_id"), "members")
    discard(banded), discard(low)
    # A sort-merge join at every size: a plan that changed with the size would hide how the shuffle grows.
    inside = members.select("doc_id").distinct().hint("merge")
    texts = materialize(docs.drop("own").join(inside, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("text").alias("text")), "texts")
    sketched = materialize(texts.mapInArrow(_sketched, "doc_id long, n_shingles long, sketch binary"), "sketched")

    side = lambda c: sketched.select(F.col("doc_id").alias(c), F.col("sketch").alias(f"sketch_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    tried = members.filter("low != doc_id").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct()
    screened = tried.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b").mapInArrow(_screened(similarity), "a long, b long")
    tried = materialize(screened, "stars")
    links = [copies, _links(tried, texts, similarity)]
    found = materialize(connected_components(links[1]), "found")
    for best in (1, None):
        placed = members.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", F.col("n").alias("size"), "doc_id", F.coalesce("component", "doc_id").alias("component"))
        mixed = materialize(placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("size").alias("n")).filter("x < y").select("key", "n"), "mixed")
        rest = attach(placed, mixed, "key", total).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        # Each block meets itself and every other one, in the order of their numbers.
        rest = rest.join(sketched, "doc_id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rest = rest.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "component", "n_shingles", "sketch")
        crossed = rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_compared(similarity, best), "a long, b long")
        crossed = materialize(crossed.distinct().join(tried, ["a", "b"], "left_anti"), "crossed")
        links.append(_links(crossed, texts, similarity))
        tried = tried.unionByName(crossed)
        every = links[1].unionByName(links[2])
        if not best:
            every = every.unionByName(links[3]).unionByName(copies)
            every = every if ties is None else every.unionByName(ties)
        more = materialize(connected_components(every), "found")
        discard(found)
        found = more
    discard(members), discard(sketched), discard(texts), discard(buckets)
    for x in links:
        discard(x)
    release_shuffles(spark)
    return prepared.select("own", "doc_id", "n_shingles").join(found.hint("merge"), prepared.doc_id == found.id, "left").select(F.col("own").alias("doc_id"), "n_shingles", "component")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, without the near duplicates of a smaller doc_id."""
    gone = near_duplicates(docs, similarity).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.a = d.doc_id
"""
