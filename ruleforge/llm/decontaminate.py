"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame functions only.

A window has as many words as the item it is held against. A window and an item reach the similarity only if the window holds enough
of the item's shingles, so windows are built from shared shingles: a bitmap of the items' shingles picks positions
without exploding a document, and an equi-join with the items' rarest shingles names the items of each document (any match holds one of
these). For each such document and item, a running count over the places of shared shingles tells how many of them a
window from each start would hold. That count grows only where a shared shingle comes in at the window's end; so the best window, and the first of equally good ones, is among
those that end with a shared shingle, or start at the first word, whatever the order of the item's parts in the document.

Each of these windows and each item has a 64-bit SimHash of its words, cut into RADIUS + 1 blocks: two fingerprints that differ in at most RADIUS bits
agree in one block at least. Windows that agree with their item in a block and lie within the radius are then verified:
the similarity is the sum of the lesser over the sum of the greater shingle counts of window and item. Blocks are compared for the pairs that share
shingles alone, as RADIUS + 1 blocks have 3 bits and would join nearly all windows with all items of a length.

What grows with the benchmark alone (its shingles and fingerprints) is broadcast if it has at most BROADCAST_ROWS rows and BROADCAST_BYTES bytes,
which are counted first, and joined by shuffle otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from .common import SHINGLE_WORDS, SIMILARITY, discard, materialize, words_col

RADIUS, BROADCAST_ROWS, BROADCAST_BYTES = 20, 500_000, 32_000_000
#: Longs in the bitmap, at most; a full bitmap only lets more positions through to the join.
MAX_BITMAP = 1 << 18


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of hashes, each member counted as often as it stands there."""
    bit = lambda j: F.size(F.filter(hashes, lambda h: F.getbit(h, j) == 1)) * 2 > F.size(hashes)
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, j: acc.bitwiseOR(F.when(bit(j), F.call_function("shiftleft", F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long"))))


def fingerprint(words: Column) -> Column:
    return simhash(F.transform(words, lambda w: F.xxhash64(w)))


def blocks(fp: Column) -> Column:
    """array<long>: the fingerprint in RADIUS + 1 runs of bits, each with its number above it."""
    edges = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    one = lambda i: F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))
    return F.array(*(one(i) + F.lit(i << 32) for i in range(RADIUS + 1)))


def shingles(words: Column, k: Column) -> Column:
    """The k-word shingles in order; none of fewer words."""
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.array_join(F.slice(words, i + 1, k), " "))).otherwise(F.array().cast("array<string>"))


def _bounded(df: DataFrame, rows: int, size: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per (doc_id, item_id) whose best window reaches the similarity.

    Columns: doc_id, item_id, similarity, start_word, n_words (of the item), distance (bits between the fingerprints).
    Words have A-Z lower-cased; shingles are of 5 words, of an item with fewer words all of them. A document with fewer
    words than the item is one window. Of equally similar windows the first counts. Null, empty or blank texts, and rows with a null
    id, match nothing. Rows that repeat a doc_id count as one document with the matches of all their texts; of a repeated item_id the least text counts.
    Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    percent = round(100 * similarity)
    items = benchmark.filter("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text")).select("item_id", words_col(F.col("text")).alias("words")).filter("size(words) > 0")
    items = items.select("item_id", "words", F.size("words").alias("n"), F.least(F.size("words"), F.lit(SHINGLE_WORDS)).alias("k"))
    items = items.withColumn("total", F.col("n") - F.col("k") + 1).withColumn("item_fp", fingerprint(F.col("words"))).withColumn("item_grams", shingles(F.col("words"), F.col("k")))
    # Shared shingles that a match needs: m / (total + other - m) >= s, where a window has total shingles too, and a shorter document m at least.
    items = items.withColumn("need", F.ceil(F.col("total") * percent / 100).cast("int")).withColumn("need_full", F.ceil(F.col("total") * (2 * percent) / (100 + percent)).cast("int"))
    items = materialize(items.withColumn("repeats", F.size(F.array_distinct("item_grams")) < F.size("item_grams")), "items")
    hashed = items.select("item_id", "n", "k", "total", "need", F.transform("words", lambda w: F.xxhash64(w)).alias("wh"))
    at = F.sequence(F.lit(0), F.col("n") - F.col("k"))
    of_size = lambda i: F.coalesce(*(F.when(F.col("k") == k, gram_hash("wh", i, k)) for k in range(1, SHINGLE_WORDS + 1)))
    grams = materialize(hashed.select("item_id", "n", "k", "total", "need", F.explode(F.transform(at, of_size)).alias("h")), "grams")
    size = grams.agg(F.count("*").alias("n"), F.collect_set("k").alias("k")).first()
    if not size.n:
        return docs.select("doc_id", F.lit(None).cast("long").alias("item_id"), F.lit(None).cast("double").alias("similarity"), *(F.lit(None).cast("int").alias(c) for c in ("start_word", "n_words", "distance"))).limit(0)

    longs = min(MAX_BITMAP, 1 << max(6, (size.n - 1).bit_length()))
    bits = grams.select(F.explode(F.array(*(_probe(F.col("h"), i, longs) for i in (0, 1)))).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    bitmap = spark.range(longs).join(bits, F.col("id") == F.col("word"), "left").agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("b")).select(F.col("b.bits").alias("b"))
    bitmap = materialize(bitmap, "bitmap").scalar()

    whole = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    row = F.xxhash64("doc_id", "words")
    texts = whole.select("doc_id", words_col(F.col("text")).alias("words"))
    texts = texts.select("doc_id", row.alias("row"), F.transform("words", lambda w: F.xxhash64(w)).alias("wh"), bitmap.alias("bitmap"))
    hits = F.array().cast("array<struct<h:bigint,at:int>>")
    for k in sorted(size.k):
        hits = F.concat(hits, _hits(F.col("bitmap"), longs, k))
    # The outer form: for a plain filter the optimizer finds all hits a second time.
    texts = texts.select("doc_id", "row", F.size("wh").alias("doc_n"), hits.alias("hits")).select("doc_id", "row", "doc_n", F.explode_outer(F.when(F.size("hits") > 0, F.array("hits"))).alias("hits")).filter("hits is not null")
    # Places alone are kept, as the bitmap lets some through by chance and so holds most long texts for suspects: with their words, 2.9 GB of documents made 4,038 MB here.
    suspects = materialize(texts.dropDuplicates(["row"]), "suspects")
    hits = suspects.select("row", "doc_n", F.explode("hits").alias("x")).select("row", "doc_n", "x.h", "x.at")

    # Any match holds one of the item's total - need + 1 shingles that come first in any order; rare ones make few pairs.
    often = grams.groupBy("h").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("often", "h"))
    rare = grams.join(often, "h").withColumn("rank", rank).filter(F.col("rank") <= F.col("total") - F.col("need") + 1).select("item_id", "h").distinct()
    pairs = hits.select("row", "h").distinct().join(_bounded(rare, size.n, 40 * size.n), "h").select("row", "item_id").distinct()
    own = _bounded(grams.select("item_id", "h").distinct(), size.n, 40 * size.n)
    shared = materialize(hits.join(materialize(pairs, "pairs"), "row").join(own, ["item_id", "h"]), "shared")

    fields = items.select("item_id", "n", "k", "total", "need", "need_full", "repeats")
    n_items, n_bytes = items.count(), items.agg(F.sum(F.size("words") * 200)).first()[0]
    placed = shared.join(_bounded(fields, n_items, 60 * n_items), "item_id")
    end = F.greatest(F.col("at") - F.col("total") + 1, F.lit(0))
    step = placed.select("row", "item_id", "doc_n", "n", "need", "need_full", F.explode(F.array(F.struct(end.alias("start"), F.lit(1).alias("by")), F.struct((F.col("at") + 1).alias("start"), F.lit(-1).alias("by")))).alias("e")).select("*", "e.start", "e.by")
    held = F.sum("by").over(Window.partitionBy("row", "item_id").orderBy("start"))
    enough = F.when(F.col("doc_n") < F.col("n"), F.col("need")).otherwise(F.col("need_full"))
    starts = step.withColumn("held", held).filter((F.col("by") > 0) & (F.col("held") >= enough)).select("row", "item_id", "n", "start", "held").distinct()
    # Where no shingle repeats, what a window holds is exact, and the first of the best windows is enough.
    plain = placed.groupBy("row", "item_id").agg((~F.first("repeats") & (F.count("*") == F.count_distinct("h"))).alias("plain"))
    best = F.row_number().over(Window.partitionBy("row", "item_id").orderBy(F.desc("held"), "start"))
    starts = materialize(starts.withColumn("best", best).join(plain, ["row", "item_id"]).filter(~F.col("plain") | (F.col("best") == 1)).select("row", "item_id", "n", "start"), "starts")

    # The texts that have such a window are read again and cut into words anew, once each; a window's words are cut out as soon as its text is met, and written with their fingerprint.
    leaky = materialize(suspects.join(starts.select("row").distinct(), "row", "left_semi").select("doc_id").distinct(), "leaky")
    n_leaky, n_starts = leaky.count(), starts.count()
    texts = whole.join(_bounded(leaky, n_leaky, 8 * n_leaky), "doc_id", "left_semi").select("doc_id", words_col(F.col("text")).alias("words")).withColumn("row", row)
    windows = texts.join(_bounded(starts, n_starts, 32 * n_starts), "row").select("row", "doc_id", "item_id", "start", F.slice("words", F.col("start") + 1, F.col("n")).alias("words"))
    # Repeated rows of a text have the same windows.
    cut = materialize(windows.dropDuplicates(["row", "item_id", "start"]).drop("row").withColumn("fp", fingerprint(F.col("words"))), "windows")
    parts = items.select("item_id", "n", "k", "total", "item_fp", "item_grams")
    windows = cut.join(_bounded(parts, n_items, n_bytes), "item_id")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    near = windows.filter(F.arrays_overlap(blocks(F.col("fp")), blocks(F.col("item_fp")))).withColumn("distance", distance).filter(F.col("distance") <= RADIUS)
    near = materialize(near.select("doc_id", "item_id", "start", "n", "total", "distance", shingles(F.col("words"), F.col("k")).alias("w"), "item_grams"), "near")
    # Counts of equal shingles on both sides, by explosion: linear in the words, however long the item.
    key = ["doc_id", "item_id", "start", "n", "total", "distance"]
    side = lambda c, name: near.select(*key, F.size("w").alias("has"), F.explode(c).alias("g")).groupBy(*key, "has", "g").agg(F.count("*").alias(name))
    common = side("w", "x").join(side("item_grams", "y"), [*key, "has", "g"]).groupBy(*key, "has").agg(F.sum(F.least("x", "y")).alias("both"))
    union = F.col("has") + F.col("total") - F.col("both")
    verified = common.withColumn("union", union).filter(F.col("both") * 100 >= F.col("union") * percent)
    best = verified.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("both") / F.col("union")).alias("s"), (-F.col("start")).alias("at"), F.col("n"), F.col("distance"))).alias("b"))
    out = materialize(best.select("doc_id", "item_id", F.col("b.s").alias("similarity"), (-F.col("b.at")).alias("start_word"), F.col("b.n").alias("n_words"), F.col("b.distance").alias("distance")), "matches")
    for done in (items, grams, suspects, shared, starts, leaky, cut, near):
        discard(done)
    return out


def gram_hash(name: str, i: Column, k: int) -> Column:
    """The hash of the k words at i, from the hashes of the words."""
    return F.xxhash64(F.lit(k), *(F.get(F.col(name), i + j) for j in range(k)))


def _hits(bitmap: Column, longs: int, k: int) -> Column:
    """array<struct<h, at>>: the places of ``wh`` whose k words the bitmap may hold."""
    every = F.when(F.size("wh") >= k, F.sequence(F.lit(0), F.size("wh") - k)).otherwise(F.array().cast("array<int>"))
    found = F.filter(every, lambda i: _probed(bitmap, gram_hash("wh", i, k), longs))
    return F.transform(found, lambda i: F.struct(gram_hash("wh", i, k).alias("h"), i.alias("at")))


def _probe(h: Column, i: int, longs: int) -> Column:
    return F.shiftrightunsigned(h, 24 * i).bitwiseAND(F.lit(longs * 64 - 1).cast("long"))


def _probed(bitmap: Column, h: Column, longs: int) -> Column:
    test = None
    for i in (0, 1):
        p = _probe(h, i, longs)
        one = F.getbit(F.get(bitmap, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1
        test = one if test is None else test & one
    return test


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    leaks = matches(docs, benchmark, similarity).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


ORACLE = r"""
WITH iw AS (SELECT item_id, list_filter(string_split_regex(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
i AS (SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k FROM iw WHERE len(w) > 0),
d AS (SELECT doc_id, list_filter(string_split_regex(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE "text" IS NOT NULL),
ig AS (SELECT item_id, n, k, p, array_to_string(w[p + 1 : p + k], ' ') AS g FROM (SELECT *, unnest(range(n - k + 1)) AS p FROM i)),
dg AS (SELECT doc_id, len(w) AS dn, k, p, array_to_string(w[p + 1 : p + k], ' ') AS g FROM (SELECT d.*, ks.k, unnest(range(len(d.w) - ks.k + 1)) AS p FROM d, (SELECT DISTINCT k FROM i) ks WHERE len(d.w) >= ks.k)),
win AS (SELECT DISTINCT doc_id, n, k, unnest(range(greatest(p + k - n, 0), greatest(least(p, dn - n), 0) + 1)) AS start FROM (SELECT DISTINCT dg.doc_id, dg.dn, dg.p, k, ig.n FROM dg JOIN ig USING (k, g))),
ww AS (SELECT win.*, d.w[start + 1 : start + n] AS w FROM win JOIN d USING (doc_id)),
wg AS (SELECT doc_id, n, k, start, g, count(*) AS c FROM (SELECT doc_id, n, k, start, array_to_string(w[p + 1 : p + k], ' ') AS g FROM (SELECT *, unnest(range(len(w) - k + 1)) AS p FROM ww WHERE len(w) >= k)) GROUP BY ALL),
wn AS (SELECT doc_id, n, k, start, sum(c) AS t FROM wg GROUP BY ALL),
ic AS (SELECT item_id, n, k, g, count(*) AS c FROM ig GROUP BY ALL),
tn AS (SELECT item_id, n, k, sum(c) AS t FROM ic GROUP BY ALL),
both_ AS (SELECT doc_id, item_id, n, k, start, sum(least(wg.c, ic.c)) AS m FROM wg JOIN ic USING (n, k, g) GROUP BY ALL),
sim AS (SELECT doc_id, item_id, b.n, start, m, wn.t + tn.t - m AS u FROM both_ b JOIN wn USING (doc_id, n, k, start) JOIN tn USING (item_id, n, k))
SELECT doc_id, item_id, max(m / u)::DOUBLE AS similarity, arg_min(start, (-m / u, start))::INT AS start_word, max(n)::INT AS n_words FROM sim WHERE 100 * m >= 75 * u GROUP BY 1, 2
"""
