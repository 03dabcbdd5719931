"""Quality by an interpolated modified Kneser-Ney model (Chen and Goodman, 1998) of byte n-grams, trained on trusted text.

Text is read as bytes with A-Z lower-cased and white-space runs as one space, with ORDER - 1 spaces before it. Trusted text is every
document labelled of good quality. Counts of the longest n-grams are summed by chunk, then by n-gram; those of shorter
ones are the numbers of different bytes to their left. Discounts come from the counts of counts. Each order joins its contexts' sums and the
next lower order's probabilities by n-gram, so count tables are sharded by key at every step. A document's perplexity is taken per byte;
a document is kept up to the SHARE quantile of its language. One in HELD_OUT trusted documents, by a hash of doc_id, is left out of training, and the quantile is
taken over these alone, as a model likes the texts it has seen.

The finished table is sent to the executors while it has at most BROADCAST_ROWS n-grams, which is counted first; beyond
that each document's distinct n-grams are joined to it order by order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, prepare, string_buffer, text_chunks
from .suffix_array import words8

ORDER, SHARE, HELD_OUT, BROADCAST_ROWS = 5, 0.995, 5, 3_000_000
#: A language with fewer held-out trusted documents than this takes the quantile of all languages.
MIN_TRUSTED = 20

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_LOW[9:14] = 32


def grams(column) -> tuple[np.ndarray, np.ndarray]:
    """(document number, ORDER bytes that end at it as one number, the last byte lowest) for every byte of the texts."""
    raw, offs = string_buffer(column)
    raw, offs, n, lead = raw[offs[0] : offs[-1]], offs - offs[0], len(column), ORDER - 1
    sizes = np.diff(offs)
    doc = np.repeat(np.arange(n, dtype=np.int32), sizes + lead)
    text = np.full(len(raw) + lead * n, 32, np.uint8)
    text[np.arange(len(raw)) + lead * (np.repeat(np.arange(n), sizes) + 1)] = _LOW[raw]
    first = offs[:-1] + lead * np.arange(n)
    pad = np.zeros(len(text) + 1, np.int32)
    np.add.at(pad, first, 1)
    np.add.at(pad, first + lead, -1)
    pad = np.cumsum(pad[:-1]) > 0
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32) | pad[1:]
    text, doc, pad = text[keep], doc[keep], pad[keep]
    if len(text) < ORDER:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    w = words8(np.r_[text, np.zeros(8, np.uint8)])[: len(text) - lead].byteswap() >> np.uint64(64 - 8 * ORDER)
    real = ~pad[lead:]
    return doc[lead:][real], w[real].view(np.int64)


def _counted(batches):
    import pyarrow as pa

    for batch in text_chunks(batches):
        g, n = np.unique(grams(batch.column("text"))[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(n)], ["gram", "n"])


def _distinct(batches):
    import pyarrow as pa

    for batch in text_chunks(batches):
        doc, g = grams(batch.column("text"))
        order = np.lexsort((g, doc))
        doc, g = doc[order], g[order]
        new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])]) if len(g) else np.zeros(0, np.int64)
        ids = batch.column("key").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(ids[doc[new]]), pa.array(g[new]), pa.array(np.diff(np.r_[new, len(g)]))], ["key", "gram", "n"])


def train(trusted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(n-grams: n, gram, logp; contexts: n, gram, logg): logp of the last byte after the others, logg the weight of the lower order after a context.

    Tables are empty if the text is.
    """
    counts = materialize(trusted.select("text").mapInArrow(_counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("c")), "counts")
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        cut = F.col("gram").bitwiseAND(F.lit((1 << 8 * n) - 1))
        tables[n] = tables[n + 1].groupBy(cut.alias("gram")).agg(F.count("*").alias("c"))
    lower, grams_out, contexts_out = None, [], []
    for n in range(1, ORDER + 1):
        t = tables[n]
        r = t.agg(*(F.coalesce(F.sum((F.col("c") == k).cast("long")), F.lit(0)).alias(f"n{k}") for k in (1, 2, 3, 4))).first()
        y = r.n1 / (r.n1 + 2 * r.n2) if r.n1 else 0.5
        d = [max(0.1, min(k - 0.05, k - (k + 1) * y * (r[f"n{k + 1}"] / r[f"n{k}"]))) if r[f"n{k}"] else 0.5 * k for k in (1, 2, 3)]
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        t = t.select("gram", "c", F.shiftright("gram", 8).alias("context"), discount.alias("d"))
        sums = t.groupBy("context").agg(F.sum("c").alias("total"), F.sum("d").alias("left"))
        sums = sums.select("context", "total", (F.col("left") / F.col("total")).alias("g"))
        t = t.join(sums, "context").withColumn("short", F.col("gram").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)))
        t = t.join(lower, "short", "left") if lower is not None else t.withColumn("q", F.lit(1 / 256))
        t = materialize(t.select("gram", ((F.col("c") - F.col("d")) / F.col("total") + F.col("g") * F.col("q")).alias("q")), f"order{n}")
        lower = t.select(F.col("gram").alias("short"), "q")
        grams_out.append(t.select(F.lit(n).alias("n"), "gram", F.log("q").alias("logp")))
        contexts_out.append(sums.select(F.lit(n - 1).alias("n"), F.col("context").alias("gram"), F.log("g").alias("logg")))
    every, contexts = grams_out[0], contexts_out[0]
    for g, c in zip(grams_out[1:], contexts_out[1:], strict=True):
        every, contexts = every.unionByName(g), contexts.unionByName(c)
    return every, materialize(contexts, "contexts")


class Model:
    """The table in memory: log probabilities of whole n-grams by a direct-mapped table, the rest by backing off."""

    def __init__(self, tables: dict, contexts: dict):
        self.tables, self.contexts = tables, contexts
        g, p = tables[ORDER]
        self.bits = max(16, min(22, int(len(g) * 4).bit_length()))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits)
        self.keys[self._slot(g)], self.values[self._slot(g)] = g, p

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return (mix64(g.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def logp(self, g: np.ndarray) -> np.ndarray:
        slot = self._slot(g)
        out = self.values[slot]
        rest = np.flatnonzero(self.keys[slot] != g)
        if len(rest):
            u, at = np.unique(g[rest], return_inverse=True)
            out[rest] = self._backed_off(u)[at]
        return out

    def _backed_off(self, g: np.ndarray) -> np.ndarray:
        out = np.full(len(g), np.log(1 / 256)) + self.contexts[0][1][0]
        for n in range(1, ORDER + 1):
            here = g & ((1 << 8 * n) - 1)
            if n > 1:
                weight, seen = _found(self.contexts[n - 1], here >> 8)
                out = np.where(seen, out + weight, out)
            p, seen = _found(self.tables[n], here)
            out = np.where(seen, p, out)
        return out


def _found(table: tuple[np.ndarray, np.ndarray], g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, values = table
    at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
    return values[at], keys[at] == g


def _scored(shared):
    def run(batches):
        import pyarrow as pa

        for batch in text_chunks(batches):
            doc, g = grams(batch.column("text"))
            p = shared.value.logp(g)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.bincount(doc, p, batch.num_rows)), pa.array(np.bincount(doc, minlength=batch.num_rows))], ["key", "logp", "n"])

    return run


def _small(table: DataFrame, size: int) -> DataFrame:
    """Tables of n-grams of one or two bytes have 65,536 rows at most, and their few keys would fill few tasks."""
    return F.broadcast(table) if size <= 2 else table


def _by_join(texts: DataFrame, every: DataFrame, contexts: DataFrame) -> DataFrame:
    """Sums of log probabilities by joins, order by order, of the n-grams that occur."""
    counts = materialize(texts.mapInArrow(_distinct, "key long, gram long, n long"), "distinct")
    known = counts.select("gram").distinct().withColumn("logp", F.lit(float(np.log(1 / 256))) + F.lit(contexts.filter("n = 0").first().logg))
    for n in range(1, ORDER + 1):
        here = F.col("gram").bitwiseAND(F.lit((1 << 8 * n) - 1))
        if n > 1:
            c = _small(contexts.filter(F.col("n") == n - 1).select(F.col("gram").alias("h"), "logg"), n - 1)
            known = known.withColumn("h", F.shiftright(here, 8)).join(c, "h", "left").select("gram", (F.col("logp") + F.coalesce("logg", F.lit(0.0))).alias("logp"))
        t = _small(every.filter(F.col("n") == n).select(F.col("gram").alias("h"), F.col("logp").alias("own")), n)
        known = known.withColumn("h", here).join(t, "h", "left").select("gram", F.coalesce("own", "logp").alias("logp"))
    sums = counts.join(known, "gram").groupBy("key").agg(F.sum(F.col("n") * F.col("logp")).alias("logp"), F.sum("n").alias("n"))
    return texts.select("key").join(sums, "key", "left").select("key", F.coalesce("logp", F.lit(0.0)).alias("logp"), F.coalesce("n", F.lit(0)).alias("n"))


def perplexities(texts: DataFrame, trusted: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, logp, n) for each row of ``texts`` (key long, text): the log probability and number of its bytes; null key, logp 0 without trusted text."""
    spark = prepare(texts.sparkSession)
    every, contexts = train(trusted)
    size = every.count() + contexts.count()
    if not size:
        return texts.select("key", F.lit(0.0).alias("logp"), F.lit(0).cast("long").alias("n"))
    if size > broadcast_rows:
        return _by_join(texts, every, contexts)
    tables, weights = {}, {}
    for n in range(1, ORDER + 1):
        for out, rows, k, value in ((tables, every, n, "logp"), (weights, contexts, n - 1, "logg")):
            x = rows.filter(F.col("n") == k).select("gram", value).toArrow()
            g, v = x.column(0).to_numpy(), x.column(1).to_numpy()
            order = np.argsort(g)
            out[k] = g[order], v[order]
    model = spark.sparkContext.broadcast(Model(tables, weights))
    return texts.mapInArrow(_scored(model), "key long, logp double, n long")


def classify(docs: DataFrame, labels: DataFrame, share: float = SHARE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, perplexity (per byte), threshold, kept.

    docs needs doc_id, text and lang; labels doc_id and quality. Trusted are documents labelled 1 (of repeated labels the greatest counts).
    A text without bytes other than white space has null perplexity and is not kept; null counts as empty. A null lang is a language of its own. Languages with fewer than
    MIN_TRUSTED held-out trusted documents take the quantile of all held-out ones. Without trusted text perplexity is null; without held-out trusted text the threshold is, and all rows with text are kept.
    Rows that repeat a doc_id each have their own result. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    good = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1").select("doc_id")
    good = good.withColumn("held_out", F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0)
    trusted = docs.join(good.filter(~F.col("held_out")).hint("merge"), "doc_id", "left_semi")  # the same plan at every size
    # Scores are joined to languages by a hash of the whole row, which the texts need not travel for.
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text", "lang"))
    scored = perplexities(keyed.select("key", "text"), trusted, broadcast_rows).dropDuplicates(["key"])
    blank = F.coalesce(F.trim(F.regexp_replace("text", r"\s+", " ")), F.lit("")) == ""
    rows = materialize(keyed.select("doc_id", "lang", "key", blank.alias("blank")).join(scored, "key").select("doc_id", "lang", F.when(~F.col("blank") & (F.col("n") > 0), F.exp(-F.col("logp") / F.col("n"))).alias("perplexity"), "blank"), "scored")
    known = rows.join(good.filter("held_out"), "doc_id", "left_semi").filter("perplexity is not null")
    at = F.percentile_approx("perplexity", F.lit(share), F.lit(100_000))
    limits = known.groupBy(F.col("lang").alias("of")).agg(at.alias("own"), F.count("*").alias("trusted")).filter(F.col("trusted") >= MIN_TRUSTED)
    overall = known.agg(at.alias("overall")).first().overall
    out = rows.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left").select("doc_id", "lang", "perplexity", "blank", (F.coalesce("own", F.lit(overall)).cast("double")).alias("threshold"))
    return out.select("doc_id", "lang", "perplexity", "threshold", (~F.col("blank") & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).alias("kept"))


