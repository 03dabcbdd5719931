"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Terms are 5-byte grams of lower-cased text in which every run of ASCII signs and spaces is one space, and the 8 bytes from each space on; so a
term can hold the start or end of a word, and inflected forms share terms. The model's vocabulary is the TERMS terms that the training labels tie to label 1 most
(likelihood ratio above MIN_RATIO): with more of them, or all, the nearest texts are those of a like topic, not of a like tone, and fewer toxic texts are found. Document frequencies count all documents. Examples and queries are unit vectors of
(1 + log tf) * idf. The index keeps a list of postings for each term, cut into blocks of examples, with the largest weight of each block;
a query takes blocks by falling upper bound until none can change its K best, so the K best are exact.
Votes weigh by squared cosine, with the base rate as a prior vote, and a logistic curve fitted to leave-one-out votes of the examples calibrates them.

Training reads at most MAX_LABELLED labelled rows, and the index holds at most MAX_EXAMPLES of them, the first by a hash of doc_id.
So terms, index and curve have bounded size; scores and document frequencies cover all rows and whole texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import discard, materialize, mix64, prepare, string_buffer, text_chunks
from .suffix_array import words8

GRAM, START, TERMS, MIN_RATIO, K, BLOCK = 5, 8, 1024, 15.0, 25, 64
MAX_LABELLED, MAX_EXAMPLES, CALIBRATED = 20_000, 4096, 2048
#: Weight of the base rate among the votes.
PRIOR = 0.5

_SPACE_OR_LOW = np.arange(256, dtype=np.uint8)
for _b in range(128):
    _SPACE_OR_LOW[_b] = ord(chr(_b).lower()) if chr(_b).isalnum() else 32


def grams(column) -> tuple[np.ndarray, np.ndarray]:
    """(document number, gram) of the texts of an Arrow column, with the highest bit set in those that start at a space."""
    raw, offs = string_buffer(column)
    raw, offs, n = raw[offs[0] : offs[-1]], offs - offs[0], len(column)
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(offs) + 2)
    text = np.full(len(raw) + 2 * n + 8, 32, np.uint8)  # a space before and after each text
    text[np.arange(len(raw)) + 2 * np.repeat(np.arange(n), np.diff(offs)) + 1] = _SPACE_OR_LOW[raw]
    text = text[:-8]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32) | (doc[1:] != doc[:-1])
    text, doc = text[keep], doc[keep]
    if len(text) < GRAM:
        return np.zeros(0, np.int32), np.zeros(0, np.uint64)
    w = words8(np.r_[text, np.zeros(8, np.uint8)])
    g = w[: len(text) - GRAM + 1] & np.uint64((1 << 8 * GRAM) - 1)
    own = doc[: len(g)] == doc[GRAM - 1 :]
    at = np.flatnonzero(text[: max(len(text) - START + 1, 0)] == 32)
    at = at[doc[at] == doc[at + START - 1]]
    return np.r_[doc[: len(g)][own], doc[at]], np.r_[g[own], w[at] | np.uint64(1 << 63)]


def _slot(g: np.ndarray) -> np.ndarray:
    return (mix64(g) >> np.uint64(44)).astype(np.int64)


class Terms:
    """The vocabulary: finds its terms in texts."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms.astype(np.uint64))
        self.slots = np.zeros(1 << 20, bool)
        self.slots[_slot(self.terms)] = True

    def counts(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document number, term number, count), by document and term."""
        doc, g = grams(column)
        hit = np.flatnonzero(self.slots[_slot(g)]) if len(self.terms) else np.zeros(0, np.int64)
        doc, g = doc[hit].astype(np.int64), g[hit]
        at = np.minimum(np.searchsorted(self.terms, g), max(len(self.terms) - 1, 0))
        ok = self.terms[at] == g if len(g) else np.zeros(0, bool)
        key, n = np.unique(doc[ok] * max(len(self.terms), 1) + at[ok], return_counts=True)
        return key // max(len(self.terms), 1), key % max(len(self.terms), 1), n


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] numbers, then those from start[1], and so on."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Index:
    """Postings of the examples by term, in runs of one block of examples each, with the largest weight of each run."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, terms: int):
        # Alike examples stand together, so that the blocks' maxima are tight.
        strongest = np.array([t[np.argmax(w)] if len(t) else -1 for t, w in vectors], np.int64)
        order = np.lexsort((ids, strongest, labels))
        self.labels, self.ids = labels[order].astype(float), ids[order]
        vectors = [vectors[i] for i in order]
        at = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        term, weight = (np.concatenate([v[i] for v in vectors]) if vectors else np.zeros(0) for i in (0, 1))
        order = np.lexsort((at, term))
        term, self.at, self.weight = term[order].astype(np.int64), at[order].astype(np.int64), weight[order].astype(float)
        block = self.at // BLOCK
        self.first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(term) else np.zeros(0, np.int64)
        self.count = np.diff(np.r_[self.first, len(term)])
        self.block = block[self.first]
        self.most = np.maximum.reduceat(self.weight, self.first) if len(term) else np.zeros(0)
        self.runs = np.searchsorted(term[self.first], np.arange(terms + 1))

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int = K, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(positions, cosines) of the k examples of greatest positive cosine, ties by position; ``without`` is left out."""
        size = self.runs[terms + 1] - self.runs[terms]
        run, value = _ranges(self.runs[terms], size), np.repeat(values, size)
        bound = np.bincount(self.block[run], value * self.most[run], -(-len(self.ids) // BLOCK))
        by_block = np.argsort(self.block[run], kind="stable")
        run, value = run[by_block], value[by_block]
        cuts = np.searchsorted(self.block[run], np.arange(len(bound) + 1))
        order = np.argsort(-bound, kind="stable")
        at, best, step = np.zeros(0, np.int64), np.zeros(0), 4
        for s in range(0, len(order), step):
            blocks = order[s : s + step]
            if bound[blocks[0]] <= 0 or len(best) >= k and best[k - 1] > bound[blocks[0]] * (1 + 1e-9):
                break
            runs = cuts[blocks + 1] - cuts[blocks]
            mine = _ranges(cuts[blocks], runs)
            r = run[mine]
            post, count = _ranges(self.first[r], self.count[r]), self.count[r]
            place = np.repeat(np.repeat(np.arange(len(blocks)), runs) * BLOCK, count) + self.at[post] % BLOCK
            cos = np.bincount(place, np.repeat(value[mine], count) * self.weight[post], len(blocks) * BLOCK)
            more = np.flatnonzero(cos > 0)
            found = blocks[more // BLOCK] * BLOCK + more % BLOCK
            cos, found = cos[more][found != without], found[found != without]
            at, best = np.r_[at, found], np.r_[best, cos]
            top = np.lexsort((at, -best))[:k]
            at, best = at[top], best[top]
        return at, best

    def vote(self, at: np.ndarray, cos: np.ndarray, base: float) -> float:
        w = cos.astype(float) ** 2
        return float((w @ self.labels[at] + PRIOR * base) / (w.sum() + PRIOR))


def _vectors(rows, idf: np.ndarray):
    """Splits (document, term, count) into (document, terms, unit weights)."""
    doc, term, n = rows
    value = (1 + np.log(n)) * idf[term] if len(term) else np.zeros(0)
    new = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    for a, b in zip(new, np.r_[new[1:], len(doc)] if len(new) else new, strict=True):
        norm = np.linalg.norm(value[a:b])
        if norm > 0:
            yield int(doc[a]), term[a:b], value[a:b] / norm


def _curve(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the log odds of weighted votes, by Newton steps on smoothed targets."""
    x = _log_odds(votes)
    ones, zeros = weights[labels > 0].sum(), weights[labels == 0].sum()
    t = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(w[0] * x + w[1])))
        g = np.array([(weights * (p - t) * x).sum(), (weights * (p - t)).sum()]) + 1e-2 * (w - [1.0, 0.0])
        r = weights * p * (1 - p)
        h = np.array([[(r * x * x).sum(), (r * x).sum()], [(r * x).sum(), r.sum()]]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -1, 1)
    return (float(w[0]), float(w[1])) if np.isfinite(w).all() and w[0] > 0 else (1.0, 0.0)


def _log_odds(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _counted(batches):
    """(gram, documents, documents of label 1) of each chunk."""
    import pyarrow as pa

    for batch in text_chunks(batches):
        doc, g = grams(batch.column("text"))
        y = batch.column("toxic").to_numpy(zero_copy_only=False)
        order = np.lexsort((g, doc))
        doc, g = doc[order], g[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
        u, at = np.unique(g[new], return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.bincount(at, minlength=len(u))), pa.array(np.bincount(at, y[doc[new]], len(u)).astype(np.int64))], ["gram", "n", "ones"])


def _frequencies(shared):
    def run(batches):
        import pyarrow as pa

        n, docs = np.zeros(len(shared.value.terms) + 1, np.int64), 0
        for batch in text_chunks(batches):
            n[:-1] += np.bincount(shared.value.counts(batch.column("text"))[1], minlength=len(n) - 1)
            docs += batch.num_rows
        n[-1] = docs
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], ["term", "n"])

    return run


def _sparse(shared):
    def run(batches):
        import pyarrow as pa

        for batch in text_chunks(batches):
            doc, term, n = shared.value.counts(batch.column("text"))
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            lists = [pa.array([x[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.list_(pa.int64())) for x in (term, n)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *lists], ["doc_id", "toxic", "terms", "counts"])

    return run


def _score(model, column, evidence: int = 0):
    """(scores, evidence) of the texts of an Arrow column."""
    terms, idf, index, base, (slope, offset), none = model
    scores, found = np.full(len(column), none), [[] for _ in range(len(column))]
    for d, t, v in _vectors(terms.counts(column), idf):
        at, cos = index.nearest(t, v)
        scores[d] = 1 / (1 + np.exp(-(slope * _log_odds(index.vote(at, cos, base)) + offset)))
        found[d] = [{"doc_id": int(index.ids[i]), "toxic": int(index.labels[i]), "cosine": float(c)} for i, c in zip(at[:evidence], cos[:evidence], strict=True)]
    return scores, found


def _scored(shared, evidence: int):
    def run(batches):
        import pyarrow as pa

        fields = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))
        for batch in text_chunks(batches):
            scores, found = _score(shared.value, batch.column("text"), evidence)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array(found, fields)], ["doc_id", "score", "evidence"])

    return run


def _clean(shared):
    """The rows whose text is not predicted toxic."""

    def run(batches):
        import pyarrow as pa

        for batch in text_chunks(batches):
            yield batch.filter(pa.array(_score(shared.value, batch.column("text"))[0] < 0.5)).drop_columns(["text"])

    return run


def held_out(doc_id):
    """Rows that training never reads."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame):
    """(model, share): a broadcast model of the labelled rows of ``docs``, or None where labels of both kinds or terms that tell them apart are missing; the share of label 1."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    # One text of each labelled doc_id, so MAX_LABELLED rows at most.
    training = materialize(docs.join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "training")
    total = training.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("ones")).first()
    n, ones = total.n, total.ones
    base = ones / n if n else 0.0
    if not 0 < ones < n:
        return None, base

    xlogy = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    m, a = F.col("n").cast("double"), F.col("ones").cast("double")
    ratio = 2 * (xlogy(a, m * base) + xlogy(m - a, m * (1 - base)) + xlogy(ones - a, ones - m * base) + xlogy((n - ones) - (m - a), (n - ones) - m * (1 - base)))
    found = training.mapInArrow(_counted, "gram long, n long, ones long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    chosen = found.filter(a / m > base).withColumn("ratio", ratio).filter(F.col("ratio") > MIN_RATIO).orderBy(F.desc("ratio"), "gram").select("gram").limit(TERMS).collect()
    if not chosen:
        return None, base
    terms = Terms(np.array([r.gram for r in chosen], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(terms)
    counts = dict(docs.mapInArrow(_frequencies(shared), "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    df = np.array([counts.get(i, 0) for i in range(len(terms.terms))], float)
    idf = np.log((1 + counts.get(len(df), 0)) / (1 + df))

    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    vectors = materialize(training.select("doc_id", "toxic", "text").mapInArrow(_sparse(shared), "doc_id long, toxic int, terms array<long>, counts array<long>"), "vectors")
    rows = vectors.filter("size(terms) > 0").orderBy(*order).limit(MAX_EXAMPLES).collect()
    known = {(r.has, r.toxic): r.n for r in vectors.groupBy((F.size("terms") > 0).alias("has"), "toxic").agg(F.count("*").alias("n")).collect()}
    discard(training), discard(vectors)
    unit = lambda r: next(((t, v) for _, t, v in _vectors((np.zeros(len(r.terms), np.int64), np.array(r.terms, np.int64), np.array(r.counts)), idf)), (np.zeros(0, np.int64), np.zeros(0)))
    vectors = [unit(r) for r in rows]
    index = Index(vectors, np.array([r.toxic for r in rows], np.int64), np.array([r.doc_id for r in rows], np.int64), len(df))
    # The curve is fitted to leave-one-out votes, beside the rows without a term, whose vote is the base rate.
    votes, own = np.full(min(len(rows), CALIBRATED) + 2, base), {d: i for i, d in enumerate(index.ids.tolist())}
    for i, r in enumerate(rows[:CALIBRATED]):
        if len(vectors[i][0]):
            votes[i] = index.vote(*index.nearest(*vectors[i], without=own[r.doc_id]), base)
    bare = np.array([known.get((False, y), 0) for y in (0, 1)], float)
    share = (len(votes) - 2) / max(1, sum(v for (has, _), v in known.items() if has))
    curve = _curve(votes, np.array([*(r.toxic for r in rows[:CALIBRATED]), 0, 1]), np.r_[np.ones(len(votes) - 2), bare * share])
    none = float((bare[1] + base) / (bare.sum() + 1))
    return spark.sparkContext.broadcast((terms, idf, index, base, curve, none)), base


def score(docs: DataFrame, labels: DataFrame, evidence: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, evidence (nearest examples: doc_id, toxic, cosine).

    docs needs doc_id and text; labels doc_id and toxic (0, 1 or null; of repeated rows the greatest counts). A score is read from the text alone.
    Texts without a term of the vocabulary, so null and empty ones, get the share of label 1 among such labelled rows. Without labels of both kinds, or
    any term that tells them apart, all scores are the share of label 1 (0 without any label). Training takes one text of a repeated doc_id, the least. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model, base = fit(docs, labels)
    kind = "array<struct<doc_id:long,toxic:int,cosine:double>>"
    if model is None:
        return docs.select("doc_id", F.lit(base).alias("score"), F.array().cast(kind).alias("evidence"))
    return docs.mapInArrow(_scored(model, evidence), f"doc_id long, score double, evidence {kind}")


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence (the nearest examples: doc_id, toxic, cosine).

    Null, empty and repeated rows, labels of one kind and empty tables as in score(). A null doc_id is not held out.
    """
    return score(docs, labels).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic.

    Each row is judged by its own text, so null and repeated ids make no difference. Null and empty texts, labels of one kind and empty tables as in score(): such
    rows stay unless half of the like labelled ones are toxic.
    """
    model, base = fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), labels)
    if model is None:
        return docs.filter(F.lit(base < 0.5))
    rows = docs.select(F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    return rows.mapInArrow(_clean(model), StructType([rows.schema["row"]])).select("row.*")
