"""Which terms set a source apart within its language, and how far sources are from each other, in whole numbers.

Terms are runs of letters and of anything beyond ASCII, A-Z lower-cased. A language keeps the terms of MIN_DOCS of its documents. The share of a term in a source,
in parts of SCALE, is 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), with N the counts of all V kept terms together; a language's share likewise.

Pairs of sources: most terms are missing in most sources, where the share is the source's baseline, that of count 0. So the distance of two sources is V times the
difference of their baselines, corrected for the terms that one of them has (from a histogram of the source's shares) and for those that both have (sources that share a
term meet in blocks of BLOCK x BLOCK sources; each task sums its terms before anything is sent).

Best terms of a source: a radix select. A histogram over the highest bits of the values finds, for each source, the digit in which the one of rank K lies; the next histogram
counts only rows of that digit, until all bits are known. Of the rows that tie there, histograms over the next bytes of the term find those that still belong;
at most TIED of them are ordered at the end. No task orders the terms of a source.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, prepare, string_buffer, text_chunks

MIN_DOCS, SMOOTH, SCALE, K = 30, 5, 1_000_000_000, 50
#: Entries that a task holds before it sends them, sources of a block, pairs taken at once, bits of a digit, ties that are ordered as they are.
HELD, BLOCK, PAIRS, BITS, TIED, SALTS = 200_000, 128, 1 << 20, 10, 1000, 32

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = _LETTERS[65:91] = np.arange(97, 123)
_LETTERS = _LETTERS.tobytes()


def _counted(limit: int):
    def run(batches):
        """(lang, source, term, n, docs): occurrences and documents of each term, summed over what the task holds."""
        import pyarrow as pa

        held = defaultdict(lambda: (Counter(), Counter()))

        def sent():
            rows = [(g, *x) for g, (n, _) in held.items() for x in n.items()]
            docs = [held[g][1][t] for g, t, _ in rows]
            names = ["lang", "source", "term", "n", "docs"]
            columns = [[g[0] for g, _, _ in rows], [g[1] for g, _, _ in rows], pa.array([t for _, t, _ in rows], pa.binary()).cast(pa.string()), [n for *_, n in rows], docs]
            held.clear()
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.string() if i < 2 else pa.int64()) for i, c in enumerate(columns)], names)

        for batch in text_chunks(batches):
            raw, offs = string_buffer(batch.column("text"))
            for lang, source, a, b in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                words = raw[a:b].tobytes().translate(_LETTERS).split()
                n, docs = held[lang, source]
                n.update(words)
                docs.update(set(words))
            if sum(len(n) for n, _ in held.values()) > limit:
                yield sent()
        yield sent()

    return run


def _share(n: Column, total: Column, terms: Column) -> Column:
    """The share of a term that stands ``n`` times among ``total``; null where the language keeps no term."""
    return F.lit(1) + _div(F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(20,0)"), (total + SMOOTH * terms).cast("decimal(20,0)"))


def _div(a: Column, b: Column) -> Column:
    """Whole part of a quotient of decimals, exact; null where b is 0 or null."""
    rest = a % F.nullif(b, F.lit(0))
    return ((a - rest) / b).cast("long")


def _near(block: int, most: int):
    def run(batches):
        """From rows sorted by lang and cell, each a term's entries in two blocks of sources: sums over the terms that both sources of a pair have."""
        import pyarrow as pa

        cell, sums = None, None

        def sent():
            at = np.flatnonzero(sums)
            lang, i, j = cell
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(i * block + at // block), pa.array(j * block + at % block), pa.array(sums[at])], ["lang", "i", "j", "value"])

        for batch in batches:
            names = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "bi", "bj")), strict=True))
            sides = []
            for c in ("left", "right"):
                entries = batch.column(c)
                flat = entries.flatten()
                sides.append((np.r_[0, np.cumsum(entries.value_lengths().to_numpy())], *(flat.field(k).to_numpy().astype(np.int64) for k in ("i", "p", "p0"))))
            (la, li, lp, l0), (ra, ri, rp, r0) = sides
            row = np.repeat(np.arange(len(names)), np.diff(la))
            width = np.diff(ra)[row]  # each entry on the left meets all on the right of its row
            ends = np.cumsum(width)
            start = 0
            while start < len(row):  # as many entries as make ``most`` pairs and belong to one cell, one at least
                own = names[row[start]]
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, side="right")))
                while names[row[stop - 1]] != own:
                    stop = start + max(1, (stop - start) // 2)
                if own != cell:
                    if cell is not None:
                        yield sent()
                    cell, sums = own, np.zeros(block * block, np.int64)
                w = width[start:stop]
                a = np.repeat(np.arange(start, stop), w)
                b = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w) + np.repeat(ra[:-1][row[start:stop]], w)
                keep = li[a] < ri[b]
                a, b = a[keep], b[keep]
                value = np.abs(lp[a] - rp[b]) - np.abs(lp[a] - r0[b]) - np.abs(l0[a] - rp[b]) + np.abs(l0[a] - r0[b])
                np.add.at(sums, li[a] % block * block + ri[b] % block, value)
                start = stop
        if cell is not None:
            yield sent()

    return run


def shares(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(sources, kept). sources: lang, source, i (number within lang), terms (V), p0 (share of a missing term, null if V is 0). kept: lang, source, term, i, p, p0, q for each kept term that the source has."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    found = rows.mapInArrow(_counted(HELD), "lang string, source string, term string, n long, docs long")
    every = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = every.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources"))
    terms = materialize(terms.filter(F.col("docs") >= min_docs), "terms")

    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("all"))
    held = terms.select("lang", "term", "total", F.explode("sources").alias("s")).select("lang", "term", "total", "s.*")
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sources = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left").withColumn("i", number.cast("long"))
    sources = sources.fillna(0, ["own", "terms", "all"]).withColumn("p0", _share(F.lit(0), F.col("own"), F.col("terms")))
    sources = materialize(sources, "sources")

    kept = held.join(sources, ["lang", "source"])
    kept = kept.select("lang", "source", "term", "i", _share(F.col("n"), F.col("own"), F.col("terms")).alias("p"), "p0", _share(F.col("total"), F.col("all"), F.col("terms")).alias("q"))
    return sources, materialize(kept, "kept")


def distances(sources: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, i, j, value), i < j: the sum of the differences of the shares over all kept terms, for each pair of sources of a language."""
    # A language may hold nearly all sources: its rows are dealt over SALTS keys.
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    other = sources.select("lang", F.col("i").alias("j"), F.col("p0").alias("o0"), salted)
    each = sources.withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(SALTS)))
    base = each.join(other, ["lang", "salt"]).filter("i < j").select("lang", "i", "j", F.coalesce(F.col("terms") * F.abs(F.col("p0") - F.col("o0")), F.lit(0)).alias("value"))

    levels = kept.groupBy("lang", "i", "p", "p0").agg(F.count("*").alias("n")).withColumn("salt", F.pmod(F.xxhash64("i", "p"), F.lit(SALTS)))
    off = F.col("n") * (F.abs(F.col("p") - F.col("o0")) - F.abs(F.col("p0") - F.col("o0")))
    one = levels.join(other, ["lang", "salt"]).filter("i != j").groupBy("lang", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).agg(F.sum(off).alias("value"))

    entries = kept.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("i", "p", "p0"))).alias("e"))
    block = lambda x: F.floor(x["i"] / BLOCK)
    cells = entries.withColumn("b", F.array_distinct(F.transform("e", block))).withColumn("bi", F.explode("b")).withColumn("bj", F.explode(F.filter("b", lambda x: x >= F.col("bi"))))
    of = lambda c: F.filter("e", lambda x: block(x) == F.col(c))
    cells = cells.select("lang", "bi", "bj", of("bi").alias("left"), of("bj").alias("right"))
    both = cells.sortWithinPartitions("lang", "bi", "bj").mapInArrow(_near(BLOCK, PAIRS), "lang string, i long, j long, value long")
    return base.unionByName(one).unionByName(both).groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def top(rows: DataFrame, by: list[str], k: int = K, value: str = "value", item: str = "item") -> DataFrame:
    """The k rows of greatest value of each group, ties by the UTF-8 bytes of the item; by radix select over values from 0 on. Items of a group must differ."""
    rows = materialize(rows.select(*by, value, item), "select")
    most = rows.agg(F.max(value)).first()[0] or 0
    state = rows.select(*by).distinct().select(*by, F.lit(0).cast("long").alias("prefix"), F.lit(k).cast("long").alias("need"))
    digits = -(-max(1, int(most).bit_length()) // BITS)
    left = rows
    for d in reversed(range(digits)):
        digit = F.shiftright(F.col(value), d * BITS)
        play = left.join(state.withColumnRenamed("prefix", "_high"), by).filter(F.shiftright(F.col(value), (d + 1) * BITS) == F.col("_high"))
        state = materialize(_crossing(play.withColumn("prefix", digit), by, "prefix", F.desc("prefix")), "state")
    # Groups of fewer than k rows have no threshold: all of them belong.
    state = state.withColumnRenamed("prefix", "_least")
    marked = rows.join(state, by, "left")
    sure = marked.filter(F.col("_least").isNull() | (F.col(value) > F.col("_least"))).select(*by, value, item)
    tied = materialize(marked.filter(F.col(value) == F.col("_least")).select(*by, value, item, "need"), "tied")
    while True:
        n = tied.groupBy(*by).agg(F.count("*").alias("_n"), F.min(F.col(item).cast("binary")).alias("_lo"), F.max(F.col(item).cast("binary")).alias("_hi"))
        many = n.filter(F.col("_n") > TIED)
        few = tied.join(n.filter(F.col("_n") <= TIED).select(*by), by, "left_semi")
        nth = F.row_number().over(Window.partitionBy(*by).orderBy(item))
        sure = sure.unionByName(few.withColumn("_nth", nth).filter("_nth <= need").select(*by, value, item))
        if many.isEmpty():
            return sure
        # All items of a group begin as its least and greatest do; the two bytes after that part them.
        same = F.transform(F.sequence(F.lit(1), F.least(F.length("_lo"), F.length("_hi")) + 1), lambda i: F.substring("_lo", i, F.lit(1)) == F.substring("_hi", i, F.lit(1)))
        many = many.select(*by, F.array_position(same, False).alias("_at"))
        play = materialize(tied.join(many, by).withColumn("_next", F.substring(F.col(item).cast("binary"), F.col("_at").cast("int"), F.lit(2))).drop("_at"), "play")
        edge = _crossing(play, by, "_next", F.asc("_next")).withColumnRenamed("_next", "_edge").withColumnRenamed("need", "_rest")
        play = materialize(play.join(edge, by), "tied")
        sure = sure.unionByName(play.filter("_next < _edge").select(*by, value, item))
        tied = play.filter("_next = _edge").select(*by, value, item, F.col("_rest").alias("need"))


def _crossing(rows: DataFrame, by: list[str], digit: str, order: Column) -> DataFrame:
    """(by, digit, need): for each group the digit in which its ``need``-th row lies, and which row of that digit it is. Groups of fewer rows are left out."""
    counts = rows.groupBy(*by, digit).agg(F.count("*").alias("_n"), F.first("need").alias("need"))
    until = F.sum("_n").over(Window.partitionBy(*by).orderBy(order))
    return counts.withColumn("_until", until).filter("_until >= need and _until - _n < need").select(*by, digit, (F.col("need") - F.col("_until") + F.col("_n")).alias("need"))


def audit(docs: DataFrame, k: int = K, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows for each ordered pair of sources of a language, ``term`` rows for the k terms by which a source exceeds its language most.

    docs needs text, lang and source; null counts as the empty text in each, and nothing else is read, so rows of a repeated doc_id count as often as they stand there. A language without kept terms has
    pairs of value 0. Ranks go by value, then by the UTF-8 bytes of the item. An empty table gives no rows.
    """
    sources, kept = shares(docs, min_docs)
    near = distances(sources, kept)
    both = near.unionByName(near.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    named = both.join(sources.select("lang", "i", "source"), ["lang", "i"]).join(sources.select("lang", F.col("i").alias("j"), F.col("source").alias("item")), ["lang", "j"])
    pairs = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = top(kept.filter("p > q").select("lang", "source", (F.col("p") - F.col("q")).alias("value"), F.col("term").alias("item")), ["lang", "source"], k)
    every = pairs.unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return every.withColumn("rank", rank)


ORACLE = r"""WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT row, lang, source, unnest(ws) AS term FROM d), kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT row) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang), g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(s.n, 0) + 5 * v.v))::BIGINT AS p, (1 + 1000000000::HUGEINT * (k.total + 5) // (v.n + 5 * v.v))::BIGINT AS q
FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(f.f, 0)::BIGINT AS value FROM g JOIN g o ON o.lang = g.lang AND o.source <> g.source
LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) f ON f.lang = g.lang AND f.source = g.source AND f.item = o.source),
best AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (FROM pair UNION ALL FROM best))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""
