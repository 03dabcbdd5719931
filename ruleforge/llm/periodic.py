"""Runs of periodic words, by counting the matches of each lag.

A stretch of words of period q and length l matches itself at lag q in l - q places. So a lag is of interest only if the whole text has as many matches as the
shortest run of that period, and the number of matches of every lag is the autocorrelation of the words. It is counted in two ways: of a word that
stands in a text so often that its pairs would cost more than a transform, by a fast Fourier transform of the places where it stands, rounded to whole numbers and so exact;
of all other words by the differences of their places, for all texts of a batch at once. Each lag that has enough matches is scanned for islands of matches: a
run covers at least three places that are multiples of q, so the scan looks at every q-th word and reads in full only around three hits in a row.
An island is a run if its first q words are no repetition of fewer. Then its matches at the multiples of q are taken off the counts, where they stand for
the same run; so a text of one word alone has one lag to scan, not a quarter of its length.

The work of a document is about n log n for each word that is frequent and the pairs of the others; no document needs any other, so there is no shuffle.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, string_buffer, text_chunks

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: A word is heavy if the square of its count is above the transform's size times its logarithm over HEAVY, and above LIGHT_PAIRS.
HEAVY, LIGHT_PAIRS = 4, 4096


def least_matches(q: np.ndarray | int):
    """Matches at lag q of the shortest run of period q."""
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * q) - q


def lag_counts(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, base): counts[base[d] + q] is the number of places of text d with equal words q apart, for 1 <= q <= n // LEAST_PERIODS.

    codes are the words of all texts as numbers, text d from first[d] to first[d + 1].
    """
    n = np.diff(first)
    most = n // LEAST_PERIODS
    base = np.r_[0, np.cumsum(most + 1)]
    counts = np.zeros(int(base[-1]), np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((codes, doc))  # stable, so places rise within a word of a text
    new = np.flatnonzero(np.r_[True, (codes[order][1:] != codes[order][:-1]) | (doc[order][1:] != doc[order][:-1])]) if len(order) else np.zeros(0, np.int64)
    size = np.diff(np.r_[new, len(order)])
    of = doc[order[new]]
    width = 1 << np.ceil(np.log2(np.maximum(2 * n, 2))).astype(np.int64)
    heavy = size.astype(float) ** 2 > np.maximum(width * np.log2(width) / HEAVY, LIGHT_PAIRS)[of] if len(new) else np.zeros(0, bool)
    for d in np.unique(of[heavy]):
        power = np.zeros(int(width[d]) // 2 + 1)
        for g in np.flatnonzero(heavy & (of == d)):
            x = np.zeros(int(width[d]))
            x[order[new[g] : new[g] + size[g]] - first[d]] = 1
            f = np.fft.rfft(x)
            power += f.real**2 + f.imag**2
        counts[base[d] : base[d + 1]] += np.rint(np.fft.irfft(power)[: most[d] + 1]).astype(np.int64)
    light = np.repeat(~heavy, size)
    at, end = np.flatnonzero(light), np.repeat(new + size, size)[light]
    place, doc, step = order, doc[order], 0
    while len(at):
        step += 1
        more = at + step < end
        at, end = at[more], end[more]
        lag = place[at + step] - place[at]
        near = lag <= most[doc[at]]  # a later place of the word is further still
        at, end, lag = at[near], end[near], lag[near]
        np.add.at(counts, base[doc[at]] + lag, 1)
    return counts, base


def _primes(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] * (q > 1)


def islands(x: np.ndarray, q: int) -> list[tuple[int, int]]:
    """(start, matches) of the maximal stretches of matches at lag q that are long enough for a run."""
    least, out = int(least_matches(q)), []
    grid = x[::q]
    hit = np.r_[False, grid[1:] == grid[:-1], False]
    edge = np.flatnonzero(hit[1:] != hit[:-1])
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):  # places a * q to (b - 1) * q match
        if b - a < least // q:
            continue
        low, high = max(0, (a - 1) * q + 1), min(len(x) - q, b * q)
        same = np.r_[False, x[low:high] == x[low + q : high + q], False]
        cut = np.flatnonzero(same[1:] != same[:-1])
        out += [(low + s, e - s) for s, e in zip(cut[::2].tolist(), cut[1::2].tolist(), strict=True) if e - s >= least]
    return out


def runs_of(x: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, by start and period; counts by lag are changed."""
    out = []
    lags = np.arange(len(counts))
    for q in np.flatnonzero((counts >= least_matches(lags)) & (lags > 0)).tolist():
        if counts[q] < least_matches(q):
            continue
        for start, n in islands(x, q):
            if any((x[start : start + q] == x[start + q // p : start + q // p + q]).all() for p in _primes(q)):
                continue
            out.append((start, n + q, q))
            multiples = np.arange(2 * q, min(len(counts), n + q), q)
            counts[multiples] -= n + q - multiples
    return sorted(out, key=lambda r: (r[0], r[2]))


def changed(n: int, doc_id: int | None) -> np.ndarray:
    """Which original word stands at each place: of a tenth of the documents, by a hash of the doc_id, the words repeat from some place on."""
    at = np.arange(n)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return at


def _found(repeat: bool):
    def run(batches):
        import pyarrow as pa

        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in text_chunks(batches):
            raw, offs = string_buffer(batch.column("text"))
            ids, words, first = batch.column("doc_id").to_pylist(), [], [0]
            for d, a, b in zip(ids, offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                own = raw[a:b].tobytes().split()  # bytes split at just the space and \t to \r
                words += own if not repeat else [own[i] for i in changed(len(own), d).tolist()]
                first.append(len(words))
            first = np.array(first)
            codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64) if words else np.zeros(0, np.int64)
            counts, base = lag_counts(codes, first)
            found, collapsed = [], []
            for d in range(batch.num_rows):
                runs = runs_of(codes[first[d] : first[d + 1]], counts[base[d] : base[d + 1]])
                keep = np.ones(first[d + 1] - first[d], bool)
                for start, length, period in runs:
                    keep[start + period : start + length] = False
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                own = words[first[d] : first[d + 1]]
                collapsed.append(b" ".join(own if not runs else [own[i] for i in np.flatnonzero(keep)]))
            columns = [batch.column("doc_id"), pa.array(np.diff(first)), pa.array(found, run_type), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, repeat: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start, length, period, by start and period) and collapsed, the words without the repetitions, joined by one space.

    Words are runs of anything but the space and \\t to \\r, compared by their bytes. docs needs doc_id and text, of which nothing else is read. Null, empty and
    blank texts have no words, no runs and an empty ``collapsed``. Rows of a repeated or null doc_id are documents of their own. An empty table gives no rows. ``repeat`` first makes the
    words of a tenth of the documents repeat, see changed(); a null doc_id is not among them.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_found(repeat), "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def summaries(docs: DataFrame, repeat: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, start, length, period and exponent_milli of the longest run, SHA-256 of all runs and of the collapsed text. Nulls, empty texts and repeats as in periodic_runs()."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = periodic_runs(docs, repeat).select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    length = -F.col("best.length")
    return rows.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * -best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: crc32 of a decimal number, bit by bit.
_CRC = """xor(list_reduce([4294967295]::BIGINT[] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

ORACLE = rf"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {_CRC} AS h FROM documents),
c AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) ELSE len(ws) END AS a FROM d),
t AS (SELECT row, n, i, ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END] AS w FROM (SELECT *, unnest(range(n)) AS i FROM c)),
pairs AS (SELECT x.row, y.i - x.i AS q, x.i FROM t x JOIN t y ON x.row = y.row AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // 4),
enough AS (SELECT row, q FROM pairs GROUP BY ALL HAVING count(*) >= greatest(3 * q, 6 - q)),
marked AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS g FROM pairs SEMI JOIN enough USING (row, q)),
island AS (SELECT row, q, min(i) AS s, count(*) + q AS n FROM marked GROUP BY row, q, g HAVING count(*) >= greatest(3 * q, 6 - q)),
run AS (SELECT * FROM island r WHERE NOT EXISTS (SELECT 1 FROM island o WHERE o.row = r.row AND o.q < r.q AND r.q % o.q = 0 AND o.s <= r.s AND o.s + o.n >= r.s + r.n)),
best AS (SELECT row, count(*) AS n_runs, first(struct_pack(s := s, n := n, q := q) ORDER BY n DESC, s, q) AS b, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM run GROUP BY row),
gone AS (SELECT DISTINCT row, unnest(range(s + q, s + n)) AS i FROM run),
kept AS (SELECT row, string_agg(w, ' ' ORDER BY i) AS words FROM t ANTI JOIN gone USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.n AS length, b.q AS period, 1000 * b.n // b.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM c LEFT JOIN best USING (row) LEFT JOIN kept USING (row)"""
