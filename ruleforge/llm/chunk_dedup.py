"""Substring dedup by content-defined chunks.

A gear rolling hash of the last 32 bytes cuts a text where its top bits are zero, MIN_CHUNK bytes after the last cut at
the earliest and MAX_CHUNK at the latest; so after an insertion the cuts fall into step again. Chunks are keyed by a 128-bit digest and
the first by (doc_id, position) is the original. Runs of neighbouring chunks that all repeat an original are removed where
they hold MIN_RUN bytes or more. That is the least chunk a cut can make, so that only a text's shorter rest stays: any longer
limit loses shared passages whose edges fall into chunks that differ.

Each piece of text tells its own repeats of a chunk before the shuffle, and these are dealt at random; so of a chunk that all documents hold,
a task gets one row a piece.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _ODD, materialize, mix64, prepare, release_shuffles, string_buffer, text_chunks
from .suffix_dedup import cut_out

MIN_CHUNK, MASK_BITS, MAX_CHUNK, MIN_RUN = 16, 5, 255, 16

_GEAR = np.random.default_rng(64).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(raw: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[raw[i - j]] << j for j < 32, modulo 2**32, by doubling the window."""
    h = _GEAR[raw]
    for w in (1, 2, 4, 8, 16):
        h[w:] += h[:-w] << np.uint32(w) if len(h) > w else 0
    return h


def cuts(raw: np.ndarray) -> list[int]:
    """Ends of the chunks of one text."""
    n, out, last = len(raw), [], 0
    for at in (np.flatnonzero(rolling(raw) >> np.uint32(32 - MASK_BITS) == 0) + 1).tolist():
        while at - last > MAX_CHUNK:
            last += MAX_CHUNK
            out.append(last)
        if at - last >= MIN_CHUNK:
            last = at
            out.append(last)
    while n - last > MAX_CHUNK:
        last += MAX_CHUNK
        out.append(last)
    if n > last:
        out.append(n)
    return out


def _chunked(batches):
    import pyarrow as pa
    import xxhash

    for batch in text_chunks(batches):
        raw, offs = string_buffer(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        doc, number, place, digest = [], [], [], []
        for i in range(batch.num_rows):
            text = raw[offs[i] : offs[i + 1]]
            ends, data, start = cuts(text), text.tobytes(), 0
            for j, end in enumerate(ends):
                digest.append(xxhash.xxh3_128_digest(data[start:end]))
                place.append(start << 9 | end - start)
                number.append(j)
                start = end
            doc.append(len(ends))
        halves = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
        d, e, doc, place = halves[:, 0], halves[:, 1], np.repeat(ids, doc), np.array(place, np.int64)
        order = np.lexsort((place, doc, e, d))
        again = np.zeros(len(d), bool)
        again[order[1:]] = (d[order][1:] == d[order][:-1]) & (e[order][1:] == e[order][:-1])
        d = np.where(again, mix64(doc.view(np.uint64) * _ODD[0] + place.view(np.uint64)).view(np.int64), d)
        yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(np.ascontiguousarray(e)), pa.array(doc), pa.array(place), pa.array(number, pa.int32()), pa.array(again)], ["d", "e", "doc_id", "place", "number", "again"])


def _repeats(batches):
    """From rows sorted by digest, document and place: all but the first of each digest."""
    import pyarrow as pa

    last = None
    for batch in batches:
        known = batch.column("again").to_numpy(zero_copy_only=False)
        out = [batch.column(i) for i in (2, 3, 4)]
        yield pa.RecordBatch.from_arrays(out, ["doc_id", "place", "number"]).filter(pa.array(known))
        at = np.flatnonzero(~known)
        if not len(at):
            continue
        d, e = (batch.column(i).to_numpy()[at] for i in (0, 1))
        again = np.zeros(batch.num_rows, bool)
        again[at] = np.r_[last == (d[0], e[0]), (d[1:] == d[:-1]) & (e[1:] == e[:-1])]
        last = (d[-1], e[-1])
        yield pa.RecordBatch.from_arrays(out, ["doc_id", "place", "number"]).filter(pa.array(again))


def remove_chunks(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, removed (array of byte ranges), kept (the bytes that stay).

    Texts count as UTF-8 bytes; null is empty. Rows with a null doc_id stay whole and are no originals. Rows that repeat a doc_id are
    one document: their equal chunks repeat each other. Repeats inside a document are removed too. Only doc_id and
    text are read; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = docs.filter("doc_id is not null and text != ''").mapInArrow(_chunked, "d long, e long, doc_id long, place long, number int, again boolean")
    again = materialize(chunks.repartition("d").sortWithinPartitions("d", "e", "doc_id", "place").mapInArrow(_repeats, "doc_id long, place long, number int"), "again")
    del chunks
    release_shuffles(spark)
    spans = again.groupBy("doc_id").agg(F.sort_array(F.collect_list("place")).alias("spans"))
    joined = docs.join(spans, "doc_id", "left").select("doc_id", "text", F.lit(False).alias("is_copy"), F.coalesce("spans", F.array().cast("array<long>")).alias("spans"))
    return joined.mapInArrow(cut_out(MIN_RUN, 0), "doc_id long, n_bytes long, removed array<struct<start:long,stop:long>>, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the kept bytes. Nulls, empty texts, repeats and empty tables as in remove_chunks()."""
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["stop"] - r["start"])
    return remove_chunks(docs).select("doc_id", "n_bytes", n.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

