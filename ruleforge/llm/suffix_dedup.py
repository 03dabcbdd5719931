"""Exact removal of repeated 50-byte strings, by suffix arrays of sharded contexts.

Of each 50-byte window the 16-byte gram of least hash is its anchor, so equal windows have equal anchors at equal
offsets and about one position in 18 is an anchor somewhere. Anchors are sorted by gram, then by the hash of
their whole context (34 bytes before the gram to 50 after its start, which holds all windows around it). An
anchor whose whole context also stands in a smaller document is settled there and then. Only where a gram
stands in different contexts are the contexts themselves gathered, one for each context and smallest document,
sharded by gram; a suffix array of each shard and its common prefixes of 50 bytes then find equal windows.

Whole copies meet first by digest, so that large groups of copies send no anchors. No common gram or context fills a task: each piece of
text settles its own repeats of a context before the shuffle; grams that are common by a sample of the documents are dealt by the bytes
on either side of them as well; and where more than hot_run() contexts of a gram are left, their windows meet by hash, with partial minima,
instead of in one suffix array. A task holds the open contexts of one gram, HELD at most. The sample only routes rows, so no result depends on it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _ODD, attach, discard, materialize, mix64, prepare, release_shuffles, string_buffer, text_chunks
from .suffix_array import permuted_prefixes, suffix_array, words8

SPAN, GRAM = 50, 16
WIDTH = SPAN - GRAM + 1
BEFORE = WIDTH - 1
CONTEXT = BEFORE + SPAN
#: Bytes of contexts in one suffix array, and of text in one pass.
SHARD_BYTES, PIECE_BYTES = 1 << 19, 1 << 20
#: Contexts of one gram that meet in one shard, by documents: one for each EACH of them, HOT_RUN at least and MOST_RUN at most, some 1.4 MB. Where there are more, their windows meet by hash,
#: which takes 35 rows a context. Any bound gives the same result.
HOT_RUN, EACH, MOST_RUN = 2048, 25, 16_384


def hot_run(documents: int) -> int:
    return max(HOT_RUN, min(documents // EACH, MOST_RUN))


#: Documents whose anchors tell which grams are common: those of which all documents, by the sample's share, have more than hot_run() open anchors, and the sample SEEN or more.
SAMPLED, SEEN = 4000, 16
#: Open contexts of one gram that a task holds, beside the rows of a pass; where a gram has more, they meet by their windows.
HELD, FLUSH = 100_000, 200_000
#: Different codes of the bytes beside a gram; with 0 they fill 10 bits.
CODES = 1023


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over each run of ``width`` values."""
    done, size = x, 1
    while 2 * size <= width:
        done = pick(done[: len(done) - size], done[size:])
        size *= 2
    rest = width - size
    return pick(done[: len(done) - rest], done[rest:]) if rest else done


def anchors(raw: np.ndarray, first: np.ndarray, last: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document number, gram hash, context hash, packed place) of the anchors in ``raw``.

    Document d has its windows start in [first[d], last[d]) and its bytes in [begin[d], end[d]).
    """
    n = len(raw)
    some = last > first
    if n < SPAN or not some.any():
        return (np.zeros(0, np.int64),) * 4
    w = words8(raw)
    h = mix64(w[:-8] * _ODD[0] + (w[8:] ^ (w[8:] >> np.uint64(31))) * _ODD[1]) | np.uint64(1)
    low = _slide(h, WIDTH, np.minimum)
    edge = np.zeros(len(low) + 1, np.int32)
    np.add.at(edge, first[some], 1)
    np.add.at(edge, last[some], -1)
    low[np.cumsum(edge[:-1]) == 0] = 0
    pad = np.zeros(BEFORE, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate((pad, low, pad)), WIDTH, np.maximum) == h)
    doc = np.searchsorted(begin, at, side="right") - 1
    before, after = np.minimum(BEFORE, at - begin[doc]), np.minimum(SPAN, end[doc] - at)
    context = np.zeros(len(at), np.uint64)
    whole = (before == BEFORE) & (after == SPAN)
    base = at[whole] - BEFORE
    acc = np.zeros(len(base), np.uint64)
    for i, o in enumerate((*range(0, CONTEXT - 8, 8), CONTEXT - 8)):
        acc += mix64(w[base + o] * _ODD[i + 2])
    context[whole] = mix64(acc)
    cut = np.flatnonzero(~whole)
    if len(cut):
        o = np.arange(-(-CONTEXT // 8) * 8)
        inside = (o >= BEFORE - before[cut, None]) & (o < BEFORE + after[cut, None])
        part = np.where(inside, raw[np.clip(at[cut, None] - BEFORE + o, 0, n - 1)], 0).astype(np.uint8).view("<u8")
        acc = mix64((before[cut] * 64 + after[cut]).astype(np.uint64) * _ODD[1])
        for i in range(part.shape[1]):
            acc += mix64(part[:, i] * _ODD[i + 20])
        context[cut] = mix64(acc)
    # Codes of the 17 bytes on either side of the gram; 0 where there are fewer.
    half = (SPAN - GRAM) // 2
    codes = []
    for ok, o in ((before >= half, -half), (after >= GRAM + half, GRAM)):
        p, code = at[ok] + o, np.zeros(len(at), np.int64)
        code[ok] = 1 + (mix64(mix64(w[p]) + mix64(w[p + 8] * _ODD[1]) + w[p + half - 8] * _ODD[2]) % np.uint64(CODES)).astype(np.int64)
        codes.append(code)
    # The codes follow from the context, so they can be the lowest bits of its hash.
    context = context & ~np.uint64((1 << 20) - 1) | (codes[0] << 10 | codes[1]).astype(np.uint64)
    # A context that a document repeats, as in a line said again and again, goes out once and is found again when the text is cut.
    order = np.argsort(mix64(mix64(h[at]) + context + doc.astype(np.uint64) * _ODD[3]), kind="stable")
    new = np.ones(len(at), bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (doc, h[at], context)], axis=0)
    first = np.flatnonzero(new)
    again = np.diff(np.r_[first, len(at)]) > 1
    keep = order[first]
    return doc[keep], h[at][keep], context[keep], _pack(at[keep] - begin[doc[keep]], again, before[keep], after[keep])


def _pack(at, again, before, after):
    """Place in the document, whether the context stands in it more than once, bytes before the gram and from its start on."""
    return (at << 13) | (again.astype(np.int64) << 12) | (before << 6) | after


def _unpack(place):
    return place >> 13, (place >> 12) & 1, (place >> 6) & 63, place & 63


def _anchored(common: np.ndarray | None = None):
    """Rows (key, context hash, doc_id, place, covered): ``covered`` if a smaller document of the same piece of text has the context."""

    def run(batches):
        import pyarrow as pa

        for batch in text_chunks(batches, PIECE_BYTES):
            raw, offs = string_buffer(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            lo, hi = int(offs[0]), int(offs[-1])
            if hi - lo <= 2 * PIECE_BYTES:
                begin, end = offs[:-1] - lo, offs[1:] - lo
                parts = [anchors(raw[lo:hi], begin, np.maximum(end - SPAN + 1, begin), begin, end)]
            else:  # one very long text, by overlapping pieces
                parts, n = [], hi - lo
                for s in range(0, n - SPAN + 1, PIECE_BYTES):
                    a, b = max(0, s - 2 * CONTEXT), min(n, s + PIECE_BYTES + 2 * CONTEXT)
                    one = lambda x, a=a: np.array([x - a])
                    parts.append(anchors(raw[lo + a : lo + b], one(s), one(min(s + PIECE_BYTES, n - SPAN + 1)), one(0), one(n)))
            for doc, h, c, place in parts:
                doc = ids[doc]
                order = np.lexsort((doc, mix64(h) + c))
                h, c, doc, place = (x[order] for x in (h, c, doc, place))
                new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])] if len(h) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                covered = doc > np.repeat(doc[first], np.diff(np.r_[first, len(h)]))
                # What is settled needs no place beside its like.
                key = np.where(covered, mix64(h ^ mix64(doc.astype(np.uint64) * _ODD[5] + place.astype(np.uint64))), h)
                rows = [(key, c, doc, place, covered)]
                if common is not None and len(common):
                    at = ~covered & np.isin(h, common)
                    rows = [tuple(x[~at] for x in rows[0])]
                    for side, code in ((1, c >> np.uint64(10) & np.uint64(1023)), (2, c & np.uint64(1023))):
                        x = np.flatnonzero(at & (code > 0))
                        rows.append((_dealt(h[x], side, code[x]), c[x], doc[x], place[x], covered[x]))
                for key, c, doc, place, covered in rows:
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc), pa.array(place), pa.array(covered)], ["h", "c", "doc_id", "place", "covered"])

    return run


def _dealt(h: np.ndarray, side: int, code: np.ndarray) -> np.ndarray:
    """The key of a gram's contexts that have the same bytes on one side of it: equal windows share the gram and those of one side."""
    return mix64(h * _ODD[side] + code)


def _met(run: np.ndarray, c: np.ndarray, code: np.ndarray) -> np.ndarray:
    """True where another context of the same run has the same code; a code of 0 meets nothing."""
    out = np.zeros(len(run), bool)
    at = np.flatnonzero(code)
    if len(at):
        at = at[np.lexsort((code[at], run[at]))]
        new = np.flatnonzero(np.r_[True, (run[at][1:] != run[at][:-1]) | (code[at][1:] != code[at][:-1])])
        out[at] = np.repeat(np.minimum.reduceat(c[at], new) != np.maximum.reduceat(c[at], new), np.diff(np.r_[new, len(at)]))
    return out


def settled_by(most: int):
    return lambda batches: _settled(batches, most)


def _settled(batches, most: int | None = None):
    """From rows sorted by gram, context and document: covered anchors, and those whose contexts must be compared (hot, where a gram has more than ``most``: by their windows)."""
    import pyarrow as pa

    def out(h, doc, place, covered, hot=False):
        flags = [np.full(len(h), x) for x in (covered, hot)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (h, doc, place, *flags)], ["h", "doc_id", "place", "covered", "hot"])

    held = [np.zeros(0, np.int64)] * 4
    rows, ready, full = [], 0, None  # full: a gram of more than HELD open contexts

    def flush(final: bool):
        nonlocal held, full
        h, c, d, p = (np.concatenate((held[i], *(r[i] for r in rows))) for i in range(4))
        rows.clear()
        if not len(h):
            return
        known = len(held[0]) if full is not None else 0  # of a full gram the last context alone is held, which is out already
        run = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        kind = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
        of_kind = np.repeat(d[kind], np.diff(np.r_[kind, len(h)]))
        covered = d > of_kind
        yield out(h[covered], d[covered], p[covered], True)
        sizes = np.diff(np.r_[run, len(h)])
        open_ = np.repeat(np.minimum.reduceat(of_kind, run) < np.maximum.reduceat(of_kind, run), sizes)
        keep = ~covered
        keep[:known] = False
        last = np.arange(len(h)) >= run[-1]
        if full is not None:
            more = keep & (h == full)
            yield out(h[more], d[more], p[more], False, True)
            keep &= ~more
        if final:
            held = [np.zeros(0, np.int64)] * 4
        elif full is not None and h[-1] == full:
            held = [x[~covered & (np.arange(len(h)) >= kind[-1])] for x in (h, c, d, p)]
        else:
            held, full = [x[keep & last] for x in (h, c, d, p)], None
            keep &= ~last
            if len(held[0]) > HELD:
                full = h[-1]
                yield out(held[0], held[2], held[3], False, True)
                held = [x[~covered & (np.arange(len(h)) >= kind[-1])] for x in (h, c, d, p)]
        keep &= open_
        # Equal windows share the gram and all 17 bytes on its left or on its right.
        at = np.flatnonzero(keep)
        of_run = np.repeat(np.arange(len(run)), sizes)[at]
        at = at[_met(of_run, c[at], (c[at] >> 10) & 1023) | _met(of_run, c[at], c[at] & 1023)]
        of_run = np.repeat(np.arange(len(run)), sizes)[at]
        hot = np.bincount(of_run, minlength=1)[of_run] > (HOT_RUN if most is None else most) if len(at) else np.zeros(0, bool)
        for x, is_hot in ((at[~hot], False), (at[hot], True)):
            yield out(h[x], d[x], p[x], False, is_hot)

    for batch in batches:
        done = batch.column("covered").to_numpy(zero_copy_only=False)
        h, c, d, p = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        yield out(h[done], d[done], p[done], True)
        rows.append([x[~done] for x in (h, c, d, p)])
        ready += batch.num_rows
        if ready >= FLUSH:
            yield from flush(False)
            ready = 0
    yield from flush(True)


def _windowed(batches):
    """(key of gram and window, doc_id, span) of every window around the anchors in ``wanted``."""
    import pyarrow as pa

    o = np.arange(WIDTH)
    for batch in text_chunks(batches, PIECE_BYTES):
        raw, offs = string_buffer(batch.column("text"))
        lists, ids = batch.column("wanted"), batch.column("doc_id").to_numpy(zero_copy_only=False)
        wanted, count = lists.flatten(), np.diff(lists.offsets.to_numpy())
        w, offs = words8(raw[offs[0] : offs[-1]]), offs - offs[0]
        every_h, every_place = (wanted.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        row = np.repeat(np.arange(batch.num_rows), count)
        for s in range(0, len(row), 1 << 14):
            h, place, r = every_h[s : s + (1 << 14)], every_place[s : s + (1 << 14)], row[s : s + (1 << 14)]
            at, again, before, after = _unpack(place)
            # window o starts o bytes before the gram, where the document has them all
            which, left = np.nonzero((o <= before[:, None]) & (SPAN - o <= after[:, None]))
            start = at[which] - left
            p = offs[:-1][r[which]] + start
            acc = np.zeros(len(p), np.uint64)
            for i, x in enumerate((*range(0, SPAN - 8, 8), SPAN - 8)):
                acc += mix64(w[p + x] * _ODD[i + 2])
            window = mix64(acc + left.astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([pa.array(h[which]), pa.array(window)], ["h", "w"]), pa.array(ids[r[which]]), pa.array(start << 9 | again[which] << 8 | SPAN)], ["key", "doc_id", "span"])


def _contexts(batches):
    import pyarrow as pa

    for batch in text_chunks(batches, PIECE_BYTES):
        raw, offs = string_buffer(batch.column("text"))
        lists = batch.column("wanted")
        wanted = lists.flatten()
        count = np.diff(lists.offsets.to_numpy())
        h, place = (wanted.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        base = np.repeat(offs[:-1], count)
        at, again, before, after = _unpack(place)
        start, stop = base + at - before, base + at + after
        sizes = stop - start
        ends = np.cumsum(sizes)
        index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - sizes), sizes)
        text = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.r_[0, ends].astype(np.int32).tobytes()), pa.py_buffer(raw[index].tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), count)), pa.array((at - before) << 1 | again), text], ["h", "doc_id", "start", "context"])


def repeated_windows(raw: np.ndarray, offs: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context number, start in the context) of the windows that also stand in a context of a smaller document."""
    sizes = np.diff(offs)
    # One separator, smaller than any byte, ends each context.
    text = np.zeros(len(raw) + len(sizes), np.int16)
    text[np.arange(len(raw)) + np.repeat(np.arange(len(sizes)), sizes)] = raw.astype(np.int16) + 1
    begin = offs[:-1] + np.arange(len(sizes))
    sa = suffix_array(text, SPAN)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    full = sa[sa + SPAN <= (begin + sizes)[owner[sa]]]
    if not len(full):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Bytes stand for symbols here: windows hold no separator, so its value cannot make two windows equal.
    shared = permuted_prefixes((text - 1).astype(np.uint8), full, SPAN)
    group = np.flatnonzero(np.r_[True, shared[full[1:]] < SPAN])
    docs = doc[owner[full]]
    least = np.repeat(np.minimum.reduceat(docs, group), np.diff(np.r_[group, len(full)]))
    hit = full[docs > least]
    return owner[hit], hit - begin[owner[hit]]


def _sorted_out(batches):
    import pyarrow as pa

    def solve(parts):
        rows = pa.Table.from_batches(parts).combine_chunks()
        raw, offs = string_buffer(rows.column("context"))
        raw, offs = raw[offs[0] : offs[-1]], offs - offs[0]
        doc, start = (rows.column(c).to_numpy() for c in ("doc_id", "start"))
        which, o = repeated_windows(raw, offs, doc)
        if len(which):
            order = np.lexsort((o, which))
            which, o = which[order], o[order]
            new = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (o[1:] > o[:-1] + SPAN)])
            stop = np.r_[new[1:], len(which)] - 1
            size = o[stop] + SPAN - o[new]
            yield pa.RecordBatch.from_arrays([pa.array(doc[which[new]]), pa.array(((start[which[new]] >> 1) + o[new]) << 9 | (start[which[new]] & 1) << 8 | size)], ["doc_id", "span"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("context").nbytes
        if size < SHARD_BYTES:
            continue
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        h = rows.column("h").to_numpy()
        cut = int(np.searchsorted(h, h[-1]))  # the last gram may go on in the next batch
        if cut:
            yield from solve([rows.slice(0, cut)])
            held = [rows.slice(cut)]
            size = held[0].column("context").nbytes * (len(rows) - cut) // max(1, len(rows))
    if held and sum(b.num_rows for b in held):
        yield from solve(held)


def _joined(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of packed spans."""
    spans = np.sort(spans)
    start, stop = spans >> 9, np.maximum.accumulate((spans >> 9) + (spans & 255))
    new = np.flatnonzero(np.r_[True, start[1:] > stop[:-1]])
    return start[new], np.r_[stop[new[1:] - 1], stop[-1]]


def cut_out(least: int, copy_bytes: int):
    """Cuts the union of packed spans (start << 9 | again << 8 | size) out of each text where a run has ``least`` bytes; all of a copy of ``copy_bytes`` or more.

    A span marked ``again`` stands for every place of its bytes in the text.
    """

    def spread(text, spans):
        data, more, seen = text.tobytes(), [], set()
        for x in spans[(spans >> 8) & 1 == 1].tolist():
            piece = data[x >> 9 : (x >> 9) + (x & 255)]
            if piece in seen:
                continue
            seen.add(piece)
            at = data.find(piece)
            while at >= 0:
                more.append(at << 9 | len(piece))
                at = data.find(piece, at + 1)
        return np.r_[spans, np.array(more, np.int64)]

    def ranges(text, copy, spans):
        if copy:
            return [(0, len(text))] if len(text) >= max(copy_bytes, 1) else []
        if not len(spans):
            return []
        start, stop = _joined(spread(text, spans))
        return [(a, b) for a, b in zip(start.tolist(), np.minimum(stop, len(text)).tolist(), strict=True) if b - a >= least]

    def run(batches):
        import pyarrow as pa

        fields = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in text_chunks(batches, PIECE_BYTES):
            raw, offs = string_buffer(batch.column("text"))
            copy, spans = batch.column("is_copy").to_pylist(), batch.column("spans")
            values, begin = spans.flatten().to_numpy(zero_copy_only=False), spans.offsets.to_numpy() - spans.offsets[0].as_py()
            kept, removed = [], []
            for i in range(batch.num_rows):
                text, at, pieces = raw[offs[i] : offs[i + 1]], 0, []
                cuts = ranges(text, copy[i], values[begin[i] : begin[i + 1]])
                for a, b in cuts:
                    pieces.append(text[at:a].tobytes())
                    at = b
                pieces.append(text[at:].tobytes())
                kept.append(b"".join(pieces))
                removed.append([{"start": a, "stop": b} for a, b in cuts])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offs)), pa.array(removed, fields), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])

    return run


_ANCHORS = "h long, c long, doc_id long, place long, covered boolean"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, removed (array of byte ranges), kept (the bytes that stay).

    Texts count as UTF-8 bytes; null is empty. Every byte is removed that a 50-byte string covers which also
    starts in a document of smaller doc_id, judged on the input. Texts under 50 bytes stay whole. Repeats within
    one document stay. A row whose doc_id is null is left whole and removes nothing elsewhere. Rows that repeat a doc_id
    are one document: neither removes bytes of the other, and what is found at a place in one is removed at that
    place in the other. Only doc_id and text are read; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = docs.filter(f"doc_id is not null and octet_length(text) >= {SPAN}")
    digests = materialize(long.select("doc_id", F.unhex(F.md5("text")).alias("digest")), "digests")
    groups = digests.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("digest", "least")
    copies = materialize(digests.join(groups, "digest").filter("doc_id > least").select("doc_id").distinct(), "copies")
    singles = long.join(copies, "doc_id", "left_anti")

    total = digests.count()
    some = singles.filter(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, total // SAMPLED))) == 0) if total else singles
    often = materialize(some.mapInArrow(_anchored(), _ANCHORS).groupBy("h").agg(F.count_if(~F.col("covered")).alias("n")), "often")
    # A share of the sample's anchors, so there are as many common grams at most as the sample has anchors, by SEEN.
    run = hot_run(total)
    least = max(SEEN, run // max(1, total // SAMPLED))
    common = np.array([r.h for r in often.filter(F.col("n") >= least).select("h").collect()], np.int64).view(np.uint64)
    found = singles.mapInArrow(_anchored(common), _ANCHORS)
    settled = found.repartition("h").sortWithinPartitions("h", "c", "doc_id", "place").mapInArrow(settled_by(run), "h long, doc_id long, place long, covered boolean, hot boolean")
    settled = materialize(settled, "settled")
    discard(digests), discard(often)
    del found
    release_shuffles(spark)

    def wanted(hot: bool) -> DataFrame:
        places = settled.filter(~F.col("covered") & (F.col("hot") == hot)).groupBy("doc_id").agg(F.collect_list(F.struct("h", "place")).alias("wanted"))
        return docs.join(places, "doc_id").select("doc_id", "text", "wanted")

    contexts = wanted(False).mapInArrow(_contexts, "h long, doc_id long, start long, context binary")
    compared = materialize(contexts.repartition("h").sortWithinPartitions("h").mapInArrow(_sorted_out, "doc_id long, span long"), "compared")
    del contexts
    release_shuffles(spark)
    if not settled.filter("hot").isEmpty():
        windows = materialize(wanted(True).mapInArrow(_windowed, "key struct<h:long,w:long>, doc_id long, span long"), "windows")
        low = windows.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")).filter("least < most").select("key", "least", "n")
        low = materialize(low, "low")
        again = materialize(attach(windows, low, "key", windows.count()).filter("doc_id > least").select("doc_id", "span"), "again")
        discard(windows), discard(low)
        compared = compared.unionByName(again)

    whole = settled.filter("covered").select("doc_id", F.expr("(((place >> 13) - ((place >> 6) & 63)) << 9) | (((place >> 12) & 1) << 8) | (((place >> 6) & 63) + (place & 63))").alias("span"))
    spans = whole.unionByName(compared).groupBy("doc_id").agg(F.collect_list("span").alias("spans"))
    marks = spans.join(copies.withColumn("is_copy", F.lit(True)), "doc_id", "full").withColumn("is_copy", F.coalesce("is_copy", F.lit(False)))
    joined = docs.join(marks, "doc_id", "left").select("doc_id", "text", F.coalesce("is_copy", F.lit(False)).alias("is_copy"), F.coalesce("spans", F.array().cast("array<long>")).alias("spans"))
    return joined.mapInArrow(cut_out(1, SPAN), "doc_id long, n_bytes long, removed array<struct<start:long,stop:long>>, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the kept bytes. Nulls, empty texts, repeats and empty tables as in remove_repeats()."""
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["stop"] - r["start"])
    return remove_repeats(docs).select("doc_id", "n_bytes", n.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def rewrite(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with the kept text in place of the text and its length in n_chars, if there is such a column.

    A character that lost some of its bytes is dropped. A null text that nothing was removed from stays null.
    """
    cut = remove_repeats(docs.select("doc_id", "text")).filter("size(removed) > 0").select("doc_id", "kept").mapInArrow(_decoded, "_cut_id long, _kept string")
    cut = cut.groupBy("_cut_id").agg(F.max("_kept").alias("_kept"))
    whole = docs.join(cut, docs["doc_id"] == cut["_cut_id"], "left")
    text = F.when(F.col("_cut_id").isNull(), docs["text"]).otherwise(F.col("_kept"))
    return whole.select(*(_column(docs, name, text) for name in docs.columns))


def _decoded(batches):
    import pyarrow as pa

    for batch in batches:
        texts = [x.decode("utf-8", "ignore") for x in batch.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["_cut_id", "_kept"])


def _column(docs: DataFrame, name: str, text):
    if name == "text":
        return text.alias("text")
    return F.char_length(text).cast(docs.schema[name].dataType).alias(name) if name == "n_chars" else docs[name]


ORACLE = """
WITH b AS (SELECT doc_id, hex(encode(coalesce("text", ''))) AS h, octet_length(encode(coalesce("text", '')))::BIGINT AS n FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM b WHERE n >= 50)),
low AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM win JOIN low USING (s) WHERE doc_id > m),
run AS (SELECT doc_id, i, sum((before IS NULL OR i > before + 50)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM run GROUP BY doc_id, r),
piece AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM span
  UNION ALL SELECT doc_id, coalesce(max(z), 0), any_value(n) FROM b LEFT JOIN span USING (doc_id) GROUP BY doc_id
), kept AS (SELECT doc_id, string_agg(substr(h, 2 * piece.a + 1, 2 * (piece.z - piece.a)), '' ORDER BY piece.a) AS k FROM piece JOIN b USING (doc_id) GROUP BY doc_id),
cut AS (SELECT doc_id, sum(z - a) AS gone, count(*) AS spans FROM span GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256 FROM b JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)
"""
