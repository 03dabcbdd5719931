import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ruleforge.llm import suffix_dedup as m
from ruleforge.llm.suffix_array import permuted_prefixes, suffix_array
from tests.llm.conftest import prose


def brute(rows):
    seen, out = {}, {}
    for i, b in sorted(rows):
        for p in range(len(b) - 49):
            seen.setdefault(b[p : p + 50], i)
    for i, b in rows:
        cov = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if seen[b[p : p + 50]] < i:
                cov[p : p + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~cov])
        out[i] = (len(b), int(cov.sum()), int((np.diff(np.r_[0, cov.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def check(df):
    rows = {(r.doc_id, (r.text or "").encode()) for r in df.collect() if r.doc_id is not None}
    expected = brute(sorted(rows))
    got = m.digests(df).collect()
    assert len(got) == df.count()
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0 and r.n_spans == 0
        else:
            assert tuple(r)[1:] == expected[r.doc_id]


def test_against_brute_force(docs):
    check(docs)


def in_this_process(rows, common=False):
    """The steps of remove_repeats one after another, without Spark, so that the module's constants can be changed."""
    docs = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], ["doc_id", "text"])
    found = pa.Table.from_batches(m._anchored()([docs]))
    if common:  # every gram is dealt by its sides
        grams = np.unique(found["h"].to_numpy()).view(np.uint64)
        found = pa.Table.from_batches(m._anchored(grams)([docs]))
    found = found.sort_by([(c, "ascending") for c in ("h", "c", "doc_id", "place")])
    settled = pa.Table.from_batches(m._settled(found.to_batches(max_chunksize=37))).to_pylist()
    spans = {}
    for r in settled:
        at, again, before, after = m._unpack(r["place"])
        if r["covered"]:
            spans.setdefault(r["doc_id"], []).append((at - before) << 9 | again << 8 | before + after)
    kind = pa.list_(pa.struct([("h", pa.int64()), ("place", pa.int64())]))
    asked = lambda hot: docs.append_column("wanted", pa.array([[{"h": r["h"], "place": r["place"]} for r in settled if not r["covered"] and r["hot"] == hot and r["doc_id"] == i] for i, _ in rows], kind))
    windows = [r for b in m._windowed([asked(True)]) for r in b.to_pylist()]
    least = {}
    for r in windows:
        key = (r["key"]["h"], r["key"]["w"])
        least[key] = min(least.get(key, r["doc_id"]), r["doc_id"])
    for r in windows:
        if r["doc_id"] > least[r["key"]["h"], r["key"]["w"]]:
            spans.setdefault(r["doc_id"], []).append(r["span"])
    contexts = pa.Table.from_batches(m._contexts([asked(False)]), pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("context", pa.binary())]))
    for batch in m._sorted_out(contexts.sort_by([("h", "ascending")]).to_batches(max_chunksize=11)):
        for r in batch.to_pylist():
            spans.setdefault(r["doc_id"], []).append(r["span"])
    full = docs.append_column("is_copy", pa.array([False] * len(rows))).append_column("spans", pa.array([spans.get(i, []) for i, _ in rows], pa.list_(pa.int64())))
    out = pa.Table.from_batches(m.cut_out(1, m.SPAN)([full])).to_pylist()
    return {r["doc_id"]: (r["n_bytes"], sum(x["stop"] - x["start"] for x in r["removed"]), len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out}


@pytest.mark.parametrize("held,flush", [(100_000, 200_000), (5, 1), (1, 7), (0, 30)])
@pytest.mark.parametrize("hot,piece,shard,common", [(4096, 1 << 21, 1 << 20, False), (1, 200, 1000, False), (3, 5000, 300, True), (0, 1 << 20, 1 << 20, True), (4096, 100, 1 << 20, True)])
def test_overlapping_repeats_with_small_pieces_shards_and_runs(monkeypatch, hot, piece, shard, common, held, flush):
    rng = random.Random(2)
    base = prose(rng, 300)
    rows = [(i, base[(a := rng.randrange(600)) : a + rng.randint(30, 400)] + rng.choice(["", "x", prose(rng, 8)]) + base[(b := rng.randrange(900)) : b + rng.randint(40, 80)]) for i in range(60)]
    rows += [(100, "a" * 300), (101, "a" * 49), (102, "a" * 50), (103, "b" + "a" * 120), (104, "line of text again, " * 40), (105, "x line of text again, line of text again, line of text again"), (106, base)]
    monkeypatch.setattr(m, "HELD", held)
    monkeypatch.setattr(m, "FLUSH", flush)
    monkeypatch.setattr(m, "HOT_RUN", hot)
    monkeypatch.setattr(m, "PIECE_BYTES", piece)
    monkeypatch.setattr(m, "SHARD_BYTES", shard)
    assert in_this_process(rows, common) == brute([(i, t.encode()) for i, t in rows])


def test_common_passages_and_grams(spark, monkeypatch):
    """A line in most texts, between words that differ, with every gram hot and common in the sample."""
    from ruleforge.llm import common

    monkeypatch.setattr(common, "HOT", 20)
    monkeypatch.setattr(m, "SEEN", 1)
    monkeypatch.setattr(m, "HOT_RUN", 2)
    rng = random.Random(8)
    line, passage = "the very same line stands in all of these texts", prose(rng, 30)
    rows = [(i, f"{prose(rng, 4)} {line} {prose(rng, 3)}" + (f" {passage} {rng.randrange(3)}" if i % 3 else "")) for i in range(90)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_empty_table_and_rewrite(docs, empty):
    assert m.remove_repeats(empty).count() == 0
    out = m.rewrite(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    removed = {r.doc_id: r.n_removed for r in m.digests(docs).collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        if not removed[r.doc_id]:
            assert r.doc_id is None or r.text == before[r.doc_id]
        else:
            assert len((r.text or "").encode()) <= len(before[r.doc_id].encode()) - removed[r.doc_id]
            assert r.n_chars == len(r.text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=200), st.integers(1, 4))
def test_suffix_array(values, k):
    t = np.array(values, np.int16) % k if values else np.zeros(0, np.int16)
    b = bytes(t.astype(np.uint8))
    assert suffix_array(t).tolist() == sorted(range(len(b)), key=lambda i: b[i:])


def test_large_alphabet_and_prefixes():
    t = np.random.default_rng(3).integers(0, 5000, 3000)
    assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
    raw = np.frombuffer(b"abcabcabcabd" * 3, np.uint8)
    sa = suffix_array(raw.astype(np.int16))
    plcp = permuted_prefixes(raw, sa, 16)
    for x, y in zip(sa[1:], sa[:-1], strict=True):
        a, b, n = bytes(raw[x:]), bytes(raw[y:]), 0
        while n < min(len(a), len(b), 16) and a[n] == b[n]:
            n += 1
        assert plcp[x] >= n


def test_a_task_holds_a_bounded_part_of_a_common_gram(monkeypatch):
    """One gram in different contexts: what a task holds doesn't grow with the documents that have it."""
    import tracemalloc

    monkeypatch.setattr(m, "HELD", 3000)
    monkeypatch.setattr(m, "FLUSH", 5000)

    def rows(n):
        for s in range(0, n, 1000):
            c = np.arange(s, s + 1000) << 21
            at = [np.full(1000, 77), c, np.arange(s, s + 1000) % 997, np.full(1000, 40 << 13 | 34 << 6 | 50), np.zeros(1000, bool)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in at], ["h", "c", "doc_id", "place", "covered"])

    peaks = []
    for n in (20_000, 200_000):
        tracemalloc.start()
        hot = sum(sum(b.column("hot").to_pylist()) for b in m._settled(rows(n)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert hot == n
    assert peaks[1] < 1.2 * peaks[0]
