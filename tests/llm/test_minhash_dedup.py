import random

import numpy as np

from ruleforge.llm import minhash_dedup as m
from ruleforge.llm.common import hashed_words, shingle_sets, string_buffer, words_of
from tests.llm.conftest import edited, prose


def brute(rows):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        k = min(5, len(w))
        sets.setdefault(i, []).append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    items = [(i, s) for i, ss in sets.items() for s in ss if s]
    for x, (i, s) in enumerate(items):
        for j, t in items[:x]:
            if 100 * len(s & t) >= 75 * len(s | t):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sets, find


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    sets, find = brute([(i, t) for i, t in rows if i is not None])
    got = m.near_duplicates(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
            assert (r.component_id, r.kept) == (find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_against_all_pairs(docs):
    check(docs)


def test_large_group_of_near_copies(spark):
    rng = random.Random(1)
    base = prose(rng, 90)
    rows = [(i, edited(rng, base, rng.randint(0, 6))) for i in range(150)] + [(1000 + i, prose(rng, 40)) for i in range(20)]
    block, m.BLOCK = m.BLOCK, 32
    try:
        check(spark.createDataFrame(rows, "doc_id long, text string"))
    finally:
        m.BLOCK = block


def test_repeated_ids_with_several_texts(spark):
    """All texts of an id link it: 5 holds A and B, 7 is near B, 9 near A, 3 near 9's other text; rows without an id stay apart."""
    rng = random.Random(3)
    a, b, c = (prose(rng, 40) for _ in range(3))
    rows = [(5, a), (5, b), (7, b + " word"), (9, a + " more"), (9, c), (3, c + " end"), (5, None), (11, prose(rng, 30)), (None, a), (None, prose(rng, 8))]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))


def test_hot_digests_and_bands(spark, monkeypatch):
    """Copies and near copies that fill most of the table, with every key of more than two rows sent by broadcast."""
    from ruleforge.llm import common

    monkeypatch.setattr(common, "HOT", 50)
    rng = random.Random(4)
    base, near = prose(rng, 60), prose(rng, 90)
    rows = [(i, base) for i in range(60)] + [(100 + i, edited(rng, near, rng.randint(0, 3))) for i in range(40)] + [(200 + i, prose(rng, 30)) for i in range(10)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_empty_table_and_columns_kept(docs, empty):
    assert m.near_duplicates(empty).count() == 0
    kept = m.keep_one(docs)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in m.near_duplicates(docs).filter("not kept").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - gone


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 400))
    b = np.r_[b, a[:500]]
    x, y = m.registers(a), m.registers(b)
    assert (m.merge(x, y) == m.registers(np.r_[a, b])).all()
    one = lambda v: np.array([float(v)])
    j = m.joint_estimate(one((x > y).sum()), one((x < y).sum()), one(800), one(900))[0]
    assert abs(j - 500 / 1200) < 0.08


def test_words_and_pieces():
    import pyarrow as pa

    texts = pa.array(["A b\tc", "", None, "  x ", "éa É", "a" * 50 + " b"])
    for piece in (1, 7, 1 << 20):
        h, first = hashed_words(*string_buffer(texts), piece=piece)
        assert np.diff(first).tolist() == [3, 0, 0, 1, 2, 2]
    sets = list(shingle_sets(pa.array(["a b c d e f", "A B C D E F", "a b c"])))
    assert (sets[0] == sets[1]).all() and len(sets[2]) == 1
