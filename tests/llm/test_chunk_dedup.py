import random

import numpy as np

from ruleforge.llm import chunk_dedup as m
from tests.llm.conftest import prose


def brute(rows):
    """Chunks by a byte-at-a-time rolling hash; all but the first of each go where runs are long enough."""
    def ends(b):
        out, last, h = [], 0, 0
        for i, x in enumerate(b):
            h = ((h << 1) + int(m._GEAR[x])) & 0xFFFFFFFF
            size = i + 1 - last
            if size == m.MAX_CHUNK and i + 1 < len(b) and not (h >> (32 - m.MASK_BITS) == 0):
                out.append(i + 1)
                last = i + 1
            elif h >> (32 - m.MASK_BITS) == 0 and size >= m.MIN_CHUNK:
                out.append(i + 1)
                last = i + 1
        return out + ([len(b)] if len(b) > last else [])

    seen, out = set(), {}
    for i, b in sorted(rows):
        start, cov = 0, np.zeros(len(b), bool)
        for e in ends(b):
            if b[start:e] in seen:
                cov[start:e] = True
            seen.add(b[start:e])
            start = e
        edge = np.flatnonzero(np.diff(np.r_[0, cov.astype(int), 0]))
        out[i] = [(int(a), int(z)) for a, z in zip(edge[::2], edge[1::2], strict=True) if z - a >= m.MIN_RUN]
    return out


def test_against_brute_force(spark, texts):
    rng = random.Random(1)
    long = prose(rng, 400)
    rows = [(i, (t or "")) for i, t in enumerate(texts)] + [(500 + i, prose(rng, 20) + " " + long[i * 7 :] + prose(rng, 5)) for i in range(5)]
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, place string, number int").repartition(3)
    expected = brute([(i, t.encode()) for i, t in rows])
    for r in m.remove_chunks(df).collect():
        t = dict(rows)[r.doc_id].encode()
        assert [(x.start, x.stop) for x in r.removed] == expected[r.doc_id]
        gone = np.zeros(len(t), bool)
        for x in r.removed:
            gone[x.start : x.stop] = True
        assert bytes(r.kept) == bytes(np.frombuffer(t, np.uint8)[~gone]) and r.n_bytes == len(t)
    assert sum(len(v) for v in expected.values()) > 5


def test_edges(docs, empty):
    assert m.remove_chunks(empty).count() == 0
    got = m.digests(docs).collect()
    assert len(got) == docs.count() and all(r.n_removed == 0 for r in got if r.doc_id is None)


def test_cuts_fall_into_step_after_an_insertion():
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 256, 20_000).astype(np.uint8)
    a, b = set(m.cuts(raw)), {x - 7 for x in m.cuts(np.r_[raw[:500], rng.integers(0, 256, 7).astype(np.uint8), raw[500:]])}
    assert len({x for x in a if x > 1500} ^ {x for x in b if x > 1500}) <= 4


def test_passages_of_over_50_words_are_found(spark):
    rng = random.Random(3)
    made = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(n))
    rows = []
    for i in range(600):
        passage = made(51 + i % 3)
        rows += [(2 * i + j, f"{made(40)} {passage} {made(40)}") for j in (0, 1)]
    got = {r.doc_id: r.n_removed for r in m.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # A passage without a whole chunk of its own goes through, about 1 in 300.
    assert sum(got[2 * i + 1] == 0 for i in range(600)) <= 6
    assert all(got[2 * i] == 0 for i in range(600))
