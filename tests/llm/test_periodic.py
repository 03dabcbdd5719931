import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ruleforge.llm import periodic as m
from tests.llm.conftest import prose


def brute(words):
    """Every stretch, by definition: its smallest period by trying all, and that neither neighbour keeps it."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            smallest = next(p for p in range(1, len(part) + 1) if all(part[k] == part[k + p] for k in range(len(part) - p)))
            if smallest == q and len(part) >= max(6, 4 * q):
                out.append((i, len(part), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def altered(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def summary(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = altered(words, doc_id) if doc_id is not None else words
    runs = brute(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def found(words):
    codes = np.unique(np.array(words, dtype=object), return_inverse=True)[1].astype(np.int64) if words else np.zeros(0, np.int64)
    counts, base = m.lag_counts(codes, np.array([0, len(codes)]))
    return m.runs_of(codes, counts[base[0] : base[1]])


pieces = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.integers(1, 9)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_runs_by_definition(parts):
    words = [w for block, times in parts for w in block * times]
    assert found(words) == brute(words)


@settings(max_examples=100, deadline=None)
@given(pieces, st.integers(1, 3))
def test_heavy_words_count_alike(parts, heavy):
    """Whatever share of the words is counted by transforms."""
    words = [w for block, times in parts for w in block * times]
    old = m.HEAVY, m.LIGHT_PAIRS
    m.HEAVY, m.LIGHT_PAIRS = 10.0**heavy, 0
    try:
        assert found(words) == brute(words)
    finally:
        m.HEAVY, m.LIGHT_PAIRS = old


def test_counts_of_many_texts():
    rng = random.Random(1)
    texts = [[rng.choice("aaaabcd") for _ in range(rng.randint(0, 300))] for _ in range(40)] + [["a"] * 5000, []]
    flat = np.array([ord(w) for t in texts for w in t], np.int64)
    first = np.cumsum([0, *map(len, texts)])
    counts, base = m.lag_counts(flat, first)
    for d, t in enumerate(texts):
        for q in range(1, len(t) // 4 + 1):
            assert counts[base[d] + q] == sum(x == y for x, y in zip(t, t[q:], strict=False))


def test_long_texts_stay_cheap(monkeypatch):
    scans = []
    monkeypatch.setattr(m, "islands", lambda x, q, f=m.islands: scans.append(q) or f(x, q))
    assert found(["w"] * 400_000) == [(0, 400_000, 1)] and scans == [1]
    scans.clear()
    block = [str(i) for i in range(7000)]
    assert found(["x", *block * 40, "y"]) == [(1, 280_000, 7000)] and scans == [7000]


def test_table(spark, docs, texts):
    rng = random.Random(9)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if not r.text or len(r.text) < 4000]
    hit = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, prose(rng, rng.randint(0, 90))) for i in hit] + [(hit[0], None), (hit[1], "one"), (None, "a b " * 9), (7, "A a A a A a"), (8, "x\x0by " * 7 + "  \x85"), (9, "\t\r\n"), (7, "A a A a A a")]
    df = spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, runs string, period int").repartition(3)
    expected = sorted((summary(*r) for r in rows), key=repr)
    assert sorted((tuple(r) for r in m.summaries(df).collect()), key=repr) == expected
    plain = m.periodic_runs(df).filter("doc_id = 7").collect()
    assert [(r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in plain] == [(6, [], "A a A a A a")] * 2
    assert m.periodic_runs(df.filter("doc_id is null and text like 'a b%'")).first().collapsed == "a b"


def test_empty(empty):
    assert m.summaries(empty).count() == 0
    assert m.summaries(empty).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
