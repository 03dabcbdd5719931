import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ruleforge.llm import toxicity as m
from tests.llm.conftest import prose

BAD = ["grumblefoul", "vexknave", "snarlwretch", "mockcur"]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for i in range(1200):
        toxic = rng.random() < 0.15
        words = prose(rng, rng.randint(10, 80)).split()
        if toxic:
            for w in rng.sample(BAD, 2):
                words.insert(rng.randrange(len(words)), w + rng.choice(["", "s", "ish"]))
        out.append((i, " ".join(words), int(toxic)))
    return out


@pytest.fixture(scope="module")
def tables(spark, rows):
    extra = [(5000, None), (5001, ""), (5002, "???"), (5003, "vexknave"), (5003, "vexknave"), (5004, "x " * 30000 + "grumblefoul mockcur"), (None, "grumblefoul")]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t, _ in rows] + [(i, t, 0, "s") for i, t in extra], "doc_id long, text string, toxic int, score string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, None), (1, rows[1][2]), (None, 1), (99999, 1)], "doc_id long, toxic int")
    return docs, labels


def test_held_out_accuracy_and_edges(tables, rows):
    got = m.predictions(*tables).collect()
    assert len(got) == len(rows) + 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: y for i, _, y in rows}
    hidden = [r for r in got if r.doc_id in truth and held(r.doc_id)]
    assert len(hidden) > 100 and all(r.held_out for r in hidden)
    assert np.mean([r.predicted == truth[r.doc_id] for r in hidden]) > 0.98
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[5000][0].score == by[5001][0].score == by[5002][0].score < 0.5
    assert by[5003][0].score == by[5003][1].score >= 0.5 and by[5004][0].predicted == 1
    assert by[None][0].held_out is False


def test_labels_of_held_out_rows_change_nothing(spark, tables):
    docs, labels = tables
    one = sorted(m.predictions(docs, labels).collect(), key=repr)
    other = labels.filter("doc_id is null or crc32(cast(doc_id as string)) % 5 != 0")
    assert sorted(m.predictions(docs, other).collect(), key=repr) == one


def plain_terms(text):
    """Terms of a text, written out: 5-byte grams, and 8 bytes from each space on, which are marked."""
    raw = b" " + b" ".join("".join(c if not c.isascii() else c.lower() if c.isalnum() else " " for c in text or "").encode().split(b" ")) + b" "
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    every = [raw[i : i + 5] for i in range(len(raw) - 4)]
    return Counter(every + [b"!" + raw[i : i + 8] for i in range(len(raw) - 7) if raw[i : i + 1] == b" "])


def test_scores_against_brute_force(spark):
    """Vocabulary, frequencies, cosines, votes and evidence computed plainly; all scores lie on one logistic curve of the votes."""
    rng = random.Random(14)
    docs = []
    for i in range(260):
        words = prose(rng, rng.randint(3, 25)).split()
        if i % 4 == 0:
            words += rng.sample(BAD, rng.randint(1, 3)) * rng.randint(1, 3)
        docs.append((i, " ".join(words)))
    labels = {i: int(i % 4 == 0) for i in range(0, 260) if i % 13}
    train = [(i, t) for i, t in docs if i in labels and not held(i)]
    n, ones = len(train), sum(labels[i] for i, _ in train)
    base = ones / n
    have, bad = Counter(), Counter()
    for i, t in train:
        for g in plain_terms(t):
            have[g] += 1
            bad[g] += labels[i]

    def ratio(g):
        part = lambda o, e: o * math.log(o / e) if o else 0.0
        x, y = have[g], bad[g]
        return 2 * (part(y, x * base) + part(x - y, x * (1 - base)) + part(ones - y, ones - x * base) + part(n - ones - x + y, (n - ones) - x * (1 - base)))

    vocabulary = {g for g in have if bad[g] / have[g] > base and ratio(g) > m.MIN_RATIO}
    assert 0 < len(vocabulary) <= m.TERMS
    df = Counter(g for _, t in docs for g in plain_terms(t) if g in vocabulary)

    def vector(t):
        v = {g: (1 + math.log(c)) * math.log((1 + len(docs)) / (1 + df[g])) for g, c in plain_terms(t).items() if g in vocabulary}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / size for g, x in v.items()} if size else {}

    examples = {i: vector(t) for i, t in train}
    got = {r.doc_id: r for r in m.score(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), evidence=m.K).collect()}
    seen = []
    for i, t in docs:
        v = vector(t)
        cos = {j: sum(x * e.get(g, 0.0) for g, x in v.items()) for j, e in examples.items()}
        best = sorted((c for c in cos.values() if c > 0), reverse=True)[: m.K]
        assert np.allclose([e.cosine for e in got[i].evidence], best)
        assert all(abs(cos[e.doc_id] - e.cosine) < 1e-9 and labels[e.doc_id] == e.toxic for e in got[i].evidence)
        if v:
            vote = (sum(e.cosine**2 * e.toxic for e in got[i].evidence) + m.PRIOR * base) / (sum(e.cosine**2 for e in got[i].evidence) + m.PRIOR)
            seen.append((m._log_odds(vote), math.log(got[i].score / (1 - got[i].score))))
    assert len({i for i, t in docs if not vector(t)}) > 100 and len({got[i].score for i, t in docs if not vector(t)}) == 1
    (x0, y0), (x1, y1) = min(seen), max(seen)
    slope = (y1 - y0) / (x1 - x0)
    assert slope > 0 and np.allclose([y for _, y in seen], [y0 + slope * (x - x0) for x, _ in seen])


def test_nearest_is_exact():
    rng = np.random.default_rng(2)
    w = rng.random((500, 60)) * (rng.random((500, 60)) < 0.1)
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)
    index = m.Index([(np.flatnonzero(x), x[x > 0]) for x in w], rng.integers(0, 2, 500), np.arange(500), 60)
    for _ in range(50):
        t = np.sort(rng.choice(60, 6, replace=False))
        v = rng.random(6)
        at, cos = index.nearest(t, v / np.linalg.norm(v), k=10)
        every = np.sort(w[:, t] @ (v / np.linalg.norm(v)))[::-1]
        assert np.allclose(cos, every[every > 0][:10])
        assert np.allclose(w[index.ids[at]][:, t] @ (v / np.linalg.norm(v)), cos)


def test_evidence_and_missing_labels(spark, tables, empty):
    docs, labels = tables
    r = m.score(docs, labels, evidence=2).filter("doc_id = 5003").first()
    assert len(r.evidence) == 2 and r.evidence[0].toxic == 1 and not held(r.evidence[0].doc_id)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in m.score(docs, none).collect()} == {0.0}
    few = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    assert len({r.score for r in m.score(docs, few).collect()}) == 1
    assert m.predictions(empty, labels).count() == 0
    kept = m.without_toxic(docs, labels)
    assert kept.columns == docs.columns and 5003 not in {r.doc_id for r in kept.collect()}


def test_each_row_is_judged_by_its_own_text(spark, tables):
    docs, labels = tables
    seen = docs.select("doc_id", "text").filter("doc_id < 5000").join(m.score(docs, labels), "doc_id")
    worst, best = seen.orderBy(F.desc("score"), "doc_id").first(), seen.orderBy("score", "doc_id").first()
    assert worst.score >= 0.5 > best.score
    more = [(i, t, f"c{k}", k) for k, (i, t) in enumerate([(None, worst.text), (None, best.text), (90_001, worst.text), (90_001, best.text), (90_002, None), (90_003, "")])]
    extra = spark.createDataFrame(more, "doc_id long, text string, row string, score int")
    every = docs.select("doc_id", "text").withColumns({"row": F.lit("d"), "score": F.lit(-1)}).unionByName(extra)
    got = [r for r in m.without_toxic(every, labels).collect() if r.row != "d"]
    assert sorted(r.row for r in got) == ["c1", "c3", "c4", "c5"]
    assert all(r.text == dict((c, t) for _, t, c, _ in more)[r.row] for r in got)
