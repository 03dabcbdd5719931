import math
import random
from collections import Counter, defaultdict

import pytest

from ruleforge.llm import quality_lm as m
from tests.llm.conftest import prose


def brute(trusted, texts):
    """The same model with dictionaries, straight from its definition."""
    def read(t):
        b = bytes(m._LOW[x] for x in t.encode())
        while b"  " in b:
            b = b.replace(b"  ", b" ")
        return b

    counts = {5: Counter()}
    for t in trusted:
        b = b" " * 4 + read(t)
        # the padding stands apart: a text's own leading space comes after it
        counts[5].update(b[i - 4 : i + 1] for i in range(4, len(b)))
    for n in (4, 3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    d = {}
    for n in range(1, 6):
        c = Counter(counts[n].values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.5
        d[n] = [max(0.1, min(k - 0.05, k - (k + 1) * y * c[k + 1] / c[k])) if c[k] else 0.5 * k for k in (1, 2, 3)]
    total, left = defaultdict(float), defaultdict(float)
    for n in range(1, 6):
        for g, c in counts[n].items():
            total[n, g[:-1]] += c
            left[n, g[:-1]] += d[n][min(c, 3) - 1]

    def p(g):
        n = len(g)
        low = 1 / 256 if n == 1 else p(g[1:])
        if (n, g[:-1]) not in total:
            return low
        c = counts[n][g]
        return ((c - d[n][min(c, 3) - 1] if c else 0) + left[n, g[:-1]] * low) / total[n, g[:-1]]

    out = []
    for t in texts:
        b = b" " * 4 + read(t)
        out.append(sum(math.log(p(b[i - 4 : i + 1])) for i in range(4, len(b))))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(2)
    good = [prose(rng, 30) for _ in range(60)]
    junk = ["".join(rng.choice("!#$%^&*()XYZ019 ") for _ in range(200)) for _ in range(20)]
    rows = [(i, t, "en" if i % 2 else "fr") for i, t in enumerate(good + junk)]
    rows += [(200, None, "en"), (201, "", "en"), (202, " \n ", None), (203, "a", None), (204, good[0], None), (0, good[0], "fr"), (205, "é ünï\tA  b", "de"), (206, " ".join(good), "en"), (None, good[1], "en")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, lang string, quality int, key string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(80)] + [(5, None), (6, 0), (None, 1), (999, 1)], "doc_id long, quality int")
    return rows, docs, labels


def test_model_and_joins_agree_with_the_definition(spark, case):
    rows, docs, _ = case
    texts = [t for _, t, _ in rows if t and t.strip() and not t.startswith(" ")]
    trusted = spark.createDataFrame([(t,) for t in texts[:40]], "text string")
    keyed = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    expected = brute(texts[:40], texts)
    for limit in (m.BROADCAST_ROWS, 0):
        got = {r.key: r for r in m.perplexities(keyed, trusted, limit).collect()}
        for i, e in enumerate(expected):
            assert abs(got[i].logp - e) < 1e-6 * max(1, abs(e))


def test_classification_and_edges(case):
    rows, docs, labels = case
    got = m.classify(docs, labels).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(60)) and not any(kept[i] for i in range(60, 80))
    assert not kept[200] and not kept[201] and not kept[202] and kept[204] and kept[206] and kept[None]
    assert all(r.perplexity is None for r in got if r.doc_id in (200, 201, 202))


def test_without_labels_or_rows(spark, case, empty):
    _, docs, labels = case
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.kept for r in m.classify(docs, none).filter("doc_id < 80").collect()} == {True}
    assert m.classify(empty, labels).count() == 0
