import random
from collections import Counter

from ruleforge.llm import decontaminate as m
from ruleforge.llm.common import words_of
from tests.llm.conftest import edited, prose


def shingles(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(docs, items):
    """Best window of every start, for windows of the item's size that share a shingle."""
    out = {}
    for d, t in docs:
        w = words_of(t)
        for i, x in items:
            v = words_of(x)
            if not v or not w:
                continue
            n, k = len(v), min(5, len(v))
            b = shingles(v, k)
            for s in range(max(1, len(w) - n + 1)):
                a = shingles(w[s : s + n], k)
                both, union = sum((a & b).values()), sum((a | b).values())
                if both and 100 * both >= 75 * union:
                    best = out.get((d, i))
                    if best is None or both / union > best[0]:
                        out[d, i] = (both / union, s, n)
    return out


def cases():
    rng = random.Random(9)
    items = [(i, prose(rng, rng.randint(12, 50))) for i in range(12)] + [(50, "three word item"), (51, "the the the the the the the the"), (52, ""), (53, None), (None, "null id item with some words here"), (54, prose(rng, 30))]
    docs = []
    for i, t in items[:12]:
        docs.append((i, prose(rng, 30) + " " + t.upper() + "  \n " + prose(rng, 20)))
        docs.append((100 + i, prose(rng, 5) + " " + edited(rng, t, 1)))
        docs.append((200 + i, prose(rng, 40)))
        docs.append((300 + i, t[: len(t) * 2 // 3]))
    for i, t in items[:12]:  # the parts of an item in another order, and words put in or left out
        w = t.split(" ")
        docs.append((500 + i, prose(rng, 8) + " " + " ".join(w[len(w) // 2 :] + w[: len(w) // 2]) + " " + prose(rng, 9)))
        docs.append((600 + i, prose(rng, 3) + " " + " ".join(w[: len(w) // 3] + ["in"] + w[len(w) // 3 :]) + " " + prose(rng, 4)))
        docs.append((700 + i, " ".join(w[1:-1]) + " " + prose(rng, 4) + " " + t))
    docs += [(400, "x three WORD item y"), (401, "the the the the the the the the the the"), (402, None), (403, ""), (404, " ".join(t for _, t in items[:3])), (405, items[0][1] + " " + items[0][1]), (None, items[0][1])]
    return docs, items


def test_against_all_windows(spark):
    docs, items = cases()
    expected = brute([d for d in docs if d[0] is not None], [x for x in items if x[0] is not None])
    df = spark.createDataFrame([(*d, "n", 1) for d in docs], "doc_id long, text string, words string, start int").repartition(3)
    got = m.matches(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id): (r.similarity, r.start_word, r.n_words) for r in got}
    assert len(got) == len(found)
    assert found == expected
    assert all(r.distance <= m.RADIUS for r in got)


def test_repeats_and_other_join(spark, monkeypatch):
    docs, items = cases()
    df = spark.createDataFrame([d for d in docs if d[0] is not None] + docs[:2], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = {tuple(r) for r in m.matches(df, bench).collect()}
    monkeypatch.setattr(m, "BROADCAST_ROWS", -1)
    assert {tuple(r) for r in m.matches(df, bench).collect()} == one


def test_recall_over_similarities(spark):
    """Of 600 items whose words are changed, moved or dropped until the similarity is between 0.75 and 1, those whose fingerprint lies too far away."""
    rng = random.Random(11)
    docs, items = [], []
    for i in range(600):
        w = prose(rng, rng.randint(12, 120)).split(" ")
        at, n = rng.randrange(len(w)), rng.randint(1, max(1, len(w) // 9))
        v = w[:at] + [prose(rng, 1) for _ in range(n)] + w[at + n :] if rng.random() < 0.6 else w[at:] + w[:at]
        items.append((i, " ".join(w)))
        docs.append((i, prose(rng, 6) + " " + " ".join(v) + " " + prose(rng, 6)))
    expected = {i for (d, x), i in ((k, k[0]) for k in brute_own(docs, items)) if d == x}
    found = {r.doc_id for r in m.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(expected) > 200 and found <= expected
    assert len(found) >= 0.99 * len(expected)


def brute_own(docs, items):
    out = {}
    for d, x in zip(docs, items, strict=True):
        out |= brute([d], [x])
    return out


def test_long_items(spark):
    """Items of thousands of words, one of them a word said again and again."""
    rng = random.Random(12)
    long = prose(rng, 4000)
    items = spark.createDataFrame([(1, long), (2, "again and " * 700)], "item_id long, text string")
    docs = spark.createDataFrame([(1, prose(rng, 50) + " " + long), (2, prose(rng, 3000)), (3, "again and " * 800)], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.start_word, r.similarity) for r in m.matches(docs, items).collect()) == [(1, 1, 50, 1.0), (3, 2, 0, 1.0)]


def test_empty_tables_and_filter(spark, docs, empty):
    bench = spark.createDataFrame([(1, "some words of an item that is nowhere else")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert m.matches(empty, bench).count() == 0 and m.matches(docs, none).count() == 0
    kept = m.without_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_words_of_texts_are_not_written(spark, monkeypatch):
    """Of the texts places alone are written, and the words of the windows, as a bitmap's chance hits make most long texts suspects."""
    docs, items = cases()
    written, write = {}, m.materialize
    monkeypatch.setattr(m, "materialize", lambda df, name: written.setdefault(name, write(df, name)))
    monkeypatch.setattr(m, "discard", lambda df: None)
    assert m.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).count()
    assert {n for n, df in written.items() if "string" in str(dict(df.dtypes).values())} <= {"items", "windows", "near"}
    longest = written["items"].agg({"n": "max"}).first()[0]
    assert 0 < written["windows"].selectExpr("max(size(words))").first()[0] <= longest
