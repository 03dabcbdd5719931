import random
import re
from collections import Counter, defaultdict

import pytest

from ruleforge.llm import divergence as m

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, k, min_docs):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        share = lambda c, total: 1 + 1000000000 * (c + 5) // (total + 5 * v)
        p = {s: {t: share(counts[lang, s][t], n[s]) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(n.values())) for t in kept}
        for s in sources:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, k)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["the", "The", "of", "ÉTÉ", "été", "x", "naïve", "日本", "a"] + [f"w{'abcdefgh'[i % 8]}{'klmnop'[i // 8 % 6]}" for i in range(48)]
    out = []
    for i in range(400):
        source = rng.choice(["s0"] * 6 + ["s1", "s2", "é", "Z", "", None])
        mine = words[: 12 + 6 * len(source or "")] + [f"only{source}"]
        out.append((" ".join(rng.choice(mine) + rng.choice(["", ",", ".\t", "'s", "2"]) for _ in range(rng.randint(0, 25))), rng.choice(["en"] * 4 + ["fr", None]), source))
    # Many terms of one count, so of one value, that begin alike.
    long = "q" * 30
    out += [(" ".join(long + a + b for a in "abcdefé" for b in "uvwxyzü"), "en", "ties")] * 9
    return out + [(None, "en", "s0"), (None, "xx", "nothing"), ("", None, None), ("12 34 []", "en", "digits only"), ("solo", "yy", "alone"), ("word " * 9000, "en", "s2")]


@pytest.mark.parametrize("small", [False, True])
def test_by_definition(spark, monkeypatch, rows, small):
    if small:
        for name, value in (("HELD", 9), ("BLOCK", 2), ("PAIRS", 3), ("TIED", 1), ("BITS", 4), ("SALTS", 3)):
            monkeypatch.setattr(m, name, value)
    df = spark.createDataFrame([(i % 7, *r, 1, "x") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, i int, term string").repartition(5)
    got = m.audit(df, k=7, min_docs=8)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 7, 8)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_top_with_ties_and_long_prefixes(spark, monkeypatch):
    monkeypatch.setattr(m, "TIED", 2)
    rng = random.Random(2)
    rows = [("g", rng.choice([0, 1, 5, 1 << 40]), "p" * rng.choice([0, 1, 50]) + f"{i}é") for i in range(300)] + [("few", 3, "b"), ("few", 3, "a"), ("one", 0, ""), ("same", 7, "x"), ("same", 7, "x\x00"), ("same", 7, "x\x00\x00"), ("same", 7, "")]
    df = spark.createDataFrame(rows, "g string, value long, item string").repartition(4)
    for k in (1, 3, 120, 290, 1000):
        expected = [r for g in {r[0] for r in rows} for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))[:k]]
        assert sorted(tuple(r) for r in m.top(df, ["g"], k).collect()) == sorted(expected)


def test_no_kept_terms_and_empty(spark, empty):
    assert m.audit(empty).count() == 0
    df = spark.createDataFrame([("a b", "en", "s"), ("c", "en", "t"), (None, None, None)], "text string, lang string, source string")
    assert sorted(tuple(r) for r in m.audit(df).collect()) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
