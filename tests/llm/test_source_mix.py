import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ruleforge.llm import source_mix as m
from ruleforge.llm.common import words_of
from tests.llm.conftest import prose


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=12))
def test_targets(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    t = m.targets(sizes, weights)
    assert sum(t) == sum(sizes)
    assert all(0 <= x <= 3 * s for x, s in zip(t, sizes, strict=True))
    free = [(x / w) for x, w, s in zip(t, weights, sizes, strict=True) if s and x < 3 * s]
    assert len(set(free)) <= 1
    assert all(3 * Fraction(s) / w <= f for f in free[:1] for x, w, s in zip(t, weights, sizes, strict=True) if s and x == 3 * s)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 200), min_size=1, max_size=6), st.integers(1, 9))
def test_splitting_tree(quotas, shards):
    q = np.array(quotas)
    split = m.splitting_tree(q, shards, np.random.default_rng(1))
    assert split.shape == (shards, len(q)) and (split.sum(axis=0) == q).all() and (split >= 0).all()
    assert split.sum(axis=1).max() - split.sum(axis=1).min() <= shards.bit_length()


def table(spark, block=2048):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 60)), rng.choice(["b"] * 6 + ["a", "é", "Z", "", None])) for i in range(600)]
    rows += [(1000, None, "a"), (1001, "", "b"), (1002, " ", "only blank"), (1003, None, "only null"), rows[0], rows[0], (None, "no id here", "a"), (1004, "w " * 5000, "a")]
    return rows, spark.createDataFrame([(*r, 7, 1.0, "s") for r in rows], "doc_id long, text string, source string, size int, target double, s string").repartition(4)


@pytest.mark.parametrize("block", [2048, 16])
def test_plan(spark, monkeypatch, block):
    monkeypatch.setattr(m, "BLOCK_DOCS", block)
    rows, df = table(spark)
    got = m.mix_plan(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((i is None, i or 0, len(words_of(t))) for i, t, _ in rows)
    names = sorted({r[2] for r in rows if r[2] is not None}, key=lambda s: [ord(c) for c in s]) + [None]
    sizes = [sum(len(words_of(t)) for _, t, s in rows if s == n) for n in names]
    goal = dict(zip(names, m.targets(sizes, [1 + i % 3 for i in range(len(names))]), strict=True))
    for n, size in zip(names, sizes, strict=True):
        mine = [r for r in got if r.source == n]
        assert {r.source_size for r in mine} == {size} and all(abs(r.target - float(goal[n])) < 1e-6 for r in mine)
        largest = max(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - float(goal[n])) <= largest
        for r in mine:
            assert r.taken <= 3 * r.size and r.taken == r.size * len(r.shards) and all(0 <= k < m.SHARDS for k in r.shards)
    again = m.mix_plan(df.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mixture_and_empty(spark, empty):
    assert m.mix_plan(empty).count() == 0 and m.mixed(empty).count() == 0
    rows, df = table(spark)
    plan = {}
    for r in m.mix_plan(df, shards=4).collect():
        plan.setdefault((r.doc_id, r.size), []).extend(r.shards)
    out = m.mixed(df, shards=4)
    assert out.columns == [*df.columns, "_copy", "_shard"]
    made = {}
    for r in out.collect():
        made.setdefault((r.doc_id, len(words_of(r.text))), []).append(r._shard)
    assert {k: sorted(v) for k, v in made.items()} == {k: sorted(v) for k, v in plan.items() if v}


def test_shards_follow_the_size(spark, monkeypatch):
    _, df = table(spark)
    monkeypatch.setattr(m, "SHARDS", 1)
    monkeypatch.setattr(m, "SHARD_WORDS", 1000)
    monkeypatch.setattr(m, "MAX_BLOCKS", 9)
    monkeypatch.setattr(m, "BLOCK_DOCS", 2)
    plan = m.mix_plan(df).collect()
    used = [k for r in plan for k in r.shards]
    assert max(used) + 1 == int(sum({r.source: r.target for r in plan}.values())) // 1000
    for source in {r.source for r in plan}:
        mine = [r for r in plan if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)
