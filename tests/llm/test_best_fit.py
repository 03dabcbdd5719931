import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ruleforge.llm import best_fit as m
from tests.llm.conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def best_fit_decreasing(lengths, limit):
    """Document by document: the longest first, each into the fullest sequence that still takes it."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(limit - n)
    return len(gaps)


def filled(rounds, limit):
    """Tokens of each sequence, from the runs; every run starts where its sequences end so far."""
    at, ranks = {}, {}
    for length, rank, n, first, each, before in sorted(rounds.runs, key=lambda r: r[5]):
        ranks.setdefault(length, []).append((rank, n))
        for s in range(first, first + n // each):
            assert at.get(s, 0) == before
            at[s] = before + each * length
    for length, parts in ranks.items():
        assert [r for r, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist(), length
    assert max(at.values(), default=0) <= limit and set(at) == set(range(rounds.sequences))
    return at


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40).flatmap(lambda limit: st.tuples(st.just(limit), st.lists(st.integers(1, limit), max_size=80))))
def test_rounds_fill_like_best_fit(case):
    limit, lengths = case
    rounds = m.plan(np.bincount(lengths, minlength=limit + 1), limit)
    assert sum(filled(rounds, limit).values()) == sum(lengths)
    assert -(-sum(lengths) // limit) <= rounds.sequences <= best_fit_decreasing(lengths, limit)


def test_runs_grow_like_a_logarithm():
    counts = np.bincount(np.random.default_rng(1).lognormal(5.5, 1, 5000).astype(int).clip(1, 2048), minlength=2049)
    small, large = m.plan(counts * 1000), m.plan(counts * 1_000_000)
    assert len(large.runs) < 2 * len(small.runs) < 20_000 and large.sequences <= 1000 * small.sequences


def test_ids_equal_the_library(whole, texts):
    encode = m.encoder(PATH)
    odd = ["a<|endoftext|>b", "  two  spaces\n\n\tand   tab ", "it's we'll I'D", " x\x85y\xa0z", "日本語テキスト🙂🙂", "áé", "1234567890" * 30, "\x00\x1f\x7f", "aaaa" * 700]
    for t in [*odd, *(t for t in texts if t)]:
        assert encode(t).tolist() == whole.encode(t, add_special_tokens=False).ids, t[:40]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_library_on_any_text(whole, text):
    assert m.encoder(PATH)(text).tolist() == whole.encode(text, add_special_tokens=False).ids


def check(rows, docs, whole, limit):
    """Pieces against the library's ids; sequences without holes or overlaps, near the least number."""
    expected, lengths = [], []
    for i, t in docs:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % limit + 1
        cuts = [0, *range(first, len(ids) + 1, limit)]
        expected += [(i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted(map(repr, expected)) == sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    held = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert held.get(r.sequence_id, 0) == r.offset
        held[r.sequence_id] = r.offset + r.length
        lengths.append(r.length)
    assert max(held.values()) <= limit
    assert -(-sum(lengths) // limit) <= len(held) <= best_fit_decreasing(lengths, limit)


def test_pack(spark, docs, whole):
    given_ = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(m.pack(docs).collect(), given_, whole, 2048)
    check(m.pack(docs, limit=50).collect(), given_, whole, 50)


def test_many_of_one_length(spark, whole, monkeypatch):
    monkeypatch.setattr(m, "RANKED", 3)
    rng = random.Random(4)
    rows = [(i, "same text each time") for i in range(500)] + [(900 + i, prose(rng, rng.randint(0, 30))) for i in range(200)] + [(5, None), (5, None), (None, ""), (None, "x " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = m.pack(df, limit=64).collect()
    check(got, rows, whole, 64)
    assert sorted((r.length, r.sequence_id, r.offset) for r in m.pack(df.repartition(2), limit=64).collect()) == sorted((r.length, r.sequence_id, r.offset) for r in got)


def test_sequences_hold_the_ids(spark, docs, whole):
    ids = {}
    for r in m.sequences(docs, limit=100).collect():
        assert len(r.ids) == sum(p.length for p in r.parts) <= 100
        at = 0
        for p in r.parts:
            ids.setdefault(p.doc_id, []).append((p.start, r.ids[at : at + p.length]))
            at += p.length
    known = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    alone = {i: t for i, t in known if [j for j, _ in known].count(i) == 1}
    for i, t in alone.items():
        assert [x for _, part in sorted(ids[i]) for x in part] == [*whole.encode(t or "", add_special_tokens=False).ids, 0]


def test_empty(spark, empty):
    assert m.pack(empty).count() == 0 and m.sequences(empty).count() == 0
    assert m.pack(empty).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
