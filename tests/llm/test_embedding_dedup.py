import numpy as np
import pytest

from ruleforge.llm import embedding_dedup as m

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, m int, rep string"


def vectors(n=400, dims=16):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(n, dims))
    near = base[rng.integers(0, 60, 150)] + rng.normal(size=(150, dims)) * 0.08
    crowd = rng.normal(size=dims) + rng.normal(size=(120, dims)) * 0.05
    rows = [(i, [float(x) for x in v], int(i % 2)) for i, v in enumerate(np.concatenate([base, near, crowd]).astype(np.float32))]
    rows += [(10_000 + i, rows[0][1], 0) for i in range(5)] + [(10_010, [2 * x for x in rows[0][1]], 0), (10_011, rows[0][1], None), (10_012, None, 0), (10_013, [0.0] * dims, 0), (10_014, [float("nan")] + [1.0] * (dims - 1), 0), (10_015, [None] + [1.0] * (dims - 1), 0), (10_016, rows[0][1][:-1], 0), (10_017, [float("inf")] * dims, 0), (10_018, [], 0), (None, rows[0][1], 0), rows[3], rows[3]]
    return rows


def brute(rows):
    ok = [k for k, (i, e, lab) in enumerate(rows) if i is not None and lab is not None and e and None not in e and np.isfinite(e).all() and any(e)]
    n, root = {k: 0 for k in range(len(rows))}, {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(np.array(rows[k][1], float)) for k in ok}
    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a], ok[b]
            if rows[x][2] == rows[y][2] and len(unit[x]) == len(unit[y]) and unit[x] @ unit[y] >= 0.98:
                n[x] += 1
                n[y] += 1
                p, q = sorted((find(rows[x][0]), find(rows[y][0])))
                root[q] = p
    return sorted(((rows[k][0] is not None, rows[k][0] or 0), n[k], find(rows[k][0]) if rows[k][0] is not None else None) for k in range(len(rows)))


@pytest.mark.parametrize("shard", [2048, 64])
def test_against_all_pairs(spark, shard):
    rows = vectors()
    df = spark.createDataFrame([(*r, "c", 1, "r") for r in rows], SCHEMA).repartition(4)
    got = sorted(((r.vec_id is not None, r.vec_id or 0), r.n_links, r.component_id) for r in m.near_vectors(df, shard=shard).collect())
    expected = brute(rows)
    if shard == 2048:
        assert got == expected
    else:  # split into many small shards, the search may miss a link, seldom
        assert [g[0] for g in got] == [e[0] for e in expected]
        assert all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))
        assert sum(g[1] for g in got) >= 0.95 * sum(e[1] for e in expected)


def test_labels_like_paths_and_extreme_lengths(spark):
    """Labels that look like shards of one another never share one; long and short finite vectors have links like any other."""
    rng = np.random.default_rng(9)
    rows, i = [], 0
    for label in ("a", "a/2", "a/2/0", "a/8"):
        for x in rng.normal(size=(60, 8)):
            rows.append((i, x.tolist(), label))
            i += 1
    rows += [(1000 + k, [v * s for v in rows[0][1]], "a") for k, s in enumerate((1e250, 1e-250, 1e-300))]
    rows += [(2000, rows[5][1], "a/2"), (2001, rows[65][1], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    scaled = [(k, [v / max(map(abs, e)) for v in e], lab) for k, e, lab in rows]
    expected = {k: (n, c) for (_, k), n, c in brute(scaled)}
    for shard in (2048, 30):
        assert {r.vec_id: (r.n_links, r.component_id) for r in m.near_vectors(df, shard=shard).collect()} == expected


def test_one_vector_and_one_label_hold_most_rows(spark, monkeypatch):
    from ruleforge.llm import common

    monkeypatch.setattr(common, "HOT", 20)
    monkeypatch.setattr(m, "CHUNK", 40)
    rng = np.random.default_rng(10)
    many = rng.normal(size=(500, 8))
    rows = [(i, x.tolist(), "big") for i, x in enumerate(many)] + [(1000 + i, many[0].tolist(), "big") for i in range(200)] + [(2000 + i, rng.normal(size=8).tolist(), f"l{i}") for i in range(9)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in m.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(5), shard=64).collect()}
    expected = {k: (n, c) for (_, k), n, c in brute(rows)}
    assert set(got) == set(expected) and all(got[k][0] <= expected[k][0] for k in got)
    assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in expected.values())


def test_audit_and_empty(spark):
    df = spark.createDataFrame([(*r, "c", 1, "r") for r in vectors()], SCHEMA)
    assert m.audit(df.filter("vec_id < 10000").dropDuplicates(["vec_id"]), every=5, shard=200)["recall"] >= 0.9
    assert m.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_graph_search_finds_the_range():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12))
    x[200:] = x[:100] + rng.normal(size=(100, 12)) * 0.03
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = m.robust_pruned(x)
    assert max(map(len, graph)) <= m.DEGREE
    for q in range(300):
        true = set(np.flatnonzero(x @ x[q] >= 0.98)) - {q}
        assert set(m.range_search(x, graph, 0, q).tolist()) == true
