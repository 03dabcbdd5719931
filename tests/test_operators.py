import numpy as np
import pytest
from pyspark.sql import functions as F

from ruleforge.functions.text import COUNT_EXTENSIONS, LETTERS
from ruleforge.functions import keyed
from ruleforge.functions.keyed import running_sums
from ruleforge.operators import aggregate, assemble, evolve, lineage, merge, neighbours, providers, select


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_replaced(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "id long, e string")
    right = spark.createDataFrame([(1, "A"), (2, "B"), (4, None), (None, "x")], "id long, t string")
    out = merge.replaced(left, right, "id", "e", "t")
    assert rows(out) == {(1, "A", True, True), (2, None, True, False), (3, "c", False, False), (4, "d", True, False)}
    assert tuple(merge.merge_counters(out).first()) == (1, 1, 2)


def test_correct_and_reindexed(spark):
    p = spark.createDataFrame([(5, " a ", "A", 0), (6, "", "", 1), (7, None, "B", 2), (8, "B", "b\n", 3), (None, "B", "b", 4), (9, "x", "y", 5)], "id long, answer string, truth string, pos long")
    right = merge.correct_rows(p, "answer", "truth")
    assert {r.id for r in right.collect()} == {5, 6, 8}
    questions = spark.createDataFrame([(5, "q"), (8, "r")], "id long, q string")
    assert rows(merge.reindexed(right, questions)) == {(5, "q", 0), (8, "r", 2)}
    again = merge.reindexed(right.unionByName(right.withColumn("pos", F.col("pos") + 10)), questions)
    assert rows(again) == {(5, "q", 3), (8, "r", 5)}


def test_parents_keep_order_and_fall_back(spark):
    r = spark.createDataFrame([(1, [30, 10, 99, 20]), (2, []), (3, None), (4, [99])], "id long, parents array<long>")
    own = spark.createDataFrame([(10, 0), (20, 1)], "old_id long, new_id long")
    other = spark.createDataFrame([(20, 7), (30, 8)], "old_id long, new_id long")
    assert {k: v for k, v in merge.remapped_parents(r, own, other).collect()} == {1: [8, 0, 1], 2: [], 3: [], 4: []}


def test_merges(spark):
    details = spark.createDataFrame([(12, ["r"], "q", "k", True, 0.5)], "id long, rule_content array<string>, question_type string, knowledge_point string, has_duplicate boolean, accuracy double")
    variants = spark.createDataFrame([("12_A",), ("13_A",), ("x_A",)], "id string")
    got = {r.id: r for r in merge.with_details(variants, details).collect()}
    assert got["12_A"].matched and got["12_A"].accuracy == 0.5 and not got["13_A"].matched and not got["x_A"].matched
    assert merge.with_details(variants, details, null_accuracy=True).filter("accuracy is not null").count() == 0
    acc = spark.createDataFrame([("12", 0.25), ("12_1", 0.5), ("no", 1.0)], "key string, value double")
    ids = spark.createDataFrame([("12",), ("121",), ("bad",)], "id string")
    assert rows(merge.with_accuracy(ids, acc)) == {("12", 0.25), ("121", None), ("bad", None)}
    meta = merge.with_meta(spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([(1, None, "a", "b")], "id long, rule_content array<string>, question_type string, knowledge_point string"))
    assert {r.id: r.rule_content for r in meta.collect()} == {1: [], 2: None}
    summary = spark.createDataFrame([("1", True, False), ("2", False, True), ("x", False, False)], "id string, has_duplicate boolean, has_blank boolean")
    assert rows(merge.without_blank(spark.createDataFrame([(1,), (2,), (3,)], "id long"), summary)) == {(1, True)}
    q = spark.createDataFrame([(1, "first", 0), (1, "second", 1)], "id long, q string, pos long")
    sc = spark.createDataFrame([(1, 3, 0), (1, 4, 1)], "id long, score int, pos long")
    assert rows(merge.with_scores(q, sc).select("id", "q", "score")) == {(1, "first", 4)}


def test_the_last_row_of_a_key_wins_in_every_merge(spark):
    """Right sides with repeated keys never multiply rows; the row of the greatest position decides, or the greatest row where there are none."""
    make = lambda data, kinds: spark.createDataFrame(data, kinds).repartition(3)
    left = make([(1, "a"), (2, "b"), (2, "c"), (3, None)], "id long, e string")
    right = make([(1, "new", 5), (1, "old", 2), (2, "x", 1), (2, None, 9), (3, "y", 0), (None, "z", 1)], "id long, t string, pos long")
    assert rows(merge.replaced(left, right, "id", "e", "t")) == {(1, "new", True, True), (2, "x", True, True), (3, None, True, False)}
    assert merge.replaced(left, right.drop("pos"), "id", "e", "t").count() == 4
    tags = make([(1, "q1", None, 1), (1, "q2", "k2", 3), (1, "q3", "k3", 2)], "id long, q string, k string, pos long")
    assert rows(merge.with_defaults(left.select("id"), tags, "id", ("q", "k"))) == {(1, "q2", "k2"), (2, "", ""), (3, "", "")}
    scores = make([(1, 3, 1), (1, 4, 2), (9, 1, 1)], "id long, s int, pos long")
    assert rows(merge.overlaid_scores(make([(1, "r", 7), (1, "last", 8), (2, "r", 9)], "id long, rule string, pos long"), scores).drop("pos")) == {(1, "last", 4)}
    rules = make([(1, ["a"], "q", "k", 1), (1, None, "q2", "k2", 2)], "id long, rule_content array<string>, question_type string, knowledge_point string, pos long")
    assert [tuple(r) for r in merge.with_meta(make([(1,)], "id long"), rules).collect()] == [(1, [], "q2", "k2")]
    summary = make([("1", True, True, 1), ("1", True, False, 2), ("2", False, False, 1), ("2", False, True, 2)], "id string, has_duplicate boolean, has_blank boolean, pos long")
    assert rows(merge.without_blank(make([(1,), (2,)], "id long"), summary)) == {(1, True)}
    accuracy = make([("1", 0.9, 1), ("01", 0.1, 2), ("x", 0.5, 3)], "key string, value double, pos long")
    assert rows(merge.with_accuracy(make([("1",)], "id string"), accuracy)) == {("1", 0.1)}
    details = make([("7", "old", 1), ("7", "new", 2), ("bad", "no", 3)], "id string, v string, pos long")
    assert rows(merge.with_details(make([("7_A",), ("bad_A",)], "id string"), details, ("v",))) == {("7_A", "new", True), ("bad_A", None, False)}


def test_parents_by_both_branches(spark):
    """In 4 of 10 draws one of the unused rules, else by weight; every task gets one parent of its own group."""
    candidates = spark.createDataFrame([(g, g * 1000 + i, 0 if g == 0 and i < 10 else i % 4 + 1) for g in range(3) for i in range(100)], "g long, id long, used long")
    tasks = spark.range(3).selectExpr("id as g", "explode(sequence(1L, 3000L)) as slot")
    got = evolve.pick_parents(tasks, candidates, "g", "slot", "id", "used", 1, "p").collect()
    assert len(got) == 9000 == len({(r.g, r.slot) for r in got}) and all(r.id // 1000 == r.g for r in got)
    weight = {r.id: evolve.UNIT // (r.used + 1) for r in candidates.collect()}
    for g in range(3):
        mine = [r.id for r in got if r.g == g]
        low = sum(i % 1000 < 10 for i in mine) / 3000
        share = sum(w for i, w in weight.items() if i // 1000 == g and i % 1000 < 10) / sum(w for i, w in weight.items() if i // 1000 == g)
        assert abs(low - (0.4 + 0.6 * share if g == 0 else share)) < 0.04


def test_running_sums(spark):
    df = spark.createDataFrame([(i % 3, i, i * i) for i in range(1000)], "g int, i long, w long").repartition(7)
    got = {(r.g, r.i): r.s for r in running_sums(df, "i", "w", "s", by=("g",)).collect()}
    for g in range(3):
        total = 0
        for i in range(g, 1000, 3):
            total += i * i
            assert got[g, i] == total


def test_owed(spark):
    items = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    done = spark.createDataFrame([(1, "error")] * 1 + [(2, None)] * 8 + [(3, None)] * 9, "id long, error string")
    assert rows(merge.owed(items, done)) == set()
    assert rows(merge.owed_requests(items, done)) == {(1, k) for k in range(2, 9)}
    assert len(rows(merge.owed_requests(items, done.limit(0)))) == 24


def test_batches_by_position_and_id(spark):
    requests = spark.createDataFrame([(i + 40, i) for i in range(5)], "id long, pos long")
    answers = spark.createDataFrame([("req-0",), ("req-4",), ("req-9",), ("bad",), (None,)], "custom_id string")
    assert {r.id for r in merge.by_position(answers, requests).collect()} == {40, 44}
    assert {r.id for r in merge.by_id(spark.createDataFrame([("41",), ("x",)], "custom_id string"), requests).collect()} == {41}


def test_filters(spark):
    t = spark.createDataFrame([(1, "Others", "Others"), (2, "Others", "x"), (3, "x", "y"), (4, None, "Others")], "id long, a string, b string")
    yes, no = select.split_by(t, select.one_other("a", "b"))
    assert {r.id for r in yes.collect()} == {2, 4} and {r.id for r in no.collect()} == {1, 3}
    r = spark.createDataFrame([(1, 0, None, 5, 5, 2), (2, 0, None, 4, 5, 3), (3, 1, 4, 5, 5, 5), (4, 1, 3, 5, 5, 5), (5, 0, None, -1, -1, -1), (6, None, None, 5, None, 5)], "id long, repeat_count long, min_similar_rule_id long, format_score int, content_quality_score int, feasibility_score int")
    assert {x.id for x in select.good_rules(r).collect()} == {2}
    assert {x.id for x in select.good_rules(r, keep_representative=True).collect()} == {2, 3}
    p = spark.createDataFrame([("1", "p", {"A": "a"}, "images/a.png", "A"), ("2", "", {"A": "a"}, "images/a.png", "A"), ("3", "p", {}, "images/a.png", "A"), ("4", "p", {"A": "a"}, "a.png", "A"), ("5", "p", {"A": "a"}, "images/b.png", "A")], "id string, prompt string, options map<string,string>, image string, correct_answer string")
    files = spark.createDataFrame([("images/a.png",)], "path string")
    assert {x.id for x in select.complete_puzzles(p).collect()} == {"1", "5"} and {x.id for x in select.complete_puzzles(p, files).collect()} == {"1"}
    assert {x.id for x in select.digit_ids(spark.createDataFrame([("7",), ("7",), ("7a",), (None,)], "id string")).collect()} == {7}


def test_validity_uses_the_latest_attempt_by_number(spark):
    made = [(1, 10, "output_correct", f"c{i}.gif", "fail") for i in range(5)] + [(1, 10, "output_incorrect", f"w{i}.png", "fail") for i in range(3)] + [(1, 2, "output_correct", "x.png", "success"), (2, 1, "output_correct", "a.txt", "Success!")]
    m = spark.createDataFrame(made, "id long, attempt int, kind string, path string, test_result string")
    counts = aggregate.image_counts(m, COUNT_EXTENSIONS)
    assert rows(counts) == {(1, 5, 3, False), (2, 0, 0, True)}
    assert {r.id for r in select.complete_groups(counts).collect()} == {1}


def test_rates_and_statuses(spark):
    a = spark.createDataFrame([(1, True), (1, None), (2, False)], "id long, is_correct boolean")
    assert rows(aggregate.pass_rates(a)) == {(1, 2, 1, 0.5), (2, 1, 0, 0.0)}
    assert tuple(aggregate.status_counts(spark.createDataFrame([(None,), ("",), ("e",)], "error string")).first()) == (3, 2, 1, 2 / 3)
    tags = spark.createDataFrame([(0, "b", "x"), (1, "a", "x"), (2, "b", "x")], "pos long, question_type string, knowledge_point string")
    assert rows(aggregate.islands(tags)) == {("b", "x", 0, 2), ("a", "x", 1, 1)}
    d = aggregate.distinct_tags(tags).first()
    assert (d.question_types, d.knowledge_points, d.n_pairs) == (["a", "b"], ["x"], 2)


def test_neighbours(spark):
    v = [(0, [0.0, 0.0]), (1, [0.1, 0.0]), (2, [0.2, 0.0]), (3, [5.0, 5.0]), (4, [5.0, 5.0]), (5, [9.0, 0.0]), (6, [9.0, 0.2 ** 0.5])]
    df = spark.createDataFrame([(i + 100, i, e) for i, e in v], "id long, pos long, embedding array<double>")
    got = {r.id: r for r in neighbours.near_duplicates(df, limit=0.02).collect()}
    assert [got[100 + i].repeat_count for i in range(7)] == [1, 2, 1, 1, 1, 0, 0]
    assert got[101].min_similar_rule_id == 100 and got[103].min_neighbor_distance == 0.0 and got[105].min_similar_rule_id is None
    assert {r.repeat_count for r in neighbours.near_duplicates(df, k=2, limit=0.02).collect()} == {0, 1}
    assert neighbours.near_duplicates(df.limit(1)).first().min_neighbor_distance == -1.0
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("pieces", [(64, 16, 4096), (20, 7, 8)])
def test_neighbours_visit_only_what_their_radius_reaches(spark, monkeypatch, pieces):
    """Clusters, loners, large groups of copies: the rows of a brute force, while each vector goes to few of the pieces."""
    monkeypatch.setattr(neighbours, "PIECE", pieces[0])
    monkeypatch.setattr(neighbours, "BLOCK", pieces[1])
    monkeypatch.setattr(neighbours, "QUESTIONS", pieces[1])
    monkeypatch.setattr(neighbours, "MAX_PIECES", pieces[2])
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(25, 6)) * 5
    x = np.r_[centres[rng.integers(0, 25, 500)] + rng.normal(size=(500, 6)) * 0.05, np.repeat(centres[:1], 150, axis=0), rng.normal(size=(50, 6)) * 8]
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(1000 - i, i, v.tolist()) for i, v in enumerate(x)], "id long, pos long, embedding array<double>").repartition(4)
    for k, limit in ((500, 0.03), (5, 1.0)):
        d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        np.fill_diagonal(d, np.inf)
        expected = {}
        for i in range(len(x)):
            order = np.argsort(d[i], kind="stable")[: k - 1]
            near = order[d[i][order] < limit]
            expected[i] = (1000 - i, round(d[i][order[0]], 9), len(near), 1000 - int(near.min()) if len(near) else None)
        got = neighbours.near_duplicates(df, k=k, limit=limit)
        assert {r.pos: (r.id, round(r.min_neighbor_distance, 9), r.repeat_count, r.min_similar_rule_id) for r in got.collect()} == expected
    index = neighbours.Neighbours(df.withColumnRenamed("embedding", "v"), 500, 0.03)
    index.found()
    different = len(np.unique(x, axis=0))
    assert index.visits[0] == different
    assert len(index.index.size) >= 8 and sum(index.visits) < different * len(index.index.size) / (4 if pieces[2] > 8 else 1.5)


def test_few_distances_are_taken_by_differences(monkeypatch):
    """Products screen what can count: of random vectors few pairs are left, and those that count are all among them, copies, far offsets and vectors that aren't finite included."""
    rng = np.random.default_rng(9)
    unit = rng.normal(size=(3000, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for x, limit, few in ((unit, 1.2, 0.02), (unit * 1e-4 + 1e3, 1.2e-8, 1), (np.repeat(unit[:30], 20, axis=0), 1e-9, 0.2), (np.where(np.arange(600)[:, None] == 7, np.nan, unit[:600]), 1.2, 1), (unit[:1], 1.2, 1)):
        q, r, taken = np.arange(0, len(x), 5), np.arange(len(x)), 0
        for mine, i, j, d in neighbours._screened(x, q, r, limit):
            every = ((x[mine][:, None] - x[None]) ** 2).sum(axis=2)
            counts = (every < limit) | (np.argsort(np.argsort(every, axis=1, kind="stable"), axis=1, kind="stable") < 2)
            got = np.full(every.shape, -1.0)
            got[i, j] = d
            taken += len(i)
            assert np.array_equal(np.nan_to_num(got[counts], nan=7.0), np.nan_to_num(every[counts], nan=7.0)) or np.allclose(got[counts], every[counts], rtol=1e-14, atol=0, equal_nan=True)
        assert taken <= few * len(q) * len(r)


def test_hash_groups(spark):
    h = [(1, 0, [0, 0]), (1, 1, [3, 0]), (1, 2, [7, 0]), (2, 0, [0, 0]), (2, 1, [0, 1])]
    df = spark.createDataFrame([(*x, x[1] == 2) for x in h], "id long, idx int, phash array<long>, blank boolean")
    pairs = neighbours.hash_pairs(df)
    assert rows(pairs) == {(1, 0, 1, 2), (1, 1, 2, 1), (2, 0, 1, 1)}
    assert rows(neighbours.group_flags(df, pairs)) == {(1, True, True), (2, False, False)}
    dups = {(r.id, r.idx): r.dups for r in neighbours.duplicates_of(pairs).collect()}
    assert dups == {(1, 0): [1], (1, 1): [0, 2], (1, 2): [1], (2, 0): [1], (2, 1): [0]}


def test_relatives(spark):
    r = spark.createDataFrame([(1, []), (2, [1]), (3, [2]), (4, [3]), (5, [5]), (6, [7]), (7, [6])], "id long, parents array<long>")
    valid = spark.createDataFrame([(1,), (4,), (7,)], "id long")
    got = {x.id: x.relatives for x in lineage.relatives(r, valid).collect()}
    assert got == {1: [4], 2: [1, 4], 3: [4, 1], 4: [1], 5: [], 6: [7], 7: []}


def test_relatives_however_far(spark):
    """Chains of 11 steps against a search from each rule, with a branch, a ring and a part without valid rules."""
    parents = {1: [], **{i: [i - 1] for i in range(2, 13)}, 20: [3], 21: [20, 4], 30: [32], 31: [30], 32: [31], 40: [41], 41: []}
    valid, near = {1, 12, 21, 31}, {i: set() for i in parents}
    for i, ps in parents.items():
        for p in ps:
            near[i].add(p)
            near[p].add(i)
    expected = {}
    for i in parents:
        seen, front, expected[i] = {i}, {i}, []
        while front:
            front = {y for x in front for y in near[x]} - seen
            seen |= front
            expected[i] += sorted(front & valid)
    assert expected[12][:2] == [21, 1]
    r = spark.createDataFrame(list(parents.items()), "id long, parents array<long>")
    got = {x.id: x.relatives for x in lineage.relatives(r, spark.createDataFrame([(i,) for i in valid], "id long")).collect()}
    assert got == {i: x[:2] for i, x in expected.items()}


def test_hashes_within_a_radius_by_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, (60, 4), dtype=np.int64)
    def flipped(h, n):
        bits = np.unpackbits(h.view(np.uint8))
        bits[rng.choice(256, n, replace=False)] ^= 1
        return np.packbits(bits).view(np.int64)
    x = np.array([flipped(base[i % 60], int(rng.integers(0, 6))) for i in range(400)])
    bits = np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(400, -1), axis=1)
    apart = (bits[:, None] != bits[None]).sum(axis=2)
    df = spark.createDataFrame([(i, i % 3 if i < 390 else 100 + i, h.tolist()) for i, h in enumerate(x)] + [(1000, 0, None)], "idx int, id int, phash array<long>")
    for limit in (0, 2, 7):
        every = {(i, j, int(apart[i, j])) for i in range(400) for j in range(i + 1, 400) if apart[i, j] <= limit}
        assert rows(neighbours.near_hashes(df, limit, "idx")) == every
        mine = {(i % 3, i, j, n) for i, j, n in every if i % 3 == j % 3 and j < 390}
        assert rows(neighbours.hash_pairs(df, limit)) == mine
        monkeypatch.setattr(neighbours, "SMALL_GROUP", 1000)
        assert rows(neighbours.hash_pairs(df, limit)) == mine
        monkeypatch.setattr(neighbours, "SMALL_GROUP", 16)


@pytest.mark.parametrize("words, limit", [(1, 12), (2, 20)])
def test_hashes_within_a_large_radius_by_tiles(spark, monkeypatch, words, limit):
    """Where blocks of bits are short, no join on them meets most pairs: all different hashes are compared by tiles, copies and all."""
    def joined(*_):
        raise AssertionError("joined on short blocks")

    monkeypatch.setattr(neighbours, "hash_candidates", joined)
    monkeypatch.setattr(neighbours, "TILE", 40)
    rng = np.random.default_rng(6)
    x = rng.integers(-(1 << 63), (1 << 63) - 1, (230, words), dtype=np.int64)
    x[30:60], x[60:90, 0] = x[:1], x[:30, 0] ^ rng.integers(0, 4096, 30)
    bits = np.unpackbits(x.view(np.uint8).reshape(230, -1), axis=1)
    apart = (bits[:, None] != bits[None]).sum(axis=2)
    df = spark.createDataFrame([(i, h.tolist()) for i, h in enumerate(x)] + [(1000, None)], "idx int, phash array<long>").repartition(3)
    every = {(i, j, int(apart[i, j])) for i in range(230) for j in range(i + 1, 230) if apart[i, j] <= limit}
    assert len(every) > 400 and rows(neighbours.near_hashes(df, limit, "idx")) == every
    monkeypatch.undo()
    assert neighbours.near_hashes(df.filter("idx = 1000"), limit, "idx").count() == 0


def test_a_group_of_many_hashes_meets_few_pairs(spark):
    """100,000 hashes of one group: of five thousand million pairs some thousand meet."""
    n = 100_000
    word = lambda i: F.xxhash64(F.lit(i), F.col("id"))
    df = spark.range(n).select(F.col("id").cast("int").alias("idx"), F.lit(1).alias("id"), F.array(*(F.when(F.col("id") % 100 == 1, F.xxhash64(F.lit(i), F.col("id") - 1)).otherwise(word(i)) for i in range(3)), F.when(F.col("id") % 100 == 1, F.xxhash64(F.lit(3), F.col("id") - 1).bitwiseXOR(F.lit(5))).otherwise(word(3))).alias("phash"))
    candidates = neighbours.hash_candidates(df, 2, ["id"], "idx", "phash").count()
    assert rows(neighbours.hash_pairs(df, 2)) == {(1, i, i + 1, 2) for i in range(0, n, 100)}
    assert candidates < 2 * n // 100


def searched(parents, valid, wanted=2):
    """Nearest valid rules by a search from each rule."""
    near = {i: set() for i in parents}
    for i, ps in parents.items():
        for p in ps:
            near[i].add(p)
            near[p].add(i)
    out = {}
    for i in parents:
        seen, front, found = {i}, {i}, []
        while front and len(found) < wanted:
            front = {y for x in front for y in near[x]} - seen
            seen |= front
            found += sorted(front & valid)
        out[i] = found[:wanted]
    return out


def test_relatives_over_a_long_chain_take_few_rounds(spark, monkeypatch):
    """4,096 steps with valid rules at the ends alone, and a random graph."""
    rounds = []
    monkeypatch.setattr(lineage, "contracted", lambda g, v, f=lineage.contracted: rounds.append(f(g, v)) or rounds[-1])
    rng = np.random.default_rng(3)
    parents = {i: [i - 1] if i else [] for i in range(4096)} | {10_000 + i: sorted({10_000 + int(x) for x in rng.integers(max(0, i - 9), i, rng.integers(0, 3))}) if i else [] for i in range(300)}
    valid = {0, 4095, *(10_000 + int(x) for x in rng.choice(300, 12, replace=False))}
    r = spark.createDataFrame(list(parents.items()), "id long, parents array<long>")
    got = {x.id: x.relatives for x in lineage.relatives(r, spark.createDataFrame([(i,) for i in valid], "id long")).collect()}
    assert got[2048] == [4095, 0] and got[0] == [4095]
    assert got == searched(parents, valid)
    core, removed = rounds[0]
    assert len(removed) <= 22 and core.count() < 700


def test_relatives_and_ten_options_send_no_table_to_the_driver(spark, monkeypatch):
    """However small the files, tables that grow with the rules aren't broadcast."""
    plans = []
    shown = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(lineage, "materialize", lambda df, f=lineage.materialize: shown(df) or f(df))
    g = groups(spark)
    rules = spark.createDataFrame([(i, [i - 1] if i else []) for i in range(30)], "id long, parents array<long>")
    ten = assemble.ten_options(g, lineage.relatives(rules, rules.filter("id % 4 = 0")))
    shown(ten)
    assert ten.count() == 30
    assert sum("SortMergeJoin" in p for p in plans) > 5 and not any("Broadcast" in p for p in plans)


def groups(spark):
    return spark.createDataFrame([(i, [f"{i}c{k}" for k in range(5)], [f"{i}w{k}" for k in range(3)]) for i in range(30)] + [(99, ["a"], ["b"])], "id long, correct array<string>, incorrect array<string>")


def test_assembly(spark):
    g = groups(spark)
    four = assemble.four_options(g).collect()
    assert len(four) == 30 and len({r.correct_answer for r in four}) == 4
    for r in four:
        assert r.options[r.correct_answer] == f"{r.id}c4" and sorted(r.options) == LETTERS[:4] and set(r.options.values()) == {f"{r.id}c4", *(f"{r.id}w{k}" for k in range(3))} and len(r.question) == 4
    assert {r.correct_answer for r in assemble.four_options(g, compat=True).collect()} == {"A"}
    variants = assemble.four_variants(g).collect()
    assert len(variants) == 120
    for r in variants:
        i, c = r.id.split("_")
        assert r.correct_answer == c and r.options[c] == f"{i}c4" and len(set(r.options.values())) == 4
    rel = spark.createDataFrame([(0, [1, 2]), (1, [2]), (2, [1, 99]), (3, [4, 5])], "id long, relatives array<long>")
    ten = {r.id: r for r in assemble.ten_options(g, rel).collect()}
    assert set(ten) == {0, 3}
    assert ten[0].options[ten[0].correct_answer] == "0c4" and sorted(ten[0].options.values()) == sorted(["0c4", *(f"{i}w{k}" for i in (0, 1, 2) for k in range(3))])


def test_evolution_invariants(spark):
    seeds = spark.createDataFrame([(i, [f"r{i}", f"s{i}"], "t" + str(i % 3), "k") for i in range(40)] + [(40, ["lone"], "t9", "k")], "id long, rule_content array<string>, question_type string, knowledge_point string")
    saved = []
    out = evolve.evolve(seeds, evolve.Settings(generations=3, seed=3), on_generation=lambda g, p, c: saved.append((g, p.count(), c.count()))).collect()
    ids = [r.id for r in out]
    assert len(ids) == len(set(ids)) == max(ids) + 1
    by = {r.id: r for r in out}
    assert [g for g, *_ in saved] == [1, 2, 3] and all(n > 0 for _, _, n in saved)
    for r in out:
        assert all(p in by and by[p].generation < r.generation for p in r.parents)
        if r.creation_method.startswith("simulated"):
            assert r.ancestry_depth == 1 + max(by[p].ancestry_depth for p in r.parents) and r.rule_content[0].startswith("Combined rule")
    # islands follow the tags of the seeds
    tags = {(r.question_type, r.knowledge_point): r.island_id for r in out if r.generation == 0}
    assert all(r.island_id == tags[r.question_type, r.knowledge_point] for r in out if r.creation_method.startswith("simulated"))
    share = sum(r.mutated for r in out) / sum(r.generation > 0 for r in out)
    assert 0.03 < share < 0.35


def test_slots_are_dealt_and_candidates_sorted_once(spark, monkeypatch):
    """One group's slots go over several tasks, and both parents share the sorts of the candidates."""
    made = evolve.slots(spark.createDataFrame([(0, 20_500), (1, 1)], "g int, k int"), "g", "k")
    parts = made.rdd.map(tuple).glom().collect()
    assert sum(len(p) > 0 for p in parts) >= 3 and max(map(len, parts)) < 20_000
    assert sorted(x for p in parts for x in p) == [*((0, i) for i in range(1, 20_501)), (1, 1)]
    sorts = []
    monkeypatch.setattr(keyed, "_sorted", lambda *a, f=keyed._sorted: sorts.append(a) or f(*a))
    seeds = spark.createDataFrame([(i, [f"r{i}"], "t" + str(i % 2), "k") for i in range(16)], "id long, rule_content array<string>, question_type string, knowledge_point string")
    population, tags = evolve.seeded(seeds)
    sorts.clear()
    assert evolve.next_generation(population, tags, 1, evolve.Settings(), 16)[1].count() > 0
    assert len(sorts) == 5  # elites, unused candidates, all candidates, children, lone rules


def test_a_share_of_draws_by_digits(spark):
    shares = [-1.0, 0.0, 2.0**-33, 0.15, 0.5, 0.7, 1 - 2.0**-33, 1.0, 2.0]
    row = spark.range(500).select(*(F.count_if(keyed.below(x, 7, "b", F.col("id")) != (keyed.u(7, "b", F.col("id")) < x)).alias(f"c{i}") for i, x in enumerate(shares))).first()
    assert not any(row)


def test_evolution_goes_on_from_a_saved_generation(spark):
    seeds = spark.createDataFrame([(i, [f"r{i}"], "t" + str(i % 2), "k") for i in range(16)], "id long, rule_content array<string>, question_type string, knowledge_point string")
    saved = {}
    whole = evolve.evolve(seeds, evolve.Settings(generations=2), on_generation=lambda g, p, c: saved.update({g: (p, c)}))
    every = evolve.seeded(seeds)[0].unionByName(saved[1][1])
    again = evolve.evolve(seeds, evolve.Settings(generations=2), done=(1, saved[1][0], every))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, whole.collect()))


def test_migration_moves_few_and_one_island_stays(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(200, 2)], "id long, island_id int")
    after = {r.id: r.island_id for r in evolve.migrated(df, 1, 3).collect()}
    moved = [i for i, isl in after.items() if isl != (2 if i == 200 else i % 2)]
    assert len(after) == 101 and len(moved) == 5 and 200 in moved
    alone = df.filter("island_id = 0")
    assert {r.island_id for r in evolve.migrated(alone, 1, 3).collect()} == {0}
    # An island that lost all its rules can get some again.
    every = spark.createDataFrame([(i,) for i in range(4)], "island_id int")
    for seed in range(8):
        after = {r.id: r.island_id for r in evolve.migrated(df, seed, 3, islands=every).collect()}
        moved = {i: isl for i, isl in after.items() if isl != (2 if i == 200 else i % 2)}
        assert len(moved) == 5 and len({moved[i] for i in moved if i % 2 and i != 200}) == 1
        if 3 in moved.values():
            break
    else:
        raise AssertionError("no rule reached the empty island")


def test_providers(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id long, prompt string")
    ok = providers.ask(df, providers.Offline(("a", "b"))).collect()
    assert all(r.error is None and "<a>" in r.response for r in ok)

    class Broken:
        def __call__(self, prompt):
            if prompt == "p3":
                raise ValueError("no")
            return "x"

    got = {r.id: (r.response, r.error) for r in providers.ask(df, Broken()).collect()}
    assert got[3] == (None, "ValueError: no") and got[2] == ("x", None)

    waits, calls = [], []

    def limited(prompt):
        calls.append(prompt)
        if len(calls) < 4:
            raise providers.RateLimited
        return "late"

    assert providers.Retry(base=1, factor=2, most=3, sleep=waits.append).call(limited, "x") == "late" and waits == [1, 2, 3]


def test_calls_in_parts_go_on_where_they_broke_off(spark, tmp_path):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "id long, prompt string")
    log, schema = str(tmp_path / "log"), "id long, prompt string, response string, error string"
    first = providers.ask_in_parts(df.filter("id < 10"), providers.Offline(), log, schema, every=4)
    assert first.count() == 10
    every = providers.ask_in_parts(df, providers.Offline(), log, schema, every=7, at_once=3).collect()
    assert {r.id: r.response for r in every} == {i: providers.Offline()(f"p{i}") for i in range(40)}
    from ruleforge.sources import json_io

    assert json_io.read_lines(spark, log, schema).count() == 40  # none was asked for twice
    failed = providers.ask(df.limit(3), Broken(), parse=lambda a: None)
    got = providers.or_simulated(failed, F.concat(F.lit("made "), "prompt")).collect()
    assert all(r.is_simulated and r.response == f"made {r.prompt}" for r in got)


class Broken:
    def __call__(self, prompt):
        raise ValueError("no")


def test_batches_have_a_limit_of_open_ones(spark):
    seen, open_ = [], set()

    def submit(rows, number):
        open_.add(number)
        seen.append(len(open_))
        return [number, rows, 2]

    def poll(handle):
        handle[2] -= 1
        if handle[2]:
            return None
        open_.discard(handle[0])
        return handle[1].select("id", "batch")

    requests = spark.createDataFrame([(100 + i, i) for i in range(23)], "id long, pos long")
    waits = []
    got = providers.run_batches(requests, submit, poll, size=4, active=2, sleep=waits.append).collect()
    assert sorted(r.id for r in got) == list(range(100, 123)) and max(seen) == 2 and len(seen) == 6 and waits


class Runner:
    def __call__(self, path):
        if path == "slow":
            raise TimeoutError
        return {"ok": "SUCCESS: 8 images", "bad": "error", "none": None}[path]


def test_script_runner(spark):
    df = spark.createDataFrame([(p,) for p in ("ok", "bad", "none", "slow", "unknown")], "path string")
    assert {r.path: r.status for r in providers.run_scripts(df, Runner()).collect()} == {"ok": "success", "bad": "fail", "none": "fail - no result", "slow": "fail - timeout", "unknown": "fail"}


def test_judged_loses_no_request(spark):
    requests = spark.createDataFrame([(i,) for i in range(10)], "id long")

    def submit(left, n):
        good = F.col("id") % 3 < n
        return left.select("id", F.lit("req").alias("custom_id"), F.when(good & (F.col("id") != 8), 200).otherwise(500).alias("status_code"), F.lit(None).cast("string").alias("error"), F.lit("fine").alias("content"))

    got = {r.id: r.error for r in providers.judged(requests, submit, most=3).collect()}
    assert got == {i: ("attempts exhausted" if i == 8 else None) for i in range(10)}


def test_attempts_and_statuses(spark):
    def once(ids, n):
        return ids.select("id", (F.col("id") <= n).alias("ok"))

    got = sorted((r.id, r.attempt, r.ok) for r in providers.attempts(spark.createDataFrame([(1,), (3,), (9,)], "id long"), once).collect())
    assert got == [(1, 1, True), (3, 1, False), (3, 2, False), (3, 3, True), (9, 1, False), (9, 2, False), (9, 3, False), (9, 4, False)]
    m = spark.createDataFrame([(1, 1, "Test success"), (1, 2, "fail - timeout"), (2, 1, None), (3, 1, "fail")], "id long, attempt int, test_result string")
    assert {r.status for r in providers.recorded_status(m).collect()} == {"success", "fail - timeout", "fail - no result", "fail"}


def test_embeddings_are_unit_and_stable(spark):
    df = spark.createDataFrame([("a b c",), ("a b c",), (None,)], "text string")
    got = [r.embedding for r in providers.embedded(df).collect()]
    assert got[0] == got[1] and abs(sum(x * x for x in got[0]) - 1) < 1e-5 and set(got[2]) == {0.0}
