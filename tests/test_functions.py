import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ruleforge.functions import images, keyed, scores, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in zip(values, [type_of(v) for v in values.values()], strict=True))) if values else spark.range(1)
    return row.select(column).first()[0]


def type_of(v):
    return {str: "string", int: "long", float: "double", bool: "boolean", list: "array<string>", dict: "map<string,string>", type(None): "string"}[type(v)]


def s(spark, f, value, *args, **kw):
    return one(spark, f(F.col("x"), *args, **kw), x=value)


def test_tags(spark):
    assert s(spark, text.tag_text, "a <r> one\ntwo </r> <r>b</r>", "r") == "one\ntwo"
    assert s(spark, text.tag_text, " whole ", "r", default=None) == "whole"
    assert s(spark, text.tag_text, "none", "r") == "" and s(spark, text.tag_text, None, "r") == ""
    assert s(spark, text.required_tags, "<a>1</a>", "a", "b") is None
    assert s(spark, text.required_tags, "<a>1</a><b> 2</b>", "a", "b").asDict() == {"a": "1", "b": "2"}
    assert s(spark, text.strip, "\u2003 x\t\n") == "x"


def test_bullets(spark):
    assert s(spark, text.bullets, "- a\n\n -- b -\n-\n c") == ["a", "b -", "c"]
    assert s(spark, text.numbered_bullets, "1. a\n# h\n(x)\n- 2.5 b\n 3.\nc") == ["a", "b", "c"]
    assert s(spark, text.bullets, None) == []


def test_scores(spark):
    assert s(spark, text.int_tag, "<FORMAT> 5 </Format>", "format") == 5 and s(spark, text.int_tag, "<format>123</format>", "format") is None
    assert s(spark, text.int_tags, "<a>1</a><b>x</b>", "a", "b") is None
    assert s(spark, text.labelled_score, "Readability:  4", "Readability") == 4 and s(spark, text.labelled_score, "no", "Readability") is None
    assert s(spark, text.boxed, "so \\boxed{ B } \\boxed{C}") == "B" and s(spark, text.boxed, "\\boxed{}") == "" and s(spark, text.boxed, "none") is None and s(spark, text.boxed, "\\boxed{a\nb}") is None


def test_ids_and_paths(spark):
    assert tuple(s(spark, text.id_attempt, "12_3")) == (12, 3) and s(spark, text.id_attempt, "12_x") is None
    assert s(spark, text.prefix_key, "12_A") == 12 and s(spark, text.prefix_key, "x_A") is None and s(spark, text.prefix_key, "7") == 7
    assert s(spark, text.extension, "a.b/c.d.png") == ".png" and s(spark, text.extension, "a.b/c") == "" and s(spark, text.base_name, "a/b.c") == "b.c"
    assert one(spark, text.renamed_image(F.lit(7), F.col("x")), x="dir/old") == "image_7.png"
    assert s(spark, text.mime_type, "a.JPG") == "image/jpeg" and s(spark, text.mime_type, "a.x") == "image/png"
    assert s(spark, text.absolute_path, "a/b", "/r/") == "/r/a/b" and s(spark, text.absolute_path, "/a", "/r") == "/a"
    assert s(spark, text.is_success, "Test SUCCESS") and not s(spark, text.is_success, None)


def test_options_and_templates(spark):
    m = {"A": "x", "B": "y"}
    assert one(spark, text.options_block(F.col("x")), x=m) == "A: x\nB: y" and one(spark, text.options_block(F.col("x"), True), x=m) == '"A": "x"\n"B": "y"'
    assert s(spark, text.parsed_options, "not json") == {} and s(spark, text.parsed_options, '{"A": 1}') == {"A": "1"}
    assert one(spark, text.rule_block(F.col("x")), x=["a", "b"]) == "\n- a\n- b"
    assert one(spark, text.rendered("{{q}} {q} {z} $1", q=F.col("x")), x="a$1\\") == "a$1\\ a$1\\ {z} $1"
    parts = one(spark, text.content_parts(F.col("x"), "<img>", F.lit("data")), x="before <img> after")
    assert [(p.type, p.text, p.data) for p in parts] == [("text", "before ", None), ("image", None, "data"), ("text", " after", None)]
    alone = one(spark, text.content_parts(F.col("x"), "<img>", F.lit(None).cast("string")), x="a<img>b")
    assert [(p.type, p.text) for p in alone] == [("text", "ab")]
    assert one(spark, text.all_given(F.col("x"), F.col("y")), x="a", y="") is False
    assert [one(spark, text.duration(F.col("x")), x=v) for v in (5.0, 65.0, 3661.0)] == ["5s", "1m 5s", "1h 1m 1s"]
    assert "question" in one(spark, text.chat_prompt(F.col("x"), "be brief"), x="question")


def test_dense_ids_are_a_bijection_in_order(spark):
    rows = [(i * 37 % 1009, i % 3) for i in range(1009)]
    df = spark.createDataFrame(rows, "pos long, grp long")
    got = sorted((r.pos, r.new_id) for r in keyed.dense_ids(df, "pos").collect())
    assert [n for _, n in got] == list(range(1009))
    for g in range(3):
        mine = sorted((r.pos, r.new_id) for r in keyed.dense_ids(df, "pos", by=("grp",)).collect() if r.grp == g)
        assert [n for _, n in mine] == list(range(len(mine)))
    ties = keyed.dense_ids(spark.createDataFrame([(1, b) for b in "dbca"], "pos long, b string"), "pos", ties=("b",), start=5)
    assert sorted((r.b, r.new_id) for r in ties.collect()) == [("a", 5), ("b", 6), ("c", 7), ("d", 8)]
    assert keyed.dense_ids(df.limit(0), "pos").count() == 0


def test_dense_ids_of_nulls_ties_and_one_value(spark):
    rows = [(None, i % 5, i % 2) for i in range(40)] + [(i % 4, i, None) for i in range(60)] + [(7, 7, 0)] * 3
    df = spark.createDataFrame(rows, "pos int, t int, grp int").repartition(6)
    got = keyed.dense_ids(df, "pos", by=("grp",), ties=("t",)).collect()
    assert len(got) == len(rows)
    for g in (None, 0, 1):
        mine = sorted((r.new_id, r.pos is not None, r.pos or 0, r.t) for r in got if r.grp == g)
        assert [n for n, *_ in mine] == list(range(len(mine))) and [x[1:] for x in mine] == sorted(x[1:] for x in mine)
    sums = keyed.running_sums(df, "pos", "t", "s", by=("grp",), ties=("t",)).collect()
    assert max(r.s for r in sums if r.grp is None) == sum(t for _, t, g in rows if g is None)


def test_ranges_follow_the_size(spark):
    """One group of one order value is dealt over as many ranges as its size asks for, each of about the same rows."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ranges = []
        for n in (1_000, 20_000, 80_000):
            df = spark.range(n).select("id", F.lit(1).alias("g"), F.lit(0).alias("pos"))
            sizes = [r["count"] for r in keyed._sorted(df, "pos", ("g",), ("id",)).groupBy("__range").count().collect()]
            assert sum(sizes) == n and max(sizes) < 4 * n / len(sizes)
            ranges.append(len(sizes))
            ids = keyed.dense_ids(df, "pos", by=("g",), ties=("id",)).filter("id != new_id")
            assert ids.isEmpty()
        assert ranges[0] < ranges[1] < ranges[2]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_wins_and_overlay(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 5, "c")], "id long, pos long, v string")
    assert {(r.id, r.v) for r in keyed.last_wins(df, "id").collect()} == {(1, "b"), (2, "c")}
    assert {(r.id, r.v) for r in keyed.first_wins(df, "id").collect()} == {(1, "a"), (2, "c")}
    right = spark.createDataFrame([(1, "new", 9), (2, None, 8)], "id long, v string, w long")
    assert {tuple(r) for r in keyed.overlay(df, right, "id").select("id", "pos", "v", "w").collect()} == {(1, 0, "new", 9), (1, 1, "new", 9), (2, 5, "c", 8)}
    assert keyed.renamed(df, {"id": "key", "gone": "x"}).columns == ["key"]


def test_uniform_is_uniform(spark):
    v = [r[0] for r in spark.range(2000).select(keyed.u("seed", F.col("id"))).collect()]
    assert 0 <= min(v) and max(v) < 1 and abs(np.mean(v) - 0.5) < 0.03


def test_numbers(spark):
    f = one(spark, scores.fitness(F.lit(0), F.lit(9), F.lit(True), F.lit(0.5)))
    assert math.isclose(f, (0.4 + 0.4 + 0.2) * 1.1)
    assert one(spark, scores.elite_count(F.lit(5))) == 1 and one(spark, scores.offspring_count(F.lit(10))) == 11 and one(spark, scores.child_depth(F.lit(2), F.lit(None).cast("int"))) == 3
    assert one(spark, scores.squared_distance(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(1.0), F.lit(4.0)))) == 4.0
    assert one(spark, scores.hamming(F.array(F.lit(5).cast("long"), F.lit(-1).cast("long")), F.array(F.lit(6).cast("long"), F.lit(-1).cast("long")))) == 2
    assert one(spark, scores.sign_bits(F.array(F.lit(1.0), F.lit(-1.0), F.lit(2.0)))) == 5


def test_images():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (120, 90, 3)).astype(np.uint8)
    h = images.phash(x)
    assert len(h) == 4 and h == images.phash(x)
    bits = lambda a, b: sum(bin((p ^ q) & (1 << 64) - 1).count("1") for p, q in zip(a, b, strict=True))
    assert bits(h, images.phash(np.clip(x.astype(int) + 1, 0, 255))) < 20 < bits(h, images.phash(rng.integers(0, 256, (120, 90, 3))))
    white = np.full((50, 50), 255)
    assert images.is_blank(white) and images.is_blank(np.full((9, 9, 4), 0)) and not images.is_blank(x)
    assert math.isclose(images.similarity_to_white(white), 1.0) and images.similarity_to_white(x) < 0.1
    assert np.allclose(images.resized(np.ones((7, 5)), 3, 2), 1.0)


def test_image_column(spark):
    x = np.random.default_rng(1).integers(0, 256, (32, 32)).astype(np.uint8)
    df = spark.createDataFrame([(1, (32, 32, 1, bytearray(x.tobytes()))), (2, (8, 8, 3, bytearray(b"\xff" * 192)))], "id long, pixels struct<h:int,w:int,channels:int,data:binary>")
    got = {r.id: r for r in images.hashed_images(df).collect()}
    assert got[1].phash == images.phash(x) and not got[1].blank and got[2].blank


@pytest.mark.parametrize("w,h,expected", [(100, 50, (80, 40, 0, 20)), (10, 1000, (1, 80, 39, 0))])
def test_fitted(spark, w, h, expected):
    from ruleforge.operators.assemble import canvas, fitted

    got = spark.range(1).select(*(c.alias(str(i)) for i, c in enumerate(fitted(F.lit(w), F.lit(h), F.lit(80), F.lit(80))))).first()
    assert abs(got[0] - expected[0]) <= 0 and tuple(got)[1:] == expected[1:]
    assert tuple(spark.range(1).select(*(c.alias(str(i)) for i, c in enumerate(canvas(F.lit(100), F.lit(10))))).first())[:2] == (520, 485)


def test_sheets_and_png():
    import zlib

    from ruleforge.functions import raster

    rng = np.random.default_rng(0)
    figures = [rng.integers(0, 256, (40 + 10 * i, 60, c)).astype(np.uint8) for i, c in enumerate((3, 4, 3, 4, 3, 3, 3, 3, 3, 3))]
    four, ten = raster.sheet(figures[:4], figures[4:8]), raster.sheet(figures[:4], figures)
    assert four.shape[1] == 800 and ten.shape[1] == 1000 and four.min() < 50 and (four[:5] == 255).all()
    data = raster.png(four)
    assert data[:8] == b"\x89PNG\r\n\x1a\n" and data.endswith(b"IEND\xaeB`\x82")
    at = data.index(b"IDAT")
    raw = np.frombuffer(zlib.decompress(data[at + 4 : at + 4 + int.from_bytes(data[at - 4 : at], "big")]), np.uint8).reshape(four.shape[0], -1)
    assert (raw[:, 1:].reshape(four.shape) == four).all()
    assert (raster.rgb(np.zeros((2, 2, 4))) == 255).all() and raster.rgb(np.zeros((2, 2))).shape == (2, 2, 3)


def test_templates_in_one_pass(spark):
    df = spark.createDataFrame([("has {b} in it", "B", "{{a}}|{b}|{c}")], "a string, b string, t string")
    for template in ("{{a}}|{b}|{c}", F.col("t")):
        assert df.select(text.rendered(template, a=F.col("a"), b=F.col("b"))).first()[0] == "has {b} in it|B|{c}"


def test_similarity_by_window_sums():
    """The same as means and variances of each window, at a cost that doesn't follow the window's area."""
    rng = np.random.default_rng(8)
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    for x in (rng.integers(0, 256, (40, 30)), np.full((16, 16), 254), np.where(np.arange(900).reshape(30, 30) % 97 == 0, 0, 255), rng.integers(250, 256, (16, 12))):
        view = np.lib.stride_tricks.sliding_window_view(images.resized(images.gray(x), 256, 256), (7, 7))
        mean, var = view.mean(axis=(2, 3)), view.var(axis=(2, 3), ddof=1)
        expected = (((2 * mean * 255 + c1) * c2) / ((mean**2 + 255.0**2 + c1) * (var + c2))).mean()
        assert math.isclose(images.similarity_to_white(x), expected, rel_tol=1e-12)
    cells = np.arange(20.0).reshape(4, 5)
    assert images._window_sums(cells, 2).tolist() == [[cells[i : i + 2, j : j + 2].sum() for j in range(4)] for i in range(3)]


def test_rows_of_one_file_are_spread(spark, tmp_path):
    """A small file is read by one task; costly rows of it go to several."""
    from ruleforge.sources.tables import spread

    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert df.rdd.getNumPartitions() == 1 and sum(len(p) > 0 for p in spread(df).rdd.glom().collect()) >= 4


def test_the_bound_of_similarity_to_white_holds():
    """Blank checks stop at a bound from the windows' mean: it is never below the similarity, and equal to it where nothing varies."""
    rng = np.random.default_rng(4)
    for _ in range(60):
        h, w, low = rng.integers(1, 40), rng.integers(1, 40), rng.integers(0, 255)
        x = rng.integers(low, 256, (h, w))
        assert images.most_similarity_to_white(x) >= images.similarity_to_white(x) - 1e-9
        assert images.is_blank(x) == bool(x.std() < images.MIN_DEVIATION or images.similarity_to_white(x) > images.MAX_WHITE)
    flat = np.full((20, 31), 240)
    assert math.isclose(images.most_similarity_to_white(flat), images.similarity_to_white(flat), rel_tol=1e-9)
