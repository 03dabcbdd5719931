import pyarrow as pa
import pytest
import json

import pytest
from pyspark.sql import functions as F

from ruleforge.sources import checkpoints, directory, files, json_io
from ruleforge.streaming.resume import run_available

SCHEMA = "id long, name string, tags array<string>"


def test_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 2, "name": "é\n", "tags": ["x"]}, {"id": 1}], ensure_ascii=False, indent=2))
    got = json_io.read_array(spark, str(tmp_path / "a.json"), SCHEMA).collect()
    assert [(r.pos, r.id, r.name, r.tags) for r in sorted(got)] == [(0, 2, "é\n", ["x"]), (1, 1, None, None)]
    (tmp_path / "o.json").write_text('{"id": 7}')
    assert [r.id for r in json_io.read_array(spark, str(tmp_path / "o.json"), SCHEMA).collect()] == [7]
    (tmp_path / "bad.json").write_text("[{")
    assert json_io.read_array(spark, str(tmp_path / "bad.json"), SCHEMA).filter("id is not null").count() == 0
    with pytest.raises(Exception):
        json_io.read_array(spark, str(tmp_path / "bad.json"), SCHEMA, strict=True).collect()
    out = str(tmp_path / "out")
    json_io.write_array(spark.createDataFrame([(3, "c"), (1, "a")], "id long, name string"), out, "id")
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert json.loads(text) == [{"id": 1, "name": "a"}, {"id": 3, "name": "c"}]


def test_lines_and_resume(spark, tmp_path):
    path = str(tmp_path / "log")
    assert json_io.resumed(spark, path, "id long, v string").count() == 0
    json_io.append_lines(spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "id long, v string, pos long"), path)
    json_io.append_lines(spark.createDataFrame([(1, "c", 2)], "id long, v string, pos long"), path)
    assert {tuple(r) for r in json_io.resumed(spark, path, "id long, v string, pos long", pos="pos").select("id", "v").collect()} == {(1, "c"), (2, "b")}
    again = str(tmp_path / "again")
    for v in ("c", "b", "a"):
        json_io.append_lines(spark.createDataFrame([(1, v), (2, v), (None, v)] if v != "a" else [(1, v)], "id long, v string").repartition(2), again, json_io.last_run(spark, again) + 1)
    assert {tuple(r) for r in json_io.resumed(spark, again, "id long, v string").collect()} == {(1, "a"), (2, "b")} and json_io.last_run(spark, again) == 2
    (tmp_path / "w_1.jsonl").write_text('{"id": 1}\nbroken\n{"id": 2}\n')
    (tmp_path / "w_2.jsonl").write_text('{"id": 3}\n')
    assert {r.id for r in json_io.read_lines(spark, str(tmp_path / "w_*.jsonl"), "id long").collect()} == {1, 2, 3}
    with pytest.raises(Exception):
        json_io.read_lines(spark, str(tmp_path / "w_*.jsonl"), "id long", tolerant=False).collect()
    json_io.write_sorted(spark.createDataFrame([(2,), (1,)], "id long"), str(tmp_path / "sorted"), "id")
    assert "".join(p.read_text() for p in sorted((tmp_path / "sorted").glob("part-*"))).split() == ['{"id":1}', '{"id":2}']


def test_seed_questions(spark):
    raw = spark.createDataFrame([(1, "p", '{"A": "x"}', ["i.png", "j.png"], None, "A"), (2, "p", "bad", [], "e", "B"), (None, "p", None, None, None, None)], "id long, prompt string, options string, images array<string>, explanation string, correct_answer string")
    got = {r.id: r for r in json_io.seed_questions(raw).collect()}
    assert set(got) == {1, 2} and got[1].image == "i.png" and got[1].has_image and got[2].options == {} and not got[2].has_image


def test_attempt_folders(spark, tmp_path):
    for name in ("3_1/output_correct/b.png", "3_1/output_correct/a.png", "3_1/output_incorrect/c.jpg", "3_2/output_correct/d.gif", "x_1/output_correct/e.png"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"img")
    (tmp_path / "3_1/test_result.txt").write_text("Success")
    m = directory.manifest(spark, str(tmp_path))
    assert {(r.id, r.attempt, r.kind, r.test_result) for r in m.collect()} == {(3, 1, "output_correct", "Success"), (3, 1, "output_incorrect", "Success"), (3, 2, "output_correct", None)}
    g = {(r.id, r.attempt): [p.rsplit("/", 1)[1] for p in r.images] for r in directory.image_groups(m, total=None).collect()}
    assert g == {(3, 1): ["a.png", "b.png", "c.jpg"]}
    assert directory.image_groups(m, total=8).count() == 0
    urls = directory.files(spark, str(tmp_path), content=True).filter("name = 'c.jpg'").select(directory.data_url(F.col("path"), F.col("content"))).first()[0]
    assert urls == "data:image/jpeg;base64,aW1n"
    df = spark.createDataFrame([(1, "no.png", "yes.png"), (2, "x", "y")], "id long, a string, b string")
    found = directory.first_existing(df, spark.createDataFrame([("yes.png",)], "path string"), F.col("a"), F.col("b"))
    assert {r.id: r.found for r in found.collect()} == {1: "yes.png", 2: None}


def test_checkpoints(spark, tmp_path):
    folder = str(tmp_path / "run")
    assert checkpoints.restore(spark, folder) is None
    rules = spark.createDataFrame([(i, i % 2) for i in range(6)], "id long, island_id int")
    for g in (1, 2, 3):
        checkpoints.save(folder, g, rules.limit(g), rules.limit(1))
    assert [r.generation for r in checkpoints.listed(spark.read.parquet(folder + "/manifest")).collect()] == [3, 2, 1]
    import shutil

    shutil.rmtree(tmp_path / "run/generation=3/population")
    g, df = checkpoints.restore(spark, folder)
    assert g == 2 and df.count() == 2
    assert checkpoints.restore(spark, folder, 1)[1].count() == 1
    checkpoints.export_islands(rules, str(tmp_path / "islands"))
    assert sorted(p.name for p in (tmp_path / "islands").glob("island_id=*")) == ["island_id=0", "island_id=1"]
    checkpoints.export_document(rules, str(tmp_path / "document"))
    doc = json.loads("".join(p.read_text() for p in sorted((tmp_path / "document").glob("part-*"))))
    assert (doc["total_rules"], doc["n_islands"]) == (6, 2) and [(i["island_id"], i["size"], len(i["rules"])) for i in doc["islands"]] == [(0, 3, 3), (1, 3, 3)]
    checkpoints.export_document(rules.limit(0), str(tmp_path / "none"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == {"total_rules": 0, "n_islands": 0, "islands": []}


def test_streaming_resume(spark, tmp_path):
    src, log, ck = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "ck")
    src.mkdir()
    (src / "1.json").write_text('{"id": 1}\n{"id": 2}\n{"id": 2}\n')
    calls = []

    def process(items):
        calls.append(items.count())
        return items.withColumn("answer", F.col("id") * 10)

    go = lambda: run_available(spark, str(src), "id long", log, "id long, answer long", ck, process)
    go()
    (src / "2.json").write_text('{"id": 2}\n{"id": 3}\n')
    go()
    go()
    assert sorted((r.id, r.answer) for r in spark.read.json(log).collect()) == [(1, 10), (2, 20), (3, 30)] and sum(calls) == 3


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a/1.png", bytearray(b"one")), ("b.png", None)], "path string, content binary")
    assert {(r.path, r.error is None) for r in files.write_files(df, str(tmp_path)).collect()} == {("a/1.png", True), ("b.png", False)}
    assert (tmp_path / "a/1.png").read_bytes() == b"one"
    moves = spark.createDataFrame([("x/2.png", "/no/such", str(tmp_path / "a/1.png")), ("y.png", None, "/none")], "target string, p string, q string")
    got = {r.target: (r.source, r.error) for r in files.copy_files(moves, str(tmp_path), ["p", "q"]).collect()}
    assert got == {"x/2.png": (str(tmp_path / "a/1.png"), None), "y.png": (None, "no source")} and (tmp_path / "x/2.png").read_bytes() == b"one"


def visible(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and not str(p.relative_to(folder)).startswith("_"))


def test_a_task_that_runs_twice_leaves_one_copy(tmp_path):
    """Two attempts of a part, of which Spark commits one; what the other left goes."""
    import pyarrow as pa

    batch = lambda text: pa.RecordBatch.from_pydict({"path": ["a/x", "b"], "content": [text, text], "sources": [None, None]}, pa.schema([("path", pa.string()), ("content", pa.binary()), ("sources", pa.list_(pa.string()))]))
    writer = files.FileWriter(str(tmp_path), "job")
    writer.write(iter([batch(b"lost")]))
    kept = writer.write(iter([batch(b"kept")]))
    assert not any(p.startswith("a/") for p in visible(tmp_path))
    writer.commit([kept, None])
    assert visible(tmp_path) == ["a/x", "b"] and (tmp_path / "a/x").read_bytes() == b"kept"
    other = files.FileWriter(str(tmp_path), "other")
    other.write(iter([batch(b"new")]))
    other.abort([None])
    assert visible(tmp_path) == ["a/x", "b"] and (tmp_path / "b").read_bytes() == b"kept"


def test_nothing_is_visible_after_a_failure(spark, tmp_path):
    fails = F.when(F.col("id") == 90, F.raise_error(F.lit("broken row"))).otherwise(F.lit("x"))
    df = spark.range(100).repartition(4).select(F.concat(F.lit("f/"), "id").alias("path"), fails.cast("binary").alias("content"))
    with pytest.raises(Exception, match="broken row"):
        files.write_files(df, str(tmp_path))
    assert visible(tmp_path) == []
    good = df.filter("path != 'f/90'").unionByName(spark.createDataFrame([("../out", bytearray(b"x")), (None, bytearray(b"x")), ("/abs", bytearray(b"x"))], "path string, content binary"))
    said = files.write_files(good, f"file://{tmp_path}")
    assert said.count() == 102 and said.filter("error is not null").count() == 3 and said.count() == 102
    assert len(visible(tmp_path)) == 99 and not (tmp_path.parent / "out").exists()


def test_a_batch_costs_what_its_items_cost(spark, tmp_path, monkeypatch):
    """Of five micro-batches of a run the first alone reads the log; keys of an older log and keys that come again are known."""
    from ruleforge.streaming import resume

    src, log, ck = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "ck")
    src.mkdir()
    json_io.append_lines(spark.createDataFrame([(3, 30), (11, 110)], "id long, answer long"), log)
    for i in range(5):
        (src / f"{i}.json").write_text("".join(f'{{"id": {k}}}\n' for k in (3 * i, 3 * i + 1, 3 * i + 2, 1)))
    reads, sizes = [], []
    monkeypatch.setattr(resume, "resumed", lambda *a, f=resume.resumed: reads.append(1) or f(*a))

    def process(items):
        sizes.append(items.count())
        return items.withColumn("answer", F.col("id") * 10)

    go = lambda: resume.run_available(spark, str(src), "id long", log, "id long, answer long", ck, process, files=1)
    go()
    assert len(sizes) == 5 and sum(sizes) == 13 and len(reads) == 2  # once for the keys known before, once for the first batch
    (src / "9.json").write_text('{"id": 3}\n{"id": 20}\n')
    go()
    assert sorted((r.id, r.answer) for r in spark.read.json(log).collect()) == [(i, 10 * i) for i in (*range(15), 20)]
    assert len(reads) == 3


def test_a_batch_that_runs_again_adds_nothing_twice(spark, tmp_path):
    from ruleforge.streaming import resume

    src, log, ck = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "ck")
    src.mkdir()
    (src / "a.json").write_text('{"id": 1}\n{"id": 2}\n')

    class Ends(Exception):
        pass

    def broken(items):
        json_io.append_lines(items.limit(1).withColumn("answer", F.lit(5).cast("long")), log, 0)
        raise Ends

    call = lambda process: resume.run_available(spark, str(src), "id long", log, "id long, answer long", ck, process)
    with pytest.raises(Exception, match="Ends"):
        call(broken)
    call(lambda items: items.withColumn("answer", F.lit(7).cast("long")))
    got = sorted((r.id, r.answer) for r in spark.read.json(log).collect())
    assert [i for i, _ in got] == [1, 2] and sorted(a for _, a in got) == [5, 7]


def test_owed_attempts_are_counted_in_state(spark, tmp_path):
    from ruleforge.streaming import resume

    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    parts = [[(1, True), (1, True), (2, True)], [(1, False), (2, False), (2, True), (3, False)], [(1, False), (3, True)], [(4, True)] * 9 + [(4, False)]]

    def run():
        stream = resume.owed_attempts(spark.readStream.schema("id long, done boolean").json(str(src)), 4)
        stream.writeStream.format("json").option("path", out).option("checkpointLocation", f"{out}-ck").outputMode("append").trigger(availableNow=True).start().awaitTermination()

    for i, part in enumerate(parts):
        (src / f"{i}.json").write_text("".join(json.dumps({"id": k, "done": d}) + "\n" for k, d in part))
        run()
    got = sorted((r.id, r.attempt) for r in spark.read.schema("id long, attempt long").json(out).collect())
    assert got == [(1, 3), (1, 4), (2, 3), (2, 4), (3, 1), (3, 2), (3, 3), (3, 4)]


@pytest.mark.parametrize("indent", [None, 0, 3])
def test_arrays_are_read_by_blocks(spark, tmp_path, indent):
    """Whatever the line breaks and wherever a block ends: strings with brackets, quotes and commas, nested values, several documents, parts of one."""
    odd = ['a "b" [', "}, {", "\\", "\\\"", "x\ny", "é,", "", "]"]
    make = lambda n, k: [{"id": i * k, "name": odd[i % len(odd)] * (i % 4 + 1), "tags": [odd[(i + j) % len(odd)] for j in range(i % 3)]} for i in range(n)]
    documents = {"a.json": make(120, 1), "b.json": [], "c.json": make(7, -1), "d.json": {"id": 5, "name": "one {", "tags": None}}
    (tmp_path / "in").mkdir()
    for name, rows in documents.items():
        (tmp_path / "in" / name).write_text(json.dumps(rows, ensure_ascii=False, indent=indent) + "\n\n")
    expected = [(p, r["id"], r["name"], r["tags"]) for rows in documents.values() for p, r in enumerate(rows if isinstance(rows, list) else [rows])]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        for strict in (True, False):
            got = json_io.read_array(spark, str(tmp_path / "in"), SCHEMA, strict)
            assert sorted(map(repr, ((r.pos, r.id, r.name, r.tags) for r in got.collect()))) == sorted(map(repr, expected))
        rows = spark.createDataFrame([(r["id"], r["name"], r["tags"]) for r in documents["a.json"]], SCHEMA).repartition(5)
        json_io.write_array(rows, str(tmp_path / "out"), "id")
        back = json_io.read_array(spark, str(tmp_path / "out"), SCHEMA, strict=True)
        assert sorted(map(repr, ((r.pos, r.id, r.name, r.tags) for r in back.collect()))) == sorted(repr(x) for x in expected[:120])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("most", [0, 100_000])
def test_arrays_move_their_text_once(spark, tmp_path, monkeypatch, most):
    """Of 3,000 elements the one of the greatest key is numbered, all are written once, and those at the edges of blocks meet; blocks are joined either way. Copies and null keys stay."""
    moved = {"numbered": 0, "written": 0}
    texts = {"value", "parts", "text"}

    def counted(kind, f):
        def run(df, *a, **b):
            moved[kind] += df.count() if texts & {*df.columns} or "_json" in df.columns else 0
            return f(df, *a, **b)

        return run

    data = [(i, "x, [" * (i % 5), None) for i in range(2997)] + [(None, "n", ["a"]), (2996, "", None), (2996, "", None)]
    df = spark.createDataFrame(data, SCHEMA)
    monkeypatch.setattr(json_io, "dense_ids", counted("numbered", json_io.dense_ids))
    monkeypatch.setattr(json_io, "materialize", counted("written", json_io.materialize))
    monkeypatch.setattr(json_io, "BLOCKS", most, raising=False)
    json_io.write_array(df, str(tmp_path / "out"), "id")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = json_io.read_array(spark, str(tmp_path / "out"), SCHEMA, strict=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert [(r.id, r.name, r.tags) for r in sorted(got)] == sorted(data, key=key) and [r.pos for r in sorted(got)] == [*range(3000)]
    assert moved["numbered"] == 3 and moved["written"] < 3200


@pytest.mark.parametrize("text", ["[1, 2", "[{}, {]", '[{"id": 1},, {"id": 2}]', '{"id": 1', "nothing", '[{"id": 1}] x'])
def test_broken_arrays(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    assert json_io.read_array(spark, str(tmp_path / "bad.json"), SCHEMA).count() == 0
    with pytest.raises(ValueError, match="no JSON array"):
        json_io.read_array(spark, str(tmp_path / "bad.json"), SCHEMA, strict=True)


def test_a_commit_knows_few_files_at_once(spark, tmp_path, monkeypatch):
    """Files are moved by the tasks' logs, a bounded number at a time, a path that is written twice among them; and read back by their names, in bounded pieces."""
    messages, task = [], files.FileWriter(str(tmp_path), "job")
    table = pa.table({"path": [f"{i % 90}_1/output_correct/{i % 90}.png" for i in range(100)] + ["/out"], "content": [bytes([i]) * 10 for i in range(101)], "sources": pa.nulls(101, pa.list_(pa.string()))})
    messages.append(task.write(iter(table.to_batches())))
    held = []
    monkeypatch.setattr(files, "KNOWN", 16)
    monkeypatch.setattr(files.FileWriter, "_logged", staticmethod(lambda *a, f=files.FileWriter._logged: (held.append(len(x)) or x for x in f(*a))))
    task.commit(messages)
    assert max(held) <= 16 and sum(held) == 100
    paths = spark.createDataFrame([(f"{i}_1/output_correct/{i}.png",) for i in range(90)], "path string").repartition(2)
    monkeypatch.setattr(files, "PIECE", 25)
    got = {r.id: (r.content, r.length, r.name, r.attempt, r.kind) for r in directory.known_files(paths, str(tmp_path)).collect()}
    assert got == {i: (bytes([i + 90 if i < 10 else i]) * 10, 10, f"{i}.png", 1, "output_correct") for i in range(90)}
    listed = directory.files(spark, str(tmp_path), content=True)
    assert {r.id: (r.content, r.length, r.name, r.attempt, r.kind) for r in listed.collect()} == got and listed.columns == directory.known_files(paths, str(tmp_path)).columns
