"""More operators as queries with their SQL: records, files, prompts, responses, geometry and single steps of the evolution."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import images, raster, scores, sql, text
from ..functions.keyed import u
from ..operators import aggregate, assemble, evolve, inference, ledger, lineage, merge, neighbours, providers, select
from ..sources import checkpoints, directory, files, json_io, remote
from ..sources.tables import scratch, spread, table
from ..streaming.resume import owed_attempts, run_available
from . import templates
from .catalog import _BITS, _PLACED, _hashes, _picked, _r, _u, query


#: Of the orders, the columns that the remote dataset has.
_ORDERS = "o_orderkey long, o_orderstatus string, o_totalprice double"


def _folder(spark) -> str:
    """A scratch folder as executors' file calls see it; on several machines it must be one that all of them mount."""
    return scratch(spark).removeprefix("file://")


@query(f"""WITH p AS ({_PLACED}), part_ AS (SELECT part.*, island_id FROM part JOIN p ON p.id = p_partkey), n AS (SELECT island_id, count(*) AS n FROM p GROUP BY 1),
k AS (SELECT island_id, greatest(0, floor(n * 1.2::DOUBLE)::BIGINT - greatest(1, floor(n * 0.1::DOUBLE)::BIGINT)) AS k FROM n WHERE n > 1),
t AS (SELECT island_id, unnest(range(1, k + 1)) AS slot FROM k), c AS (SELECT island_id, id, 0::BIGINT AS used FROM p),
one AS {_picked("t", "c", "island_id", "slot", "id", "'7'", "'p1'", "'1'")}, two AS {_picked("t", "c", "island_id", "slot", "id", "'7'", "'p2'", "'1'")},
b AS (SELECT row_number() OVER (ORDER BY island_id, slot) + (SELECT max(p_partkey) FROM part) AS id, one.id AS p1, two.id AS p2 FROM one JOIN two USING (island_id, slot)),
g AS (SELECT b.id, CASE WHEN p1 = p2 THEN p1::VARCHAR ELSE p1 || ',' || p2 END AS parents, {_u("'7'", "'mutate'", "'1'", "b.id")} < 0.15::DOUBLE AS mutated, CASE WHEN {_u("'7'", "'type'", "'1'", "b.id")} < 0.5 THEN x.p_type ELSE y.p_type END AS question_type FROM b JOIN part x ON x.p_partkey = p1 JOIN part y ON y.p_partkey = p2),
top AS (SELECT coalesce(max(id), (SELECT max(p_partkey) FROM part)) AS top FROM g), lone AS (SELECT p.id, row_number() OVER (ORDER BY p.id) AS nth FROM p JOIN n USING (island_id) WHERE n = 1)
SELECT id, parents, mutated, question_type, CASE WHEN mutated THEN 'simulated_mutation' ELSE 'simulated_crossover' END AS creation_method, 1 AS ancestry_depth FROM g
UNION ALL SELECT top + nth, lone.id::VARCHAR, false, p_type, 'replicated', 0 FROM lone JOIN part ON p_partkey = lone.id, top""")
def q52_generation(spark, d):
    """All that one generation creates from the parts as seeds: draws of both parents, mutation, tags, new ids, copies of lone rules."""
    rules = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.split("p_name", " ").alias("rule_content"), F.col("p_type").alias("question_type"), F.lit("").alias("knowledge_point"))
    population, tags = evolve.seeded(rules)
    next_id = population.agg(F.max("id")).first()[0] + 1
    created = evolve.next_generation(population, tags, 1, evolve.Settings(), next_id)[1]
    return created.select("id", F.array_join(F.transform("parents", lambda x: x.cast("string")), ",").alias("parents"), "mutated", "question_type", "creation_method", "ancestry_depth")


@query("""WITH p AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'no json' ELSE props END AS o FROM events WHERE event_id % 11 <> 0)
SELECT event_id AS id, CASE WHEN o = 'no json' THEN '' ELSE 'k: ' || json_extract_string(CASE WHEN o = 'no json' THEN '{}' ELSE o END, '$.k') END AS options, event_id % 3 <> 0 AS has_image, CASE WHEN event_id % 3 <> 0 THEN 'images/' || event_id || '.png' END AS image FROM p""")
def q53_seed_questions(spark, d):
    key = F.col("event_id")
    images = F.when(key % 3 != 0, F.array(F.concat(F.lit("images/"), key, F.lit(".png")), F.lit("other.png"))).otherwise(F.array().cast("array<string>"))
    raw = table(spark, d, "events").select(F.when(key % 11 != 0, key).alias("id"), F.lit("p").alias("prompt"), F.when(key % 13 == 0, "no json").otherwise(F.col("props")).alias("options"), images.alias("images"), F.lit("e").alias("explanation"), F.lit("A").alias("correct_answer"))
    return json_io.seed_questions(raw).select("id", text.options_block(F.col("options")).alias("options"), "has_image", "image")


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'held' ELSE 'rest' END AS side FROM documents")
def q54_split(spark, d):
    held, rest = select.split_by(table(spark, d, "documents").select("doc_id", "lang"), F.col("lang") == "en")
    return held.select("doc_id", F.lit("held").alias("side")).unionByName(rest.select("doc_id", F.lit("rest").alias("side")))


def _puzzles(spark, d):
    key = F.col("p_partkey")
    image = F.concat(F.when(key % 4 == 0, "pictures/").otherwise("images/"), key, F.lit(".PNG"))
    return table(spark, d, "part").select(key.alias("id"), F.when(key % 3 == 0, "").otherwise(F.col("p_name")).alias("prompt"), F.create_map(F.lit("A"), F.col("p_brand")).alias("options"), F.when(key % 5 > 0, "A").alias("correct_answer"), image.alias("image"))


@query("SELECT p_partkey AS id, 'images/' || p_partkey || '.PNG' AS image FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 4 <> 0 AND p_partkey % 5 > 0 AND p_size > 10")
def q55_complete_puzzles(spark, d):
    there = table(spark, d, "part").filter("p_size > 10").select(F.concat(F.lit("images/"), "p_partkey", F.lit(".PNG")).alias("path"))
    return select.complete_puzzles(_puzzles(spark, d), there.unionByName(there)).select("id", "image")


@query("SELECT DISTINCT user_id AS id FROM events WHERE user_id % 3 <> 0")
def q56_digit_ids(spark, d):
    key = F.col("user_id")
    return select.digit_ids(table(spark, d, "events").select(F.when(key % 3 == 0, F.concat(F.lit("u"), key)).otherwise(key.cast("string")).alias("id")))


@query("""SELECT p_partkey AS id, '/root/' || i AS absolute, p_partkey || '.PNG' AS name, '.PNG' AS extension, 'image/png' AS mime, 'images/image_' || p_partkey || '.PNG' AS target FROM (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'pictures/' ELSE 'images/' END || p_partkey || '.PNG' AS i FROM part)""")
def q57_image_paths(spark, d):
    rows = select.re_imaged(_puzzles(spark, d))
    image = F.col("image")
    return rows.select("id", text.absolute_path(image, "/root/").alias("absolute"), text.base_name(image).alias("name"), text.extension(image).alias("extension"), text.mime_type(image).alias("mime"), "target")


@query("SELECT count(*) AS total, count(*) FILTER (event_id % 6 > 1) AS success, count(*) FILTER (event_id % 6 <= 1) AS errors, round(count(*) FILTER (event_id % 6 > 1) / count(*), 6) AS ratio FROM events")
def q58_status_counts(spark, d):
    error = F.when(F.col("event_id") % 6 == 0, "timeout").when(F.col("event_id") % 6 == 1, "refused").when(F.col("event_id") % 6 == 2, "")
    return aggregate.status_counts(table(spark, d, "events").select(error.alias("error"))).withColumn("ratio", _r("ratio"))


@query("SELECT CASE WHEN p_size % 4 = 0 THEN 'seed' ELSE 'evolved' END AS kind, count(*) AS n FROM part GROUP BY 1")
def q59_seeds_and_evolved(spark, d):
    rules = table(spark, d, "part").select((F.col("p_size") % 4).alias("generation"))
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count(select.seeds(rules), "seed").unionByName(count(select.evolved(rules), "evolved"))


@query("SELECT doc_id FROM labels WHERE doc_id IN (SELECT item_id FROM benchmark)")
def q60_known(spark, d):
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"))
    return merge.known(table(spark, d, "labels").select("doc_id"), items.unionByName(items), "doc_id")


@query("SELECT event_id AS id, user_id, 'ok' AS content FROM events WHERE event_id % 4 > 0")
def q61_batch_by_id(spark, d):
    key = F.col("event_id")
    answers = table(spark, d, "events").select(F.when(key % 4 == 0, F.concat(F.lit("x-"), key)).otherwise(key.cast("string")).alias("custom_id"), F.lit("ok").alias("content"))
    return merge.by_id(answers, table(spark, d, "events").select(key.alias("id"), "user_id")).select("id", "user_id", "content")


@query("SELECT string_agg(DISTINCT lang, ',' ORDER BY lang) AS question_types, string_agg(DISTINCT source, ',' ORDER BY source) AS knowledge_points, count(DISTINCT (lang, source)) AS n_pairs FROM documents")
def q62_distinct_tags(spark, d):
    return aggregate.distinct_tags(table(spark, d, "documents"), "lang", "source").select(F.array_join("question_types", ",").alias("question_types"), F.array_join("knowledge_points", ",").alias("knowledge_points"), "n_pairs")


@query("SELECT count(*) AS total, count(*) FILTER (p_size % 6 + 4 + p_size % 5 >= 12 AND p_size % 5 >= 3) AS qualified FROM part")
def q63_qualified_count(spark, d):
    size = F.col("p_size")
    return aggregate.qualified_count(table(spark, d, "part").select((size % 6).alias("format_score"), F.lit(4).alias("content_quality_score"), F.when(size % 5 > 0, size % 5).alias("feasibility_score")))


@query("SELECT p_partkey AS id, p_size AS size, 2 AS generation FROM part WHERE p_size > 20")
def q64_checkpoints(spark, d):
    """Two generations saved and the newest one restored; a third whose files are missing is passed over."""
    folder, rows = scratch(spark), table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"))
    checkpoints.save(folder, 1, rows)
    checkpoints.save(folder, 2, rows.filter("size > 20"), rows.filter("size > 40"))
    lost = spark.range(1).select(F.lit(3).alias("generation"), F.lit(0).cast("long").alias("rules"), F.lit(f"{folder}/gone").alias("path"), F.current_timestamp().alias("saved_at"))
    lost.write.mode("append").parquet(f"{folder}/manifest")
    generation, population = checkpoints.restore(spark, folder)
    return population.withColumn("generation", F.lit(generation))


@query("""SELECT n_nationkey::BIGINT AS id, 2 AS attempt, n_nationkey || '_2/output_correct/1.png,' || n_nationkey || '_2/output_correct/2.jpg' AS images, 'success' AS test_result, 'data:image/png;base64,' || base64(encode(n_name || '1')) AS first FROM nation""")
def q65_attempt_folders(spark, d):
    """Folders of attempts written by the executors, the last attempt's images listed in order, one of them copied from the first path that exists."""
    root = _folder(spark)
    key = F.col("n_nationkey").cast("string")
    made = [("1", "output_correct/0.png"), ("2", "output_correct/2.jpg"), ("2", "output_correct/1.png"), ("2", "output_correct/note.txt"), ("2", "test_result.txt")]
    content = lambda p: F.lit("success") if p.endswith("result.txt") else F.concat("n_name", F.lit(p[15:16]))
    nation = table(spark, d, "nation")
    rows = None
    for attempt, p in made:
        part = nation.select(F.concat(key, F.lit(f"_{attempt}/{p}")).alias("path"), content(p).cast("binary").alias("content"))
        rows = part if rows is None else rows.unionByName(part)
    if files.write_files(rows, root).filter("error is not null").count():
        raise OSError(f"can't write to {root}")
    manifest = directory.manifest(spark, root)
    groups = aggregate.latest(directory.image_groups(manifest, total=None), "id", "attempt")
    results = manifest.select("id", "attempt", "test_result").distinct()
    names = F.array_join(F.transform("images", lambda x: F.regexp_extract(x, r"(\d+_\d+/.*)$", 1)), ",")
    out = groups.join(results, ["id", "attempt"]).select("id", "attempt", names.alias("images"), "test_result")
    wanted = nation.select(F.col("n_nationkey").cast("long").alias("id"), F.concat(F.lit(f"{root}/missing/"), key).alias("a"), F.concat(F.lit(f"{root}/"), key, F.lit("_2/output_correct/1.png")).alias("b"), F.concat(F.lit("copies/"), key, F.lit("_9/output_correct/1.png")).alias("target"))
    if files.copy_files(wanted, root, ["a", "b"]).filter("error is not null").count():
        raise OSError(f"can't copy in {root}")
    copied = directory.files(spark, f"{root}/copies", content=True).select("id", directory.data_url(F.col("path"), F.col("content")).alias("first"))
    return out.join(copied, "id")


@query("""WITH p AS (SELECT p_brand, count(*) AS n, dense_rank() OVER (ORDER BY min(p_partkey)) - 1 AS island_id FROM part GROUP BY 1) SELECT island_id::INT AS island_id, n AS size, n AS written, (SELECT count(*) FROM part) AS total_rules, (SELECT count(*) FROM p) AS n_islands FROM p""")
def q66_exports(spark, d):
    """One document of all islands, and a folder of one part for each, read back."""
    part = table(spark, d, "part").withColumn("one", F.lit(""))
    tags = aggregate.islands(part, "p_brand", "one", "p_partkey")
    rules = evolve.routed(part.select(F.col("p_partkey").alias("id"), "p_brand", "one", F.lit(0).alias("island_id")), tags, "p_brand", "one")
    path = scratch(spark)
    checkpoints.export_islands(rules, path)
    written = json_io.read_lines(spark, path, "id long, island_id int").groupBy("island_id").agg(F.count("*").alias("written"))
    document = scratch(spark)
    checkpoints.export_document(rules, document)
    whole = json_io.read_array(spark, document, "total_rules long, n_islands long, islands array<struct<island_id:int,size:long,rules:array<struct<id:long>>>>", strict=True)
    whole = whole.select("total_rules", "n_islands", F.explode("islands").alias("i")).select("total_rules", "n_islands", "i.island_id", F.size("i.rules").cast("long").alias("size"))
    return whole.join(written, "island_id").select("island_id", "size", "written", "total_rules", "n_islands")


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def q67_sorted_snapshot(spark, d):
    path = scratch(spark)
    json_io.write_sorted(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")), path, "id")
    return json_io.read_lines(spark, path, "id long, status string", tolerant=False)


@query("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_orderkey AS id, o_orderpriority || chr(10) || '[\"' AS rule FROM orders")
def q68_strict_array(spark, d):
    """A list of rules saved and loaded strictly; what is no JSON gives no rows where that is allowed."""
    path, bad = scratch(spark), scratch(spark)
    json_io.write_array(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat("o_orderpriority", F.lit('\n["')).alias("rule")), path, "id")
    spark.range(1).select(F.lit("{broken").alias("value")).write.text(bad)
    return json_io.read_array(spark, path, "id long, rule string", strict=True).unionByName(json_io.read_array(spark, bad, "id long, rule string"))


@query("""SELECT event_id, CASE WHEN event_id % 3 > 0 AND event_id % 4 > 0 THEN event_type END AS reasoning, CASE WHEN event_id % 3 > 0 AND event_id % 4 > 0 THEN user_id::VARCHAR END AS answer FROM events""")
def q69_required_tags(spark, d):
    key = F.col("event_id")
    made = F.concat(F.when(key % 3 > 0, F.concat(F.lit("<reasoning>\n"), "event_type", F.lit(" </reasoning>"))).otherwise(F.lit("none")), F.lit("<answer>"), F.when(key % 4 > 0, F.col("user_id").cast("string")).otherwise(F.lit(" ")), F.lit("</answer>"))
    return table(spark, d, "events").select("event_id", text.required_tags(made, "reasoning", "answer").alias("t")).select("event_id", "t.reasoning", "t.answer")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS id, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS attempt FROM orders")
def q70_id_attempt(spark, d):
    name = F.concat("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, "_").otherwise("_x"), "o_custkey")
    return table(spark, d, "orders").select("o_orderkey", text.id_attempt(name).alias("x")).select("o_orderkey", "x.id", F.col("x.attempt").alias("attempt"))


@query("""SELECT p_partkey AS id, md5('Change this rule a little, in four to six bullets.' || chr(10) || '- ' || p_name || chr(10) || '- ' || p_brand) AS mutation, md5('Combine these two rules into one of four to six bullets.' || chr(10) || 'First:' || chr(10) || '- ' || p_name || chr(10) || '- ' || p_brand || chr(10) || 'Second:' || chr(10) || '- ' || p_type) AS crossover FROM part""")
def q71_rule_prompts(spark, d):
    rule = F.array("p_name", "p_brand")
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.md5(templates.rule_prompt("mutation", rule)).alias("mutation"), F.md5(templates.rule_prompt("crossover", rule, F.array("p_type"))).alias("crossover"))


@query("""SELECT p_partkey AS id, CASE WHEN p_size % 3 > 0 THEN 'text,image,text' ELSE 'text' END AS kinds, CASE WHEN p_size % 3 > 0 THEN p_name END AS data,
md5(CASE WHEN p_size % 3 > 0 THEN 'Answer the puzzle.' || chr(10) || p_type || chr(10) || '|' || chr(10) || 'A: ' || p_brand || chr(10) || 'Explanation: why' || chr(10) || 'Give <reasoning> and the letter in <answer>.' ELSE 'Answer the puzzle.' || chr(10) || p_type || chr(10) || chr(10) || 'A: ' || p_brand || chr(10) || 'Explanation: why' || chr(10) || 'Give <reasoning> and the letter in <answer>.' END) AS texts FROM part""")
def q72_content_parts(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("prompt"), F.create_map(F.lit("A"), F.col("p_brand")).alias("options"), F.lit("why").alias("explanation"), F.when(F.col("p_size") % 3 > 0, F.col("p_name")).alias("image"))
    rows = rows.select("id", templates.puzzle_prompt("verify").alias("parts"))
    image = F.filter("parts", lambda p: p["type"] == "image")
    texts = F.transform(F.filter("parts", lambda p: p["type"] == "text"), lambda p: p["text"])
    return rows.select("id", F.array_join(F.transform("parts", lambda p: p["type"]), ",").alias("kinds"), F.get(image, F.lit(0))["data"].alias("data"), F.md5(F.array_join(texts, "|")).alias("texts"))


@query("""SELECT p_partkey AS id, md5('<|im_start|>system' || chr(10) || 'You solve puzzles.<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || '<|vision_start|><|image_pad|><|vision_end|>' || p_name || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)) AS prompt FROM part""")
def q73_chat_prompt(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.md5(text.chat_prompt(F.col("p_name"), "You solve puzzles.")).alias("prompt"))


@query("""WITH s AS (SELECT p_partkey, p_size + 10 AS w, p_size * 2 + 5 AS h, 100 + p_size AS cell, p_size % 7 AS margin FROM part), k AS (SELECT *, least(120::DOUBLE / w, 90::DOUBLE / h) AS x FROM s), f AS (SELECT *, greatest(1, floor(w * x)::INT) AS nw, greatest(1, floor(h * x)::INT) AS nh FROM k)
SELECT p_partkey AS id, nw AS width, nh AS height, floor((120 - nw) / 2)::INT AS "left", floor((90 - nh) / 2)::INT AS top, cell * 5 + margin * 2 AS sheet_width, 50 + cell * 2 + 225 + margin AS sheet_height, round(800.0::DOUBLE / (cell * 5 + margin * 2), 6) AS scale FROM f""")
def q74_geometry(spark, d):
    size = F.col("p_size")
    w, h, left, top = assemble.fitted(size + 10, size * 2 + 5, F.lit(120), F.lit(90))
    sheet_w, sheet_h, scale = assemble.canvas(size + 100, size % 7)
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), w.alias("width"), h.alias("height"), left.alias("left"), top.alias("top"), sheet_w.alias("sheet_width"), sheet_h.alias("sheet_height"), _r(scale).alias("scale"))


@query("""SELECT event_id, CASE WHEN s >= 3600 THEN format('{}h {}m {}s', s // 3600, s % 3600 // 60, s % 60) WHEN s >= 60 THEN format('{}m {}s', s // 60, s % 60) ELSE format('{}s', s) END AS took, least(300.0::DOUBLE, pow(2.0::DOUBLE, event_id % 12)) AS wait FROM (SELECT event_id, event_id * 7 % 9000 AS s FROM events)""")
def q75_durations(spark, d):
    key = F.col("event_id")
    return table(spark, d, "events").select("event_id", text.duration(key * 7 % 9000 + 0.5).alias("took"), scores.backoff(key % 12).alias("wait"))


@query("SELECT p_partkey AS id, p_name AS one, p_name || ',' || p_brand AS many, len(p_name) > 0 AND p_size % 2 = 0 AS given FROM part")
def q76_promoted(spark, d):
    name, brand = F.col("p_name"), F.col("p_brand")
    given = text.all_given(name, F.when(F.col("p_size") % 2 == 0, brand).otherwise(F.lit("")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.array_join(text.as_array(name, False), ",").alias("one"), F.array_join(text.as_array(F.array(name, brand), True), ",").alias("many"), given.alias("given"))


@query("""SELECT p_brand, count(*) AS n, floor(count(*) * 1.2::DOUBLE)::INT AS target, greatest(1, floor(count(*) * 0.1::DOUBLE)::INT) AS elites, greatest(0, floor(count(*) * 1.2::DOUBLE)::INT - greatest(1, floor(count(*) * 0.1::DOUBLE)::INT)) AS offspring, (greatest(max(p_size), coalesce(min(p_size), 0)) + 1)::INT AS depth FROM part GROUP BY 1""")
def q77_generation_sizes(spark, d):
    rows = table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.max("p_size").alias("a"), F.min("p_size").alias("b"))
    return rows.select("p_brand", "n", scores.target_size(F.col("n")).alias("target"), scores.elite_count(F.col("n")).alias("elites"), scores.offspring_count(F.col("n")).alias("offspring"), scores.child_depth(F.col("a"), F.col("b")).cast("int").alias("depth"))


@query("""WITH p AS (SELECT o_orderkey AS src, unnest([o_orderkey // 2, o_orderkey // 3, o_orderkey]) AS dst FROM orders) SELECT src, dst FROM p WHERE src <> dst UNION SELECT dst, src FROM p WHERE src <> dst""")
def q78_lineage_edges(spark, d):
    key = F.col("o_orderkey")
    return lineage.edges(table(spark, d, "orders").select(key.alias("id"), F.array(F.floor(key / 2), F.floor(key / 3), key).alias("parents")))


@query("SELECT event_id AS pos, (event_id % 6)::INT AS credential FROM events")
def q79_round_robin(spark, d):
    return templates.keyed_round_robin(table(spark, d, "events").select(F.col("event_id").alias("pos")), 6)


@query("""WITH r AS (SELECT p_partkey AS id, CASE WHEN p_size % 5 = 0 THEN '# nothing' ELSE '1. ' || p_name || chr(10) || '(aside)' || chr(10) || '- ' || p_brand END AS response, p_size % 5 > 0 AS ok FROM part)
SELECT id, 'crossover' AS step, md5(p_name || chr(10) || p_brand) AS rule_md5, (id - 1) || ',' || (id - 2) AS parents, false AS mutated, 'crossover' AS creation_method FROM r JOIN part ON p_partkey = id WHERE ok
UNION ALL SELECT id, 'mutation', md5(CASE WHEN ok THEN p_name || chr(10) || p_brand ELSE p_type END), CASE WHEN ok THEN id::VARCHAR ELSE '5,6' END, ok, CASE WHEN ok THEN 'mutation' ELSE 'crossover' END FROM r JOIN part ON p_partkey = id""")
def q80_rule_records(spark, d):
    """New rules from model responses, and rules replaced by their mutations; a response without bullets makes none and changes none."""
    key, size = F.col("p_partkey"), F.col("p_size")
    response = F.when(size % 5 == 0, "# nothing").otherwise(F.concat(F.lit("1. "), "p_name", F.lit("\n(aside)\n- "), "p_brand"))
    answers = table(spark, d, "part").select(key.alias("id"), response.alias("response"), F.lit(1).alias("generation"), (key - 1).alias("p1"), (key - 2).alias("p2"), F.lit("q").alias("question_type"), F.lit("k").alias("knowledge_point"), F.lit(2).alias("depth"))
    rules = table(spark, d, "part").select(key.alias("id"), F.array("p_type").alias("rule_content"), F.array(F.lit(5).cast("long"), F.lit(6).cast("long")).alias("parents"), F.lit(False).alias("mutated"), F.lit("crossover").alias("creation_method"))
    out = None
    for step, df in (("crossover", templates.crossover_records(answers)), ("mutation", templates.mutation_records(rules, answers))):
        df = df.select("id", F.lit(step).alias("step"), F.md5(F.array_join("rule_content", "\n")).alias("rule_md5"), F.array_join(F.transform("parents", lambda x: x.cast("string")), ",").alias("parents"), "mutated", "creation_method")
        out = df if out is None else out.unionByName(df)
    return out


@query("SELECT p_partkey AS id, attempt::INT AS attempt, p_partkey % 6 < attempt AS ok FROM part, range(1, 5) t(attempt) WHERE attempt = 1 OR p_partkey % 6 >= attempt - 1")
def q81_attempts(spark, d):
    """Up to four attempts an id; only failed ids go on."""
    ids = table(spark, d, "part").select(F.col("p_partkey").alias("id"))
    return providers.attempts(ids, lambda left, n: left.select("id", (F.col("id") % 6 < n).alias("ok"))).select("id", "attempt", "ok")


@query("SELECT event_id AS id, CASE WHEN event_id % 7 < 5 THEN 'answer' END AS content, CASE WHEN event_id % 7 < 5 THEN NULL ELSE 'attempts exhausted' END AS error FROM events")
def q82_judged(spark, d):
    """Batches sent up to five times, at most so many active at a time; what still fails becomes an error row."""

    def submit(left, n):
        status = F.when(F.col("id") % 7 < n, 200).otherwise(500)
        return left.select("id", F.concat(F.lit("req-"), "pos").alias("custom_id"), status.alias("status_code"), F.lit(None).cast("string").alias("error"), F.lit("answer").alias("content"))

    return providers.judged(table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_id").alias("pos")), submit)


class Refusing(providers.Offline):
    """The offline provider, which refuses prompts that ask for it, and is rate-limited at the first call of some others."""

    def __call__(self, prompt: str) -> str:
        if "refuse" in prompt:
            raise ValueError("refused")
        return super().__call__(prompt)


@query("""WITH p AS (SELECT p_partkey AS id, CASE WHEN p_size % 9 = 0 THEN 'refuse ' ELSE 'rate ' END || p_name AS prompt FROM part)
SELECT id, CASE WHEN prompt LIKE 'rate%' THEN '<format>' || (('0x' || substr(md5(prompt), 1, 2))::INT % 5 + 1) || '</format><feasibility>' || (('0x' || substr(md5(prompt), 3, 2))::INT % 5 + 1) || '</feasibility>' END AS response, CASE WHEN prompt NOT LIKE 'rate%' THEN 'ValueError: refused' END AS error FROM p""")
def q83_asked(spark, d):
    """Model calls by the offline provider, several at a time in a task; a failed call leaves its error in the row."""
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.when(F.col("p_size") % 9 == 0, "refuse ").otherwise("rate "), "p_name").alias("prompt"))
    return providers.ask(rows, Refusing(("format", "feasibility"))).select("id", "response", "error")


@query("""SELECT conv_id AS id, turn::INT AS attempt, CASE WHEN max("text") IS NULL THEN 'fail - no result' WHEN contains(lower(max("text")), 'success') THEN 'success' WHEN contains(lower(max("text")), 'timeout') THEN 'fail - timeout' ELSE 'fail' END AS status FROM conversations GROUP BY 1, 2""")
def q84_recorded_status(spark, d):
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("id"), F.col("turn").cast("int").alias("attempt"), F.col("text").alias("test_result"))
    return providers.recorded_status(rows)


@query("""SELECT p_partkey AS id, md5(CASE p_size % 3 WHEN 0 THEN 'Change this rule a little, in four to six bullets.' || chr(10) || '- ' || p_name WHEN 1 THEN 'own text for ' || chr(10) || '- ' || p_name ELSE '' END) AS prompt_md5 FROM part""")
def q85_template_choice(spark, d):
    """Prompts of all parts by the template that each one names: one from a folder, the built-in one where the folder has none, the empty text where there is neither."""
    folder = scratch(spark)
    spark.range(1).select(F.lit("own text for {{rule}}").alias("value")).coalesce(1).write.option("lineSep", "\n").text(f"{folder}/scoring.md")
    texts = {n: templates.template(spark, n, folder).strip() for n in ("mutation", "scoring", "unknown")}
    made = lambda n: templates.rule_prompt(n, F.array("p_name"), text=texts[n])
    prompt = F.when(F.col("p_size") % 3 == 0, made("mutation")).when(F.col("p_size") % 3 == 1, made("scoring")).otherwise(made("unknown"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.md5(prompt).alias("prompt_md5"))


@query("SELECT event_id AS id, event_type || '!' AS answer FROM events WHERE event_id % 2 = 0 OR event_id % 5 = 0")
def q86_incremental(spark, d):
    """Two streaming runs over a folder that grows between them: each item is answered once."""
    folder = scratch(spark)
    rows = table(spark, d, "events").select(F.col("event_id").alias("id"), "event_type")
    for part in (rows.filter("id % 2 = 0"), rows.filter("id % 5 = 0")):
        part.write.mode("append").json(f"{folder}/in")
        run_available(spark, f"{folder}/in", "id long, event_type string", f"{folder}/log", "id long, answer string", f"{folder}/state", lambda items: items.select("id", F.concat("event_type", F.lit("!")).alias("answer")))
    return json_io.read_lines(spark, f"{folder}/log", "id long, answer string")


@query(f"""SELECT doc_id, {_u("'7'", "'mutate'", "'2'", "doc_id")} < 0.15::DOUBLE AS mutated, round(1.0::DOUBLE / (doc_id % 4 + 1), 6) AS weight FROM labels""")
def q87_bernoulli_and_weights(spark, d):
    return table(spark, d, "labels").select("doc_id", (u(7, "mutate", 2, F.col("doc_id")) < 0.15).alias("mutated"), _r(scores.parent_weight(F.col("doc_id") % 4)).alias("weight"))


class OrdersPages:
    """A fetcher without a network: the orders of a folder in pages of 2,000 rows, which know their least and greatest key."""

    @staticmethod
    def _table(name, columns):
        import pyarrow.parquet as pq

        return pq.read_table(name, columns=columns)

    def pages(self, name, split, conditions):
        keys = self._table(name, ["o_orderkey"]).column(0).to_numpy()
        cuts = [(s, keys[s : s + 2000].min(), keys[s : s + 2000].max()) for s in range(0, len(keys), 2000)]
        outside = {"GreaterThan": lambda lo, hi, v: hi <= v, "LessThanOrEqual": lambda lo, hi, v: lo > v, "EqualTo": lambda lo, hi, v: not lo <= v <= hi}
        return [s for s, lo, hi in cuts if not any(c == "o_orderkey" and kind in outside and outside[kind](lo, hi, v) for c, kind, v in conditions)]

    def batches(self, name, split, page, columns, conditions):
        yield from self._table(name, columns).slice(page, 2000).to_batches()


orders_pages = OrdersPages()


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 5000 AND o_orderkey <= 30000")
def q88_remote_scan(spark, d):
    """The orders by pages of a remote dataset; the condition on the key reaches the fetcher, which leaves out pages, and two columns alone are fetched."""
    rows = remote.scan(spark, "ruleforge.plans.catalog_steps:orders_pages", f"{d}/orders.parquet".removeprefix("file://"), "train", _ORDERS, ["o_orderkey", "o_orderstatus"])
    return rows.filter((F.col("o_orderkey") > 5000) & (F.col("o_orderkey") <= 30000))


@query("SELECT s_suppkey AS id, s_suppkey % 3 = 0 AS blank, 4 AS n_longs FROM supplier")
def q89_blank_images(spark, d):
    """Rasters of one grey each, which count as blank, and of many, with their perceptual hashes."""
    key = F.col("s_suppkey")
    pixel = lambda i: F.lpad(F.hex(F.when(key % 3 == 0, key % 250).otherwise((key * 7 + i * 37) % 256).cast("long")), 2, "0")
    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(255)), pixel), ""))
    image = F.struct(F.lit(16).alias("h"), F.lit(16).alias("w"), F.lit(1).alias("channels"), data.alias("data"))
    looked = images.hashed_images(spread(table(spark, d, "supplier").select(key)).select(key.alias("id"), image.alias("pixels")))
    return looked.select("id", "blank", F.size("phash").alias("n_longs"))


@query(f"WITH h AS ({_BITS}), v AS (SELECT id * 8 + idx AS row, b FROM h) SELECT x.row AS a, y.row AS b, list_sum(list_transform(list_zip(x.b, y.b), lambda z: (z[1] <> z[2])::INT))::INT AS distance FROM v x JOIN v y ON x.row < y.row WHERE list_sum(list_transform(list_zip(x.b, y.b), lambda z: (z[1] <> z[2])::INT)) <= 12")
def q90_near_hashes(spark, d):
    """All pairs of rows of the whole table whose hashes differ in 12 bits at most, by blocks of bits."""
    rows = _hashes(spark, d).select((F.col("id") * 8 + F.col("idx")).alias("row"), "phash")
    return neighbours.near_hashes(rows, 12, "row")


class Counter:
    """A batch service without a network, many batches a call: it keeps what it is sent; some answers fail once, some always."""

    def __init__(self, spark):
        self.spark, self.open, self.breaks = spark, {}, True

    def submit_all(self, rows, keys):
        failed = (F.col("id") % 7 == 5) & F.col("key").endswith("-1") | (F.col("id") % 21 == 20)
        answers = rows.select("key", "id", "custom_id", F.when(failed, 500).otherwise(200).alias("status_code"), F.lit(None).cast("string").alias("error"), F.concat("event_type", F.lit(" "), F.col("id")).alias("content"))
        for key in keys:
            self.open[key] = answers
            if self.breaks and len(self.open) > 1:
                self.breaks = False
                raise ConnectionError
        return keys

    def find(self, key):
        return key if key in self.open else None

    def poll_all(self, handles):
        sent = {}
        for handle in handles:
            sent.setdefault(id(self.open[handle]), (self.open[handle], []))[1].append(handle)
        return reduce(lambda x, y: x.unionByName(y), (answers.filter(F.col("key").isin(part)) for answers, part in sent.values())), handles, []


@query("""SELECT event_id AS id, CASE WHEN event_id % 21 <> 20 THEN event_type || ' ' || event_id END AS content, CASE WHEN event_id % 21 = 20 THEN 'attempts exhausted' END AS error, CASE WHEN event_id % 21 = 20 THEN 3 WHEN event_id % 7 = 5 THEN 2 ELSE 1 END AS attempts FROM events""")
def q91_batch_ledger(spark, d):
    """Requests in batches through a service, in a run that breaks off while it sends and is taken up again from its ledger."""
    rows = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_id").alias("pos"), "event_type")
    folder, service = scratch(spark), Counter(spark)
    call = lambda: ledger.run(rows, folder, service, size=4000, most=3)
    try:
        call()
    except ConnectionError:
        pass
    return call()


class Digests:
    """A model without weights: what it opens answers lists of prompts by their digests."""

    def open(self):
        import hashlib

        return lambda prompts: [hashlib.md5(p.encode()).hexdigest() for p in prompts]


@query("SELECT p_partkey AS id, CASE WHEN p_size % 9 > 0 THEN md5('rate ' || p_name) END AS response, CAST(NULL AS VARCHAR) AS error FROM part")
def q92_inference(spark, d):
    """Lists of prompts through a model that each worker opens once; null prompts are not sent."""
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 9 > 0, F.concat(F.lit("rate "), "p_name")).alias("prompt"))
    return inference.infer(rows, Digests(), batch=32).select("id", "response", "error")


@query("SELECT s_suppkey AS id, 16 AS height, 12 AS width, s_suppkey % 3 = 0 AS blank, s_suppkey % 5 = 0 AS unreadable, CASE WHEN s_suppkey % 3 > 0 AND s_suppkey % 5 > 0 THEN s_suppkey % 4 = 0 END AS alike FROM supplier")
def q93_image_files(spark, d):
    """From pixels to files to hashes: two PNG files for each supplier, written with a commit, read back, decoded and hashed. Every third pair is blank, every fourth alike, every fifth first file cut short."""
    key, root = F.col("s_suppkey"), _folder(spark)

    @F.pandas_udf("binary")
    def drawn(keys: pd.Series, nth: pd.Series) -> pd.Series:
        def one(k, n):
            x = (np.arange(192).reshape(16, 12) * (k % 89 + 5 + (n if k % 4 else 0) * 31) % 251).astype(np.uint8) if k % 3 else np.full((16, 12), k % 250, np.uint8)
            data = raster.png(x)
            return data[:60] if k % 5 == 0 and n == 0 else data

        return pd.Series([one(k, n) for k, n in zip(keys, nth, strict=True)])

    made = spread(table(spark, d, "supplier").select(key)).select(key, F.explode(F.array(F.lit(0), F.lit(1))).alias("n"))
    written = files.write_files(made.select(F.concat(key, F.lit("_1/output_correct/"), "n", F.lit(".png")).alias("path"), drawn(key, "n").alias("content")), root)
    if written.filter("error is not null").count():
        raise OSError(f"can't write to {root}")
    looked = images.hashed_files(directory.known_files(spread(written), root).select("id", "name", "content"))
    # Both files of a supplier in one pass: each is read and hashed once.
    one = lambda name: F.first(F.when(F.col("name") == name, F.struct("height", "width", "blank", "phash")), ignorenulls=True)
    pairs = looked.groupBy("id").agg(one("0.png").alias("x"), one("1.png").alias("y")).filter("x is not null and y is not null")
    alike = F.when(~F.col("y.blank"), scores.hamming(F.col("x.phash"), F.col("y.phash")) <= images.MAX_DISTANCE)
    return pairs.select("id", "y.height", "y.width", "y.blank", F.col("x.phash").isNull().alias("unreadable"), alike.alias("alike"))


@query(r"""WITH l AS (SELECT doc_id, list_transform(list_filter(list_transform(string_split("text", chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '' AND x <> '-'), lambda x: regexp_replace(x, '^[- ]+', '')) AS b FROM documents)
SELECT doc_id, unnest(range(len(b)))::INT AS pos, md5(unnest(b)) AS bullet_md5 FROM l""")
def q94_bullets_in_sql(spark, d):
    """q03 in Spark SQL, by a registered table function."""
    sql.register(spark)
    return spark.sql("SELECT doc_id, pos, md5(bullet) AS bullet_md5 FROM {documents}, LATERAL bullets(text)", documents=table(spark, d, "documents").select("doc_id", "text"))


@query("""SELECT page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title, 'k: ' || page_id AS options, (page_id % 90)::INT AS score FROM pages""")
def q95_functions_in_sql(spark, d):
    """Tags, options and scores by registered SQL functions."""
    sql.register(spark)
    return spark.sql("""SELECT page_id, tag_text(html, 'title') AS title, options_block(parsed_options(concat('{{"k": "', page_id, '"}}'))) AS options, int_tag(concat('<S> ', page_id % 90, '</S>'), 's') AS score FROM {pages}""", pages=table(spark, d, "pages"))


@query("""WITH c AS (SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY 1), i AS (SELECT DISTINCT conv_id FROM conversations) SELECT i.conv_id AS id, unnest(range(coalesce(n, 0) + 1, 9)) AS attempt FROM i LEFT JOIN c USING (conv_id)""")
def q96_owed_stream(spark, d):
    """q38 as a stream: finished requests come first, then the items, each twice; what is owed is counted in state."""
    turns, folder = table(spark, d, "conversations").select(F.col("conv_id").alias("id"), "role"), scratch(spark)
    items = turns.select("id", F.lit(False).alias("done")).distinct()
    for part in (turns.filter("role = 'assistant'").select("id", F.lit(True).alias("done")), items.filter("id % 2 = 0"), items):
        part.write.mode("append").json(f"{folder}/in")
        stream = owed_attempts(spark.readStream.schema("id long, done boolean").json(f"{folder}/in"))
        stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("id long, attempt long").parquet(f"{folder}/out")
