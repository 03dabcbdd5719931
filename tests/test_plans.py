from pyspark.sql import functions as F

from ruleforge.operators.evolve import Settings
from ruleforge.operators.providers import Offline
from ruleforge.plans import puzzles, rules, templates


def test_seed_rules_to_chosen_rules(spark):
    n = 12
    questions = spark.createDataFrame([(i, f"q{i}", "old") for i in range(n)], "id long, prompt string, explanation string")
    translations = spark.createDataFrame([(i, "new") for i in range(0, n, 2)], "id long, translation string")
    verified = spark.createDataFrame([(i, "A", "a" if i % 4 else "b", i) for i in range(n)], "id long, correct_answer string, answer string, pos long")
    abstracted = spark.createDataFrame([(i, f"<key_points>- point {i}\n- other {i}</key_points>") for i in range(n)], "id long, raw_response string")
    tagged = spark.createDataFrame([(i, f"<question_type>{'Others' if i % 3 else 'T'}</question_type><knowledge_point>K</knowledge_point>") for i in range(n - 1)], "id long, raw_response string")
    seeds = rules.seed_rules(questions, translations, verified, abstracted, tagged)
    got = {r.seed_id: r for r in seeds.collect()}
    assert sorted(got) == list(range(9)) and got[0].seed_rule == ["point 1", "other 1"] and got[8].question_type == ""
    others, classes, mapping = rules.two_groups(seeds)
    assert sorted(r.id for r in others.collect()) == list(range(others.count())) and mapping.count() == others.count() + classes.count() == 9
    grown = rules.evolved_rules(seeds, Settings(generations=1))
    ids = sorted(r.id for r in grown.collect())
    assert ids == list(range(len(ids))) and len(ids) > 9
    chosen = rules.chosen_rules(grown, Offline(("format", "content_quality", "feasibility"))).collect()
    assert all(r.repeat_count == 0 and r.format_score + r.content_quality_score + r.feasibility_score >= 12 and r.feasibility_score >= 3 for r in chosen)


def test_puzzles_to_dataset(spark):
    made = [(i, a, kind, f"/r/{i}_{a}/{kind}/{k}.png", "success") for i in range(8) for a in (1, 2) for kind, n in (("output_correct", 5), ("output_incorrect", 3 if i else 2)) for k in range(n)]
    manifest = spark.createDataFrame(made, "id long, attempt int, kind string, path string, test_result string")
    groups = puzzles.grouped_images(manifest)
    assert {r.id for r in groups.collect()} == set(range(1, 8)) and all("_2/" in p for r in groups.collect() for p in r.correct)
    lineage = spark.createDataFrame([(i, [i // 2] if i else []) for i in range(8)], "id long, parents array<long>")
    four, variants, ten = puzzles.puzzles(groups, lineage)
    assert (four.count(), variants.count()) == (7, 28) and ten.count() == 7
    images = spark.createDataFrame([(1, 0, [0], False), (1, 1, [1], False), (2, 0, [0], True)], "id long, idx int, phash array<long>, blank boolean")
    assert {tuple(r) for r in puzzles.hash_summary(images).collect()} == {(1, False, False), (2, False, True)}
    records = spark.createDataFrame([(1, "<final_score>Reasonableness: 3\nReadability: 4</final_score>", 0), (2, None, 1)], "id long, score string, pos long")
    assert {tuple(r)[:3] for r in puzzles.judged_scores(records).collect()} == {(1, 3, 4), (2, None, None)}
    inference = spark.createDataFrame([(1, "\\boxed{A}", "A"), (1, "\\boxed{a}", "A"), (1, "none", "A")], "id long, generated_text string, correct_answer string")
    assert [(r.key, round(r.value, 3)) for r in puzzles.accuracies(inference).collect()] == [("1", 0.333)]
    style = four.withColumn("prompt", F.lit("p")).withColumn("image", F.concat(F.lit("images/"), F.col("id"), F.lit(".png")))
    out = puzzles.dataset([style, style.limit(2)]).collect()
    assert len(out) == 9 and all(r.image == f"images/image_{r.id}.png" for r in out)


def test_templates_and_records(spark, tmp_path):
    (tmp_path / "scoring.md").write_text("own {{rule}}")
    assert templates.template(spark, "scoring", str(tmp_path)) == "own {{rule}}"
    assert templates.template(spark, "judge", str(tmp_path)) == templates.TEMPLATES["judge"] and templates.template(spark, "no such") == ""
    q = spark.createDataFrame([("p?", {"A": "a"}, "because", "img"), ("p?", {"A": "a"}, None, None)], "prompt string, options map<string,string>, explanation string, image string")
    kinds = [[p.type for p in r[0]] for r in q.select(templates.puzzle_prompt("verify")).collect()]
    assert kinds == [["text", "image", "text"], ["text"]]
    answers = spark.createDataFrame([(9, "1. a\n2. b", 3, 1, 2, "t", "k", 4), (10, "# none", 3, 1, 1, "t", "k", 0)], "id long, response string, generation int, p1 long, p2 long, question_type string, knowledge_point string, depth int")
    made = templates.crossover_records(answers)
    assert [(r.id, r.rule_content, r.parents, r.ancestry_depth) for r in made.collect()] == [(9, ["a", "b"], [1, 2], 5)]
    changed = templates.mutation_records(made.unionByName(made.withColumn("id", F.lit(11).cast("long"))), spark.createDataFrame([(11, "- c"), (9, "")], "id long, response string"))
    assert {r.id: (r.rule_content, r.mutated, r.parents) for r in changed.collect()} == {9: (["a", "b"], False, [1, 2]), 11: (["c"], True, [11])}
    assert "- a" in made.select(templates.rule_prompt("scoring", F.col("rule_content"))).first()[0]
    assert {r.credential for r in templates.keyed_round_robin(spark.range(5).withColumnRenamed("id", "pos"), 3).collect()} == {0, 1, 2}
