"""From seed questions to chosen rules: the first two stages as plans over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keyed import dense_ids
from ..functions.text import bullets, int_tags, rendered, required_tags, rule_block, tag_text
from ..operators import merge, select
from ..operators.evolve import Settings, evolve
from ..operators.neighbours import near_duplicates
from ..operators.providers import ModelProvider, ask, embedded

SCORING = "Score this rule.\n{{rule}}\nGive <format>, <content_quality> and <feasibility> from 1 to 5."
TAGGING = "Name the <question_type> and <knowledge_point> of this puzzle.\n{{text}}"


def seed_rules(questions: DataFrame, translations: DataFrame, verified: DataFrame, abstracted: DataFrame, tagged: DataFrame) -> DataFrame:
    """(seed_id, seed_rule, question_type, knowledge_point) of the questions that a model answered right, under dense ids."""
    translated = merge.replaced(questions, translations, "id", "explanation", "translation").drop("matched", "replaced")
    right = merge.correct_rows(verified, "answer", "correct_answer")
    chosen = merge.reindexed(right, translated)
    rules = chosen.select("id", "new_id").join(abstracted.select("id", bullets(tag_text(F.col("raw_response"), "key_points", default=None)).alias("seed_rule")), "id")
    tags = tagged.withColumn("_t", required_tags(F.col("raw_response"), "question_type", "knowledge_point")).select("id", "_t.question_type", "_t.knowledge_point")
    return merge.with_defaults(rules, tags, "id", ("question_type", "knowledge_point")).select(F.col("new_id").alias("seed_id"), "seed_rule", "question_type", "knowledge_point")


def two_groups(seeds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rules with exactly one catch-all tag, the others, the map to both), each group under dense ids of its own."""
    marked = dense_ids(seeds.withColumn("others", select.one_other("question_type", "knowledge_point")), "seed_id", "new_id", by=("others",))
    parts = [marked.filter(F.col("others") == x).select(F.col("new_id").alias("id"), F.col("seed_rule").alias("rule_content"), "question_type", "knowledge_point") for x in (True, False)]
    return parts[0], parts[1], marked.select("seed_id", F.when(F.col("others"), "others").otherwise("classes").alias("file"), "new_id")


def evolved_rules(seeds: DataFrame, settings: Settings = Settings()) -> DataFrame:
    others, classes, _ = two_groups(seeds)
    grown = [evolve(g, settings).withColumn("pos", F.col("id")) for g in (others, classes)]
    return merge.united_rules(*grown)


def chosen_rules(rules: DataFrame, judge: ModelProvider, k: int = 500, limit: float = 0.20, keep_representative: bool = False) -> DataFrame:
    """Rules without near duplicates whose scores suffice."""
    text = embedded(rules.withColumn("text", rule_block(F.col("rule_content"))))
    near = near_duplicates(text, k, limit, pos="id")
    asked = ask(rules.select("id", rendered(SCORING, rule=rule_block(F.col("rule_content"))).alias("prompt")), judge)
    score = int_tags(F.col("response"), "format", "content_quality", "feasibility")
    scores = asked.withColumn("_s", score).select("id", *(F.coalesce(F.col(f"_s.{t}"), F.lit(-1)).alias(f"{t}_score") for t in ("format", "content_quality", "feasibility")))
    return select.good_rules(merge.overlaid_scores(rules.join(near.drop("pos"), "id"), scores), keep_representative=keep_representative)
