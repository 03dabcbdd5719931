"""Prompt templates of the stages, short and our own; the tags they ask for are what the parsers of functions.text look for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_parts, numbered_bullets, options_block, rendered, rule_block

TEMPLATES = {
    "rewrite": "Translate the explanation into plain English inside <translation>.\n{{explanation}}",
    "verify": "Answer the puzzle.\n{{prompt}}\n<image>\n{{options}}\nExplanation: {{explanation}}\nGive <reasoning> and the letter in <answer>.",
    "abstract": "State the rule behind the puzzle as bullets inside <key_points>, with a <puzzle_breakdown>.\n{{prompt}}\n<image>\n{{explanation}}",
    "category": "Name the <question_type> and <knowledge_point>.\n{{prompt}}\n<image>\n{{breakdown}}",
    "crossover": "Combine these two rules into one of four to six bullets.\nFirst:{{first}}\nSecond:{{second}}",
    "mutation": "Change this rule a little, in four to six bullets.{{rule}}",
    "scoring": "Rate the rule from 1 to 5 in <format>, <content_quality> and <feasibility>.{{rule}}",
    "generate_1": "Write a script in style one that draws five figures that follow the rule and three that don't.{{rule}}",
    "generate_2": "Write a script in style two that draws five figures that follow the rule and three that don't.{{rule}}",
    "generate_3": "Write a script in style three that draws five figures that follow the rule and three that don't.{{rule}}",
    "judge": "Rate the puzzle in <final_score> with lines Reasonableness: n and Readability: n.\n{{prompt}}\n<image>\n{{options}}",
}
MARKER = "<image>"


def template(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """The text of ``<folder>/<name>.md`` if it is there, else the built-in one, else the empty string."""
    from ..sources.json_io import exists

    if folder and exists(spark, f"{folder}/{name}.md"):
        return spark.read.text(f"{folder}/{name}.md", wholetext=True).first()[0]
    return TEMPLATES.get(name, "")


def puzzle_prompt(name: str, text: str | None = None, prompt: str = "prompt", options: str = "options", explanation: str = "explanation", image: str = "image") -> Column:
    """Typed content parts of a puzzle's request: text, the image at the template's mark, text; text alone without an image."""
    made = rendered(TEMPLATES[name] if text is None else text, prompt=F.col(prompt), options=options_block(F.col(options)), explanation=F.col(explanation), breakdown=F.col(explanation))
    return content_parts(made, MARKER, F.col(image))


def rule_prompt(name: str, rule: Column, second: Column | None = None, text: str | None = None) -> Column:
    values = {"first": rule_block(rule), "second": rule_block(second)} if second is not None else {"rule": rule_block(rule)}
    return rendered(TEMPLATES[name] if text is None else text, **values)


def crossover_records(responses: DataFrame) -> DataFrame:
    """Rules parsed from responses (id, response, generation, p1, p2, question_type, knowledge_point, depth of the deeper parent); those without bullets go."""
    bullets = numbered_bullets(F.col("response"))
    out = responses.select("id", bullets.alias("rule_content"), "generation", F.array_distinct(F.array("p1", "p2")).alias("parents"), F.lit(False).alias("mutated"), "question_type", "knowledge_point", F.lit(0).cast("long").alias("times_used_as_parent"), F.lit("crossover").alias("creation_method"), (F.col("depth") + 1).cast("int").alias("ancestry_depth"))
    return out.filter(F.size("rule_content") > 0)


def mutation_records(rules: DataFrame, responses: DataFrame) -> DataFrame:
    """Rules with the bullets of their response, joined by id whatever the order of arrival; a rule without any keeps its own."""
    found = responses.select("id", numbered_bullets(F.col("response")).alias("_new")).filter(F.size("_new") > 0)
    done = F.col("_new").isNotNull()
    out = rules.join(found, "id", "left").withColumn("rule_content", F.coalesce("_new", "rule_content")).withColumn("mutated", F.col("mutated") | done)
    return out.withColumn("parents", F.when(done, F.array("id")).otherwise(F.col("parents"))).withColumn("creation_method", F.when(done, "mutation").otherwise(F.col("creation_method"))).drop("_new")


def keyed_round_robin(df: DataFrame, keys: int, pos: str = "pos") -> DataFrame:
    """Adds the number of the credential that each request uses, in turn."""
    return df.withColumn("credential", F.pmod(F.col(pos), F.lit(keys)).cast("int"))
