"""Counts, histograms, flags and rates of the stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keyed import dense_ids


def tag_counts(df: DataFrame, a: str = "question_type", b: str = "knowledge_point") -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return df.groupBy(blank(a), blank(b)).agg(F.count("*").alias("n")).orderBy(a, b)


def latest(df: DataFrame, key: str, attempt: str) -> DataFrame:
    """Rows of the greatest attempt of each key, whether or not it succeeded."""
    top = df.groupBy(key).agg(F.max(attempt).alias("_top"))
    return df.join(top, key).filter(F.col(attempt) == F.col("_top")).drop("_top")


def image_counts(manifest: DataFrame, extensions: list[str]) -> DataFrame:
    """Of each id's latest attempt: correct and incorrect images, and whether its test succeeded (which validity doesn't need)."""
    is_image = F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1)).isin(extensions)
    kind = lambda k: F.count_if(is_image & (F.col("kind") == k))
    ok = F.coalesce(F.max(F.lower("test_result").contains("success")), F.lit(False))
    return latest(manifest, "id", "attempt").groupBy("id").agg(kind("output_correct").alias("n_correct"), kind("output_incorrect").alias("n_incorrect"), ok.alias("succeeded"))


def dedup_counts(df: DataFrame) -> DataFrame:
    """total, dup (has a near neighbour of another id), non_dup."""
    dup = F.count_if(F.col("min_similar_rule_id").isNotNull() & (F.col("min_similar_rule_id") != F.col("id")))
    return df.agg(F.count("*").alias("total"), dup.alias("dup")).withColumn("non_dup", F.col("total") - F.col("dup"))


def score_histograms(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, score, n) of each score and of their total; missing scores count as 0."""
    filled = df.select(*(F.coalesce(F.col(m), F.lit(0)).alias(m) for m in metrics))
    total = sum((F.col(m) for m in metrics[1:]), F.col(metrics[0]))
    long = filled.withColumn("total", total).unpivot([], [*metrics, "total"], "metric", "score")
    return long.groupBy("metric", "score").agg(F.count("*").alias("n")).orderBy("metric", "score")


def category_counts(df: DataFrame, duplicate: str = "has_duplicate", blank: str = "has_blank") -> DataFrame:
    d, b = F.col(duplicate), F.col(blank)
    return df.agg(F.count_if(d & ~b).alias("duplicate_only"), F.count_if(~d & b).alias("blank_only"), F.count_if(d & b).alias("both"), F.count("*").alias("total"))


def pass_rates(attempts: DataFrame, key: str = "id", correct: Column | None = None) -> DataFrame:
    """Share of correct attempts of each key; an unknown outcome counts as wrong."""
    ok = F.coalesce(F.col("is_correct") if correct is None else correct, F.lit(False)).cast("int")
    return attempts.groupBy(key).agg(F.count("*").alias("n"), F.sum(ok).alias("n_correct")).withColumn("accuracy", F.when(F.col("n") > 0, F.col("n_correct") / F.col("n")).otherwise(F.lit(0.0)))


def islands(df: DataFrame, a: str = "question_type", b: str = "knowledge_point", pos: str = "pos") -> DataFrame:
    """(a, b, island_id, size): tag pairs numbered in the order they are first seen."""
    pairs = df.groupBy(a, b).agg(F.min(pos).alias("_first"), F.count("*").alias("size"))
    return dense_ids(pairs, "_first", "_island").select(a, b, F.col("_island").cast("int").alias("island_id"), "size")


def qualified_count(df: DataFrame, least_total: int = 12, least_feasibility: int = 3) -> DataFrame:
    """total, qualified: rules whose scores suffice, whatever their neighbours; missing scores count as 0."""
    score = lambda c: F.coalesce(F.col(c), F.lit(0))
    total = score("format_score") + score("content_quality_score") + score("feasibility_score")
    return df.agg(F.count("*").alias("total"), F.count_if((total >= least_total) & (score("feasibility_score") >= least_feasibility)).alias("qualified"))


def distinct_tags(df: DataFrame, a: str = "question_type", b: str = "knowledge_point") -> DataFrame:
    return df.agg(F.sort_array(F.collect_set(a)).alias("question_types"), F.sort_array(F.collect_set(b)).alias("knowledge_points"), F.count_distinct(F.struct(a, b)).alias("n_pairs"))


def parent_usage(rules: DataFrame, key: str = "id", parents: str = "parents") -> DataFrame:
    """How often each rule is named as a parent, once for each child."""
    used = rules.select(F.explode(F.array_distinct(parents)).alias(key)).groupBy(key).agg(F.count("*").alias("times_used"))
    return rules.select(key).join(used, key, "left").select(key, F.coalesce("times_used", F.lit(0)).alias("times_used"))


def status_counts(df: DataFrame) -> DataFrame:
    """Successes, errors and the share of successes of records with an ``error`` column."""
    ok = F.count_if(F.col("error").isNull() | (F.col("error") == ""))
    return df.agg(F.count("*").alias("total"), ok.alias("success")).withColumn("errors", F.col("total") - F.col("success")).withColumn("ratio", F.when(F.col("total") > 0, F.col("success") / F.col("total")).otherwise(0.0))


def with_status(df: DataFrame, name: str = "status") -> tuple[DataFrame, Observation]:
    """The records, and an observation of their number and of those without an error, counted while they are written or sent on."""
    seen = Observation(name)
    ok = F.count_if(F.col("error").isNull() | (F.col("error") == ""))
    return df.observe(seen, F.count(F.lit(1)).alias("total"), ok.alias("success")), seen
