"""Filters and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import all_given, renamed_image

OTHERS = "Others"


def one_other(a: str, b: str) -> Column:
    """Exactly one of the two tags is the catch-all; null counts as a tag of its own."""
    return (F.coalesce(F.col(a), F.lit("")) == OTHERS) != (F.coalesce(F.col(b), F.lit("")) == OTHERS)


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where it holds, all others, null among them)."""
    holds = F.coalesce(condition, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def good_rules(df: DataFrame, least_total: int = 12, least_feasibility: int = 3, keep_representative: bool = False) -> DataFrame:
    """Rules without a near neighbour whose scores suffice; missing scores count as 0, failed ones as -1.

    Of near duplicates none stays, unless ``keep_representative`` lets the one of the least id stay.
    """
    score = lambda c: F.coalesce(F.col(c), F.lit(0))
    total = score("format_score") + score("content_quality_score") + score("feasibility_score")
    alone = F.coalesce(F.col("repeat_count"), F.lit(0)) == 0
    if keep_representative:
        alone = alone | (F.col("id") < F.col("min_similar_rule_id"))
    return df.filter(alone & (total >= least_total) & (score("feasibility_score") >= least_feasibility))


def complete_groups(counts: DataFrame, correct: int = 5, incorrect: int = 3) -> DataFrame:
    return counts.filter((F.col("n_correct") == correct) & (F.col("n_incorrect") == incorrect))


def complete_puzzles(df: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Rows with id, prompt, options, answer and an image under ``images/`` (that is listed in ``files``, if given)."""
    out = df.filter(all_given(F.col("id"), F.col("prompt"), F.col("correct_answer")) & (F.size("options") > 0) & F.col("image").startswith("images/"))
    return out if files is None else out.join(files.select(F.col("path").alias("image")).distinct(), "image", "left_semi")


def digit_ids(df: DataFrame, c: str = "id") -> DataFrame:
    """Distinct numbers among string ids."""
    return df.filter(F.col(c).rlike(r"^\d+$")).select(F.col(c).try_cast("long").alias(c)).filter(F.col(c).isNotNull()).distinct()


def seeds(df: DataFrame) -> DataFrame:
    return df.filter(F.col("generation") == 0)


def evolved(df: DataFrame) -> DataFrame:
    return df.filter(F.col("generation") > 0)


def re_imaged(df: DataFrame, key: str = "id") -> DataFrame:
    """Adds where each image goes under its new name."""
    return df.withColumn("target", F.concat(F.lit("images/"), renamed_image(F.col(key), F.col("image"))))
