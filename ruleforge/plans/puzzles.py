"""From attempt folders to the dataset: validity, hashes, assembly, scores, pass rates and the union of styles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.images import hashed_files
from ..functions.text import COUNT_EXTENSIONS, boxed, labelled_score, renamed_image, tag_text
from ..operators import aggregate, assemble, merge, neighbours, select
from ..operators.lineage import relatives
from ..sources import directory


def valid_ids(manifest: DataFrame) -> DataFrame:
    return select.complete_groups(aggregate.image_counts(manifest, COUNT_EXTENSIONS)).select("id")


def grouped_images(manifest: DataFrame) -> DataFrame:
    """(id, correct, incorrect): the sorted images of the latest attempts of valid ids."""
    last = aggregate.latest(manifest, "id", "attempt").join(valid_ids(manifest), "id", "left_semi")
    kind = lambda k: F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.col("path"))))
    return last.groupBy("id").agg(kind("output_correct").alias("correct"), kind("output_incorrect").alias("incorrect"))


def hash_summary(images: DataFrame) -> DataFrame:
    return neighbours.group_flags(images, neighbours.hash_pairs(images))


def folder_flags(spark, root: str, limit: int = 2, total: int | None = 8) -> DataFrame:
    """(id, has_duplicate, has_blank, unreadable) from the image files of attempt folders: of each id's last attempt with ``total`` images, all files are read, hashed and compared.

    Files that can't be read are near nothing and not blank; ``unreadable`` counts them.
    """
    groups = aggregate.latest(directory.image_groups(directory.manifest(spark, root), total=total), "id", "attempt")
    listed = groups.select("id", F.posexplode("images").alias("idx", "path"))
    looked = hashed_files(directory.files(spark, root, content=True).select("path", "content")).drop("content")
    images = listed.join(looked, "path").withColumn("unread", F.col("phash").isNull())
    flags = neighbours.group_flags(images.withColumn("blank", F.coalesce("blank", F.lit(False))), neighbours.hash_pairs(images, limit))
    return flags.join(images.groupBy("id").agg(F.count_if("unread").alias("unreadable")), "id")


def puzzles(groups: DataFrame, rules: DataFrame, seed: int = 7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(four options, four variants of each, ten options)."""
    return assemble.four_options(groups, seed), assemble.four_variants(groups, seed), assemble.ten_options(groups, relatives(rules, groups), seed)


def judged_scores(records: DataFrame) -> DataFrame:
    """(id, reasonableness, readability) from the last record of each id."""
    text = tag_text(F.col("score"), "final_score", default=None)
    return records.select("id", labelled_score(text, "Reasonableness").alias("reasonableness"), labelled_score(text, "Readability").alias("readability"), "pos")


def accuracies(inference: DataFrame) -> DataFrame:
    answer = boxed(F.col("generated_text"))
    return aggregate.pass_rates(inference, correct=answer == F.col("correct_answer")).select(F.col("id").cast("string").alias("key"), F.col("accuracy").alias("value"))


def dataset(styles: list[DataFrame], files: DataFrame | None = None) -> DataFrame:
    """Complete puzzles of all styles under ids ``<id>_<style>``, with the name their image gets."""
    rows = merge.united_styles([select.complete_puzzles(s, files) for s in styles])
    return rows.withColumn("image", F.concat(F.lit("images/"), renamed_image(F.col("id"), F.col("image"))))
