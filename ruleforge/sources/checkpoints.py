"""Generations as Parquet snapshots under a folder, and the export of an evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keyed import dense_ids
from .json_io import exists, text_parts


def save(folder: str, generation: int, population: DataFrame, created: DataFrame | None = None) -> None:
    """A snapshot is complete once its manifest row is there, which is written last."""
    spark = population.sparkSession
    population.write.mode("overwrite").parquet(f"{folder}/generation={generation}/population")
    if created is not None:
        created.write.mode("overwrite").parquet(f"{folder}/generation={generation}/created")
    n = population.count()
    spark.range(1).select(F.lit(generation).alias("generation"), F.lit(n).cast("long").alias("rules"), F.lit(f"{folder}/generation={generation}/population").alias("path"), F.current_timestamp().alias("saved_at")).write.mode("append").parquet(f"{folder}/manifest")


def listed(manifest: DataFrame) -> DataFrame:
    """The manifest, newest generation first; of a generation saved twice the later row."""
    last = manifest.groupBy("generation").agg(F.max_by(F.struct("rules", "path", "saved_at"), "saved_at").alias("m"))
    return last.select("generation", "m.*").orderBy(F.desc("generation"))


def restore(spark: SparkSession, folder: str, generation: int | None = None) -> tuple[int, DataFrame] | None:
    """(generation, population) of the newest snapshot, or the one asked for; None without one. Rows whose files are gone are passed over."""
    if not exists(spark, f"{folder}/manifest"):
        return None
    rows = listed(spark.read.parquet(f"{folder}/manifest"))
    for r in rows.collect():  # one row a generation
        if (generation is None or r.generation == generation) and exists(spark, r.path):
            return r.generation, spark.read.parquet(r.path)
    return None


def export_islands(rules: DataFrame, folder: str) -> None:
    rules.write.mode("overwrite").partitionBy("island_id").json(folder)


def export_document(rules: DataFrame, path: str) -> None:
    """One JSON document {total_rules, n_islands, islands: [{island_id, size, rules: [...]}]}, a rule a line, as a folder of text parts which are the document one after another. No task has all rules."""
    spark = rules.sparkSession
    plain = [c for c in rules.columns if c != "island_id"]
    rows = dense_ids(rules.select("island_id", F.to_json(F.struct(*plain)).alias("rule")), "rule", "nth", by=("island_id",))
    sizes = dense_ids(rules.groupBy("island_id").agg(F.count("*").alias("size")), "island_id", "at")
    total = sizes.agg(F.sum("size").alias("n"), F.count("*").alias("k")).first()
    # An island's lines: its head, its rules, its end; `at` orders islands and `nth` the lines of one.
    head = sizes.select("at", F.lit(-1).cast("long").alias("nth"), F.concat(F.lit('{"island_id": '), F.coalesce(F.col("island_id").cast("string"), F.lit("null")), F.lit(', "size": '), "size", F.lit(', "rules": [')).alias("value"))
    foot = sizes.select("at", F.col("size").alias("nth"), F.concat(F.lit("]}"), F.when(F.col("at") < F.lit(total.k - 1), ",").otherwise("")).alias("value"))
    numbered = sizes.select(F.col("island_id").alias("_island"), "size", "at")
    body = rows.join(numbered, F.col("island_id").eqNullSafe(F.col("_island"))).select("at", "nth", F.concat(F.lit("  "), "rule", F.when(F.col("nth") < F.col("size") - 1, ",").otherwise("")).alias("value"))
    lines = dense_ids(head.unionByName(body).unionByName(foot), "at", "n", ties=("nth",))
    text_parts(spark, path, lines.select(F.lit(2).alias("k"), "n", "value"), f'{{"total_rules": {total.n or 0}, "n_islands": {total.k}, "islands": [', "]}")
