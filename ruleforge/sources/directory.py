"""Folders of attempts as tables: ``<root>/<id>_<attempt>/{output_correct,output_incorrect}/*`` and ``test_result.txt``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import HASH_EXTENSIONS, mime_type
from .files import read_files

_ATTEMPT = r"/(\d+)_(\d+)/(?:(output_correct|output_incorrect)/)?([^/]+)$"


def files(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """(path, id, attempt, kind, name, length[, content]) of the files of all attempts; content is read only if asked for."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return _of_attempts(found, content)


def known_files(paths: DataFrame, root: str) -> DataFrame:
    """As files() with content, of the rows' ``path`` below the root. Nothing is listed: a listing of all files is held by the driver."""
    found = read_files(paths.select("path"), root)
    return _of_attempts(found.withColumn("path", F.concat(F.lit(root.rstrip("/") + "/"), "path")).withColumn("length", F.length("content").cast("long")), True)


def _of_attempts(found: DataFrame, content: bool) -> DataFrame:
    found = found.filter(F.col("path").rlike(_ATTEMPT))
    part = lambda i: F.regexp_extract("path", _ATTEMPT, i)
    columns = ["path", part(1).try_cast("long").alias("id"), part(2).try_cast("int").alias("attempt"), F.nullif(part(3), F.lit("")).alias("kind"), part(4).alias("name"), "length"]
    return found.select(*columns, *(["content"] if content else []))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(id, attempt, kind, path, test_result): each file beside its attempt's recorded result."""
    results = files(spark, root, content=True).filter("name = 'test_result.txt'").select("id", "attempt", F.col("content").cast("string").alias("test_result"))
    return files(spark, root).filter("name != 'test_result.txt'").join(results, ["id", "attempt"], "left").select("id", "attempt", "kind", "path", "test_result")


def image_groups(manifest: DataFrame, extensions: list[str] = HASH_EXTENSIONS, total: int | None = 8) -> DataFrame:
    """(id, attempt, images): sorted image paths of each attempt, of those with ``total`` images alone if it is given."""
    images = manifest.filter(F.col("kind").isNotNull() & F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1)).isin(extensions))
    groups = images.groupBy("id", "attempt").agg(F.sort_array(F.collect_list("path")).alias("images"))
    return groups if total is None else groups.filter(F.size("images") == total)


def data_url(path: Column, content: Column) -> Column:
    """``data:<mime>;base64,...``; null content stays null, as an image that can't be read is sent without one."""
    return F.concat(F.lit("data:"), mime_type(path), F.lit(";base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def first_existing(df: DataFrame, listed: DataFrame, *candidates: Column) -> DataFrame:
    """Adds ``found``: the first candidate path that is listed."""
    each = df.withColumn("_cand", F.array(*candidates)).withColumn("_key", F.xxhash64(*df.columns))
    hits = each.select("_key", F.posexplode("_cand").alias("_nth", "path")).join(listed.select("path").distinct(), "path").groupBy("_key").agg(F.min_by("path", "_nth").alias("found"))
    return each.join(hits, "_key", "left").drop("_cand", "_key")
