"""JSON arrays and JSON lines with explicit schemas and row positions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from ..functions.keyed import dense_ids, last_wins
from .tables import materialize


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


#: Up to so many blocks of lines go to all tasks; more meet their lines by a join.
BLOCKS = 100_000

_STRING = r'"[^"\\]*(?:\\.[^"\\]*)*"'


def _cut(line: str, depth: int, base: int, token: re.Pattern) -> list[str]:
    """A line cut at the commas between the elements of its document, without the outer brackets; ``depth`` is that at its start."""
    out, start = [], 0
    for m in token.finditer(line):
        c = m.group()
        if c in "[{":
            if depth < base:
                start = m.end()
            depth += 1
        elif c in "]}":
            depth -= 1
            if depth < base:
                out.append(line[start : m.start()])
                # Nothing may follow the end.
                return out + ["]" + line[m.end() :]] * (line[m.end() :].strip() != "")
        elif c == "," and depth == base:
            out.append(line[start : m.start()])
            start = m.end()
    return [*out, line[start:]]


def _elements(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The elements of each block of lines, numbered from 0 in it. The first and the last of a block are marked as its edges: they may go on beyond it."""
    token = re.compile(_STRING + r"|[\[\]{},]")
    block, document, depth, i, open_ = None, None, 0, 0, []
    out: list[tuple] = []
    end = lambda edge: out.append((document, block, i, edge, "\n".join(open_)))
    columns = ["document", "no", "i", "edge", "text"]
    for batch in batches:
        for line, change, no, of, deep, base in zip(*(batch[c] for c in ("value", "change", "no", "document", "deep", "base")), strict=True):
            if no != block:
                if block is not None:
                    end(True)
                block, document, depth, i, open_ = no, of, deep, 0, []
            first, *more = _cut(line, depth, base, token)
            depth += change
            open_.append(first)
            for part in more:
                end(i == 0)
                i, open_ = i + 1, [part]
        yield pd.DataFrame(out, columns=columns)
        out.clear()
    if block is not None:
        end(True)
        yield pd.DataFrame(out, columns=columns)


def read_array(spark: SparkSession, path: str, schema: StructType | str, strict: bool = False) -> DataFrame:
    """Rows of files that hold one JSON array (or one object) each, or of parts of files that hold one together, as write_array() leaves them, with their place in it as ``pos``.

    Files are read by lines in blocks, twice: how deep each block starts is a running sum over blocks; then each block is cut into elements, which are written once. Only an element at the edge
    of a block meets the rest of it by a shuffle. So a task holds a block of lines, or one element, and a file of one line goes through one task. Documents that aren't JSON
    give no rows, or an error if ``strict``; a path that isn't there is an error.
    """
    kind = _schema(schema).simpleString()
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.filter(F.trim("value") != "").withColumn("n", F.monotonically_increasing_id())
    bare = F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '"[^"]*"', "")  # without escapes each quote begins or ends a string
    lines = lines.withColumn("change", F.length(F.regexp_replace(bare, r"[^\[{]", "")) - F.length(F.regexp_replace(bare, r"[^\]}]", "")))
    # A row a block: how deep it starts, and which document its file belongs to.
    blocks = lines.groupBy("file", "block").agg(F.sum("change").alias("all"), F.min_by(F.substring(F.ltrim("value"), 1, 1), "n").alias("head"))
    order = Window.partitionBy().orderBy("file", "block")
    blocks = blocks.withColumn("no", F.row_number().over(order).cast("long")).withColumn("deep", F.coalesce(F.sum("all").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = (F.col("deep") <= 0) & (F.coalesce(F.lag("file").over(order), F.lit("")) != F.col("file"))
    blocks = blocks.withColumn("document", F.sum(starts.cast("int")).over(order))
    first = F.first("head").over(Window.partitionBy("document").orderBy("file", "block"))
    blocks = materialize(blocks.withColumn("base", F.when(first == "[", 1).otherwise(0)).drop("head"))
    few = F.broadcast if blocks.count() <= BLOCKS else lambda df: df
    # In each task a block's lines follow one another, whichever way the join goes.
    placed = lines.join(few(blocks), ["file", "block"]).sortWithinPartitions("n").select("value", "change", "no", "document", "deep", "base")
    bad = (F.trim("text") != "") & F.try_parse_json("text").isNull()
    cut = placed.mapInPandas(_elements, "document long, no long, i long, edge boolean, text string")
    cut = materialize(cut.withColumn("bad", ~F.col("edge") & bad))
    # Elements before a block: commas in the blocks before.
    before = Window.partitionBy("document").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    past = cut.groupBy("document", "no").agg(F.max("i").alias("i")).select("no", F.coalesce(F.sum("i").over(before), F.lit(0)).alias("past"))
    each = cut.join(few(materialize(past)), "no").withColumn("pos", F.col("past") + F.col("i"))
    meeting = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "text"))), lambda x: x["text"]), "\n")
    edges = materialize(each.filter("edge").groupBy("document", "pos").agg(meeting.alias("text")).withColumn("bad", bad))
    found = each.filter("not edge").select("document", "pos", "text", "bad").unionByName(edges)
    # A document is whole if all of its elements are, and it ends as deep as it began.
    ends = blocks.groupBy("document").agg(F.max_by(F.col("deep") + F.col("all"), "no").alias("after"))
    broken = found.groupBy("document").agg(F.bool_or(F.col("bad") | ((F.trim("text") == "") & (F.col("pos") > 0))).alias("bad"))
    broken = materialize(broken.join(ends, "document").filter("bad or after != 0").select("document"))
    if strict and not broken.isEmpty():
        raise ValueError(f"no JSON array in {path}")
    rows = found.filter(F.trim("text") != "").join(few(broken), "document", "left_anti")
    return rows.select(F.col("pos").cast("long").alias("pos"), F.from_json("text", kind).alias("row")).select("pos", "row.*")


def write_array(df: DataFrame, path: str, order: str | None = None) -> None:
    """A JSON array in order, an element a line, as a folder of text parts which are the array one after another; concatenated by name they are one file. No task has all rows.

    The rows are shuffled once, by the sort that writes them. Only those of the greatest key, among which is the one without a comma, are numbered first.
    """
    body = F.to_json(F.struct(*df.columns))
    rows = df.select((F.col(order) if order else body).alias("o"), F.concat(F.lit("  "), body).alias("value"))
    top = materialize(rows.agg(F.max("o").alias("top")))
    rows = rows.crossJoin(F.broadcast(top)).withColumn("last", F.col("o").eqNullSafe(F.col("top")))
    # Without a key the text is the key, and is not shuffled beside itself.
    key = F.col("o") if order else F.lit(0)
    tail = dense_ids(rows.filter("last").select(key.alias("o"), "value"), "value", "n")
    n = tail.agg(F.max("n")).first()[0]
    tail = tail.select(F.lit(2).alias("k"), "o", "n", F.when(F.col("n") < F.lit(-1 if n is None else n), F.concat("value", F.lit(","))).otherwise(F.col("value")).alias("value"))
    every = rows.filter("not last").select(F.lit(1).alias("k"), key.alias("o"), F.lit(0).cast("long").alias("n"), F.concat("value", F.lit(",")).alias("value")).unionByName(tail)
    ends = df.sparkSession.createDataFrame([(0, 0, "["), (9, 0, "]")], "k int, n long, value string")
    every = every.unionByName(ends, allowMissingColumns=True)
    every.orderBy("k", "o", "n", "value").select("value").write.mode("overwrite").text(path)


def text_parts(spark: SparkSession, path: str, body: DataFrame, head: str, foot: str) -> None:
    """Lines (k, n, value) in order between two others, a comma after all but the last of k = 1, as a folder of text parts."""
    last = body.agg(F.max("n")).first()[0]
    ends = spark.createDataFrame([(0, 0, head), (9, 0, foot)], "k int, n long, value string")
    comma = F.when((F.col("k") == 1) & (F.col("n") < F.lit(-1 if last is None else last)), F.concat("value", F.lit(","))).otherwise(F.col("value"))
    every = body.select(F.col("k").cast("int").alias("k"), F.col("n").cast("long").alias("n"), "value").unionByName(ends)
    every.withColumn("value", comma).orderBy("k", "n").select("value").write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str | list[str], schema: StructType | str, tolerant: bool = True) -> DataFrame:
    """Rows of JSON lines in one file, a folder or a pattern of part files; malformed lines are skipped, or an error if not ``tolerant``."""
    return spark.read.schema(_schema(schema)).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").json(path)


def append_lines(df: DataFrame, path: str, run: int | None = None) -> None:
    """Appends JSON lines. With ``run``, each row says in ``_run`` which append it came with, so that later rows can win on resume."""
    (df if run is None else df.withColumn("_run", F.lit(run).cast("long"))).write.mode("append").json(path)


def last_run(spark: SparkSession, path: str) -> int:
    """The number of the last append to ``path`` that says so; -1 where there is none."""
    if not exists(spark, path):
        return -1
    top = read_lines(spark, path, "_run long").agg(F.max("_run")).first()[0]
    return -1 if top is None else top


def write_sorted(df: DataFrame, path: str, *order: str) -> None:
    """A snapshot in global order. The committer renames the finished files at the end, so readers never see half of it."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def resumed(spark: SparkSession, path: str, schema: StructType | str, key: str = "id", pos: str | None = None) -> DataFrame:
    """The earlier output, of each key the last row; an empty table where there is none. Rows without a key are left out.

    Later is what has a greater ``pos``, where rows have one; else a later ``_run`` (rows that name none came first), then a later file, then a greater row.
    """
    schema = _schema(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    if pos is not None:
        return last_wins(read_lines(spark, path, schema).filter(F.col(key).isNotNull()), key, pos=pos)
    wide = StructType([*schema.fields, StructField("_run", LongType())])
    rows = read_lines(spark, path, wide).select("*", F.col("_metadata.file_modification_time").alias("_time")).filter(F.col(key).isNotNull())
    later = F.struct(F.coalesce("_run", F.lit(-1)).alias("run"), F.col("_time"), F.to_json(F.struct(*schema.names)).alias("row"))
    return last_wins(rows.withColumn("_later", later).select(*schema.names, "_later"), key, pos="_later").select(*schema.names)


def seed_questions(raw: DataFrame) -> DataFrame:
    """Source rows without a null id, with parsed options (empty where they can't be), the first image, and whether there is one."""
    from ..functions.text import parsed_options

    image = F.try_element_at("images", F.lit(1))
    return raw.filter("id is not null").select("id", "prompt", parsed_options(F.col("options")).alias("options"), image.isNotNull().alias("has_image"), image.alias("image"), "explanation", "correct_answer")
