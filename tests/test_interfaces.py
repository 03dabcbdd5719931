"""SQL functions, the remote source's conditions and columns, counters beside rows."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ruleforge.functions import sql, text
from ruleforge.operators import aggregate, merge
from ruleforge.sources import remote

TEXTS = ["- a\n\n -  b \n-\n c-d", "", None, "<t> x\n </t><t>y</t> <T>7</T>", "<T> 123 </T>", "score: 12 of", r"so \boxed{ 4 } and \boxed{5}", r"\boxed{}"]


def test_sql_functions_equal_the_column_functions(spark):
    names = sql.register(spark)
    assert sql.register(spark) == names and "bullets" in names
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, c string")
    pairs = {
        "tag_text(c, 't')": text.tag_text(F.col("c"), "t"),
        "int_tag(c, 't')": text.int_tag(F.col("c"), "t"),
        "labelled_score(c, 'score')": text.labelled_score(F.col("c"), "score"),
        "boxed(c)": text.boxed(F.col("c")),
        "bullet_list(c)": text.bullets(F.col("c")),
        "options_block(parsed_options('{\"a\": \"x\", \"b\": \"y\"}'))": text.options_block(text.parsed_options(F.lit('{"a": "x", "b": "y"}'))),
        "parsed_options(c)": text.parsed_options(F.col("c")),
    }
    df.createOrReplaceTempView("texts")
    for call, column in pairs.items():
        assert [r[0] for r in spark.sql(f"SELECT {call} FROM texts ORDER BY id").collect()] == [r[0] for r in df.orderBy("id").select(column).collect()], call
    got = spark.sql("SELECT id, pos, bullet FROM texts, LATERAL bullets(c)")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.select("id", F.posexplode(text.bullets(F.col("c")))).collect()))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_table_function_over_partitions(spark):
    sql.register(spark)
    spark.createDataFrame([(1, "b", "- x\n- y"), (2, "a", "z\n\n"), (3, "b", "-\nw"), (4, "a", None)], "id long, grp string, rule string").createOrReplaceTempView("rules")
    got = spark.sql("SELECT * FROM numbered_bullets(TABLE(SELECT id, grp, rule FROM rules) PARTITION BY grp ORDER BY id)")
    assert sorted(map(tuple, got.collect())) == [(1, 0, "x"), (1, 1, "y"), (2, 0, "z"), (3, 2, "w")]


class Pages:
    """Ten pages of ten rows; each call leaves a file in a folder."""

    def pages(self, name, split, conditions):
        low = max([v for c, kind, v in conditions if c == "id" and kind == "GreaterThan"], default=-1)
        return [p for p in range(10) if split == "train" and p * 10 + 9 > low]

    def batches(self, name, split, page, columns, conditions):
        open(f"{name}/{page}-{'+'.join(columns)}-{os.urandom(3).hex()}", "w").close()
        ids = np.arange(page * 10, page * 10 + 10)
        yield pa.RecordBatch.from_pydict({c: {"id": ids, "x": ids * 2}[c] for c in columns})


pages = Pages()


def test_conditions_and_columns_reach_the_fetcher(spark, tmp_path):
    scan = lambda split="train", columns=None: remote.scan(spark, "tests.test_interfaces:pages", str(tmp_path), split, "id long, x long", columns)
    assert sorted(map(tuple, scan(columns=["x", "id"]).filter("id > 74").collect())) == [(2 * i, i) for i in range(75, 100)]
    seen = sorted(f.rpartition("-")[0] for f in os.listdir(tmp_path))
    assert seen == ["7-x+id", "8-x+id", "9-x+id"]
    assert scan().count() == 100 and scan("none").count() == 0


def test_rows_and_counters_come_from_one_execution(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        runs.add(1)
        return x

    left = spark.range(50).select(counted("id").alias("id"), F.when(F.col("id") % 5 > 0, "old").alias("e"))
    right = spark.createDataFrame([(i, "new") for i in range(0, 60, 2)], "id long, t string")
    rows, seen = merge.with_counters(merge.replaced(left, right, "id", "e", "t"))
    rows.write.parquet(f"{tmp_path}/rows")
    assert merge.counters(seen) == {"replaced": 20, "missing": 25, "no_field": 5} and runs.value == 50
    rows, seen = aggregate.with_status(spark.createDataFrame([(None,), ("",), ("e",)], "error string"))
    assert len(rows.collect()) == 3 and seen.get == {"total": 3, "success": 2}


def test_merge_counters_alone(spark):
    with pytest.raises(Exception, match="UNRESOLVED|cannot be resolved"):
        merge.with_counters(spark.range(1))[0].count()
