"""The text functions under names that SQL can call, registered in one call.

Scalar and table functions are SQL functions over built-in ones, so they are inlined into the plan and stay in the JVM. One table function is a Python one: it reads a whole table, partition by
partition, to number bullets through the rows of a partition.
"""

from __future__ import annotations

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

# The patterns are the formats'.
SCALAR = {
    "strip(c STRING) RETURNS STRING": r"regexp_replace(c, r'(?U)^\s+|\s+$', '')",
    "tag_text(c STRING, tag STRING) RETURNS STRING": r"CASE WHEN c RLIKE concat('(?s)<', tag, '>(.*?)</', tag, '>') THEN regexp_replace(regexp_extract(c, concat('(?s)<', tag, '>(.*?)</', tag, '>'), 1), r'(?U)^\s+|\s+$', '') ELSE '' END",
    "int_tag(c STRING, tag STRING) RETURNS INT": r"try_cast(regexp_extract(c, concat('(?is)<', tag, r'>\s*(\d{1,2})\s*</', tag, '>'), 1) AS INT)",
    "labelled_score(c STRING, label STRING) RETURNS INT": r"try_cast(regexp_extract(c, concat(label, r':\s*(\d+)'), 1) AS INT)",
    "boxed(c STRING) RETURNS STRING": r"CASE WHEN c RLIKE r'\\boxed\{(.*?)\}' THEN regexp_replace(regexp_extract(c, r'\\boxed\{(.*?)\}', 1), r'(?U)^\s+|\s+$', '') END",
    "options_block(options MAP<STRING, STRING>) RETURNS STRING": "array_join(transform(map_entries(options), e -> concat(e.key, ': ', e.value)), '\n')",
    "parsed_options(c STRING) RETURNS MAP<STRING, STRING>": "coalesce(from_json(c, 'map<string,string>'), CAST(map() AS MAP<STRING, STRING>))",
    "bullet_list(c STRING) RETURNS ARRAY<STRING>": r"transform(filter(transform(split(coalesce(c, ''), '\n'), x -> regexp_replace(x, r'(?U)^\s+|\s+$', '')), x -> x != '' AND x != '-'), x -> regexp_replace(x, '^[- ]+', ''))",
}
TABLE = {"bullets(c STRING) RETURNS TABLE (pos INT, bullet STRING)": r"SELECT p, b FROM (SELECT posexplode(transform(filter(transform(split(coalesce(c, ''), '\n'), x -> regexp_replace(x, r'(?U)^\s+|\s+$', '')), x -> x != '' AND x != '-'), x -> regexp_replace(x, '^[- ]+', ''))) AS (p, b))"}


@F.udtf(returnType="id long, nth int, bullet string")
class NumberedBullets:
    """The bullets of all rows (id, rule) of a partition under running numbers, in the order of the rows; blank ones are dropped."""

    def __init__(self):
        self.n = 0

    def eval(self, row: Row):
        for line in (row["rule"] or "").split("\n"):
            bullet = line.strip().lstrip("- ")
            if bullet:
                yield row["id"], self.n, bullet
                self.n += 1


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session's SQL and returns their names; calling it again changes nothing."""
    for head, body in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    for head, body in TABLE.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udtf.register("numbered_bullets", NumberedBullets)
    return [h.split("(")[0] for h in (*SCALAR, *TABLE)] + ["numbered_bullets"]
