"""Keyed randomness, positions and keyed choices of rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import materialize


def u(*key: Column | str | int) -> Column:
    """A uniform number in [0, 1) that depends on the key alone, the same in SQL: the first 32 bits of an MD5."""
    parts = [k if isinstance(k, Column) else F.lit(str(k)) for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def below(share: float, *key: Column | str | int) -> Column:
    """Whether u(*key) is less than ``share``, by the digits of the MD5 alone: cheaper inside lambdas, which are not compiled."""
    parts = [k if isinstance(k, Column) else F.lit(str(k)) for k in key]
    least = math.ceil(share * 2.0**32)
    return F.md5(F.concat_ws("|", *(p.cast("string") for p in parts))) < F.lit("g" if least >= 2**32 else f"{max(least, 0):08x}")


def last_wins(df: DataFrame, *keys: str, pos: str = "pos") -> DataFrame:
    """Of each key the row of greatest position. Partial aggregation keeps hot keys cheap."""
    return _one(df, keys, F.max_by, pos)


def first_wins(df: DataFrame, *keys: str, pos: str = "pos") -> DataFrame:
    return _one(df, keys, F.min_by, pos)


def _one(df: DataFrame, keys: tuple[str, ...], pick, pos: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), pos).alias("_row")).select(*keys, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)


def dense_ids(df: DataFrame, order: str, name: str = "new_id", by: tuple[str, ...] = (), ties: tuple[str, ...] = (), start: int = 0) -> DataFrame:
    """Adds dense numbers by the column ``order`` (nulls first, then ``ties``), for each value of ``by``, null among them.

    Rows are sorted over ranges; each row's number is its place in its range, moved up by the rows of the ranges before. So no task orders all rows, which a window
    without a partition would need, and no row is compared with the bounds of the ranges.
    """
    rows = _sorted(df, order, by, ties)
    sizes = _before(rows.groupBy(*by, "__range").agg(F.count("*").alias("__n"), F.min("__at").alias("__first")), by)
    return _beside(rows, sizes, by).withColumn(name, F.col("__before") + F.col("__at") - F.col("__first") + start).select(*df.columns, name)


def running_sums(df: DataFrame, order: str, value: str, name: str, by: tuple[str, ...] = (), ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds the sum of ``value`` up to and with each row, by the column ``order`` (then ``ties``), for each value of ``by``; ranges as in dense_ids()."""
    rows = _sorted(df, order, by, ties)
    here = F.sum(value).over(Window.partitionBy("__range", *by).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = _before(rows.groupBy(*by, "__range").agg(F.sum(value).alias("__n")), by)
    return _beside(rows.withColumn("__here", here), sums, by).withColumn(name, F.col("__before") + F.coalesce("__here", F.lit(0))).select(*df.columns, name)


def _sorted(df: DataFrame, order: str, by: tuple[str, ...], ties: tuple[str, ...]) -> DataFrame:
    """Written with ``__range`` and ``__at``: which range of by, order and ties a row is in, and a number that rises with them.

    Ranges hold as many rows each, as sampled; their number is that of the session's shuffle partitions, of which the adaptive execution joins small ones. Rows
    that are alike in order and ties are told apart by a hash of the rest, so they need not share a range. The rows are written once, as ranges are drawn anew each time a plan runs.
    """
    keys = [*by, order, *ties, "__tie"]
    rows = df.withColumn("__tie", F.xxhash64(*df.columns)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(rows.withColumn("__at", F.monotonically_increasing_id()).drop("__tie")).withColumn("__range", F.shiftright("__at", 33))


def _before(sizes: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """With the sum of ``__n`` over the ranges before, a row a range and value of ``by``."""
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")


def _beside(rows: DataFrame, sizes: DataFrame, by: tuple[str, ...]) -> DataFrame:
    sizes = sizes.select(F.col("__range").alias("__r"), *(F.col(c).alias(f"__b{i}") for i, c in enumerate(by)), *(c for c in sizes.columns if c not in (*by, "__range")))
    same = F.col("__range") == F.col("__r")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"__b{i}"))
    return rows.join(sizes, same)


def overlay(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Right-biased: columns of ``right`` that are not null there take the place of the left ones; new columns are added."""
    there = [c for c in right.columns if c != key]
    r = right.select(key, *(F.col(c).alias(f"_r_{c}") for c in there))
    old = [F.coalesce(f"_r_{c}", c).alias(c) if c in there else F.col(c) for c in left.columns]
    return left.join(r, key, how).select(*old, *(F.col(f"_r_{c}").alias(c) for c in there if c not in left.columns))


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Selects and renames the columns of ``mapping`` that there are."""
    return df.select(*(F.col(a).alias(b) for a, b in mapping.items() if a in df.columns))
