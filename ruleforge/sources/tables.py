"""Tables of a folder, and tables that a plan writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows over as many tasks as shuffles have, twice the cores at least: for rows of a small file that each take long, which would all go through the task that reads it."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))


def shuffled(df: DataFrame) -> DataFrame:
    """For a side of a join that grows with the input: it is not broadcast, however small its files are, so it doesn't pass through the driver."""
    return df.hint("merge")


_OWN_ROOTS: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``. Where that is unset: in a temporary folder in local mode, in the warehouse on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _OWN_ROOTS:
            local = spark.sparkContext.master.startswith("local")
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="scratch-") if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{app}"
        root = _OWN_ROOTS[app]
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Written and read again: the plan starts anew here, and lost executors lose nothing of it."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitioned(df: DataFrame, column: str) -> DataFrame:
    """Written in a folder for each value of ``column`` and read again: a filter on it reads that folder alone."""
    path = scratch(df.sparkSession)
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
