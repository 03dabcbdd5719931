"""A dataset behind a fetcher as a Spark data source: pages are partitions, executors fetch them as Arrow batches, and filters and columns reach the fetcher.

The fetcher is an object of the user, named ``package.module:name``, that all executors can import. What it needs to log in is its own affair; no secret passes through the plan.
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib import import_module
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: A condition on a column that holds for each wanted row: (column, kind, value), kind one of the classes of pyspark.sql.datasource such as EqualTo or GreaterThan.
Condition = tuple[str, str, object]


class Fetcher(Protocol):
    def pages(self, name: str, split: str, conditions: list[Condition]) -> list:
        """The pages that can hold rows for which all conditions are true; more than those do no harm."""

    def batches(self, name: str, split: str, page, columns: list[str], conditions: list[Condition]) -> Iterator:
        """A page's rows as Arrow batches of just these columns; rows that fail a condition may be left out."""


class Paged(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options), schema)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.options, self.columns, self.conditions = options, schema.fieldNames(), []

    @property
    def fetcher(self) -> Fetcher:
        module, name = self.options["fetch"].split(":")
        return getattr(import_module(module), name)

    def pushFilters(self, filters):
        """Simple conditions reach the fetcher; Spark checks all of them again, so a fetcher may use them for its pages alone."""
        for f in filters:
            if len(getattr(f, "attribute", ())) == 1 and hasattr(f, "value"):
                self.conditions.append((f.attribute[0], type(f).__name__, f.value))
            yield f

    def partitions(self) -> list[InputPartition]:
        # Spark asks for one partition at least.
        return [InputPartition(page) for page in self.fetcher.pages(self.options["dataset"], self.options["split"], self.conditions)] or [InputPartition(None)]

    def read(self, partition: InputPartition):
        if partition.value is not None:
            yield from self.fetcher.batches(self.options["dataset"], self.options["split"], partition.value, self.columns, self.conditions)


def scan(spark: SparkSession, fetch: str, name: str, split: str, schema: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of ``split`` of a dataset, of ``columns`` alone if they are given; no pages give no rows. Filters on it reach the fetcher where the session allows that, which this turns on."""
    from pyspark.sql.types import StructType

    whole = StructType.fromDDL(schema)
    wanted = StructType([whole[c] for c in columns]) if columns else whole
    spark.dataSource.register(Paged)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("paged").schema(wanted).options(fetch=fetch, dataset=name, split=split).load()
