"""Incremental runs by Structured Streaming: new files are read once, items seen before are known by the state store, and requests still owed are counted in state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.merge import owed
from ..sources.json_io import append_lines, exists, last_run, resumed


def run_available(spark: SparkSession, source: str, schema: str, log: str, log_schema: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], key: str = "id", files: int | None = None) -> None:
    """Processes the items of all JSON files that have come since the last call, ``files`` in a micro-batch, and appends the records to ``log``.

    Which keys were seen is state of the query, so a micro-batch costs what its own items cost, however long the log is. Keys that the log has before the first call go
    into the state first. A run reads the log once, for its first micro-batch: that one may be run again after a failure, and then finds its own records there and adds none twice.
    """
    known = f"{checkpoint.rstrip('/')}-known"
    if not exists(spark, f"{checkpoint}/offsets"):
        resumed(spark, log, log_schema, key).select(key).write.mode("overwrite").json(known)
    many = {} if files is None else {"maxFilesPerTrigger": files}
    items = spark.readStream.schema(schema).options(**many).json(source).withColumn("_known", F.lit(False))
    before = spark.readStream.schema(items.select(key).schema).json(known).withColumn("_known", F.lit(True))
    first: list[int] = []

    def batch(rows: DataFrame, number: int) -> None:
        new = rows.filter("not _known").drop("_known")
        if not first:
            first.extend((number, last_run(spark, log) + 1))
            new = owed(new, resumed(spark, log, log_schema, key), key)
        append_lines(process(new), log, first[1] + number - first[0])

    both = items.unionByName(before, allowMissingColumns=True).dropDuplicates([key])
    both.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def owed_attempts(events: DataFrame, total: int = 8) -> DataFrame:
    """(id, attempt) of the requests still owed, from a stream of (id, done): done is false where an item comes, true for each of its finished requests.

    State holds for each id how many are done and whether its requests went out, so a micro-batch touches its own ids alone. An item's requests go out once, with the batch it
    comes in, less what was done until then, that batch included. Null ids are one item.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done, told = state.get if state.exists else (0, False)
        item = False
        for frame in frames:
            done += int(frame["done"].sum())
            item = item or not frame["done"].all()
        if item and not told:
            yield pd.DataFrame({"id": pd.array([key[0]] * max(0, total - done), "Int64"), "attempt": range(done + 1, max(done, total) + 1)})
        state.update((done, told or item))

    return events.select("id", "done").groupBy("id").applyInPandasWithState(step, "id long, attempt long", "done long, told boolean", "append", GroupStateTimeout.NoTimeout)
