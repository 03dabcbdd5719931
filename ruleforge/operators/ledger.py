"""Batch jobs that outlive the driver.

A folder holds the requests, written once in a partition for each batch; the answers, a table for each time that batches were settled; what those batches still owe, likewise; and a ledger, to which each step
of a batch is added before the next is taken. Batches that end one after another are written together: what came in is held as a plan until nothing can be opened, nothing ended or it is GATHERED
tables, while the places of ended batches at the service go to others. So jobs follow neither the batches nor, if the service takes many batches in a call, the rounds of open ones. A run that breaks off is called again with the same folder: batches that are open are polled, finished ones are left alone, and a
batch whose sending was noted but not its handle is looked up at the service by its key, so none is sent twice.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.keyed import last_wins
from .providers import batch_outcome, batches

LEDGER = "at long, batch long, attempt int, event string, handle string"
ANSWER = "id long, custom_id string, status_code int, error string, content string"
#: Tables of answers that are written together; each is one poll's.
GATHERED = 32


class BatchFailed(Exception):
    """Raised by a service that gave up a batch as a whole."""


class BatchService(Protocol):
    def submit(self, rows: DataFrame, key: str) -> str:
        """Opens a batch under a key of the caller's and returns its handle."""

    def find(self, key: str) -> str | None:
        """The handle of the batch that was opened under a key, if there is one."""

    def poll(self, handle: str) -> DataFrame | None:
        """None while the batch runs, then its answers: id, custom_id, status_code, error, content."""


class BulkService(Protocol):
    """A service that takes many batches in a call, so that a round of them is one plan. Each batch has a key and a handle of its own all the same."""

    def submit_all(self, rows: DataFrame, keys: list[str]) -> list[str]:
        """Opens a batch for each key, of the rows that have it in the column ``key``, and returns the handles in this order."""

    def find(self, key: str) -> str | None:
        """As of BatchService."""

    def poll_all(self, handles: list[str]) -> tuple[DataFrame | None, list[str], list[str]]:
        """The answers of the batches that are done, as poll() has them and with ``key``; the handles of those; and of the batches that were given up as a whole."""


class Ledger:
    """The events of all batches; the last one of a batch is its state."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.path = spark, f"{folder}/ledger"
        self.at, self.planned, self.settled, self.state = 0, False, 0, {}
        try:
            events = spark.read.schema(LEDGER).json(self.path)
        except AnalysisException:  # no ledger yet
            return
        for r in events.groupBy("batch").agg(F.max("at").alias("at"), F.max_by(F.struct("attempt", "event", "handle"), "at").alias("last")).collect():  # a row a batch
            self.at = max(self.at, r.at)
            if r.batch < 0:
                self.planned, self.settled = True, r.last.attempt
            else:
                self.state[r.batch] = (r.last.attempt, r.last.event, r.last.handle)

    def note(self, events: list[tuple[int, int, str, str | None]]) -> None:
        """Adds events (batch, attempt, event, handle) as one file, which has its name once it is whole. They are few, so no job is started for them."""
        if not events:
            return
        names = [f.split()[0] for f in LEDGER.split(", ")]
        lines = "".join(json.dumps(dict(zip(names, (self.at + 1 + i, *e), strict=True))) + "\n" for i, e in enumerate(events))
        at = self.spark._jvm.org.apache.hadoop.fs.Path
        part, whole = at(f"{self.path}/_part-{self.at + 1}"), at(f"{self.path}/part-{self.at + 1}.json")
        files = whole.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = files.create(part, True)
        out.write(bytearray(lines.encode()))
        out.close()
        if not files.rename(part, whole):
            raise OSError(f"can't write {whole.toString()}")
        self.at += len(events)
        self.state |= {b: tuple(rest) for b, *rest in events if b >= 0}


def run(requests: DataFrame, folder: str, service: BatchService | BulkService, size: int = 500, active: int = 32, most: int = 5, every: float = 30.0, sleep: Callable[[float], None] = time.sleep, key: str = "id") -> DataFrame:
    """(id, content, error, attempts): the answer of each request, in batches of ``size`` requests (by ``pos``), of which ``active`` are open at most.

    What fails of a batch, or a batch that fails as a whole, is sent again as the batch's next attempt, ``most`` times in all; what fails then keeps its place with an error. Ids must differ and
    not be null. Called again with the same folder, it goes on where it broke off; ``requests`` must then be the same. The driver holds a row for each batch.
    """
    spark = requests.sparkSession
    ledger = Ledger(spark, folder)
    planned = batches(requests, size, active)
    planned = planned.select(F.col(key).alias("id"), "pos", "batch", "custom_id", *(c for c in requests.columns if c not in (key, "id", "pos", "batch", "custom_id")))
    if not ledger.planned:
        planned.write.mode("overwrite").partitionBy("batch").parquet(f"{folder}/requests")
        ledger.note([(-1, 0, "planned", None)])
    rows = spark.read.schema(planned.schema).parquet(f"{folder}/requests")
    known = [r.batch for r in rows.select("batch").distinct().orderBy("batch").collect()]  # from the folders' names

    def answers() -> DataFrame:
        """All that came in so far, of the settlings that were noted."""
        return spark.read.schema(ANSWER + ", batch long, attempt int").parquet(*(f"{folder}/answers/{k}" for k in range(1, ledger.settled + 1))) if ledger.settled else spark.createDataFrame([], ANSWER + ", batch long, attempt int")

    def owe(again: dict[int, int], came: DataFrame, name: int) -> set[int]:
        """Writes what batches still owe, with the attempt in which it is sent, as one table in place of what an earlier run left there; returns those that owe something."""
        mine = rows.filter(F.col("batch").isin(list(again)))
        mine = mine.join(batch_outcome(came).filter(F.col("batch").isin(list(again)) & (F.col("outcome") == "ok")).select("batch", "id"), ["batch", "id"], "left_anti")
        attempt = reduce(lambda x, n: x.when(F.col("batch").isin([b for b in again if again[b] == n]), n), set(again.values()), F)
        mine = mine.withColumn("_attempt", attempt)
        mine.write.mode("overwrite").parquet(f"{folder}/owed/{name}")
        table = spark.read.schema(mine.schema).parquet(f"{folder}/owed/{name}")
        left = {r.batch for r in table.select("batch").distinct().collect()}
        owing.update(dict.fromkeys(left, table))
        return left

    def settled(ended: list[int], found: list[DataFrame]) -> set[int]:
        """Writes the answers that came in, and of the ended batches that may be sent again what they still owe; returns those that owe something. Two or three jobs, however many batches ended."""
        came, k = answers(), ledger.settled + 1
        new = reduce(DataFrame.unionAll, found) if found else came.limit(0)
        new.write.mode("overwrite").parquet(f"{folder}/answers/{k}")
        came = came.unionAll(spark.read.schema(came.schema).parquet(f"{folder}/answers/{k}"))
        again = {b: ledger.state[b][0] + 1 for b in ended if ledger.state[b][0] < most}
        return owe(again, came, k) if again else set()

    def opened(numbers: dict[int, int]) -> list[str]:
        """The handles of batches, sent in one call if the service can."""
        if not bulk:
            return [service.submit((rows if n == 1 else owing.pop(b).drop("_attempt")).filter(F.col("batch") == b), f"{b}-{n}") for b, n in numbers.items()]
        first, parts = rows.withColumn("_attempt", F.lit(1)), {}
        for b, n in numbers.items():
            table = first if n == 1 else owing.pop(b)
            parts.setdefault(id(table), (table, []))[1].append(b)
        together = reduce(DataFrame.unionByName, (table.filter(F.col("batch").isin(part)) for table, part in parts.values()))
        return service.submit_all(together.withColumn("key", F.concat_ws("-", "batch", "_attempt")).drop("batch", "_attempt"), [f"{b}-{n}" for b, n in numbers.items()])

    def polled(running: list[int]) -> tuple[list[int], list[DataFrame]]:
        """The batches that ended, and what came in of them."""
        columns = ["id", "custom_id", "status_code", "error", "content"]
        if bulk and running:
            of = {ledger.state[b][2]: b for b in running}
            came, done, lost = service.poll_all(list(of))
            key = lambda at: F.substring_index("key", "-", at)
            return [of[h] for h in (*done, *lost)], [came.select(*columns, key(1).cast("long").alias("batch"), key(-1).cast("int").alias("attempt"))] if done else []
        gone, found = [], []
        for b in running:
            n, _, handle = ledger.state[b]
            try:
                came = service.poll(handle)
                if came is None:
                    continue
                found.append(came.select(*columns, F.lit(b).cast("long").alias("batch"), F.lit(n).alias("attempt")))
            except BatchFailed:
                pass
            gone.append(b)
        return gone, found

    # A batch that was being sent when the run broke off is open, if the service knows it.
    ledger.note([(b, n, "open", handle) for b, (n, event, _) in ledger.state.items() if event == "sending" and (handle := service.find(f"{b}-{n}"))])
    waiting = [b for b in known if ledger.state.get(b, (0, "new"))[1] in ("new", "again", "sending")]
    open_ = [b for b in known if ledger.state.get(b, (0, "new"))[1] == "open"]
    bulk, owing = hasattr(service, "submit_all"), {}
    numbered = lambda b: (lambda n, event, _: n if event == "sending" else n + 1)(*ledger.state.get(b, (0, "new", None)))
    if again := {b: n for b in waiting if (n := numbered(b)) > 1}:
        owe(again, answers(), 0)
    ended, found = [], []
    while waiting or open_ or ended:
        opening = [waiting.pop(0) for _ in range(min(len(waiting), active - len(open_)))]
        if opening:
            numbers = {b: numbered(b) for b in opening}
            ledger.note([(b, n, "sending", None) for b, n in numbers.items()])
            ledger.note([(b, n, "open", handle) for (b, n), handle in zip(numbers.items(), opened(numbers), strict=True)])
            open_ += opening
        gone, came = polled(open_)
        ended, found, gone = ended + gone, found + came, set(gone)
        open_ = [b for b in open_ if b not in gone]
        if ended and (not waiting or not gone or len(found) >= GATHERED):
            left = settled(ended, found)
            ledger.note([(-1, ledger.settled + 1, "settled", None), *((b, ledger.state[b][0], "again" if b in left else "done", None) for b in ended)])
            ledger.settled += 1
            waiting += [b for b in ended if b in left]
            ended, found = [], []
        if open_ and not gone:
            sleep(every)
    good = last_wins(batch_outcome(answers()).filter("outcome = 'ok'").select("id", "content", "attempt"), "id", pos="attempt")
    return rows.select("id").join(good, "id", "left").select("id", "content", F.when(F.col("attempt").isNull(), "attempts exhausted").alias("error"), F.coalesce("attempt", F.lit(most)).alias("attempts"))
