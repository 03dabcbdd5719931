"""Model calls, embeddings and script runs behind interfaces, with offline defaults that give the same answer each time.

Nothing here runs generated code or opens a network connection: a provider that does is passed in by the user.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ModelProvider(Protocol):
    def __call__(self, prompt: str) -> str: ...


class RateLimited(Exception):
    """Raised by a provider that should be asked again later."""


@dataclass(frozen=True)
class Offline:
    """Answers by a digest of the prompt, inside the tags asked for."""

    tags: tuple[str, ...] = ("answer",)

    def __call__(self, prompt: str) -> str:
        h = hashlib.md5(prompt.encode()).hexdigest()
        return "".join(f"<{t}>{int(h[i * 2 : i * 2 + 2], 16) % 5 + 1}</{t}>" for i, t in enumerate(self.tags))


@dataclass(frozen=True)
class Retry:
    """Asks again only when the provider is rate-limited: base * factor ** attempt seconds later, ``most`` at the longest."""

    tries: int = 8
    base: float = 1.0
    factor: float = 2.0
    most: float = 300.0
    sleep: Callable[[float], None] = time.sleep

    def delay(self, attempt: int) -> float:
        return min(self.most, self.base * self.factor**attempt)

    def call(self, provider: ModelProvider, prompt: str) -> str:
        for attempt in range(self.tries):
            try:
                return provider(prompt)
            except RateLimited:
                if attempt + 1 == self.tries:
                    raise
                self.sleep(self.delay(attempt))
        raise RateLimited


def ask(df: DataFrame, provider: ModelProvider, prompt: str = "prompt", retry: Retry = Retry(), parse: Callable[[str], object] | None = None, parses: int = 3, at_once: int = 8) -> DataFrame:
    """Adds ``response`` and ``error``: a row whose call fails keeps its place with the error, others go on. A task has ``at_once`` calls open at most.

    With ``parse``, a response that it returns None for is asked for again, ``parses`` times in all.
    """
    none = F.lit(None).cast("string")
    schema = df.withColumn("response", none).withColumn("error", none).schema

    def one(text: str) -> tuple[str | None, str | None]:
        try:
            for _ in range(parses if parse else 1):
                answer = retry.call(provider, text)
                if parse is None or parse(answer) is not None:
                    return answer, None
            return None, "no parsable response"
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"

    def run(frames: Iterator):
        with ThreadPoolExecutor(at_once) as calls:
            for frame in frames:
                found = list(calls.map(one, frame[prompt]))
                yield frame.assign(response=[r for r, _ in found], error=[e for _, e in found])

    return df.mapInPandas(run, schema)


def or_simulated(asked: DataFrame, simulated, response: str = "response") -> DataFrame:
    """Responses, with ``simulated`` (a column) in place of those that calls and parses failed to give, and whether that was so."""
    missing = F.col(response).isNull()
    return asked.withColumn("is_simulated", missing).withColumn(response, F.coalesce(response, simulated))


def ask_in_parts(df: DataFrame, provider: ModelProvider, log: str, schema: str, every: int = 1000, key: str = "id", **options) -> DataFrame:
    """All records of ``log`` once the rows of ``df`` that it lacks have been asked for, in parts of about ``every`` rows, each committed before the next starts.

    A run that breaks off loses one part at most, and goes on with what the log lacks. ``schema`` is that of the log: columns of ``df``, response and error.
    """
    from ..sources.json_io import append_lines, last_run, resumed
    from ..sources.tables import materialize, partitioned
    from .merge import owed

    spark = df.sparkSession
    left = materialize(owed(df, resumed(spark, log, schema, key), key))
    parts = -(-left.count() // every)
    # Each part is a folder, so that it is read alone.
    left = partitioned(left.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")), "_part") if parts else left
    for i in range(parts):
        part = left.filter(F.col("_part") == i).drop("_part")
        append_lines(ask(part, provider, **options), log, last_run(spark, log) + 1)
    return resumed(spark, log, schema, key)


def embedded(df: DataFrame, text: str = "text", size: int = 64) -> DataFrame:
    """Adds ``embedding``: unit vectors of hashed words, a stand-in for a model's."""
    import numpy as np

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        def one(t):
            v = np.zeros(size, np.float32)
            for w in (t or "").lower().split():
                h = int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "little")
                v[h % size] += 1.0 if h >> 63 else -1.0
            return v / max(float(np.linalg.norm(v)), 1e-9)

        return texts.map(one)

    return df.withColumn("embedding", encode(text))


def attempts(ids: DataFrame, once: Callable[[DataFrame, int], DataFrame], most: int = 4, key: str = "id", wait: Retry | None = None) -> DataFrame:
    """Records of up to ``most`` attempts: ``once(ids, attempt)`` returns (id, ok, ...); failed ids enter the next attempt, after the delay of ``wait``."""
    from ..sources.tables import materialize

    out = None
    for n in range(1, most + 1):
        if wait and n > 1:
            wait.sleep(wait.delay(n - 2))
        records = materialize(once(ids, n).withColumn("attempt", F.lit(n)))
        out = records if out is None else out.unionByName(records)
        ids = records.filter(~F.col("ok")).select(key)
        if ids.isEmpty():
            break
    return out


class ScriptRunner(Protocol):
    """Runs the script at a path and returns what it printed; raises TimeoutError beyond its time limit."""

    def __call__(self, path: str) -> str | None: ...


def run_scripts(df: DataFrame, runner: ScriptRunner, path: str = "path") -> DataFrame:
    """Adds ``status``: success, fail, fail - timeout, or fail - no result. The runner is the user's; none here runs code."""
    schema = df.withColumn("status", F.lit(None).cast("string")).schema

    def one(p: str) -> str:
        try:
            said = runner(p)
        except TimeoutError:
            return "fail - timeout"
        except Exception:
            return "fail"
        return "fail - no result" if not said else "success" if "success" in said.lower() else "fail"

    def run(frames: Iterator):
        for frame in frames:
            yield frame.assign(status=[one(p) for p in frame[path]])

    return df.mapInPandas(run, schema)


def recorded_status(manifest: DataFrame) -> DataFrame:
    """(id, attempt, status) as recorded in test_result: success, fail, fail - timeout, or fail - no result where nothing is."""
    text = F.lower(F.max("test_result"))
    return manifest.groupBy("id", "attempt").agg(F.when(text.isNull(), "fail - no result").when(text.contains("success"), "success").when(text.contains("timeout"), "fail - timeout").otherwise("fail").alias("status"))


def batches(df: DataFrame, size: int = 500, active: int = 32, pos: str = "pos") -> DataFrame:
    """Adds batch (items of ``size``), wave (``active`` batches at a time) and the custom id of each request."""
    return df.withColumn("batch", F.floor(F.col(pos) / size).cast("long")).withColumn("wave", F.floor(F.col(pos) / (size * active)).cast("long")).withColumn("custom_id", F.concat(F.lit("req-"), F.col(pos).cast("string")))


def batch_outcome(responses: DataFrame) -> DataFrame:
    """Adds ``outcome``: ok, or why a batch response (custom_id, status_code, error, content) failed."""
    status, content = F.col("status_code"), F.col("content")
    return responses.withColumn(
        "outcome",
        F.when(F.col("custom_id").isNull(), "no custom id").when(F.col("error").isNotNull(), F.concat(F.lit("error: "), F.col("error"))).when(status.isNull() | (status != 200), F.concat(F.lit("status "), F.coalesce(status.cast("string"), F.lit("unknown")))).when(content.isNull() | (content == ""), "empty content").otherwise("ok"),
    )


def judged(requests: DataFrame, submit: Callable[[DataFrame, int], DataFrame], most: int = 5, key: str = "id") -> DataFrame:
    """(id, content, error): requests submitted up to ``most`` times; what still fails then becomes an error row, none is lost."""
    from ..sources.tables import materialize

    left, done = requests, None
    for n in range(1, most + 1):
        answers = materialize(batch_outcome(submit(left, n)))
        good = answers.filter("outcome = 'ok'").select(key, "content", F.lit(None).cast("string").alias("error"))
        done = good if done is None else done.unionByName(good)
        left = left.join(good.select(key), key, "left_anti")
        if left.isEmpty():
            return done
    return done.unionByName(left.select(key, F.lit(None).cast("string").alias("content"), F.lit("attempts exhausted").alias("error")))


def run_batches(requests: DataFrame, submit: Callable[[DataFrame, int], object], poll: Callable[[object], DataFrame | None], size: int = 500, active: int = 32, every: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """The answers to all batches of ``size`` requests (with a ``pos``), of which ``active`` are open at most.

    ``submit(rows, number)`` opens a batch and returns its handle; ``poll(handle)`` returns None while it runs, its answers once it is done. The driver holds
    batch numbers and handles alone. Answers are written as they come.
    """
    from ..sources.tables import partitioned, scratch

    spark = requests.sparkSession
    rows = partitioned(batches(requests, size, active), "batch")  # a folder a batch, so that each is read once
    waiting = [r.batch for r in rows.select("batch").distinct().orderBy("batch").collect()]  # one number a batch
    open_: dict = {}
    folder, kind = scratch(spark), None
    while waiting or open_:
        while waiting and len(open_) < active:
            number = waiting.pop(0)
            open_[number] = submit(rows.filter(F.col("batch") == number), number)
        done = {number: answers for number, handle in open_.items() if (answers := poll(handle)) is not None}
        for number, answers in done.items():
            del open_[number]
            kind = answers.schema
            answers.write.parquet(f"{folder}/answers-of={number}")
        if open_ and not done:
            sleep(every)
    return spark.read.schema(kind).parquet(folder).select(*kind.names) if kind else None
