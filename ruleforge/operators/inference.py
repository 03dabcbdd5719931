"""Data-parallel inference: a model is opened once in each Python worker and called with lists of inputs.

A model is a small object that says how to open it; what it opens (weights, a session, a connection) never passes through the plan. A worker holds the last model it
opened, so tasks that follow in the same worker find it there. Where executors have accelerators, a resource profile makes Spark place one task on each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Model(Protocol):
    def open(self) -> Callable[[list[str]], list]:
        """What answers a list of inputs with a list of as many outputs."""


_held: dict[str, Callable[[list[str]], list]] = {}


def held(model: Model) -> Callable[[list[str]], list]:
    """The opened model of this worker process; another model takes its place."""
    from pyspark import cloudpickle

    key = hashlib.sha256(cloudpickle.dumps(model)).hexdigest()
    if key not in _held:
        _held.clear()
        _held[key] = model.open()
    return _held[key]


def answered(call: Callable[[list[str]], list], inputs: list[str]) -> list[tuple[object, str | None]]:
    """(output, error) of each input. A list that fails is called again in halves, so that one bad input fails alone."""
    try:
        out = call(inputs)
        if len(out) != len(inputs):
            raise ValueError(f"{len(out)} outputs for {len(inputs)} inputs")
        return [(x, None) for x in out]
    except Exception as e:
        if len(inputs) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        half = len(inputs) // 2
        return answered(call, inputs[:half]) + answered(call, inputs[half:])


def infer(df: DataFrame, model: Model, prompt: str = "prompt", batch: int = 64, output: str = "response", kind: str = "string", profile: ResourceProfile | None = None) -> DataFrame:
    """Adds ``output`` (of type ``kind``) and ``error``. Rows are called in lists of up to ``batch``; null inputs are not sent and have neither.

    A task holds one Arrow batch and one list at a time. ``profile`` says what a task needs, see accelerated().
    """
    schema = df.withColumns({output: F.lit(None).cast(kind), "error": F.lit(None).cast("string")}).schema

    def run(frames: Iterator):
        call = held(model)
        for frame in frames:
            asked = frame[prompt].dropna()
            found = [x for s in range(0, len(asked), batch) for x in answered(call, asked.iloc[s : s + batch].tolist())]
            by = dict(zip(asked.index, found, strict=True))
            rows = [by.get(i, (None, None)) for i in frame.index]
            yield frame.assign(**{output: [r for r, _ in rows], "error": [e for _, e in rows]})

    return df.mapInPandas(run, schema, profile=profile)


def accelerated(cpus: int = 1, share: float = 1.0, resource: str = "gpu", executor_cores: int | None = None) -> ResourceProfile:
    """A profile by which a task takes ``share`` of an accelerator and ``cpus`` cores; with ``executor_cores`` also what executors bring, for clusters that start them on demand."""
    build = ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus).resource(resource, share))
    if executor_cores:
        build = build.require(ExecutorResourceRequests().cores(executor_cores).resource(resource, 1))
    return build.build


def embedded_by(df: DataFrame, model: Model, text: str = "text", batch: int = 64, **options) -> DataFrame:
    """Adds ``embedding`` (array of floats) and ``error`` by a model whose outputs are vectors; they are scaled to length 1, and a vector of zeros stays."""
    asked = infer(df, model, text, batch, output="embedding", kind="array<double>", **options)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return asked.withColumn("embedding", F.transform("embedding", lambda x: (x / F.when(norm > 0, norm).otherwise(1.0)).cast("float")))
