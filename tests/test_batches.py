"""Batches that outlive the driver, and models held by workers."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ruleforge.operators import inference, ledger, providers


class Killed(BaseException):
    """The driver's end."""


class Service:
    """Remembers what was sent, as the far side of a connection would; ids of 5 modulo 7 fail at the first attempt, those of 20 modulo 21 always."""

    def __init__(self, dies_after=None, loses=()):
        self.sent, self.polls, self.dies_after, self.loses = {}, [], dies_after, set(loses)

    def submit(self, rows, key):
        assert key not in self.sent, "sent twice"
        n = int(key.split("-")[1])
        failed = (F.col("id") % 7 == 5) & (F.lit(n) == 1) | (F.col("id") % 21 == 20)
        answers = rows.select("id", "custom_id", F.when(failed, 500).otherwise(200).alias("status_code"), F.lit(None).cast("string").alias("error"), F.concat(F.lit("a"), "id").alias("content"))
        self.sent[key] = [answers.collect(), answers.schema, 1]
        self.spark = rows.sparkSession
        self._die()
        return key

    def _die(self):
        if self.dies_after is not None:
            self.dies_after -= 1
            if self.dies_after < 0:
                self.dies_after = None
                raise Killed

    def find(self, key):
        return key if key in self.sent else None

    def poll(self, handle):
        self._die()
        self.polls.append(handle)
        rows, schema, left = self.sent[handle]
        if left:
            self.sent[handle][2] -= 1
            return None
        if handle in self.loses:
            raise ledger.BatchFailed
        return self.spark.createDataFrame(rows, schema)


def expected(n, lost=()):
    out = set()
    for i in range(n):
        attempts = 1 + (i % 7 == 5 or i // 10 in lost)
        out.add((i, None, "attempts exhausted", 3) if i % 21 == 20 else (i, f"a{i}", None, attempts))
    return out


@pytest.mark.parametrize("dies_after", [None, 0, 1, 4, 9])
def test_ledger_goes_on_after_the_drivers_end(spark, tmp_path, dies_after):
    requests = spark.range(45).select("id", F.col("id").alias("pos"), F.lit("p").alias("prompt"))
    service, folder = Service(dies_after, ["1-1"]), f"file://{tmp_path}/jobs"
    call = lambda: ledger.run(requests, folder, service, size=10, active=2, most=3, sleep=lambda _: None)
    if dies_after is not None:
        with pytest.raises(Killed):
            call()
    assert {tuple(r) for r in call().collect()} == expected(45, lost={1})
    sent = len(service.sent)
    assert {tuple(r) for r in call().collect()} == expected(45, lost={1}) and len(service.sent) == sent
    # Attempts hold what failed alone.
    assert len(service.sent["0-2"][0]) == sum(i % 7 == 5 or i % 21 == 20 for i in range(10)) and len(service.sent["1-2"][0]) == 10
    assert "0-3" not in service.sent and "2-3" in service.sent


def test_ledger_reads_a_partition_for_each_batch(spark, tmp_path):
    requests = spark.range(30).select("id", F.col("id").alias("pos"))
    seen = []

    class Watched(Service):
        def submit(self, rows, key):
            seen.append("PartitionFilters: [isnotnull(batch" in rows._jdf.queryExecution().executedPlan().toString())
            return super().submit(rows, key)

    ledger.run(requests, f"file://{tmp_path}/jobs", Watched(), size=10, most=1, sleep=lambda _: None).collect()
    assert seen == [True] * 3


def test_no_requests(spark, tmp_path):
    none = spark.range(0).select("id", F.col("id").alias("pos"))
    assert ledger.run(none, f"file://{tmp_path}/jobs", Service(), sleep=lambda _: None).count() == 0


class Digest:
    """Notes each time it is opened and the size of each list."""

    def __init__(self, folder):
        self.folder = folder

    def open(self):
        open(f"{self.folder}/open-{os.getpid()}-{os.urandom(4).hex()}", "w").close()

        def call(inputs):
            open(f"{self.folder}/list-{len(inputs)}-{os.urandom(4).hex()}", "w").close()
            if "bad" in inputs:
                raise ValueError("bad input")
            return [hashlib.md5(x.encode()).hexdigest() for x in inputs]

        return call


def test_a_worker_opens_its_model_once(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 3, F.col("id").cast("string")).alias("prompt")).unionByName(spark.createDataFrame([(5000, "bad")], "id long, prompt string")).repartition(12)
    for _ in range(2):
        got = inference.infer(df, Digest(str(tmp_path)), batch=16).collect()
        assert len(got) == 1001
        for r in got:
            if r.prompt == "bad":
                assert r.response is None and r.error == "ValueError: bad input"
            else:
                assert r.error is None and r.response == (r.prompt and hashlib.md5(r.prompt.encode()).hexdigest())
    made = os.listdir(tmp_path)
    workers = [f.split("-")[1] for f in made if f.startswith("open")]
    assert len(workers) == len(set(workers)) <= spark.sparkContext.defaultParallelism
    lists = [int(f.split("-")[1]) for f in made if f.startswith("list")]
    assert max(lists) == 16 and sum(n == 16 for n in lists) > 60


class Lengths:
    def open(self):
        return lambda texts: [[float(len(t)), 0.0, 1.0] for t in texts]


def test_vectors_and_profiles(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "id long, text string")
    got = {r.id: r.embedding for r in inference.embedded_by(df, Lengths()).collect()}
    assert got[2] is None and got[3] == [0.0, 0.0, 1.0] and abs(got[1][0] - 3 / 10**0.5) < 1e-6
    profile = inference.accelerated(cpus=2, share=0.5, executor_cores=4)
    assert profile.taskResources["gpu"].amount == 0.5 and profile.taskResources["cpus"].amount == 2.0 and profile.executorResources["gpu"].amount == 1


def test_attempts_wait_longer_each_time(spark):
    waits = []
    once = lambda ids, n: ids.select("id", (F.col("id") < n).alias("ok"))
    providers.attempts(spark.range(3), once, wait=providers.Retry(sleep=waits.append))
    assert waits == [1.0, 2.0]


def test_jobs_follow_rounds_not_batches(spark, tmp_path):
    """Batches that end together are settled together: three times the batches in a round take no more jobs."""
    class Lazy(Service):
        def submit(self, rows, key):
            self.sent[key] = rows.select("id", "custom_id", F.when(F.col("id") % 5 == int(key[-1]), 500).otherwise(200).alias("status_code"), F.lit(None).cast("string").alias("error"), F.lit("a").alias("content"))
            return key

        def poll(self, handle):
            return self.sent[handle]

    jobs = []
    for n in (80, 240):
        group = f"ledger-{n}"
        spark.sparkContext.setJobGroup(group, group)
        requests, folder = spark.range(n).select("id", F.col("id").alias("pos")), f"file://{tmp_path}/jobs{n}"
        ledger.run(requests, folder, service := Lazy(), size=10, active=24, most=2, sleep=lambda _: None)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        assert len(service.sent) == 2 * n // 10 and ledger.run(requests, folder, service).filter("attempts = 2 and error is null").count() == n // 5
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert jobs[1] <= jobs[0] + 2, jobs


def test_rounds_are_settled_together(spark, tmp_path):
    """What ended in one round waits for that of the next, as long as more batches can be opened: three times the rounds take no more jobs."""
    class Lazy(Service):
        def submit(self, rows, key):
            self.sent[key] = rows.select("id", "custom_id", F.lit(200).alias("status_code"), F.lit(None).cast("string").alias("error"), F.lit("a").alias("content"))
            return key

        def poll(self, handle):
            return self.sent[handle]

    jobs = []
    for n in (80, 240):
        spark.sparkContext.setJobGroup(f"rounds-{n}", "rounds")
        ledger.run(spark.range(n).select("id", F.col("id").alias("pos")), f"file://{tmp_path}/jobs{n}", service := Lazy(), size=10, active=4, most=2, sleep=lambda _: None)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds-{n}")))
        assert len(service.sent) == n // 10
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert jobs[1] <= jobs[0] + 2, jobs


class Bulk(Service):
    """Takes many batches in a call; breaks off between two of them."""

    def submit_all(self, rows, keys):
        assert {r.key for r in rows.select("key").distinct().collect()} == set(keys)
        for key in keys:
            self.submit(rows.filter(F.col("key") == key).drop("key"), key)
        return keys

    def poll_all(self, handles):
        came, lost = None, []
        for handle in handles:
            try:
                one = self.poll(handle)
            except ledger.BatchFailed:
                lost.append(handle)
                continue
            if one is not None:
                one = one.withColumn("key", F.lit(handle))
                came = one if came is None else came.unionByName(one)
        done = [] if came is None else [r.key for r in came.select("key").distinct().collect()]
        return came, done, lost


@pytest.mark.parametrize("dies_after", [None, 1, 6, 9])
def test_many_batches_a_call(spark, tmp_path, dies_after):
    requests = spark.range(45).select("id", F.col("id").alias("pos"), F.lit("p").alias("prompt"))
    service, folder = Bulk(dies_after, ["1-1"]), f"file://{tmp_path}/jobs"
    call = lambda: ledger.run(requests, folder, service, size=10, active=2, most=3, sleep=lambda _: None)
    if dies_after is not None:
        with pytest.raises(Killed):
            call()
    assert {tuple(r) for r in call().collect()} == expected(45, lost={1})
    assert len(service.sent["0-2"][0]) == sum(i % 7 == 5 or i % 21 == 20 for i in range(10)) and len(service.sent["1-2"][0]) == 10
    assert "0-3" not in service.sent and "2-3" in service.sent
