import corpus_pipeline
import pytest

from ruleforge.llm import decontaminate, minhash_dedup, queries, source_mix, suffix_dedup
from ruleforge.llm.common import materialize, table
from tests.oracle import compare, connected

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    compare(queries.queries()[name](spark, FOLDER), queries.oracle_sql()[name], connected(FOLDER))


def test_stages_take_effect(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "suffix_array", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, "/root/testdata/sf0.001"), name)
        if name != "mixing":
            assert docs.columns == names
        if name == "minhash":
            assert minhash_dedup.near_duplicates(docs).filter("not kept").count() == 0
        if name == "suffix_array":
            assert docs.count() == before.count() and suffix_dedup.digests(docs).agg({"n_removed": "sum"}).first()[0] <= suffix_dedup.digests(before).agg({"n_removed": "sum"}).first()[0] / 10
        if name == "decontamination":
            assert decontaminate.matches(docs, table(spark, "/root/testdata/sf0.001", "benchmark")).count() == 0
    assert docs.columns == [*names, "_copy", "_shard"]
    plan = {r.doc_id: len(r.shards) for r in source_mix.mix_plan(before).collect()}
    taken = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    assert taken == {k: n for k, n in plan.items() if n} and docs.join(before, names, "left_anti").count() == 0


def test_nulls_repeats_and_empty_tables(spark, docs, empty, tmp_path):
    """Every stage on rows of all kinds, and on none."""
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 120, 3)] + [(None, 1), (3, None)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five"), (None, "x"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, empty):
        names = rows.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = materialize(stage(spark, rows, str(tmp_path)), name)
            assert kept.columns == names and kept.count() <= rows.count()
            rows = kept
        assert corpus_pipeline.mixing(spark, rows, str(tmp_path)).columns == [*names, "_copy", "_shard"]
        corpus_pipeline.mixing(spark, rows, str(tmp_path)).count()
