"""Every catalogued query against its SQL, at the size that the driver compares."""

import pytest

from ruleforge.plans import catalog
from tests.oracle import compare, connected

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connected(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, con, name):
    compare(catalog.QUERIES[name](spark, FOLDER), catalog.ORACLE[name], con)


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_but_one_has_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == {"q51_evolution"}


def test_every_bullet_and_any_depth_take_part(spark, con):
    assert con.execute(f"SELECT max(len(b)) FROM ({catalog._LINES})").fetchone()[0] > 8
    assert con.execute(catalog._RELATIVES + " SELECT max(depth) FROM n WHERE nth <= 2").fetchone()[0] > 6


def test_option_lists_are_made_over_several_tasks(spark):
    """The parts are one small file, which one task reads."""
    assert catalog.table(spark, FOLDER, "part").rdd.getNumPartitions() == 1
    assert sum(len(p) > 0 for p in catalog._groups(spark, FOLDER).rdd.glom().collect()) >= 4


def test_image_files_are_hashed_once(spark):
    plan = catalog.QUERIES["q93_image_files"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_image_files_are_not_listed_by_the_driver(spark):
    """Spark's own listing holds each file's status in the driver and makes a task of a few files each."""
    plan = catalog.QUERIES["q93_image_files"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "binaryFile" not in plan and plan.count("MapInArrow") == 1
