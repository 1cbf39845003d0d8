"""Every query with SQL, against DuckDB, and every other query for rows."""

import pytest

import __spark_entry__ as entry
import bench
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, entry.queries()[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_headline_has_the_heaviest_queries():
    assert {"workflow_classification", "workflow_regression"} <= set(bench.HEADLINE)
    # Names of a subpackage that is not there are left out of the run.
    assert {n for n in bench.HEADLINE if n != "pipeline" and not n.startswith("op")} <= set(entry.queries())


def test_entry(spark):
    found = entry.entry(spark).collect()
    assert {r["split"] for r in found} == {"train", "validation", "test"}
