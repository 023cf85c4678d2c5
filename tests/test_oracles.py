"""Every registered query against its SQL, and the driver's contract."""

import os

import pytest

import __spark_entry__ as entry
from sparkrank.plans.oracles import ORACLES
from sparkrank.plans.registry import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    import check_oracles

    return check_oracles.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, connection, key):
    import check_oracles

    same, detail = check_oracles.compare(spark, connection, SF_DIR, key)
    assert same, detail


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["method"] for r in rows} == {"bm25", "vector", "hybrid", "hybrid_rrf"}
    assert all(0 <= r[m] <= 1 for r in rows for m in ("precision", "recall", "mrr", "ndcg"))
