"""Every registered query against its reference SQL on the smallest test tables."""

import os

import pytest
from compare import compare

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query_matches_reference_sql(spark, name):
    plans = []

    def watched(session, sf_dir):
        df = entry_module.queries()[name](session, sf_dir)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    assert compare(spark, name, watched, ORACLES.get(name), SF_DIR) is None
    # No cross join, no nested-loop join and no row-at-a-time Python anywhere.
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plans[0]


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert "weighted_disagreement_score" in df.columns and df.count() > 0
