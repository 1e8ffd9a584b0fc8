"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

from costwise.plans import all_queries

SF = os.environ.get("COSTWISE_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(all_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    from tools.oracle_check import compare
    res = compare(spark, SF, {name}, verbose=False)[name]
    assert res[0] in ("OK", "NO_ORACLE"), res
