"""Every registered query against its DuckDB oracle (the checker's comparison).

Runs at sf0.001 by default; set ``PARITY_SF_DIR`` (e.g. /root/testdata/sf0.01)
for the checker's scale.
"""

import os

import pytest

from oracle.sql import ORACLE_SQL as ORACLE
from visitlens.plans.registry import QUERIES
from parity import compare, duck

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    assert key in ORACLE, f"{key} has no oracle SQL"
    res = compare(QUERIES[key](spark, SF_DIR), con, ORACLE[key])
    assert res["match"], res
    assert res["spark_rows"] > 0
