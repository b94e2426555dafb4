"""Every registered query against its DuckDB oracle on sf0.001 (the driver repeats this at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(set(E.queries()) - set(E.LLM_Q))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(E.queries()) - set(E.oracle_sql())
    assert not {k for k in rows_only if k not in E.LLM_Q}  # tests/llm has theirs


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "user_id"


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, SF, key, E.queries()[key], E.oracle_sql().get(key), con)
    assert ok, msg
