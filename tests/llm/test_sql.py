"""Operators whose results SQL states, against DuckDB on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import compare, duck  # noqa: E402

from tidemark.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_query_matches_sql(spark, key):
    ok, msg = compare(spark, SF, key, queries.Q[key], queries.SQL[key], duck(SF))
    assert ok, msg
