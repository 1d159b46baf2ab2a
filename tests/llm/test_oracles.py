"""Queries that SQL can state, against DuckDB at the smallest scale."""

import pytest
from compare import compare
SF_DIR = "/root/testdata/sf0.001"

from tillhouse.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(name, spark, duck):
    assert compare(QUERIES[name](spark, SF_DIR), ORACLE[name], duck) == []


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
