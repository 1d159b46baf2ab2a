"""Every registered query against its oracle, at the smallest scale."""

import re
from pathlib import Path

import pytest
from compare import compare
from tables import SF_DIR

import __spark_entry__ as entry

from oracle.sql import oracle as library_oracle
from tillhouse.queries import load_all

QUERIES, ORACLE = load_all(), library_oracle()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"src3_file_listing"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(name, spark, duck):
    assert compare(QUERIES[name](spark, SF_DIR), ORACLE[name], duck) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_file_listing_names_every_table(spark):
    rows = QUERIES["src3_file_listing"](spark, SF_DIR).collect()
    assert {"lineitem", "orders"} <= {r["filename"] for r in rows} and all(r["size"] > 0 for r in rows)


def test_test_modules_have_names_of_their_own():
    files = list(Path(__file__).parent.rglob("*.py"))
    names = [p.stem for p in files if p.stem != "conftest"]
    assert len(names) == len(set(names))
    assert not [p for p in files if re.search(r"^\s*(from|import) conftest", p.read_text(), re.M)]
