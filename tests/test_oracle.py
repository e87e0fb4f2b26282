"""Every query with an oracle gives its rows on the smallest tables; the others run."""

import pytest
from oracle import compare, database, entry

SF = "/root/testdata/sf0.001"
SLOW = {"p7_found"}  # compared in tests/llm


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n not in SLOW and n not in {"p8_found"}))
def test_oracle(spark, con, name):
    own, theirs, extra, missing = compare(spark, con, name, SF)
    assert own == theirs and not extra and not missing


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in entry.oracle_sql() and not n.startswith("p")))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
