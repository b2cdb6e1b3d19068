"""Every registered query against its SQL twin, at the smallest scale."""

import pytest

from check_oracle import compare
from lakestrata.operators import keyed
from registry.oracle import ORACLE
from registry.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare(spark, SF, name) is None


@pytest.mark.parametrize(
    "name", ["fact_cycle", "fact_cycle_null_keys", "fact_initial", "merge_fact", "audit_log"]
)
def test_query_in_blocks_of_keys(spark, name, monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_AT_ONCE", 5000)
    assert compare(spark, SF, name) is None
