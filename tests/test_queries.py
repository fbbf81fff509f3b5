"""Every registered query against its SQL on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
# the training-data operators have tests of their own
OWN = re.compile(r"op\d+_|pipeline$")
QUERIES = {k: v for k, v in entry.queries().items() if not OWN.match(k)}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if not OWN.match(k)}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    same, note = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert same, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["conv_id", "turn", "n_tokens", "reverse_context", "band"]
