"""Every registered query against its SQL in DuckDB."""

import pytest

from contract.check import compare, duck_session
from contract.oracles import ORACLES
from contract.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_session(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf_dir, name):
    ok, note = compare(spark, duck, name, sf_dir)
    assert ok, note


def test_no_sql_without_query():
    assert set(ORACLES) <= set(QUERIES)
