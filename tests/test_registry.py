"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as spark_entry  # noqa: E402
import check_oracles  # noqa: E402
from registry.oracles import ORACLES  # noqa: E402
from registry.spark_queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check_oracles.open_duckdb(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    problem = check_oracles.difference(spark, duck, SF_DIR, name, ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
