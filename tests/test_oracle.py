"""Every registered query against its SQL, or for rows where SQL cannot express it."""

import os

import pytest

import check
from tabloom.catalogue import registry

SCALE = os.environ.get("TEST_SF", "0.001")
FOLDER = f"/root/testdata/sf{SCALE}"


@pytest.fixture(scope="module")
def connection():
    return check.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_sql(spark, connection, name):
    assert check.compare(spark, connection, FOLDER, name) is None


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
