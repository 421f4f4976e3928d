"""Every registered query at the smallest scale, compared with its SQL where it has one."""

import os

import pytest

import check_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return check_queries.connect(FOLDER)


def test_oracles_belong_to_queries():
    points = check_queries.entry_points
    assert set(points.oracle_sql()) <= set(points.queries())


@pytest.mark.parametrize("key", list(check_queries.entry_points.queries()))
def test_query(spark, connection, key):
    agrees, _, _, _, note = check_queries.compare(spark, connection, FOLDER, key)
    assert agrees is not False, note


def test_entry(spark):
    assert check_queries.entry_points.entry(spark).count() > 0
