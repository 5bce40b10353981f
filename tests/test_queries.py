"""Every registered query against its SQL twin, on whole tables."""

import pytest

import __spark_entry__ as entry
from quillframe.queries import REGISTRY, Tables

from .oracle import differences, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    q = REGISTRY[name]
    frame = q.run(Tables(spark, FOLDER))
    if q.sql is None:
        assert frame.count() > 0
    else:
        assert differences(frame, con, q.sql) == []


def test_entry_points(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
