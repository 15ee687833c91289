"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from machpulse.plans import catalogue, oracle
from tests.compare import compare, sql_tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return sql_tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalogue.all_queries()))
def test_equals_sql(spark, con, name):
    equal, message, _, _ = compare(spark, con, SF_DIR, name)
    assert equal, message


def test_every_query_has_sql():
    assert set(oracle.all_sql()) == set(catalogue.all_queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["machine_id", "fenetre", "rms_vibration", "pression_moyenne", "tendance_pression"]
    assert df.count() > 0
