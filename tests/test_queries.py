"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, database

# The corpus queries have tests of their own, as SQL cannot express them.
NAMES = [name for name in entry.queries() if name not in entry.CORPUS_QUERIES]


@pytest.fixture(scope="module")
def tables(sf_dir="/root/testdata/sf0.001"):
    return database(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tables, sf, name):
    status, text = compare(spark, tables, sf, name)
    assert status == "ok", text
    assert "types" not in text, text


def test_all_have_sql():
    assert set(NAMES) == set(entry.oracle_sql()) - set(entry.CORPUS_SQL)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 2088
