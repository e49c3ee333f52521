"""Every query with a SQL twin, side by side on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == entry.entry(spark).columns and df.count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    text, ok = compare(spark, con, name, SF)
    assert ok or text.endswith("EMPTY"), text
