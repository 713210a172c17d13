"""Every registered query against its SQL counterpart on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import TABLES, compare  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return base


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, database, name):
    df = entry.queries()[name](spark, SF)
    if name in ORACLES:
        assert compare(df, database.execute(ORACLES[name])).startswith("ok")
    else:
        assert df.collect()


def test_entry(spark):
    assert [r.split for r in entry.entry(spark).collect()] == ["train", "val", "test"]
