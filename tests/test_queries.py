"""Every registered query against its SQL, and what its plan must not contain."""

import glob
import os

import duckdb
import pytest
from helpers import SMALL

import __spark_entry__ as entry
from millpond.plans import all_oracle_sql, all_queries
from tools.check_oracle import rows_of

KEYS = sorted(all_oracle_sql())


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_its_sql(spark, db, key):
    frame = all_queries()[key](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    result = db.execute(all_oracle_sql()[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(names, result.fetchall())


def test_flagship_and_registry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["store_nbr", "family", "month_train_date", "year_train_date", "total_sales"]
    assert frame.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all_queries().keys() == all_oracle_sql().keys()
