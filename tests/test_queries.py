"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from support import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import TABLES, compare
from workload.oracle import ORACLE
from workload.queries import all_queries


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(ORACLE)
    assert set(all_queries()) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, db, name):
    assert compare(all_queries()[name](spark, SMALL), db.sql(ORACLE[name])) == ""


def test_streams_get_the_state_settings_in_any_session(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    spark.conf.set(key, "true")
    try:
        all_queries()["tumbling_counts_batch"](spark, SMALL)
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, "false")
