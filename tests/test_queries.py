"""Every registered query with a SQL twin must give the same rows in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_duckdb(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = ordered(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    expected = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({ORACLES[name]})")
    assert got == ordered(expected.fetchall())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "SF_pred" in df.columns and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_model_queries_score_the_held_out_year(spark):
    got = QUERIES["rf_scores"](spark, FOLDER)
    assert got.columns == ["key", "label", "prediction", "score"] and got.count() > 0
