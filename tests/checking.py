"""Run a registered query and its SQL side by side and compare the rows."""

import glob
import os

import duckdb

import __spark_entry__ as driver


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def both(spark, name: str, sf_dir: str):
    """(Spark columns, Spark rows), (SQL columns, SQL rows), rows sorted."""
    df = driver.queries()[name](spark, sf_dir)
    ours = (sorted(df.columns), _rows(df.columns, df.collect()))
    result = open_tables(sf_dir).execute(driver.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    return ours, (sorted(columns), _rows(columns, result.fetchall()))
