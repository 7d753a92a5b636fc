"""Every registered query of the ledger engine against its SQL on DuckDB."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tallybrook import file_queries as queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def plain(df):
    """Rows as sorted texts, numbers alike whatever their type."""
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        if out[c].dtype.kind in "iuf" or str(out[c].dtype) in ("Int64", "Float64"):
            out[c] = out[c].astype("float64")
        if c.endswith("day"):
            out[c] = out[c].astype(str).str[:10]
    rows = out.astype(str).replace({"None": "nan", "<NA>": "nan", "NaT": "nan"}).values.tolist()
    return sorted(rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_gives_what_sql_gives(spark, sf_dir, duck, name):
    got, want = queries.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_wide_balances_hold_every_account(spark, sf_dir):
    wide = queries.QUERIES["daily_balance_wide_all"](spark, sf_dir)
    accounts = {r["acct"] for r in queries.QUERIES["daily_balance_long"](spark, sf_dir).select("acct").distinct().collect()}
    assert accounts | {"day", "total"} <= set(wide.columns)
    assert sorted(wide.select("day", "total").collect()) == sorted(queries.QUERIES["daily_total"](spark, sf_dir).select("day", "total").collect())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["standardize_grids", "files_to_ledger", "files_of_any_encoding"])
def test_amounts_of_zero_keep_their_direction(spark, sf_dir, tmp_path, name):
    """Expenses and incomes of zero in each layout."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0.001 ELSE value END AS value) FROM '{sf_dir}/events.parquet' WHERE event_id < 100")
    con.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    got, want = queries.QUERIES[name](spark, str(tmp_path)).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    assert plain(got) == plain(want)


def test_bare_statements_are_of_bounded_size(spark, sf_dir, duck, monkeypatch):
    """Several statements give what SQL gives over all rows, and each has its header."""
    path = queries.bare_statements(spark, sf_dir, 300)
    files = {r["f"]: r["n"] for r in spark.read.text(path).groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"n=\d+/.*", 0).alias("f")).agg(F.count("*").alias("n")).collect()}
    assert len(files) > 3 and max(files.values()) <= 300 + 3
    monkeypatch.setattr(queries.bare_statements, "__defaults__", (300,))
    got, want = queries.QUERIES["bare_statement"](spark, sf_dir).toPandas(), duck.execute(queries.ORACLE_SQL["bare_statement"]).df()
    assert plain(got) == plain(want)
