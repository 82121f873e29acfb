"""Every catalogued query against its DuckDB oracle (row count, column
names and types, order-insensitive values) on the driver's sf0.01 tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE, SF_SMALL
from oracle_harness import compare, duck_connection

ORACLE = entry.CATALOG_ORACLE
QUERIES = entry.CATALOG


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name](spark, SF_ORACLE), ORACLE[name], con)
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_ORACLE).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["l_returnflag", "ship_year", "n_lines", "p_partkey", "p_name", "line_rank"]


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(QUERIES) - set(ORACLE) == {"profile_columns_approx", "profile_inventory"}


def test_small_scale_runs(spark):
    for name in ["stg_lineitem_dedup", "scd2_customer_priority", "dq_suite"]:
        QUERIES[name](spark, SF_SMALL).count()


def test_inventory_matches_parquet_footers(spark):
    import duckdb

    got = {r.file_name: (r.n_rows, r.n_columns, r.row_groups)
           for r in QUERIES["profile_inventory"](spark, SF_ORACLE).collect()}
    con = duckdb.connect()
    g = f"{SF_ORACLE}/*.parquet"
    meta = con.execute(f"SELECT regexp_replace(file_name, '.*/', ''), num_rows, num_row_groups "
                       f"FROM parquet_file_metadata('{g}')").fetchall()
    cols = dict(con.execute(f"SELECT regexp_replace(file_name, '.*/', ''), count(*) FROM parquet_schema('{g}') "
                            f"WHERE num_children IS NULL GROUP BY 1").fetchall())
    assert got == {f: (n, cols[f], rg) for f, n, rg in meta}


def test_approx_profile_within_hll_error(spark, con):
    got = {r.column_name: r.n_distinct for r in QUERIES["profile_columns_approx"](spark, SF_ORACLE).collect()}
    cols = list(got)
    exact = con.sql("SELECT " + ", ".join(f"count(DISTINCT {c})" for c in cols) + " FROM lineitem").fetchall()[0]
    for c, e in zip(cols, exact):
        assert abs(got[c] - e) <= max(2, 0.1 * e), (c, got[c], e)
