"""The corpus queries that SQL can express against their SQL, and the others for their rows."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE, SF_SMALL
from oracle_harness import compare, duck_connection
from starkit.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert entry.oracle_sql()[name] == ORACLE[name]
    res = compare(spark, name, QUERIES[name](spark, SF_ORACLE), ORACLE[name], con)
    assert res["ok"], res


@pytest.mark.parametrize("name", [*sorted(set(QUERIES) - set(ORACLE)), "pipeline"])
def test_query_returns_rows_for_all(spark, name):
    table = "pages" if name == "op2_html_extraction" else "documents"
    n = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    rows = entry.queries()[name](spark, SF_SMALL).count()
    assert rows >= n if name == "op8_best_fit_packing" else rows > 0 if name == "pipeline" else rows == n
