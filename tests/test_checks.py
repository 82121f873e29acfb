"""The check planner against the single checks, on random tables with nulls,
hot keys and empty tables, and the number of passes it makes."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starkit.operators import checks as chk
from starkit.operators import quality as dq
from starkit.plans import catalog
from starkit.plans.tables import Tables
from starkit.sources.export import run_folder


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        (F.col("id") % 11).cast("int").alias("d"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"), F.lit("-1").alias("u"))
    parent = spark.range(30).select(F.col("id").cast("string").alias("pk"), (F.col("id") % 8).alias("pd"), F.when(F.col("id") > 3, F.lit("c")).alias("cls"))
    return {"child": child, "parent": parent, "none": child.limit(0)}


def test_planner_equals_single_checks(tables):
    c, p, none = tables["child"], tables["parent"], tables["none"]
    pairs = [
        (chk.unique("child", "k"), dq.unique(c, "k")), (chk.unique("child", "v"), dq.unique(c, "v")),
        (chk.unique("parent", "pk"), dq.unique(p, "pk")), (chk.unique("none", "k"), dq.unique(none, "k")),
        (chk.not_null("child", "k"), dq.not_null(c, "k")), (chk.not_null("none", "k"), dq.not_null(none, "k")),
        (chk.accepted_values("child", "d", [0, 1, 2]), dq.accepted_values(c, "d", [0, 1, 2])),
        (chk.accepted_values("child", "k", ["hot", "1"]), dq.accepted_values(c, "k", ["hot", "1"])),
        (chk.relationships("child", "k", "parent", "pk"), dq.relationships(c, "k", p, "pk")),
        (chk.relationships("child", "d", "parent", "pd"), dq.relationships(c, "d", p, "pd")),
        (chk.relationships("child", "k", "none", "k", name="no_parent"), dq.relationships(c, "k", none, "k")),
        (chk.relationships("none", "k", "parent", "pk"), dq.relationships(none, "k", p, "pk")),
        (chk.unique_combination("child", ["k", "d"]), dq.unique_combination(c, ["k", "d"])),
        (chk.unmapped("unmapped", "parent", "cls", "pk", "2"), dq.unmapped(p, "cls", "pk", "2")),
        (chk.unknown_member("on_unknown", "child", "u"), dq.on_unknown_member(c, "u", "-1")),
        (chk.no_rows("rows", c.where("d = 4")), c.where("d = 4")),
    ]
    for expected in (2000, 1999, c, p, F.lit(2000)):
        for unknown in ({"k": "-1"}, {"u": "-1"}):
            wrong = unknown == {"u": "-1"} or expected is p or isinstance(expected, int) and expected != 2000
            pairs.append((chk.complete(f"complete{len(pairs)}", "child", expected, unknown), c.limit(1) if wrong else none))
    got = {r.check_name: (r.failing_rows, r.passed) for r in chk.run_checks(tables, [x for x, _ in pairs]).collect()}
    assert got == {x.name: (n := df.count(), n == 0) for x, df in pairs}


def test_suite_reads_the_fact_three_times(spark):
    t = Tables(spark, SF_SMALL)
    from starkit.plans import star

    w = star.build_star(t, run_folder(spark, "star"))
    out = chk.run_checks({**w, "orders": t.orders}, catalog.star_suite(w, t))
    p = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert len(re.findall(r"\) Scan parquet[^(]*\n[^(]*Location: [^\n]*fct_lineitem", p)) == 3, p
    assert out.count() == 24


def test_fact_completeness_runs_the_dedup_once(spark):
    out = catalog.QUERIES["dq_fact_complete"](spark, SF_SMALL)
    p = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "WindowGroupLimit" not in p and "stg_lineitem" in p
