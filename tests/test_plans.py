"""Physical-plan properties the operators are designed around (checked on
the optimized plan, so a regression in pushdown or pre-shuffle limiting
fails a test instead of only slowing down a large run)."""

import re

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from starkit.plans import registry


def plan(df) -> str:
    """The formatted physical plan text, as ``explain("formatted")`` prints it."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_dedup_limits_rows_per_key_before_the_shuffle(spark):
    p = plan(entry.queries()["stg_lineitem_dedup"](spark, SF_SMALL))
    partial = p.find("WindowGroupLimit")
    assert "Partial" in p and "Final" in p
    # the partial limit sits below (after, in the text) the exchange
    assert p.rfind("Exchange hashpartitioning") < p.rfind("Partial")
    assert partial >= 0


def test_scan_filters_are_pushed(spark):
    p = plan(entry.queries()["select_prefix_year_window"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*StringStartsWith\(p_brand,Brand#1\)", p)
    raw = spark.createDataFrame([("GM1", "A018930", "5", "2016JJ00")], "RegioS string, Measure string, Value string, Perioden string")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/plan-test-fleet.parquet"
    raw.write.mode("overwrite").parquet(path)
    p = plan(registry.stg_voertuigpark_gemeente(spark.read.parquet(path)))
    assert "StringStartsWith(RegioS,GM)" in p and "In(Measure" in p and "IsNotNull(Value)" in p


def test_projection_is_pruned_to_used_columns(spark):
    p = plan(entry.queries()["stg_numeric_two_step"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p


def test_only_bounded_dimensions_are_hinted_for_broadcast(spark):
    df = entry.queries()["fct_lineitem"](spark, SF_SMALL)
    logical = df._jdf.queryExecution().analyzed().toString()
    # exactly one broadcast hint: the calendar (bounded by its year range)
    assert logical.count("broadcast") == 2  # the calendar and its holiday list


def test_share_mart_reads_the_fact_once(spark):
    df = entry.queries()["mart_share_compare"](spark, SF_SMALL)
    df.collect()
    p = plan(df)
    main, _, subqueries = p.partition("Subqueries")
    # the latest year comes from the (years x classes) aggregate, not from a
    # subquery over the fact; the only subquery is the one-row totals, and
    # its final plan reuses the per-class shuffles of the main query instead
    # of recomputing both populations
    assert "Subquery" not in main.split("== Initial Plan ==")[0]
    entries = re.findall(r"Subquery:\d+ Hosting operator id = \d+ Hosting Expression = (\w+)", subqueries)
    assert entries[0] == "Subquery" and all(e == "ReusedSubquery" for e in entries[1:]), entries
    assert "ReusedExchange" in subqueries.split("== Initial Plan ==")[0]


def test_split_rank_shuffles_the_data_once(spark):
    df = entry.queries()["mart_top_parts"](spark, SF_SMALL)
    p = plan(df)
    # the ranked rows come from the checkpoint; the join and the window both
    # cluster on (partition id, group), so they share one exchange
    assert "Scan ExistingRDD" in p
    from collections import Counter

    # data side: one exchange feeding both the join and the window; the small
    # carry table has its own two (count aggregate, join input)
    counts = Counter(re.findall(r"hashpartitioning\((__pid#\d+, __grp#\d+)", p))
    assert sorted(counts.values()) == [1, 2], counts
    assert "Window" in p


def test_sort_merge_lookups_join_on_the_null_key_salt(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        p = plan(entry.queries()["fct_lineitem"](spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    smj = re.findall(r"SortMergeJoin[^\n]*\nLeft keys \[\d+\]: \[([^\]]*)\]\nRight keys \[\d+\]: \[([^\]]*)\]", p)
    assert len(smj) == 2 and all("__fsalt" in a and "__dsalt" in b for a, b in smj), smj


@pytest.mark.parametrize("name, columns", [("fct_lineitem", 7), ("dq_no_unknown_member", 5)])
def test_the_null_key_salt_reads_no_other_columns(spark, name, columns):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    read = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if "l_linenumber" in s]
    assert read and all(len(s.split(",")) <= columns for s in read), read
