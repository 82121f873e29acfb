import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starkit.operators import profile as prof
from starkit.operators import quality as dq
from starkit.sources import sample as smp


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "F"), (1, "O"), (2, "P"), (None, None)], "k long, s string")
    assert dq.unique(df, "k").count() == 1
    assert dq.not_null(df, "k").count() == 1
    assert dq.accepted_values(df, "s", ["F", "O"]).count() == 1
    assert dq.unique_combination(df, ["k"]).count() == 1
    parent = spark.createDataFrame([(1,)], "k long")
    assert dq.relationships(df, "k", parent, "k").count() == 1  # k=2 orphan, null passes


def test_overlaps_matches_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for code in range(40):
        for i in range(rng.randint(1, 5)):
            a = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randint(0, 300))
            rows.append((f"c{code}", f"c{code}-{i}", a, a + dt.timedelta(days=rng.randint(0, 60))))
    brute = {a[0] for a in rows for b in rows
             if a[0] == b[0] and a[1] != b[1] and a[2] <= b[3] and a[3] >= b[2]}
    df = spark.createDataFrame(rows, "code string, key string, f date, t date")
    assert {r.code for r in dq.overlaps(df, "code", "key", "f", "t").collect()} == brute


def test_gaps_current_unknown_and_completeness(spark):
    s = spark.createDataFrame([("a", 2015), ("a", 2016), ("a", 2018), ("b", 2015)], "c string, y int")
    assert [(r.c, r.y) for r in dq.gaps(s, "c", "y").collect()] == [("a", 2018)]
    v = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("c", False)], "c string, cur boolean")
    assert dq.at_most_one_current(v, "c", "cur").count() == 1
    f = spark.createDataFrame([("-1",), ("x",)], "k string")
    assert dq.on_unknown_member(f, "k").count() == 1
    stg = spark.createDataFrame([(1,), (2,)], "a int")
    assert dq.fact_completeness(f, stg, {"unk": ("k", "-1")}).count() == 1
    assert dq.fact_completeness(f.where("k <> '-1'"), stg.limit(1), {"unk": ("k", "-1")}).count() == 0


def test_run_suite(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    res = {r.check_name: (r.failing_rows, r.passed)
           for r in dq.run_suite([("u", dq.unique(df, "k")), ("n", dq.not_null(df, "k"))]).collect()}
    assert res == {"u": (1, False), "n": (0, True)}


def test_column_profile_and_grain(spark):
    df = spark.createDataFrame([(1, " "), (2, "x"), (None, None)], "a long, s string")
    p = {r.column_name: r for r in prof.column_profile(df).collect()}
    assert p["a"].min_value == "1" and p["a"].max_value == "2" and p["a"].n_distinct == 2
    assert p["s"].empty_pct == 33.33 and p["a"].null_pct == 33.33
    g = {r.table_name: r for r in prof.grain({"t": (df, ["a"]), "u": (df, ["zz"])}).collect()}
    assert g["t"].is_unique is False and g["u"].remark == "missing column: zz"


def test_castability_and_census(spark):
    df = spark.createDataFrame([("1", "2026-01-01"), ("x", "nope"), (None, None)], "n string, d string")
    c = {r.column_name: r.n_unparseable for r in prof.castability(df, {"n": "int", "d": "date"}).collect()}
    assert c == {"n": 1, "d": 1}
    cen = {(r.column_name, r.value): r.n for r in prof.value_census(df, ["n"]).collect()}
    assert cen[("n", "(null)")] == 1


def test_key_at_matches_sorted_positions(spark):
    rng = random.Random(3)
    keys = [rng.randint(0, 500) for _ in range(2000)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    s = sorted(keys)
    for pos in [0, 1, 999, 1500, 1999]:
        assert smp.key_at(df, "k", pos, num_partitions=7).first()[0] == s[pos]
    assert smp.key_at(df, "k", 2000).count() == 0


def test_first_keys_and_restrict(spark):
    df = spark.createDataFrame([(k,) for k in range(100)], "k long")
    keys = smp.first_keys(df, "k", 10, extra=[55, 5])
    assert sorted(r.k for r in keys.collect()) == list(range(10)) + [55]
    child = spark.createDataFrame([(k % 60,) for k in range(300)], "k long")
    assert smp.restrict_to(child, "k", keys, "k").count() == 55


def test_split_forms_match_window_forms(spark):
    from pyspark.sql import Window

    from starkit.operators.ordered import previous_max_split, row_number_split

    rng = random.Random(11)
    # one hot group with most rows, several small ones, and a null group key
    rows = [("hot", i, rng.randint(0, 50)) for i in range(3000)]
    rows += [(f"g{j}", i, rng.randint(0, 50)) for j in range(20) for i in range(rng.randint(1, 30))]
    rows += [(None, i, i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    order = [F.col("v").desc(), F.col("k").asc()]
    w = Window.partitionBy("g").orderBy(*order)
    expect = {(r.g, r.k): r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    got = {(r.g, r.k): r.rn for r in row_number_split(df, ["g"], order, "rn", num_partitions=9).collect()}
    assert got == expect
    wm = w.rowsBetween(Window.unboundedPreceding, -1)
    expect = {(r.g, r.k): r.m for r in df.withColumn("m", F.max("v").over(wm)).collect()}
    got = {(r.g, r.k): r.m for r in previous_max_split(df, ["g"], order, "v", "m", num_partitions=9).collect()}
    assert got == expect


def test_overlaps_split_form(spark):
    rows = [("c", f"k{i}", dt.date(2000, 1, 1) + dt.timedelta(days=3 * i),
             dt.date(2000, 1, 1) + dt.timedelta(days=3 * i + (5 if i == 700 else 1))) for i in range(1500)]
    rows += [("d", "x", dt.date(2000, 1, 1), dt.date(2000, 1, 2))]
    df = spark.createDataFrame(rows, "code string, key string, f date, t date")
    assert [r.code for r in dq.overlaps(df, "code", "key", "f", "t", split_hot_groups=True).collect()] == ["c"]


def test_key_at_with_a_hot_duplicate_key(spark):
    keys = [7] * 5000 + list(range(100)) + [500] * 3
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    s = sorted(keys)
    for pos in [0, 6, 7, 50, 5006, 5099, 5100, 5102]:
        assert smp.key_at(df, "k", pos, num_partitions=5).first()[0] == s[pos], pos


def test_more_keys_than_the_limit_are_not_broadcast(spark, scratch):
    spark.range(5000).selectExpr("id AS k", "id % 3 AS v").write.parquet(f"{scratch}/child")
    child, keys = spark.read.parquet(f"{scratch}/child"), spark.range(100, 900, 2).withColumnRenamed("id", "k")
    few, many = smp.restrict_to(child, "k", keys, "k"), smp.restrict_to(child, "k", keys, "k", broadcast_keys=399)
    plans = [spark._jvm.PythonSQLUtils.explainString(x._jdf.queryExecution(), "formatted") for x in (few, many)]
    assert "BroadcastHashJoin" in plans[0] and "Broadcast" not in plans[1] and "SortMergeJoin" in plans[1]
    assert "GreaterThanOrEqual(k,100)" in plans[1] and "LessThanOrEqual(k,898)" in plans[1]
    assert few.count() == many.count() == 400


def test_too_few_keys_are_reported(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    with pytest.warns(UserWarning, match="fewer than 9 keys"):
        assert smp.first_keys(df, "k", 9).count() == 5
    report = smp.sample_report(3, [77, 1], smp.first_keys(df, "k", 3, [77, 1]), "k", {"t": df}).first()
    assert (report.extra_keys, report.n_keys, report.limit_key, report.max_key, report.t_rows) == ("77,1", 4, 2, 77, 5)


def test_merged_sketches_equal_those_of_the_whole_table(spark, scratch):
    """Sketches stored a file and merged give the estimate of one sketch over all rows."""
    df = spark.range(40_000).selectExpr("id % 9000 AS a", "cast(if(id % 5 = 0, null, id % 17) as string) AS b", "id / 7 AS c")
    df.repartition(6).write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    per_file = prof.distinct_sketches(t)
    assert per_file.count() == 18
    per_file.write.parquet(f"{scratch}/sketches")
    merged = prof.merged_sketches(spark.read.parquet(f"{scratch}/sketches"))
    got = {r.column_name: (r.n_rows, r.n_null, r.e) for r in merged.withColumn("e", F.hll_sketch_estimate("sketch")).collect()}
    assert {r.column_name: r.n_distinct for r in prof.distinct_counts(t).collect()} == {"a": 9000, "b": 17, "c": 40_000}
    for c, exact, nulls in (("a", 9000, 0), ("b", 17, 8000), ("c", 40_000, 0)):
        # a union of one sketch: estimates of unions and of plain sketches differ in their estimator only
        whole = t.agg(F.hll_sketch_agg(F.col(c).cast("string"), F.lit(prof.SKETCH_LOG_K)).alias("s")).agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("e")).first().e
        assert got[c] == (40_000, nulls, whole) and abs(whole - exact) <= prof.SKETCH_TOLERANCE * exact


def test_orphans_of_several_references_by_one_group_by(spark):
    child = spark.createDataFrame([("a", 1), ("b", 2), (None, 2), ("z", None), ("z", 9)], "k string, n int")
    tables = {"c": child, "p": spark.createDataFrame([("a",), ("b",), (None,)], "k string"), "q": spark.range(3)}
    refs = {"no_p": ("c", "k", "p", "k"), "no_q": ("c", "n", "q", "id"), "none": ("p", "k", "p", "k")}
    assert tuple(prof.orphan_counts(tables, refs).first()) == (2, 1, 0)
    assert tuple(prof.orphan_counts(tables, refs, nulls=True).first()) == (3, 2, 1)


def test_exact_distinct_counts_are_dealt_over_tasks(spark):
    """By value as count(distinct) has it, and not by an expanded row beside all other statistics."""
    rows = [(1, 0.0, "a", b"x", [1]), (1, -0.0, "", None, None), (None, float("nan"), "a", b"x", [1]), (None, float("nan"), None, b"y", [None])] * 3
    df = spark.createDataFrame(rows, "k int, `d.x` double, s string, b binary, a array<int>")
    out = prof.column_profile(df, exact=True)
    assert {r.column_name: r.n_distinct for r in out.collect()} == {"k": 1, "d.x": 2, "s": 2, "b": 2, "a": 2}
    assert [r.column_name for r in out.collect()] == df.columns
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "RepartitionByExpression" in plan
    assert {r.n_distinct for r in prof.column_profile(df.limit(0), exact=True).collect()} == {0}
