"""Data-quality checks (D1-D12).  Each check returns its *failing rows*
(empty = pass); ``failure_count`` turns a check into a one-row result and
``run_suite`` evaluates many checks in a single job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkit.functions.scalars import count_of
from starkit.operators.dims import UNKNOWN_KEY


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values (nulls excluded) occurring more than once, with their count."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null."""
    return df.where(F.col(col).isNull())


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """D3: child rows whose non-null ``col`` has no parent (anti join; the
    parent side is not deduplicated first — an anti join needs no distinct)."""
    p = parent.select(F.col(parent_col).alias("__pk"))
    c = child.where(F.col(col).isNotNull())
    return c.join(p, c[col] == p["__pk"], "left_anti")


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Each value outside the accepted list, with its count (null is
    not a value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
              .where(~F.col(col).isin(list(values))))


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key combinations occurring more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def overlaps(versions: DataFrame, code: str, key: str, from_col: str, to_col: str,
             split_hot_groups: bool = False) -> DataFrame:
    """Codes with two versions whose closed periods overlap.

    Instead of a self-join per code (quadratic in versions per code), one
    ordered pass: ordered by start, a version overlaps an earlier one
    exactly when its start is on/before the largest end seen so far.
    Returns the distinct offending codes.  Rows are assumed to have distinct
    ``key`` values (the self-join form excludes a row paired with itself).

    ``split_hot_groups=True`` computes the running maximum on range
    partitions with a carried maximum, for inputs where one code can hold a
    large share of the rows (versions of a dimension are bounded by the
    number of snapshots, so the plain window is the default).
    """
    v = versions.select(code, key, from_col, to_col)
    order = [F.col(from_col).asc(), F.col(to_col).asc(), F.col(key).asc()]
    if split_hot_groups:
        from starkit.operators.ordered import previous_max_split
        flagged = previous_max_split(v, [code], order, to_col, "__max_to")
    else:
        w = Window.partitionBy(code).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        flagged = v.withColumn("__max_to", F.max(to_col).over(w))
    return flagged.where(F.col(from_col) <= F.col("__max_to")).select(code).distinct()


def unmapped(df: DataFrame, class_col: str, key_col: str, unknown=UNKNOWN_KEY) -> DataFrame:
    """Rows without a classification, the unknown member excluded."""
    return df.where((F.col(key_col) != F.lit(unknown)) & F.col(class_col).isNull())


def gaps(snapshots: DataFrame, code: str, period: str) -> DataFrame:
    """Snapshots whose previous period of the same code is not the
    immediately preceding one (a gap in the series)."""
    w = Window.partitionBy(code).orderBy(period)
    prev = snapshots.select(code, period, F.lag(period).over(w).alias("prev_period"))
    return prev.where(F.col("prev_period").isNotNull() & (F.col(period) != F.col("prev_period") + 1))


def fact_completeness(fact: DataFrame, staging: DataFrame,
                      unknown_keys: dict[str, tuple[str, object]]) -> DataFrame:
    """One row ``fact_rows, staging_rows, <unknown counts>`` when the
    fact lost or gained rows or any lookup fell on the unknown member;
    empty otherwise.  One pass over the fact (conditional counts), one
    count of the staging relation."""
    counts = fact.agg(F.count(F.lit(1)).alias("fact_rows"),
                      *[F.count_if(F.col(c) == F.lit(u)).alias(name)
                        for name, (c, u) in unknown_keys.items()])
    row = counts.withColumn("staging_rows", count_of(staging))
    bad = F.col("fact_rows") != F.col("staging_rows")
    for name in unknown_keys:
        bad = bad | (F.col(name) > 0)
    return row.where(bad).select("fact_rows", "staging_rows", *unknown_keys)


def at_most_one_current(versions: DataFrame, code: str, current_col: str) -> DataFrame:
    """Codes with more than one current version."""
    return (versions.where(F.col(current_col)).groupBy(code)
                    .agg(F.count(F.lit(1)).alias("n_current")).where("n_current > 1"))


def on_unknown_member(fact: DataFrame, key_col: str, unknown=UNKNOWN_KEY) -> DataFrame:
    """Fact rows that point to the unknown member."""
    return fact.where(F.col(key_col) == F.lit(unknown))


def failure_count(name: str, failing: DataFrame) -> DataFrame:
    """One row ``(check_name, failing_rows)`` for a check."""
    return failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(name).alias("check_name"), "failing_rows")


def run_suite(checks: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """All checks as one DataFrame ``(check_name, failing_rows,
    passed)``; evaluating it is a single job."""
    parts = [failure_count(n, df) for n, df in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failing_rows") == 0)


def assert_suite(result: DataFrame) -> None:
    """Fail the build when any check failed (collects one small row per check)."""
    failed = [r["check_name"] for r in result.where(~F.col("passed")).select("check_name").collect()]
    if failed:
        raise AssertionError(f"data-quality checks failed: {failed}")

