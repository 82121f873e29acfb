"""Marts: ranking, restated series, share comparison, bridge-filtered
measure (K13-K15, J13, A13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.functions.casts import safe_ratio
from starkit.functions.scalars import scalar_of
from starkit.operators.dims import UNKNOWN_KEY, latest_version
from starkit.operators.staging import order_exprs


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence, out: str = "rank",
                split_hot_groups: bool = False) -> DataFrame:
    """Stored rank per group with a unique tiebreak (W3/O3): consumers filter
    ``rank <= N``.  ``order`` must be total inside a group.

    With a bounded group size (e.g. ranking the codes of a reference list) a
    window is right.  When groups grow with the data (few groups, many rows
    each) pass ``split_hot_groups=True``: the ranking is then computed on
    range partitions with a carried row offset (``ordered.row_number_split``)
    so no group is processed by a single task.
    """
    if split_hot_groups:
        from starkit.operators.ordered import row_number_split
        return row_number_split(df, by, order_exprs(order), out)
    w = Window.partitionBy(*by).orderBy(*order_exprs(order))
    return df.withColumn(out, F.row_number().over(w))


def restate_series(facts: DataFrame, versions: DataFrame, version_key: str, code: str,
                   then_cols: dict[str, str], now_cols: dict[str, str],
                   from_col: str = "valid_from") -> DataFrame:
    """History-comparable series (K14): each fact with the version valid then
    and the newest version of its code ("now" = newest, not the current
    flag, so dissolved codes keep their history).

    Both joins are inner on keys that always match: the fact points to a real
    version (or the unknown member, excluded here by construction).
    """
    real = versions.where(F.col(version_key) != F.lit(UNKNOWN_KEY))
    then = real.select(F.col(version_key).alias("__vk"),
                       *[F.col(src).alias(dst) for dst, src in then_cols.items()])
    newest = latest_version(real, code, from_col).select(
        F.col(code).alias("__code"), *[F.col(src).alias(dst) for dst, src in now_cols.items()])
    out = (facts.join(then, facts[version_key] == F.col("__vk"), "inner")
                .join(newest, facts[code] == F.col("__code"), "inner"))
    return out.drop("__vk", "__code")


def compare_shares(a: DataFrame, b: DataFrame, class_col: str, a_col: str, b_col: str,
                   not_comparable: str, a_share: str, b_share: str, digits: int = 4) -> DataFrame:
    """Compare two distributions over classes.

    ``a`` and ``b`` hold one row per class.  Full outer join with coalesced
    class (null classes never match each other).  ``a_share`` is computed
    only over comparable classes (the non-comparable class and a null class
    have null share and are outside the denominator); ``b_share`` over all.

    Totals are one scalar subquery (evaluated once) instead of a window over
    the whole table, which would pull every row into one partition.
    """
    j = (a.alias("a").join(b.alias("b"), F.col(f"a.{class_col}") == F.col(f"b.{class_col}"), "full_outer")
          .select(F.coalesce(F.col(f"a.{class_col}"), F.col(f"b.{class_col}")).alias(class_col),
                  F.col(f"a.{a_col}").alias(a_col), F.col(f"b.{b_col}").alias(b_col)))
    comparable = F.col(class_col) != F.lit(not_comparable)
    totals = scalar_of(j.agg(F.sum(F.when(comparable, F.col(a_col))).alias("ta"),
                             F.sum(F.col(b_col)).alias("tb")))
    return j.select(
        class_col, a_col, b_col,
        F.when(comparable, F.round(safe_ratio(F.col(a_col), totals.getField("ta")), digits)).alias(a_share),
        F.round(safe_ratio(F.col(b_col), totals.getField("tb")), digits).alias(b_share),
    )


def bridge_measure(facts: DataFrame, fact_key: str, bridge: DataFrame, bridge_parent: str,
                   bridge_child: str, child_dim: DataFrame, child_key: str, class_col: str,
                   measures: Sequence[Column]) -> DataFrame:
    """A parent-grain measure per child class through a many-to-many bridge
    without double counting (J13): the bridge is reduced to distinct
    (parent, class) pairs first, so a parent with several children of one
    class contributes once to that class."""
    pairs = (bridge.join(child_dim.select(F.col(child_key).alias("__ck"), class_col),
                         bridge[bridge_child] == F.col("__ck"), "inner")
                   .select(F.col(bridge_parent).alias("__pk"), class_col)
                   .distinct())
    return (facts.join(pairs, facts[fact_key] == F.col("__pk"), "inner")
                 .groupBy(class_col).agg(*measures))
