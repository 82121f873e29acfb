"""Order-dependent operators that stay parallel inside one huge group.

A window ``partitionBy(g).orderBy(o)`` processes each group in one task, so
a group holding a third of the rows becomes one straggler task.  The forms
here range-partition on ``(g, o)`` instead: a hot group is spread over many
partitions in order.  Each partition computes its local result with a
window on ``(partition id, g)`` and a small per-(partition, group) table
(at most #groups + #partitions rows) carries the state of the earlier
partitions of the same group (row counts for numbering, maxima for
running maxima).

The range-partitioned rows are checkpointed with their partition id (to the
shared checkpoint folder), so the id is data: stable under task retries and
whatever AQE does to later shuffle reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PID = "__pid"
GROUP = "__grp"


def range_split(df: DataFrame, by: Sequence[str], order: Sequence[Column],
                num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``by`` + ``order`` and persist with ``__pid`` and
    the group packed as one struct column ``__grp`` (a struct compares
    equal with null fields, so null group keys stay a group of their own
    and a plain equi-join on it is null-safe)."""
    from starkit.session import shared_dir

    shared_dir(df.sparkSession)  # checkpoint() needs the shared folder registered
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = df.withColumn(GROUP, F.struct(*[F.col(b) for b in by]))
    return (g.repartitionByRange(n, F.col(GROUP).asc_nulls_first(), *order)
             .withColumn(PID, F.spark_partition_id())
             .checkpoint(eager=True))


def _with_carry(ranged: DataFrame, carry: DataFrame) -> DataFrame:
    """Attach the per-(partition, group) carry.  Join keys equal the later
    window's partition keys, so a sort-merge join and the window share one
    shuffle (AQE turns the join into a broadcast when the carry is small)."""
    return ranged.join(carry, [PID, GROUP], "inner")


def _carry_window() -> Window:
    return Window.partitionBy(GROUP).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)


def row_number_split(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str,
                     num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by by order by order)`` without a
    single task per group.  ``order`` must be total within a group."""
    ranged = range_split(df, by, order, num_partitions)
    counts = ranged.groupBy(PID, GROUP).agg(F.count(F.lit(1)).alias("__n"))
    carry = counts.select(PID, GROUP, F.coalesce(F.sum("__n").over(_carry_window()), F.lit(0))
                          .alias("__carry_rows"))
    local = Window.partitionBy(PID, GROUP).orderBy(*order)
    return (_with_carry(ranged, carry)
            .withColumn(out, (F.row_number().over(local) + F.col("__carry_rows")).cast("int"))
            .drop(PID, GROUP, "__carry_rows"))


def previous_max_split(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str,
                       out: str, num_partitions: int | None = None) -> DataFrame:
    """``max(value) over (partition by by order by order rows between
    unbounded preceding and 1 preceding)`` without a single task per group."""
    ranged = range_split(df, by, order, num_partitions)
    per = ranged.groupBy(PID, GROUP).agg(F.max(value).alias("__pmax"))
    carry = per.select(PID, GROUP, F.max("__pmax").over(_carry_window()).alias("__carry_max"))
    local = Window.partitionBy(PID, GROUP).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (_with_carry(ranged, carry)
            .withColumn(out, F.greatest(F.max(value).over(local), F.col("__carry_max")))
            .drop(PID, GROUP, "__carry_max"))
