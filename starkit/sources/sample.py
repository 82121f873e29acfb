"""Referentially consistent sampling.

A sample is one key range (or key set) fixed on the parent table and
applied as a predicate to every child table, so parents and children stay
consistent (sampling each table separately would break every relationship).
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.functions.scalars import count_of


def key_at(df: DataFrame, key: str, position: int, num_partitions: int | None = None) -> DataFrame:
    """One-row DataFrame with the value at 0-based ``position`` of the
    sorted non-null ``key`` values (duplicates count, like OFFSET).

    No global single-partition sort: the keys are range-partitioned and
    checkpointed to the shared checkpoint folder together with their
    partition id (so the id is fixed data, whatever AQE does to later
    reads), rows per partition are counted (one small row per partition),
    and only the partition holding the position is examined, as counts per
    distinct key (equal keys share a range partition, so a key value that
    repeats a million times is one row there, not a million to rank).
    """
    from starkit.session import shared_dir

    spark = df.sparkSession
    shared_dir(spark)  # checkpoint() needs the shared folder registered
    keys = df.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull())
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (keys.repartitionByRange(n, "__k")
                  .withColumn("__pid", F.spark_partition_id())
                  .checkpoint(eager=True))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: bounded by the partition count, not the data.
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    target = offs.where((F.col("__start") <= position) & (F.lit(position) < F.col("__start") + F.col("__n")))
    # one subquery for both values (referenced twice, evaluated once)
    tgt = target.select(F.struct("__pid", "__start").alias("__t")).scalar()
    pid, start = tgt.getField("__pid"), tgt.getField("__start")
    # Inside the target partition count rows per distinct key (a key repeated
    # a million times is one row here), then walk the cumulative counts.
    per_key = ranged.where(F.col("__pid") == pid).groupBy("__k").agg(F.count(F.lit(1)).alias("__c"))
    upto = per_key.withColumn("__end", F.sum("__c").over(
        Window.orderBy("__k").rowsBetween(Window.unboundedPreceding, Window.currentRow)) + start)
    hit = (F.col("__end") - F.col("__c") <= position) & (F.lit(position) < F.col("__end"))
    return upto.where(hit).select(F.col("__k").alias(key))


def key_range(df: DataFrame, key: str, size: int) -> DataFrame:
    """One row ``(lo, hi)``: the first and the ``size``-th smallest
    key (the first is a plain ``min``; null when there are fewer keys)."""
    lo = df.agg(F.min(key)).scalar()
    hi = key_at(df, key, size - 1).agg(F.max(key)).scalar()
    return df.sparkSession.range(1).select(lo.alias("lo"), hi.alias("hi"))


def fixed_bounds(bounds: DataFrame) -> tuple:
    """Evaluate a one-row ``(lo, hi)`` bounds DataFrame once (two values,
    not data) so the range can be applied as literal predicates.  Raises
    where a bound is null: the table has fewer keys than the range asks for."""
    row = bounds.select("lo", "hi").first()
    if row is None or row["lo"] is None or row["hi"] is None:
        raise ValueError("the table has fewer keys than the requested range")
    return row["lo"], row["hi"]


def in_range(df: DataFrame, col: str, bounds) -> DataFrame:
    """Rows with ``lo <= col <= hi``.  ``bounds`` is a ``(lo, hi)``
    pair (see ``fixed_bounds``): literal bounds are pushed into the parquet
    scan (row groups outside the range are skipped by their statistics),
    and the same range is applied to every table of the sample."""
    lo, hi = bounds if isinstance(bounds, tuple) else fixed_bounds(bounds)
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def first_keys(df: DataFrame, key: str, n: int, extra: Sequence = ()) -> DataFrame:
    """The first ``n`` distinct keys in key order, union (distinct) the
    ``extra`` keys (a row that must be in any sample, e.g. a regression
    seed).  Bounded by ``n + len(extra)`` rows, and written to the shared folder
    once, since every child of the sample reads it.  Warns when the table has
    fewer than ``n`` keys: the sample is then all of them."""
    from starkit.sources.export import run_folder

    keys = df.select(F.col(key).alias(key)).where(F.col(key).isNotNull()).distinct()
    last = key_at(keys, key, n - 1).first()           # one value
    head = keys if last is None else keys.where(F.col(key) <= F.lit(last[0]))
    if last is None:
        warnings.warn(f"fewer than {n} keys in {key}: all are taken", stacklevel=2)
    if extra:
        dtype = df.schema[key].dataType.simpleString()
        lit_rows = df.sparkSession.createDataFrame([(e,) for e in extra], f"{key} {dtype}")
        head = head.union(lit_rows).distinct()
    path = run_folder(df.sparkSession, "sample-keys")
    head.write.parquet(path)
    return df.sparkSession.read.schema(head.schema).parquet(path)


#: Keys up to which a key set is broadcast, after it was counted.
BROADCAST_KEYS = 200_000


def restrict_to(df: DataFrame, col: str, keys: DataFrame, key: str, broadcast_keys: int | None = None) -> DataFrame:
    """Children filtered to a key set (semi join).  The keys are counted
    first: up to ``broadcast_keys`` of them are broadcast.  More are joined by
    a shuffle, and their least and greatest, as literals, reach the scan of the
    children before it (a sample's keys are the first in order, so
    the row groups beyond them are not read)."""
    k = keys.select(F.col(key).alias("__key"))
    size = k.agg(F.count(F.lit(1)).alias("n"), F.min("__key").alias("lo"), F.max("__key").alias("hi")).first()
    if size.n <= (BROADCAST_KEYS if broadcast_keys is None else broadcast_keys):
        return df.join(F.broadcast(k), df[col] == F.col("__key"), "left_semi")
    near = in_range(df, col, (size.lo, size.hi))
    return near.join(k.hint("merge"), near[col] == F.col("__key"), "left_semi")


def sample_report(requested: int, extra: Sequence, keys: DataFrame, key: str,
                  tables: Mapping[str, DataFrame], details: Mapping[str, Column] | None = None) -> DataFrame:
    """One row describing a sample: requested size, the extra keys, keys
    taken, the limit key (the largest that is not an extra), the largest key,
    rows per sampled table, plus ``details`` (scalar columns such as the first
    period of the sample)."""
    own = F.when(~F.col(key).isin(list(extra)), F.col(key)) if extra else F.col(key)
    out = keys.agg(F.count(F.lit(1)).alias("n_keys"), F.max(own).alias("limit_key"), F.max(key).alias("max_key"))
    out = out.select(F.lit(requested).alias("n_requested"), F.lit(len(extra)).alias("n_extra"),
                     F.lit(",".join(str(x) for x in extra)).alias("extra_keys"), "*")
    for name, value in (details or {}).items():
        out = out.withColumn(name, value)
    for name, df in tables.items():
        out = out.withColumn(f"{name}_rows", count_of(df))
    return out
