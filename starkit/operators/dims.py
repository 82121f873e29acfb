"""Dimension builders.

Keys are md5 surrogate keys (``starkit.functions.surrogate_key``); every
dimension can carry one extra *unknown member* row that failed lookups point
to, so facts never lose rows and inner joins on surrogate keys are safe.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.functions.keys import surrogate_key

UNKNOWN_KEY = "-1"
OPEN_END = "9999-12-31"


def with_unknown(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Append one unknown-member row (K3): given values, typed nulls elsewhere.

    The row is a literal projection over ``range(1)`` so the union adds a
    one-row LocalRelation-like branch, not a scan.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    unknown_cols = [c for c in values if c not in fields]
    if unknown_cols:
        raise ValueError(f"unknown-member columns not in dimension: {unknown_cols}")
    row = df.sparkSession.range(1).select(*[
        F.lit(values.get(name)).cast(dtype).alias(name) for name, dtype in fields.items()
    ])
    return df.unionByName(row)


def type1_from_values(df: DataFrame, value_col: str, key_col: str,
                      classes: Mapping[str, Iterable[str]] | None = None,
                      class_col: str | None = None,
                      unknown_value: str = "(onbekend)") -> DataFrame:
    """Type-1 dimension from the distinct non-null values of one column (K6).

    The optional classification is a searched CASE without else, so a value
    outside every list gets a null class (checked by ``quality.unmapped``).
    """
    from starkit.operators.staging import classify

    base = df.select(value_col).where(F.col(value_col).isNotNull()).distinct()
    cols = [surrogate_key(value_col).alias(key_col), F.col(value_col)]
    if classes is not None:
        cols.append(classify(value_col, classes).alias(class_col or "class"))
    dim = base.select(*cols)
    return with_unknown(dim, {key_col: UNKNOWN_KEY, value_col: unknown_value})


def type1_dim(df: DataFrame, natural_key: Sequence[str], key_col: str,
              columns: Sequence[Column | str], unknown: Mapping[str, object]) -> DataFrame:
    """Type-1 dimension from a reference list (K7/K8): surrogate key over the
    natural key, the given attribute expressions, plus the unknown member."""
    dim = df.select(surrogate_key(*natural_key).alias(key_col),
                    *[F.col(c) if isinstance(c, str) else c for c in columns])
    values = {key_col: UNKNOWN_KEY, **unknown}
    return with_unknown(dim, values)


def lookup_attribute(df: DataFrame, child: DataFrame, on: str | Sequence[str],
                     attributes: Mapping[str, str], child_on: str | Sequence[str] | None = None,
                     child_filter: Column | None = None) -> DataFrame:
    """Denormalise child attributes onto ``df`` with a left join to a
    filtered child (J6), e.g. the main fuel = fuel row with sequence no. 1.

    The filtered child must be unique on the join key (else rows fan out);
    ``quality.unique`` checks that.  No broadcast hint: the child can be as
    large as ``df``; AQE converts to a broadcast at runtime when it is small.
    """
    on_cols = [on] if isinstance(on, str) else list(on)
    child_cols = on_cols if child_on is None else ([child_on] if isinstance(child_on, str) else list(child_on))
    c = child if child_filter is None else child.where(child_filter)
    c = c.select(*[F.col(a).alias(f"__k{i}") for i, a in enumerate(child_cols)],
                 *[F.col(src).alias(dst) for dst, src in attributes.items()])
    cond = [F.col(l) == F.col(f"__k{i}") for i, l in enumerate(on_cols)]
    cond_all = cond[0]
    for x in cond[1:]:
        cond_all = cond_all & x
    joined = df.join(c, cond_all, "left")
    return joined.drop(*[f"__k{i}" for i in range(len(child_cols))])


def scd2_from_snapshots(snapshots: DataFrame, key: str, period: str,
                        tracked: Sequence[str], carried: Sequence[str] = (),
                        key_col: str = "version_key",
                        version_col: str = "version_no",
                        from_col: str = "valid_from", to_col: str = "valid_to",
                        current_col: str = "is_current", latest: Column | None = None) -> DataFrame:
    """Type-2 dimension from yearly snapshots (K9).

    * A new version starts when a tracked column differs from the previous
      snapshot of the same key (first snapshot counts as a change), so
      A -> B -> A yields three versions (running sum, not group-by on value).
    * Carried attributes are ``max`` within a version (alphabetically last).
    * ``valid_from`` = 1 Jan of the first year, ``valid_to`` = 31 Dec of the
      last year, or 9999-12-31 when the version reaches the latest snapshot
      of the whole input; that version is current.
    * ``version_no`` is dense (row_number by first year); the surrogate key
      is built over (key, running version) like the source warehouse.

    Plan: one shuffle on ``key``.  The lag / running-sum window, the
    per-version aggregate and the numbering window all reuse that
    partitioning.  ``latest`` is the latest period of the whole input; a caller
    that can find it without the snapshots passes it, else it is a scalar
    subquery that aggregates them a second time.  Rows per key = snapshots per
    key, bounded by the number of periods, so no key can grow a task unboundedly.
    Correct only without gaps in a key's series (check ``quality.gaps``).
    """
    w = Window.partitionBy(key).orderBy(period)
    prev_period = F.lag(period).over(w)
    changed = prev_period.isNull()
    for t in tracked:
        changed = changed | ~F.col(t).eqNullSafe(F.lag(t).over(w))
    flagged = snapshots.select(key, period, *tracked, *carried,
                               F.when(changed, 1).otherwise(0).alias("__chg"))
    running = flagged.withColumn(
        "__ver", F.sum("__chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    periods = running.groupBy(key, "__ver").agg(
        F.min(period).alias("__from"), F.max(period).alias("__to"),
        *[F.max(c).alias(c) for c in (*tracked, *carried)])
    if latest is None:
        latest = snapshots.agg(F.max(period)).scalar()  # evaluated once
    is_current = F.col("__to") == latest
    return periods.select(
        surrogate_key(key, "__ver").alias(key_col),
        F.col(key),
        *[F.col(c) for c in (*tracked, *carried)],
        F.row_number().over(Window.partitionBy(key).orderBy("__from")).alias(version_col),
        F.make_date(F.col("__from"), F.lit(1), F.lit(1)).alias(from_col),
        F.when(is_current, F.lit(OPEN_END).cast("date"))
         .otherwise(F.make_date(F.col("__to"), F.lit(12), F.lit(31))).alias(to_col),
        is_current.alias(current_col),
    )


def latest_version(versions: DataFrame, key: str, from_col: str = "valid_from",
                   unknown_key_col: str | None = None) -> DataFrame:
    """Newest version per key (W2) — not the current flag: a dissolved key
    has no current version but still has a newest one."""
    v = versions if unknown_key_col is None else versions.where(F.col(unknown_key_col) != UNKNOWN_KEY)
    w = Window.partitionBy(key).orderBy(F.col(from_col).desc())
    return v.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def bridge(df: DataFrame, parent: Sequence[str], child: Sequence[str], seq: str,
           parent_key: str, child_key: str, seq_alias: str | None = None,
           main_col: str = "is_main", carry: Sequence[str] = ()) -> DataFrame:
    """Many-to-many bridge (K10): parent key, child key, sequence number and
    an ``is_main`` flag (sequence 1).  Keys use the same expression as the
    dimensions, so bridge keys resolve against them."""
    return df.select(
        surrogate_key(*parent).alias(parent_key),
        surrogate_key(*child).alias(child_key),
        *[F.col(c) for c in carry],
        F.col(seq).alias(seq_alias or seq),
        (F.col(seq) == 1).alias(main_col),
    )
