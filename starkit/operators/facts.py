"""Fact builders: lookups to the unknown member, temporal join, coverage
floor (J1, J2, P12-P15, K11, K12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.operators.dims import UNKNOWN_KEY


#: Rows up to which a counted dimension of a lookup is broadcast (two columns).
BROADCAST_ROWS = 1_000_000


def _as_list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def _spread(df: DataFrame, spread: int | None) -> int:
    """The number of shuffle partitions, unless the caller gives a number."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if spread is None else spread


def _null_key_salt(df: DataFrame, keys: list[Column], spread: int, grain: Sequence[str] | None = None) -> Column:
    """0 for rows with a complete key; 1..spread for rows with a null key part.

    A null key never matches, but a sort-merge join still hashes every such
    row to the same partition: with many of them (a missing reference is
    the typical hot key) one task would receive them all.  Joining on
    (key, salt) with salt 0 on the dimension side spreads those rows over
    ``spread`` partitions and changes no result.  The salt is a hash of the
    row's ``grain`` columns (all columns if none are given), so it is
    deterministic under task retries and reads no other column.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | k.isNull()
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in (grain or df.columns)])
    return F.when(any_null, F.pmod(row_hash, F.lit(spread)) + 1).otherwise(F.lit(0))


def _zero_salt(key: Column) -> Column:
    """The dimension side of the salted key: always 0, but written so the
    optimizer cannot fold it to a literal (it infers ``key IS NOT NULL`` on
    that side, which would reduce a CASE on nullness to a constant and turn
    the salt equality into a plain filter, dropping it from the join keys)."""
    return F.pmod(F.xxhash64(key), F.lit(1))


def lookup(fact: DataFrame, dim: DataFrame, fact_on, dim_on, key_col: str,
           out_col: str | None = None, unknown=UNKNOWN_KEY, bounded_dim: bool | str = False,
           null_key_spread: int | None = None, grain: Sequence[str] | None = None) -> DataFrame:
    """Left equi lookup of a surrogate key on the natural key (J1 + P14).

    Every fact row is kept; a miss gets the unknown-member key.  The
    dimension natural key must be unique (``quality.unique``) or the fact
    fans out.  ``bounded_dim=True`` broadcasts the dimension and is meant
    only for one that is bounded by construction: a calendar, which has 3.7
    million days at most (dates end with the year 9999), of two columns.
    ``bounded_dim="counted"`` counts the dimension (a written one by its
    footers) and broadcasts up to ``BROADCAST_ROWS`` rows; otherwise the join strategy is left to the optimizer and
    AQE, which broadcast at runtime only below the configured threshold
    and otherwise sort-merge on the key.  For a sort-merge join, fact rows
    with a null key are spread over ``null_key_spread`` partitions (as many
    as the shuffle has, if not given) instead of all landing in one
    (``_null_key_salt``; 0 disables it), by a hash of the ``grain`` columns.
    """
    f_cols = [F.col(c) if isinstance(c, str) else c for c in _as_list(fact_on)]
    d_cols = [F.col(c) if isinstance(c, str) else c for c in _as_list(dim_on)]
    d = dim.select(*[c.alias(f"__nk{i}") for i, c in enumerate(d_cols)], F.col(key_col).alias("__sk"))
    cond = None
    for i, c in enumerate(f_cols):
        e = c == F.col(f"__nk{i}")
        cond = e if cond is None else cond & e
    if bounded_dim is True or (bounded_dim == "counted" and dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS):
        d = F.broadcast(d)
    elif (spread := _spread(fact, null_key_spread)) > 0:
        fact = fact.withColumn("__fsalt", _null_key_salt(fact, f_cols, spread, grain))
        d = d.withColumn("__dsalt", _zero_salt(F.col("__nk0")))
        cond = cond & (F.col("__fsalt") == F.col("__dsalt"))
    out = out_col or key_col
    joined = fact.join(d, cond, "left")
    return (joined.withColumn(out, F.coalesce(F.col("__sk"), F.lit(unknown)))
                  .drop("__sk", "__fsalt", "__dsalt", *[f"__nk{i}" for i in range(len(d_cols))]))


def temporal_lookup(fact: DataFrame, versions: DataFrame, fact_code: str, at: Column,
                    dim_code: str, key_col: str, out_col: str | None = None,
                    from_col: str = "valid_from", to_col: str = "valid_to",
                    unknown=UNKNOWN_KEY, null_key_spread: int | None = None,
                    grain: Sequence[str] | None = None) -> DataFrame:
    """Temporal (SCD2) lookup (J2): equality on the code plus ``at`` within
    the closed validity interval — never on the current flag.

    Planned as an equi join on the code with the interval as a residual
    condition (hash or sort-merge join, no nested loop).  Versions of one
    code must not overlap (``quality.overlaps``) or facts duplicate.
    """
    v = versions.select(F.col(dim_code).alias("__code"), F.col(from_col).alias("__from"),
                        F.col(to_col).alias("__to"), F.col(key_col).alias("__sk"))
    f = fact.withColumn("__at", at)
    cond = (F.col(fact_code) == F.col("__code")) & F.col("__at").between(F.col("__from"), F.col("__to"))
    if (spread := _spread(fact, null_key_spread)) > 0:
        f = f.withColumn("__fsalt", _null_key_salt(fact, [F.col(fact_code)], spread, grain))
        v = v.withColumn("__dsalt", _zero_salt(F.col("__code")))
        cond = cond & (F.col("__fsalt") == F.col("__dsalt"))
    out = out_col or key_col
    return (f.join(v, cond, "left")
             .withColumn(out, F.coalesce(F.col("__sk"), F.lit(unknown)))
             .drop("__code", "__from", "__to", "__sk", "__at", "__fsalt", "__dsalt"))


def coverage_floor(fact: DataFrame, at: Column, versions: DataFrame, from_col: str = "valid_from",
                   key_col: str | None = None, unknown=UNKNOWN_KEY) -> DataFrame:
    """Keep facts on/after the earliest date the dimension covers.

    The bound is an uncorrelated scalar subquery over the dimension
    (evaluated once, then a plain filter), so it moves with the dimension
    instead of being typed in.
    """
    v = versions if key_col is None else versions.where(F.col(key_col) != F.lit(unknown))
    floor = v.agg(F.min(from_col)).scalar()
    return fact.where(at >= floor)
