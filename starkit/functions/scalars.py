"""One-row results used as values.

A total, a bound or a count attached to every row of another relation is an
uncorrelated scalar subquery: Spark evaluates it once and substitutes the
value (no join, no nested-loop operator in the plan).  Several values of one
aggregate travel as one struct-valued subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_of(one_row: DataFrame) -> Column:
    """The single row of ``one_row`` as a struct-valued scalar subquery;
    read its fields with ``.getField(name)``."""
    return one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("__row")).scalar()


def count_of(df: DataFrame) -> Column:
    """``(select count(*) from df)`` as a value."""
    return df.agg(F.count(F.lit(1))).scalar()
