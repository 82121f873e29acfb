"""Surrogate and date keys (K1, K2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the conventions of the warehouse being rebuilt:
# the text substituted for a null key part, and the separator between parts.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 over the string casts of ``cols`` joined with ``-``; null parts
    become a placeholder so that (null, 'a') and ('a', null) differ.

    The same expression must be used wherever a key is derived (dimension,
    bridge, fact lookups) or lookups stop matching.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def date_key(col) -> Column:
    """Readable integer date key YYYYMMDD (null stays null)."""
    return F.date_format(_col(col), "yyyyMMdd").cast("int")
