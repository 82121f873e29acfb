"""Cast helpers for typed staging."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_text_to_int(col) -> Column:
    """Two-step numeric: text such as ``'268240.0'`` -> double -> int.

    Spark truncates double->int, the source semantics round half to even;
    ``rint`` rounds half-even first so both agree (2.5 -> 2, 3.5 -> 4).
    """
    return F.rint(_col(col).cast("double")).cast("int")


def indicator(col, true_value: str = "Ja") -> Column:
    """Indicator text -> boolean: equal to ``true_value`` is true, any other
    value false, null stays null."""
    return _col(col) == F.lit(true_value)


def safe_ratio(num, den) -> Column:
    """``num / nullif(den, 0)`` — null instead of a division error."""
    d = _col(den)
    return _col(num) / F.when(d != 0, d)


def cast_fails(col, to_type: str) -> Column:
    """True where a non-null value would not cast to ``to_type``."""
    c = _col(col)
    return c.isNotNull() & c.try_cast(to_type).isNull()
