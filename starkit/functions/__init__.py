"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from starkit.functions.casts import cast_fails, indicator, numeric_text_to_int, safe_ratio
from starkit.functions.keys import NULL_PLACEHOLDER, date_key, surrogate_key
from starkit.functions.scalars import count_of, scalar_of

__all__ = [
    "NULL_PLACEHOLDER",
    "cast_fails",
    "count_of",
    "date_key",
    "indicator",
    "numeric_text_to_int",
    "safe_ratio",
    "scalar_of",
    "surrogate_key",
]
