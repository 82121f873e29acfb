"""Staging operators: typed projection, dedup, long->wide, decode.

Every operator is a pure DataFrame -> DataFrame function built from built-in
expressions; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.functions.casts import indicator, numeric_text_to_int


@dataclass(frozen=True)
class Spec:
    """One typed staging column: source name, target type, output alias.

    ``to`` is a Spark type name (``string``, ``int``, ``bigint``, ``double``,
    ``date``, ``boolean``) or one of two rules:
    ``indicator`` (text equal to ``true_value`` -> boolean) and
    ``int_from_numeric_text`` (text -> double -> rint -> int).
    Casts are hard: under ANSI mode the first bad value fails the job, which
    is the staging contract (use the castability profile to find them first).
    """

    src: str
    to: str = "string"
    alias: str | None = None
    true_value: str = "Ja"

    def column(self) -> Column:
        name = self.alias or self.src
        if self.to == "indicator":
            expr = indicator(self.src, self.true_value)
        elif self.to == "int_from_numeric_text":
            expr = numeric_text_to_int(self.src)
        elif self.to == "string":
            expr = F.col(self.src).cast("string")
        else:
            expr = F.col(self.src).cast(self.to)
        return expr.alias(name)


def typed_projection(df: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """Select, cast and rename in one projection (column pruning reaches the scan)."""
    return df.select(*[s.column() for s in specs])


def land_as_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The raw-layer contract: a fixed column list, every column text.

    Columns absent from ``df`` become typed null strings, so a source that
    omits empty fields still lands with the full schema.
    """
    cols = list(columns) if columns is not None else df.columns
    present = {c.lower() for c in df.columns}
    return df.select(*[
        (F.col(c).cast("string") if c.lower() in present else F.lit(None).cast("string")).alias(c)
        for c in cols
    ])


def order_exprs(order: Sequence) -> list[Column]:
    """Order columns with nulls last for ascending keys (the source
    semantics; Spark's own default is nulls first)."""
    out = []
    for o in order:
        if isinstance(o, str):
            if o.startswith("-"):
                out.append(F.col(o[1:]).desc_nulls_last())
            else:
                out.append(F.col(o).asc_nulls_last())
        else:
            out.append(o)
    return out


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep one row per natural key, the first by ``order``.

    ``row_number() = 1`` is planned as a WindowGroupLimit that also runs
    before the shuffle, so each map task forwards at most one row per key:
    a key holding a third of the rows is reduced map-side, never shipped
    whole to one reducer.  ``order`` must be a total order inside a key for
    a deterministic result.  Prefix a name with ``-`` for descending.
    """
    w = Window.partitionBy(*keys).orderBy(*order_exprs(order))
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))


def long_to_wide(df: DataFrame, keys: Sequence[str], name_col: str, value_col: str,
                 measures: Mapping[str, str], agg: str = "max") -> DataFrame:
    """Long observations -> one row per key with one column per measure (A4).

    Conditional aggregation (``max(value) filter (where name = m)``), so the
    group-by is a single hash aggregate with a map-side partial step.
    Unknown measure names are ignored; a key without a measure gets null.
    """
    fn = {"max": F.max, "min": F.min, "sum": F.sum, "first": F.first}[agg]
    exprs = [fn(F.when(F.col(name_col) == F.lit(m), F.col(value_col))).alias(alias)
             for m, alias in measures.items()]
    return df.groupBy(*keys).agg(*exprs)


def decode(col, mapping: Mapping[str, str]) -> Column:
    """Simple CASE without else: unmapped values give null."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for code, label in mapping.items():
        expr = F.when(c == F.lit(code), F.lit(label)) if expr is None \
            else expr.when(c == F.lit(code), F.lit(label))
    return expr if expr is not None else F.lit(None).cast("string")


def classify(col, classes: Mapping[str, Iterable[str]]) -> Column:
    """Searched CASE with IN-lists and deliberately no else (P9): a value
    outside every list yields null so a data-quality check can surface it."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for label, values in classes.items():
        cond = c.isin(list(values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr if expr is not None else F.lit(None).cast("string")
