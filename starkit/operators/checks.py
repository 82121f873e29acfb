"""The check planner of the suite (D12): many declared checks, few passes.

A check is a declaration (:class:`Check`), not a query.  ``run_checks`` sorts
the declarations by what they need of their table:

* predicates on rows (not null, unmapped, unknown member, completeness): one
  conditional aggregate a table, unpivoted to a row a check;
* keys (unique, accepted values, relationships): one tagged union for all
  tables.  Children bring (check, value, 1 row), parents (check, value,
  0 rows, parent), and a single group-by counts rows and parents a value, so
  duplicates, unaccepted values and orphans are read off the same groups.
  Values are combined on the map side: a hot key is one row a task;
* combinations of columns: a group-by each;
* what orders rows (overlaps, gaps) comes as a relation of failing rows.

So a table is scanned once for its predicates, once for its keys, and once a
combination, however many checks it has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.functions.scalars import count_of
from starkit.operators import quality as dq
from starkit.operators.dims import UNKNOWN_KEY


@dataclass(frozen=True)
class Check:
    """One declared check; made by the functions below."""

    name: str
    kind: str
    table: str = ""
    columns: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    values: tuple = ()
    unknown: Mapping[str, object] = field(default_factory=dict)
    expected: int | Column | DataFrame | None = None
    failing: DataFrame | None = None


def unique(table: str, col: str) -> Check:
    return Check(f"unique_{table}_{col}", "unique", table, (col,))


def not_null(table: str, col: str) -> Check:
    return Check(f"not_null_{table}_{col}", "not_null", table, (col,))


def accepted_values(table: str, col: str, values: Sequence) -> Check:
    return Check(f"accepted_values_{table}_{col}", "accepted_values", table, (col,), values=tuple(values))


def relationships(table: str, col: str, parent: str, parent_col: str, name: str | None = None) -> Check:
    return Check(name or f"relationships_{table}_{col}", "relationships", table, (col,), parent=(parent, parent_col))


def unique_combination(table: str, cols: Sequence[str], name: str | None = None) -> Check:
    return Check(name or f"unique_combination_{table}", "unique_combination", table, tuple(cols))


def unmapped(name: str, table: str, class_col: str, key_col: str, unknown=UNKNOWN_KEY) -> Check:
    return Check(name, "unmapped", table, (class_col, key_col), unknown={key_col: unknown})


def unknown_member(name: str, table: str, key_col: str, unknown=UNKNOWN_KEY) -> Check:
    return Check(name, "unknown_member", table, (key_col,), unknown={key_col: unknown})


def complete(name: str, table: str, expected, unknown: Mapping[str, object]) -> Check:
    """The table has ``expected`` rows (a number, a scalar, or the relation to
    be counted) and no lookup of ``unknown`` fell on its unknown member; one
    failing row otherwise."""
    return Check(name, "complete", table, tuple(unknown), unknown=dict(unknown), expected=expected)


def no_rows(name: str, failing: DataFrame) -> Check:
    """Any relation of failing rows."""
    return Check(name, "no_rows", failing=failing)


KEYED = ("unique", "accepted_values", "relationships")


def _row_failures(c: Check) -> Column:
    col = F.col(c.columns[0])
    if c.kind == "not_null":
        return F.count_if(col.isNull())
    if c.kind == "unmapped":
        key = c.columns[1]
        return F.count_if((F.col(key) != F.lit(c.unknown[key])) & col.isNull())
    if c.kind == "unknown_member":
        return F.count_if(col == F.lit(c.unknown[c.columns[0]]))
    on_unknown = F.lit(0).cast("bigint")
    for key, unknown in c.unknown.items():
        on_unknown = on_unknown + F.count_if(F.col(key) == F.lit(unknown))
    return F.struct(F.count(F.lit(1)).alias("rows"), on_unknown.alias("on_unknown"))


def _verdict(c: Check, counted: Column) -> Column:
    if c.kind != "complete":
        return counted
    expected = count_of(c.expected) if isinstance(c.expected, DataFrame) else c.expected if isinstance(c.expected, Column) else F.lit(c.expected)
    bad = (counted.getField("rows") != expected) | (counted.getField("on_unknown") > 0)
    return F.when(bad, 1).otherwise(0).cast("bigint")


def _predicates(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    one = df.agg(*[_row_failures(c).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [F.struct(F.lit(c.name).alias("check_name"), _verdict(c, F.col(f"c{i}")).alias("failing_rows")) for i, c in enumerate(checks)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _tagged(df: DataFrame, keys: Sequence[tuple[int, str]], parent: bool, nulls: bool = False) -> DataFrame:
    """(check, value, n, is_parent): the values of several columns in one pass,
    without nulls unless asked for."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("check"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in keys]))
    rows = df.select(pairs.alias("k")).select("k.check", "k.value")
    rows = rows if nulls else rows.where(F.col("value").isNotNull())
    return rows.withColumn("n", F.lit(0 if parent else 1).cast("bigint")).withColumn("is_parent", F.lit(parent))


def key_groups(tables: Mapping[str, DataFrame], children: Sequence[tuple[int, str, str]],
               parents: Sequence[tuple[int, str, str]], nulls: bool = False) -> DataFrame:
    """(check, value, n, has_parent) over ``children`` and ``parents``, lists
    of (check, table, column): one group-by for all of them.  Null values of
    children are left out unless ``nulls``; a null parent is none."""
    out = None
    for keys, parent in ((children, False), (parents, True)):
        for table in dict.fromkeys(t for _, t, _ in keys):
            part = _tagged(tables[table], [(i, c) for i, t, c in keys if t == table], parent, nulls and not parent)
            out = part if out is None else out.unionByName(part)
    return out.groupBy("check", "value").agg(F.sum("n").alias("n"), F.max("is_parent").alias("has_parent"))


def _keyed(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """A table that is child and parent, or has several keyed checks, is read
    once in each role; the groups' failures are summed a check."""
    children = [(i, c.table, c.columns[0]) for i, c in enumerate(checks)]
    parents = [(i, *c.parent) for i, c in enumerate(checks) if c.kind == "relationships"]
    groups = key_groups(tables, children, parents)
    failures = F  # one flat CASE over the checks
    for i, c in enumerate(checks):
        if c.kind == "unique":
            bad = F.when(F.col("n") > 1, 1).otherwise(0)
        elif c.kind == "accepted_values":
            bad = F.when((F.col("n") > 0) & ~F.col("value").isin([str(v) for v in c.values]), 1).otherwise(0)
        else:
            bad = F.when(F.col("has_parent"), 0).otherwise(F.col("n"))
        failures = failures.when(F.col("check") == i, bad.cast("bigint"))
    found = groups.groupBy("check").agg(F.sum(failures).alias("failing_rows"))
    names = F.explode(F.array(*[F.struct(F.lit(i).alias("check"), F.lit(c.name).alias("check_name")) for i, c in enumerate(checks)]))
    spark = groups.sparkSession  # a check without any value has no group and passes
    listed = spark.range(1).select(names.alias("k")).select("k.check", "k.check_name")
    return F.broadcast(listed).join(found, "check", "left").select("check_name", F.coalesce("failing_rows", F.lit(0).cast("bigint")).alias("failing_rows"))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All checks as ``(check_name, failing_rows, passed)``."""
    parts = []
    rows = [c for c in checks if c.kind in ("not_null", "unmapped", "unknown_member", "complete")]
    for table in dict.fromkeys(c.table for c in rows):
        parts.append(_predicates(tables[table], [c for c in rows if c.table == table]))
    if keyed := [c for c in checks if c.kind in KEYED]:
        parts.append(_keyed(tables, keyed))
    for c in checks:
        if c.kind == "unique_combination":
            parts.append(dq.failure_count(c.name, dq.unique_combination(tables[c.table], list(c.columns))))
        elif c.kind == "no_rows":
            parts.append(dq.failure_count(c.name, c.failing))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failing_rows") == 0)
