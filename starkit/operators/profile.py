"""Profiling (R1-R12): inventories, column profiles, grain, duplicates,
referential coverage, membership change, padding, castability, census.

Every profile is a DataFrame computed in as few scans as the question
allows: per-column statistics are one aggregate over all columns, then
unpivoted, instead of one query per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starkit.functions.casts import cast_fails, safe_ratio
from starkit.functions.scalars import scalar_of
from starkit.sources.footers import footers


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def column_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: type, min, max (as text), distinct count
    (HyperLogLog by default, like the source profile; exact on request),
    null %, empty-string % (trim = '').

    One aggregate computes everything for all columns; the result row is
    unpivoted with ``explode`` of an array of structs.  The HyperLogLog
    sketches merge map-side, so the shuffle is one small row per task.
    Exact distinct counts are a group-by of their own, see
    :func:`typed_distinct_counts`, which turns every row of N columns into N;
    use ``exact=True`` for narrow tables or when exact numbers are needed.
    """
    approximate = (lambda c: F.lit(None)) if exact else F.approx_count_distinct
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs += [
            F.min(c).cast("string").alias(f"mn{i}"),
            F.max(c).cast("string").alias(f"mx{i}"),
            approximate(c).cast("bigint").alias(f"nd{i}"),
            F.count_if(c.isNull()).alias(f"nn{i}"),
            (F.count_if(F.trim(c) == "") if isinstance(f.dataType, T.StringType)
             else F.lit(0).cast("bigint")).alias(f"ne{i}"),
        ]
    one = df.agg(*aggs)
    structs = [F.struct(F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("column_type"),
                        F.col(f"mn{i}").alias("min_value"), F.col(f"mx{i}").alias("max_value"),
                        F.col(f"nd{i}").alias("n_distinct"), F.col(f"nn{i}").alias("n_null"),
                        F.col(f"ne{i}").alias("n_empty"))
               for i, f in enumerate(df.schema.fields)]
    long = one.select("__rows", F.posexplode(F.array(*structs)).alias("i", "s"))
    n_distinct = F.col("s.n_distinct")
    if exact:
        long = long.join(F.broadcast(typed_distinct_counts(df)), "i", "left")  # a row a column
        n_distinct = F.coalesce("counted", F.lit(0).cast("bigint")).alias("n_distinct")
    return long.select(
        "s.column_name", "s.column_type", "s.min_value", "s.max_value", n_distinct,
        F.round(safe_ratio(100.0 * F.col("s.n_null"), F.col("__rows")), 2).alias("null_pct"),
        F.round(safe_ratio(100.0 * F.col("s.n_empty"), F.col("__rows")), 2).alias("empty_pct"),
    )


def typed_distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct non-null values of the columns, by position: (i, counted).

    One group-by over (column, value), a value in its own type: a row has a
    field for each column, null but for one.  Rows are dealt over all tasks
    first, as a file's values in few tasks, combined there, would fill their
    memory; equal rows of one task of the scan stay together."""
    fields = [f"`{c}`" for c in df.columns]
    dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in fields]))
    values = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(c).isNotNull().alias("given"),
                 *[(F.col(other) if j == i else F.lit(None).cast(f.dataType)).alias(f"c{j}")
                   for j, (other, f) in enumerate(zip(fields, df.schema.fields))])
        for i, c in enumerate(fields)]))
    return dealt.select(values.alias("v")).select("v.*").distinct().groupBy("i").agg(F.count_if("given").alias("counted"))


SKETCH_LOG_K = 14  # 2**14 registers: a relative error of about 0.8 % (1 sigma)
SKETCH_TOLERANCE = 0.04


def distinct_sketches(df: DataFrame) -> DataFrame:
    """Per source file and column: rows, nulls, and a HyperLogLog sketch of
    the distinct values, to be stored and merged later: (source_file,
    column_name, n_rows, n_null, sketch).  One scan; values are combined on
    the map side, so a file sends one row of sketches, whatever its size."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nn{i}"),
                 F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), F.lit(SKETCH_LOG_K)).alias(f"sk{i}")]
    per_file = df.groupBy(F.col("_metadata.file_path").alias("source_file")).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"nn{i}").alias("n_null"), F.col(f"sk{i}").alias("sketch"))
                               for i, c in enumerate(cols)]))
    return per_file.select("source_file", F.col("__rows").alias("n_rows"), rows.alias("s")).select(
        "source_file", "s.column_name", "n_rows", "s.n_null", "s.sketch")


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """Per column the rows, nulls and sketch of all files of ``sketches``."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_rows").cast("bigint").alias("n_rows"), F.sum("n_null").cast("bigint").alias("n_null"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact distinct non-null values of every column, (column_name,
    n_distinct): one unpivoted group-by, combined on the map side."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]))
    return (df.select(pairs.alias("p")).select("p.*").distinct()
              .groupBy("column_name").agg(F.count("value").alias("n_distinct")))


def within(sketch, exact, tolerance: float = SKETCH_TOLERANCE):
    """Whether the estimate of a sketch is within the tolerance of an exact count."""
    return F.abs(F.hll_sketch_estimate(sketch) - exact) <= F.greatest(F.lit(1.0), tolerance * exact)


def grain(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table and candidate key: rows, distinct keys, unique?,
    rows per key.  A key column the table lacks becomes a remark row
    instead of a failure."""
    parts = []
    for name, (df, key) in tables.items():
        cols = {c.lower() for c in df.columns}
        missing = [k for k in key if k.lower() not in cols]
        label = F.lit(" + ".join(key)).alias("key_cols")
        if missing:
            parts.append(df.sparkSession.range(1).select(
                F.lit(name).alias("table_name"), label,
                F.lit(None).cast("bigint").alias("n_rows"), F.lit(None).cast("bigint").alias("n_keys"),
                F.lit(None).cast("boolean").alias("is_unique"),
                F.lit(None).cast("double").alias("rows_per_key"),
                F.lit(f"missing column: {', '.join(missing)}").alias("remark")))
            continue
        keyexpr = F.col(key[0]) if len(key) == 1 else F.struct(*key)
        a = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(keyexpr).alias("n_keys"))
        parts.append(a.select(
            F.lit(name).alias("table_name"), label, "n_rows", "n_keys",
            (F.col("n_rows") == F.col("n_keys")).alias("is_unique"),
            F.round(safe_ratio(F.col("n_rows"), F.col("n_keys")), 4).alias("rows_per_key"),
            F.lit(None).cast("string").alias("remark")))
    return _union(parts)


def duplicate_count(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows minus distinct rows per table; one shuffle per table gives
    both numbers (group by all columns, then sum and count the groups)."""
    parts = []
    for name, df in tables.items():
        g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
        parts.append(g.agg(F.sum("__n").cast("bigint").alias("n_rows"),
                           F.count(F.lit(1)).alias("n_distinct"))
                      .select(F.lit(name).alias("table_name"), "n_rows",
                              (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates")))
    return _union(parts)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Fully duplicate rows with their multiplicity."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def coverage(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
             child_name: str, parent_name: str) -> DataFrame:
    """Rows, distinct keys, orphan rows (no parent; a null key is
    an orphan too) and coverage % for one child -> parent reference."""
    # rows per key first (map-side combine): a hot or null key is one row in the join
    keys = child.groupBy(F.col(child_col).alias("__ck")).agg(F.count(F.lit(1)).alias("__n"))
    p = parent.select(F.col(parent_col).alias("__pk")).distinct()
    j = keys.join(p, F.col("__ck") == F.col("__pk"), "left")
    a = j.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"), F.count("__ck").alias("n_keys"),
              F.coalesce(F.sum(F.when(F.col("__pk").isNull(), F.col("__n"))), F.lit(0)).alias("n_orphans"))
    return a.select(F.lit(f"{child_name}.{child_col}").alias("child_ref"),
                    F.lit(f"{parent_name}.{parent_col}").alias("parent_ref"),
                    "n_rows", "n_keys", "n_orphans",
                    F.round(100 * (1 - safe_ratio(F.col("n_orphans"), F.col("n_rows"))), 2)
                     .alias("coverage_pct"))


def orphan_counts(tables: Mapping[str, DataFrame], references: Mapping[str, tuple[str, str, str, str]],
                  nulls: bool = False) -> DataFrame:
    """One row with the orphans of each reference (name -> child table,
    column, parent table, column), by one group-by over the tagged keys of
    all of them; with ``nulls`` a null key is an orphan too."""
    from starkit.operators.checks import key_groups

    listed = list(references.items())
    groups = key_groups(tables, [(i, r[0], r[1]) for i, (_, r) in enumerate(listed)],
                        [(i, r[2], r[3]) for i, (_, r) in enumerate(listed)], nulls)
    return groups.agg(*[F.coalesce(F.sum(F.when((F.col("check") == i) & ~F.col("has_parent"), F.col("n"))), F.lit(0).cast("bigint")).alias(name)
                        for i, (name, _) in enumerate(listed)])


def membership_change(df: DataFrame, period: str, member: str) -> DataFrame:
    """Per period, members that appear (no previous period) and
    that vanish (no next period) — excluding the first and last period of
    the whole series, where everything would look new / vanished."""
    per = df.select(period, member).distinct()
    w = Window.partitionBy(member).orderBy(period)
    marked = per.select(period, F.lag(period).over(w).alias("__prev"),
                        F.lead(period).over(w).alias("__next"))
    bounds = scalar_of(per.agg(F.min(period).alias("lo"), F.max(period).alias("hi")))
    out = marked.groupBy(period).agg(
        F.count_if(F.col("__prev").isNull() & (F.col(period) > bounds.getField("lo"))).alias("n_new"),
        F.count_if(F.col("__next").isNull() & (F.col(period) < bounds.getField("hi"))).alias("n_vanished"))
    return out.where((F.col("n_new") > 0) | (F.col("n_vanished") > 0))


def padding(df: DataFrame, group_col: str, value_col: str, top: int = 15) -> DataFrame:
    """Per group: rows, raw vs trimmed max length, padded count; groups
    with padding, the ``top`` largest (a report limit)."""
    v = F.col(value_col)
    g = (df.where(v.isNotNull()).groupBy(group_col)
           .agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.length(v)).alias("max_len"),
                F.max(F.length(F.trim(v))).alias("max_len_trimmed"),
                F.count_if(v != F.trim(v)).alias("n_padded")))
    return (g.where("n_padded > 0")
             .orderBy(F.col("n_rows").desc(), F.col(group_col).asc()).limit(top))


def castability(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Per column, the non-null values that would not cast to the
    target type (what a hard cast in staging would fail on).  One scan."""
    one = df.agg(*[F.count_if(cast_fails(c, t)).alias(f"c{i}") for i, (c, t) in enumerate(targets.items())])
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("target_type"),
                        F.col(f"c{i}").alias("n_unparseable"))
               for i, (c, t) in enumerate(targets.items())]
    return one.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def value_census(df: DataFrame, cols: Sequence[str], table: str | None = None) -> DataFrame:
    """Value frequencies of several columns in one scan (unpivot
    to (column, value) and group once); null shows as ``(null)``."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.coalesce(F.col(c).cast("string"), F.lit("(null)")).alias("value"))
        for c in cols]))
    out = df.select(pairs.alias("p")).groupBy("p.column_name", "p.value").agg(
        F.count(F.lit(1)).alias("n"))
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


def parquet_inventory(spark, glob: str) -> DataFrame:
    """Per file: rows, columns, MB, row groups, bytes per row — from the
    parquet footers only, over a listing that stays on the executors."""
    return footers(spark, glob).select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "n_rows", "n_columns",
        F.round(F.col("size") / 1024.0 / 1024.0, 2).alias("mb"), "row_groups",
        F.round(safe_ratio(F.col("size"), F.col("n_rows")), 1).alias("bytes_per_row"))
