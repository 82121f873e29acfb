"""Materialisation and export.

Lazy DataFrames play the role of views (staging); warehouse tables are
written once and read back, so marts, checks and exports reuse them instead
of recomputing their lineage.  Everything is written under the shared
folder the cluster names in ``spark.checkpoint.dir`` (never a
machine-local temp dir), in a fresh run folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.session import shared_dir


def run_folder(spark: SparkSession, prefix: str = "run") -> str:
    """A fresh folder below the shared checkpoint location."""
    return f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"


def materialise(tables: Mapping[str, DataFrame], base: str, compression: str = "zstd",
                parallel: int = 4, bucket_by: Mapping[str, tuple] | None = None
                ) -> dict[str, DataFrame]:
    """Write each table as parquet under ``base`` and return DataFrames that
    read the written files.  An empty table still writes a dataset carrying
    its schema, so readers never miss a table.

    Independent tables of one layer are written by concurrent jobs (the
    scheduler interleaves their tasks), so small tables do not leave the
    cluster idle while they run one after another.

    ``bucket_by`` maps a table to ``(buckets, key columns)``: it is written
    bucketed and sorted on the key as an external catalog table whose files
    live under ``base``.  Two tables bucketed alike on a join key are joined
    later without shuffling either side (co-located sort-merge join).  A third
    member, a condition, names the rows of a hot key (such as the unknown
    member): these are dealt to all writers instead of the one of their bucket,
    and lie in files of their own, which a reader of the other rows skips by
    their statistics and a reader of just these takes in parallel.
    """
    import re
    from concurrent.futures import ThreadPoolExecutor

    buckets = dict(bucket_by or {})
    suffix = re.sub(r"\W", "_", base.rstrip("/").rsplit("/", 1)[-1])

    def write(item):
        name, df = item
        path = f"{base}/{name}.parquet"
        if name in buckets:
            n, cols, *hot = buckets[name]
            table = f"{name}__{suffix}"
            # one writer task per bucket -> one file per bucket (no small files)
            if hot:
                spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(n))
                dealt = (df.where(F.coalesce(~hot[0], F.lit(True))).repartition(n, *cols)
                           .unionByName(df.where(hot[0]).repartition(n, spread)))
            else:
                dealt = df.repartition(n, *cols)
            (dealt.write.mode("overwrite").option("compression", compression)
               .bucketBy(n, *cols).sortBy(*cols).option("path", path).saveAsTable(table))
            return name, ("table", table)
        df.write.mode("overwrite").option("compression", compression).parquet(path)
        return name, ("path", path)

    items = list(tables.items())
    if not items:
        return {}
    spark = items[0][1].sparkSession
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(items)))) as pool:
        written = dict(pool.map(write, items))
    return {name: (spark.table(ref) if kind == "table" else spark.read.parquet(ref))
            for name, (kind, ref) in ((n, written[n]) for n, _ in items)}


def export_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` per exported table, one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
