"""What parquet footers say: rows, columns, row groups, and the least and
greatest value of a column, without reading data pages.

The files are listed by Spark (``binaryFile``, of which only path and length
are read), so the listing stays a distributed relation; the tasks that hold the
paths open the footers.  A row group without statistics of a column has that
one column read, so the bounds are always exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

COUNTS = "path string, n_rows long, n_columns int, row_groups int, size long"


def _uri(path: str) -> str:
    return re.sub(r"^file:/+", "file:///", path)


def readable(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open files of this path's kind themselves; a store that
    only Spark's own readers reach has no footers here."""
    from pyarrow import fs

    found = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().toString()
    try:
        fs.FileSystem.from_uri(_uri(found if found.endswith("/") else f"{found}/"))
    except Exception:  # noqa: BLE001 - no such kind of store, or no access to it without Spark
        return False
    return True


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the parquet files under ``path``, a file, folder or glob."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
            .load(path).select("path", "length"))


def footers(spark: SparkSession, path: str, columns: Sequence[str] = (), known: DataFrame | None = None) -> DataFrame:
    """Per file its counts, and ``lo_<i>``, ``hi_<i>`` of the i-th of ``columns``
    (which all files must have; null where a file has no value of it).  Their
    types come from ``known``, the dataset if it is opened already."""
    schema = (known if known is not None else spark.read.parquet(path)).schema if columns else None
    types = [schema[c].dataType for c in columns]
    arrow = [to_arrow_type(t) for t in types]
    asked = list(columns)

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows, bounds = [], [[] for _ in range(2 * len(asked))]
            for name, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                filesystem, p = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name))
                with filesystem.open_input_file(p) as handle:
                    file = pq.ParquetFile(handle)
                    meta = file.metadata
                    rows.append((name, meta.num_rows, meta.num_columns, meta.num_row_groups, size))
                    for k, c in enumerate(asked):
                        at, seen = [meta.schema.column(i).path for i in range(meta.num_columns)].index(c), []
                        for g in range(meta.num_row_groups):
                            stats = meta.row_group(g).column(at).statistics
                            if stats is not None and stats.has_min_max:
                                seen += [stats.min, stats.max]
                            elif stats is None or stats.null_count != meta.row_group(g).num_rows:
                                found = pc.min_max(file.read_row_group(g, columns=[c])[c]).as_py()
                                seen += [found["min"], found["max"]]
                        seen = [x for x in seen if x is not None]
                        bounds[2 * k].append(min(seen, default=None))
                        bounds[2 * k + 1].append(max(seen, default=None))
            names = ["path", "n_rows", "n_columns", "row_groups", "size"]
            out = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))]
            for k, t in enumerate(arrow):
                names += [f"lo_{k}", f"hi_{k}"]
                out += [pa.array(bounds[2 * k], t), pa.array(bounds[2 * k + 1], t)]
            if rows:
                yield pa.record_batch(out, names)

    schema = COUNTS + "".join(f", lo_{k} {t.simpleString()}, hi_{k} {t.simpleString()}" for k, t in enumerate(types))
    return listed(spark, path).mapInArrow(read, schema)


def column_bounds(spark: SparkSession, path: str, column: str, known: DataFrame | None = None) -> DataFrame:
    """One row (lo, hi): the least and greatest value of a column of a dataset,
    from the footers where tasks can read them, else by a scan of the column."""
    if not readable(spark, path):
        return spark.read.parquet(path).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return footers(spark, path, [column], known).agg(F.min("lo_0").alias("lo"), F.max("hi_0").alias("hi"))
