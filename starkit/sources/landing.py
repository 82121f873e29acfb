"""Raw layer: scans, landing, code lists, manifest, reconciliation and
source-side selections (S1-S7, S14-S16).

The raw contract: one parquet dataset per source, a fixed column list,
every column text, missing fields null.  Ingest itself (HTTP paging with
retries) is not part of the library: jobs start from landed JSON/parquet.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def source(spark: SparkSession, raw_dir: str, group: str, name: str,
           columns: Sequence[str] | None = None, at_least: Sequence[str] = ()) -> DataFrame:
    """Named source under a swappable raw directory (S1):
    ``{raw_dir}/{group}_{name}.parquet``; with ``columns`` the all-string
    schema is declared instead of read from the files.  With ``at_least`` it is
    declared too, for these columns and whatever else the files have: a
    column that a file lacks is null instead of failing the analysis."""
    path = f"{raw_dir.rstrip('/')}/{group}_{name}.parquet"
    if columns is None and at_least:
        found = spark.read.parquet(path).columns
        have = {c.lower() for c in found}
        columns = [*found, *[c for c in at_least if c.lower() not in have]]
    reader = spark.read
    if columns is not None:
        reader = reader.schema(string_schema(columns))
    return reader.parquet(path)


def dataset_name(path_col: Column | str | None = None) -> Column:
    """Name of the parquet dataset a row came from: ``x`` for both a single
    file ``.../x.parquet`` and a dataset directory ``.../x.parquet/part-*``
    (a regex on the base file name would see only the part file)."""
    p = F.col("_metadata.file_path") if path_col is None else (
        F.col(path_col) if isinstance(path_col, str) else path_col)
    return F.regexp_extract(p, r"([^/]+)\.parquet(/[^/]*)?$", 1)


def read_family(spark: SparkSession, glob: str, name_col: str = "source_file",
                columns: Sequence[str] | None = None) -> DataFrame:
    r"""Several files read as one relation (S2): columns unioned by name
    (``mergeSchema``), plus the full path each row came from in
    ``name_col`` (regexes such as ``gebieden_(\d{4})\.parquet`` then work
    for single files and for dataset directories alike).

    The glob decides the members (e.g. ``gebieden_[0-9][0-9][0-9][0-9]``
    keeps a sibling code-list file out).
    """
    reader = spark.read.option("mergeSchema", "true")
    if columns is not None:
        reader = reader.schema(string_schema(columns))
    df = reader.parquet(glob)
    return df.withColumn(name_col, F.col("_metadata.file_path"))


def normalise_json(col: Column | str, columns: Sequence[str]) -> Column:
    """JSON text -> struct of text fields (S3): missing key -> null, nested
    values -> their JSON text (verbatim as landed), scalars -> their
    literal text (``true``, ``1e5`` as written)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, string_schema(columns))


def read_landed_json(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Landed JSON records with varying keys -> fixed all-string columns (S3)."""
    return (spark.read.schema(string_schema(columns))
            .option("primitivesAsString", "true").json(path))


@dataclass(frozen=True)
class Landed:
    """What a landing wrote: ``expected`` rows went into the write, ``written``
    are in the files."""

    n_columns: int
    expected: int
    written: int


def rows_in(spark: SparkSession, path: str) -> int:
    """Rows of a dataset by its footers; files that cannot be read have none."""
    return spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").parquet(path).count()


def land(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite") -> Landed:
    """Write the raw layer (S4): fixed all-string schema, zstd; an empty
    input still writes a readable dataset with its schema.

    The expected count is observed on the rows as they enter the write, so the
    source is read once; the written count comes from the files' footers.  The
    write has no shuffle after the observation of a plain source, so a repeated
    task is counted once.  A difference raises a warning (S7)."""
    from starkit.operators.staging import land_as_strings
    seen = Observation()
    out = land_as_strings(df.observe(seen, F.count(F.lit(1)).alias("rows")), columns)
    out.write.mode(mode).option("compression", "zstd").parquet(path)
    landed = Landed(len(out.columns), seen.get["rows"], rows_in(df.sparkSession, path))
    _warn([(path, landed.expected, landed.written)])
    return landed


def write_landing(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite") -> int:
    """:func:`land`; returns the rows written."""
    return land(df, path, columns, mode).written


def _warn(counts: Iterable[tuple[str, int, int]]) -> None:
    for name, expected, written in counts:
        if expected != written:
            warnings.warn(f"{name}: {expected} rows expected, {written} written", stacklevel=3)


def json_keys(records: DataFrame, col: str) -> list[str]:
    """The sorted union of the keys of JSON objects: found by an aggregate over
    all records; only the names reach the driver, one of each."""
    keys = records.select(F.explode(F.json_object_keys(F.col(col))).alias("key")).distinct()
    return sorted(r.key for r in keys.collect())


def code_list(records: DataFrame, col: str) -> DataFrame | None:
    """A code list (S5) from JSON records with varying keys: text columns, the
    sorted union of the keys; ``None`` when there are no records."""
    keys = json_keys(records, col)
    if not keys:
        return None
    return records.select(normalise_json(col, keys).alias("r")).select(*[F.col("r").getField(k).alias(k) for k in keys])


def land_code_list(records: DataFrame, col: str, path: str, snapshot_date: str) -> DataFrame | None:
    """Land a code list and return its manifest entry (one row); an empty list
    is skipped: nothing is written, and there is no entry."""
    codes = code_list(records, col)
    if codes is None:
        return None
    return manifest_entries(records.sparkSession, [(path.rstrip("/").rsplit("/", 1)[-1], snapshot_date, land(codes, path))])


def manifest_entries(spark: SparkSession, landed: Iterable[tuple[str, str, Landed]]) -> DataFrame:
    """Manifest entries of landings (file name, snapshot date, what was landed):
    one row each."""
    return spark.createDataFrame([(f, day, x.written, x.n_columns, x.expected) for f, day, x in landed],
                                 "file_name string, snapshot_date string, n_rows long, n_columns int, expected_rows long")


def reconciled(spark: SparkSession, entries: DataFrame, raw_dir: str | None = None) -> DataFrame:
    """Load reconciliation (S7) of manifest entries: the written rows, counted
    again from the files of ``raw_dir`` if given, against the expected ones.
    Adds ``reconciled`` and warns for every file that differs.  A manifest has
    a row a dataset, so its rows are few."""
    rows = entries.collect()
    if raw_dir is not None:
        base = raw_dir.rstrip("/")
        rows = [Row(**{**r.asDict(), "n_rows": rows_in(spark, f"{base}/{r.file_name}")}) for r in rows]
    _warn((r.file_name, r.expected_rows, r.n_rows) for r in rows)
    counted = spark.createDataFrame([tuple(r[c] for c in entries.columns) for r in rows], entries.schema)
    return counted.withColumn("reconciled", reconcile(F.col("expected_rows"), F.col("n_rows")))


def upsert_manifest(manifest: DataFrame, entries: DataFrame, file_col: str = "file_name",
                    order_col: str = "snapshot_date") -> DataFrame:
    """Manifest upsert (S6): an entry replaces the one with the same file
    name, the rest is kept; sorted by file name.  The newer entry wins by
    ``order_col``, then by being in ``entries``."""
    both = (manifest.withColumn("__new", F.lit(0))
                    .unionByName(entries.withColumn("__new", F.lit(1)), allowMissingColumns=True))
    w = Window.partitionBy(file_col).orderBy(F.col("__new").desc(), F.col(order_col).desc_nulls_last())
    return (both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
                .drop("__rn", "__new").orderBy(file_col))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot manifest (one JSON document ``{"datasets": [...]}``) as
    one row per dataset; nested selection queries stay JSON text.

    The manifest is metadata (one entry per dataset) and is conventionally
    named ``_manifest.json``, a name Spark's file sources skip as hidden;
    the document is therefore opened through the filesystem layer and only
    its entries are handed to Spark's JSON reader.  A directory written by
    ``write_manifest`` is read with the JSON source directly.
    """
    import json
    import os

    from pyarrow import fs

    uri = path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"
    filesystem, p = fs.FileSystem.from_uri(uri)
    if filesystem.get_file_info(p).type == fs.FileType.Directory:
        doc = spark.read.json(path)
        entries = doc.select(F.explode("datasets").alias("d")).select("d.*")
    else:
        with filesystem.open_input_stream(p) as fh:
            items = json.loads(fh.read().decode("utf-8"))["datasets"]
        lines = spark.sparkContext.parallelize([json.dumps(e, ensure_ascii=False) for e in items], 1)
        entries = spark.read.json(lines)
    nested = [f.name for f in entries.schema.fields if isinstance(f.dataType, (T.StructType, T.MapType))]
    return entries.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in entries.columns])


def write_manifest(manifest: DataFrame, path: str, file_col: str = "file_name") -> None:
    """Write the manifest back as one JSON document with the entries sorted
    by file name (one entry per dataset: a few hundred rows at most, so a
    single writer task is the right size)."""
    doc = manifest.agg(F.sort_array(F.collect_list(F.struct(
        F.col(file_col).alias("__sort"), F.struct(*manifest.columns).alias("entry")))).alias("__e"))
    doc = doc.select(F.transform("__e", lambda x: x["entry"]).alias("datasets"))
    doc.coalesce(1).write.mode("overwrite").json(path)


def reconcile(expected: Column, written: Column) -> Column:
    """Load reconciliation (S7): true when the written count equals the
    expected (source) count."""
    return expected == written


def select_by_title(codes: DataFrame, title_col: str, fragments: Sequence[str],
                    require_nonempty: bool = True) -> DataFrame:
    """Keep codes whose lower-cased title contains any fragment.
    Titles are stable where codes are renumbered.  An empty selection is an
    error (a renamed title would otherwise silently select nothing)."""
    pattern = "|".join(re.escape(f.lower()) for f in fragments)
    sel = codes.where(F.lower(F.col(title_col)).rlike(pattern))
    if require_nonempty and sel.isEmpty():
        raise ValueError(f"no code title contains any of {list(fragments)}")
    return sel


def prefix_or_equal(col: Column | str, prefixes: Sequence[str] = (), equals: Sequence[str] = ()) -> Column:
    """Region-style selection (S15): starts with one of ``prefixes`` or
    equals one of ``equals``."""
    c = F.col(col) if isinstance(col, str) else col
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | c.startswith(p)
    if equals:
        cond = cond | c.isin(list(equals))
    return cond


def year_window(df: DataFrame, year: Column | str, first: int | None, last: int | None,
                require_nonempty: bool = True) -> DataFrame:
    """Keep rows whose year is in [first, last] (S16); empty is an error."""
    y = F.col(year) if isinstance(year, str) else year
    cond = F.lit(True)
    if first is not None:
        cond = cond & (y >= first)
    if last is not None:
        cond = cond & (y <= last)
    out = df.where(cond)
    if require_nonempty and out.isEmpty():
        raise ValueError(f"no data in years {first}..{last}")
    return out
