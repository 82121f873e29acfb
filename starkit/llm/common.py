"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkit.sources.export import run_folder

#: The white space of the word contract, ``[\x20\x09-\x0D]`` (fixed value).
WHITE = " \t\n\x0b\x0c\r"
WHITE_RE = r"[\x20\x09-\x0D]"

#: Rows up to which a side of 8 to 24 bytes a row is broadcast, after its rows
#: were counted; above it the same join runs as a shuffle join.
BROADCAST_ROWS = 200_000


#: Folders that the operator at work has written.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


#: Spark removes the shuffle files of a query once it has ended, not when the
#: driver happens to collect its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint location
    and read it back: lineage ends here and every executor can read it.  Inside a
    :func:`tidy` operator the shuffle files of the write go with its end."""
    spark, path, folders = df.sparkSession, run_folder(df.sparkSession, f"llm-{name}"), _written.get()
    if folders is None:
        df.write.parquet(path)
    else:
        with setting(spark, CLEAN_SHUFFLES, "true"):
            df.write.option("compression", "zstd").parquet(path)
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that :func:`saved` wrote."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``operator`` with its result written and read back, after which the
    tables that it saved on the way are deleted: never before, so a lost executor's
    tasks find what they read.  What remains is the result's folder, which belongs to
    the operator that called this one, or to the caller.  After a failure all remain."""
    @wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        folders: list[str] = []
        token = _written.set(folders)
        try:
            out = saved(operator(*args, **kwargs), operator.__name__)
        finally:
            _written.reset(token)
        *inner, result = folders
        removed(out.sparkSession, inner)
        if (outer := _written.get()) is not None:
            outer.append(result)
        return out
    return run


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`saved` writes inside are deleted at the end, unless it fails."""
    folders: list[str] = []
    token = _written.set(folders)
    try:
        yield
    finally:
        _written.reset(token)
    removed(spark, folders)


def small_or_none(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """``df`` to be broadcast if it has at most ``rows`` rows (counted here,
    so ``df`` should be saved), else None."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else None


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it has at most ``rows`` rows."""
    hinted = small_or_none(df, rows)
    return df if hinted is None else hinted


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, also where
    ``body`` uses it several times or inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one struct ``__row``: columns that an operator
    adds beside it can't clash with columns the input has."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("__row.*")


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Jobs run inside have this setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def batches_of(spark: SparkSession, rows: int):
    """Jobs run inside hand Python at most ``rows`` rows at a time: for rows
    that hold whole texts or sets."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
