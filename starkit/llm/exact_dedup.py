"""Exact deduplication with an extendible-hash index on shared files.

1. Rows are grouped by the 64-bit key and the whole normalised text.  The
   grouping compares bytes, so texts whose keys collide stay apart, and it
   combines on the map side, so a text that a third of all rows share is
   one entry per map task before anything is shuffled.
2. The directory doubles (one more leading bit of the key) for as long as a
   bucket holds more than ``capacity`` entries; a bucket that fits keeps its
   depth.  The counts come from a histogram of leading bits, so no loop
   reads the entries again.
3. Entries are range-partitioned on the key: an owner task holds a key range,
   numbers the chain of entries with equal keys and writes its index files
   to the shared folder.
4. A row takes its bucket from the directory cell of its key, and there the entry
   of its key's chain whose digest has the same bytes.  The row that stays and
   the size of a group come from the rows found at each place of the index.

Defined results: a null text is empty, and all texts of white space only
are equal to it; on ties the smallest doc_id stays (null last); of rows that repeat
doc_id and text exactly one stays; an empty table gives an empty result;
other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkit.llm.common import WHITE, packed, partitions, saved, small, tidy

BUCKET_CAPACITY = 65_536


def normalised(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _leading(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def directory(entries: DataFrame, capacity: int = BUCKET_CAPACITY) -> tuple[DataFrame, int]:
    """(cell, depth, bucket) for all cells of ``bits`` leading key bits that
    occur, and ``bits``.  ``bucket`` is the first ``depth`` bits of the cell;
    the depth grows until the bucket has at most ``capacity`` entries."""
    n = entries.count()
    bits = min(40, max(1, (max(1, n // capacity)).bit_length() + 4))
    cells = saved(entries.groupBy(_leading(F.col("key"), bits).alias("cell")).agg(F.count("*").alias("n")), "cells")
    done, pending, depth = None, cells, 0
    while True:
        pending = pending.withColumn("bucket", F.shiftright("cell", bits - depth))
        full = pending.groupBy("bucket").agg(F.sum("n").alias("total")).filter((F.col("total") > capacity) & F.lit(depth < bits))
        fits = pending.join(full, "bucket", "left_anti").select("cell", F.lit(depth).alias("depth"), "bucket")
        done = fits if done is None else done.unionByName(fits)
        pending = pending.join(full, "bucket", "left_semi").select("cell", "n")
        if depth >= bits or not pending.limit(1).count():
            return saved(done, "directory"), bits
        pending, depth = saved(pending, "overfull"), depth + 1


def build_index(texts: DataFrame, capacity: int = BUCKET_CAPACITY) -> tuple[DataFrame, DataFrame, int]:
    """The index, one entry per distinct text of ``texts`` (key, norm): bucket,
    depth, key, place in the chain, digest; its directory (cell, depth, bucket);
    and the leading key bits that are a cell."""
    entries = texts.groupBy("key", "norm").agg(F.lit(1).alias("one"))
    entries = saved(entries.select("key", F.sha2("norm", 256).alias("text_sha256")), "entries")
    cells, bits = directory(entries, capacity)
    owned = (entries.withColumn("cell", _leading(F.col("key"), bits)).join(small(cells), "cell")
             .repartitionByRange(partitions(texts.sparkSession), F.shiftrightunsigned("key", 1), "key"))
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text_sha256"))
    return saved(owned.select("bucket", "depth", "key", chain.alias("chain"), "text_sha256"), "index"), cells, bits


def exact_dedup(docs: DataFrame, keep_rows: bool = False, capacity: int = BUCKET_CAPACITY) -> DataFrame:
    """Per row doc_id, keep_id, group_size, kept, text_sha256 and the index
    place (bucket, depth, chain); with ``keep_rows`` the row that stays as ``__row``
    and no others."""
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("norm", normalised(F.col("__row.text"))).withColumn("key", F.xxhash64("norm"))

    rows = keyed(packed(docs)).select(
        "__row", F.col("__row.doc_id").alias("doc_id"), F.length(F.coalesce("__row.text", F.lit(""))).alias("n"), "key",
        F.sha2("norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("rid"))
    rows = saved(rows if keep_rows else rows.drop("__row"), "rows")  # makes the row number data
    index, cells, bits = build_index(keyed(rows if keep_rows else packed(docs)).select("key", "norm"), capacity)

    found = rows.drop("__row").withColumn("cell", _leading(F.col("key"), bits)).join(small(cells.drop("depth")), "cell").drop("cell")
    found = saved(found.join(index, ["bucket", "key", "text_sha256"]), "found")
    place = ["bucket", "key", "chain"]
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("best")
    groups = found.groupBy(*place).agg(best, F.count("*").alias("group_size"))
    if keep_rows:
        stays = groups.select(*place, "group_size", F.col("best.rid").alias("rid"))
        return rows.select("__row", "rid").join(stays, "rid")
    groups = groups.select(*place, "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"))
    out = found.join(groups, place)
    return out.select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256", "bucket", "depth", "chain")


@tidy
def keep_first(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each distinct text, with its columns."""
    return exact_dedup(docs, keep_rows=True).select("__row.*")
