"""Incremental landing with Structured Streaming (S3/S4 as a stream).

The raw layer is append-only: new source pages arrive as files, each must
land once, all-string, with the fixed column list.  A file-source stream
with ``trigger(availableNow=True)`` does exactly that as an incremental
batch: it processes every file not yet recorded in its checkpoint and
stops, so re-running the job lands only new files, and a failed run
resumes where it stopped (exactly-once file sink + checkpoint, both in
the shared folder).  No watermark or state is involved: landing is a
stateless per-record projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starkit.sources.landing import string_schema


def landed_stream(spark: SparkSession, source_dir: str, fmt: str, schema: T.StructType | str,
                  columns: Sequence[str], json_column: str | None = None,
                  json_fields: Sequence[str] = (), max_files_per_trigger: int | None = None,
                  file_filter: str | None = None) -> DataFrame:
    """A streaming DataFrame of the source files projected to the raw
    contract: ``columns`` as text (absent ones null) plus, optionally, the
    fields of a JSON text column as further text columns.  ``file_filter``
    is a file-name glob for a directory that holds other files too."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir)
    present = {c.lower() for c in src.columns}
    cols = [(F.col(c).cast("string") if c.lower() in present else F.lit(None).cast("string")).alias(c)
            for c in columns]
    if json_column is not None:
        parsed = F.from_json(F.col(json_column), string_schema(json_fields))
        cols += [parsed.getField(f).alias(f) for f in json_fields]
    return src.select(*cols)


def land_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write every available input file once to ``target`` (parquet, zstd)
    and stop.  Call again later to land only what arrived since."""
    q = (stream.writeStream.format("parquet").option("compression", "zstd")
         .option("path", target).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q
