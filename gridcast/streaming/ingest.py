"""Incremental bronze -> silver ingestion with Structured Streaming.

The original job loops over season files on the driver and rewrites every season
on each run.  Here files landing in the bronze folder are picked up by a file
stream; each micro-batch restates the seasons that its files touch, from all bronze
files present (dynamic partition overwrite).  A season may thus arrive in any number
of files, over any number of batches, with copies of a play spread over them, and
a batch that is retried after a failure gives the same result: whatever the order,
silver ends as the batch job's result over the same files.  A rerun with no new
files does nothing.  Progress lives in the checkpoint location.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridcast import schemas
from gridcast.functions.columns import to_int
from gridcast.operators.silver import clean_plays
from gridcast.session import scratch_path
from gridcast.sources.files import read_plays_csv, write_season


def arrivals_stream(spark: SparkSession, bronze_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming read of the bronze folder as (file, line): it tells which files are
    new; what is in them is read by each file's own header."""
    return (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(bronze_dir)
            .select(F.col("_metadata.file_path").alias("file")))


def restate_seasons(spark: SparkSession, new_files: Sequence[str], bronze_dir: str, silver_dir: str,
                    keep_types: Sequence[str] = schemas.KEEP_TYPES,
                    dedupe_order: Sequence[str] | None = None) -> None:
    """Rewrite every season that is in ``new_files`` (null included) from all of bronze."""
    found = read_plays_csv(spark, list(new_files)).select(to_int("season").alias("s")).distinct()
    seasons = [r.s for r in found.collect()]   # a row per season
    if not seasons:
        return
    bronze = read_plays_csv(spark, bronze_dir)
    s = to_int("season")
    touched = s.isin([x for x in seasons if x is not None])
    if None in seasons:
        touched = F.coalesce(touched, F.lit(False)) | s.isNull()
    write_season(clean_plays(bronze.where(touched), keep_types, dedupe_order), silver_dir)


def stream_plays_to_silver(spark: SparkSession, bronze_dir: str, silver_dir: str,
                           checkpoint: str | None = None,
                           keep_types: Sequence[str] = schemas.KEEP_TYPES,
                           dedupe_order: Sequence[str] | None = None,
                           available_now: bool = True, max_files_per_trigger: int = 100) -> StreamingQuery:
    """Start the bronze -> silver stream; each batch restates its seasons.

    ``available_now`` processes everything present and stops (a scheduled job);
    otherwise the query keeps watching the folder.
    """
    checkpoint = checkpoint or scratch_path(spark, "streams/plays_silver")

    def write_batch(batch: DataFrame, _epoch: int) -> None:
        files = [r.file for r in batch.select("file").distinct().collect()]   # max_files_per_trigger at most
        if files:
            restate_seasons(batch.sparkSession, files, bronze_dir, silver_dir, keep_types, dedupe_order)

    writer = (arrivals_stream(spark, bronze_dir, max_files_per_trigger).writeStream
              .foreachBatch(write_batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
