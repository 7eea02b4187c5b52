"""Incremental form of the interactions conversion job (CSV → read-only Parquet).

The batch job (:func:`rankshelf.sources.io.csv_to_parquet`) rewrites the whole
table. When new interaction files keep landing in a folder, the same filter
runs as a Structured Streaming query: the file source remembers which files it
has taken, the Parquet file sink commits each micro-batch exactly once, and
the checkpoint folder (under the cluster's shared ``spark.checkpoint.dir``)
lets a restarted or partly failed job resume where it stopped.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankshelf.sources.io import INTERACTION_SCHEMA


def start_read_filter(
    spark: SparkSession,
    csv_dir: str,
    parquet_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Stream ``csv_dir`` (header CSV files) into ``parquet_dir``, keeping ``is_read == 1``.

    ``available_now=True`` processes everything present and stops (a
    restartable batch); ``False`` keeps polling for new files.
    """
    reader = spark.readStream.schema(INTERACTION_SCHEMA).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(csv_dir).where(F.col("is_read") == 1)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", parquet_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
