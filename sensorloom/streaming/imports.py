"""Logger files as a stream into the raw tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.sources.logger import format_logger, parse_lines
from sensorloom.sources.tiers import write_tier


def stream_import(
    spark: SparkSession,
    source: str,
    raw_path: str,
    checkpoint: str,
    names: Sequence[str],
    max_files: int | None = None,
    tree: Column | None = None,
) -> None:
    """Take in all files that have arrived and stop; files taken before are not read again.

    A file belongs to one micro-batch, so repeated lines of a file are dropped there, as the batch
    reader does, without state and whatever the order in which files arrive. Each micro-batch overwrites
    its own folder (batch, Tree), so a batch that runs twice after a failure is not doubled.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(source).select(F.col("_metadata.file_path").alias("path"), F.col("value"))

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = format_logger(parse_lines(batch, names), tree).where(F.col("Timestamp").isNotNull())
        write_tier(rows.withColumn("batch", F.lit(f"stream-{batch_id}")), raw_path, ("batch", "Tree"))

    query = (
        lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).outputMode("append").start()
    )
    query.awaitTermination()


def stream_resample(rows: DataFrame, cols: Sequence[str], lateness: str, window: str = "1 hour", time: str = "Timestamp", keys: Sequence[str] = ("Tree", "Cable")) -> DataFrame:
    """Tumbling means of a stream of tier rows.

    ``lateness`` is how far a row may be behind the newest of all keys; what comes later is lost, so it must cover the slowest tree.
    """
    d = rows.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", lateness)
    d = d.groupBy(*keys, F.window("_at", window).alias("_w")).agg(*[F.avg(c).alias(c) for c in cols])
    return d.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias(time), *cols)
