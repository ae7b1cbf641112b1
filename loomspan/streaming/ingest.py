"""An extension: logs that keep arriving, as Structured Streaming queries over the same operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import traces


def read_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """src_file, line_no (0: a stream has no line numbers), raw of new *.jsonl files below path."""
    rows = spark.readStream.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).text(path)
    return rows.select(F.col("_metadata.file_path").alias("src_file"), F.lit(0).cast("long").alias("line_no"), F.col("value").alias("raw")).where(F.trim("raw") != "")


def stream_traces(lines: DataFrame, metadata_key: str, late: str = "2 days") -> DataFrame:
    """Rows of TRACE with event time `at`, each dedup_key once within the watermark; state older than it goes."""
    rows = traces(lines, metadata_key).withColumn("at", F.timestamp_seconds(F.col("created")))
    return rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["dedup_key"])


def activity(events: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """window_start, kind, n of events in tumbling windows, late ones up to the watermark."""
    w = F.window(time, window)
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(w, kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), kind, "n")
