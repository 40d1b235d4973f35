"""Cue files as they arrive: the scan, filters and flags are row-wise, so they run on a stream as on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.srt import parse_cues


def stream_cues(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Cues of every file that comes into folder, each once."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return parse_cues(files.select(F.col("path").alias("file_id"), F.decode("content", "UTF-8").alias("value")))
