"""Tables of readings: characters and phrases with their syllables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.phonetic import Readings

#: Most entries of a table that workers hold; a language's dictionaries have some hundred thousand.
MOST = 2_000_000


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """text and reading (syllables without tones, one a character, with spaces between) of a tab-separated file or Parquet table.

    Lines of a file that are empty, begin with # or have no tab are left out.
    """
    if path.endswith((".tsv", ".txt")):
        part = F.split("value", "\t")
        rows = spark.read.text(path).filter(~F.startswith("value", F.lit("#")) & (F.size(part) > 1)).select(F.trim(part[0]).alias("text"), F.trim(part[1]).alias("reading"))
    else:
        rows = spark.read.parquet(path).select(F.col("text").cast("string"), F.col("reading").cast("string"))
    return rows.filter("text <> '' and reading <> ''")


def collected(rows: DataFrame, most: int = MOST) -> Readings:
    """rows as a table for workers. More than most entries are an error; of repeated texts the least reading counts."""
    own = rows.groupBy("text").agg(F.min("reading").alias("reading"))
    found = own.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} readings")
    return Readings({r["text"]: r["reading"] for r in found})


def read(spark: SparkSession, path: str) -> Readings:
    return collected(read_readings(spark, path))
