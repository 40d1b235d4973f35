"""Cue relations derived from the driver's tables, in the same whole-number arithmetic as their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Cues of a file begin within so many milliseconds.
SPAN = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, event_type, user_id, file_id, start_ms, end_ms, text: seconds since 2024 taken as milliseconds, lasting value * 100."""
    start = F.timestamp_diff("SECOND", F.expr("timestamp_ntz'2024-01-01 00:00:00'"), "ts").cast("long")
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", "user_id", F.col("user_id").cast("string").alias("file_id"), start.alias("start_ms"),
        (start + F.floor(F.col("value") * 100).cast("long")).alias("end_ms"), F.concat_ws("_", "event_type", F.col("event_id").cast("string")).alias("text"),
    )


def event_cues(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The events of one type as cues, a file for each user, within SPAN, ordinals by start."""
    start = F.col("start_ms") % SPAN
    rows = event_times(spark, sf_dir).filter(F.col("event_type") == kind).withColumns({"start_ms": start, "end_ms": start + F.col("end_ms") - F.col("start_ms")})
    return rows.withColumn("ordinal", F.row_number().over(W.partitionBy("file_id").orderBy("start_ms", "event_id"))).withColumn("index", F.col("event_id"))


EVENT_TIMES = """
  SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS file_id,
         (epoch_us(ts) - 1704067200000000) // 1000000 AS start_ms,
         (epoch_us(ts) - 1704067200000000) // 1000000 + CAST(floor(value * 100) AS BIGINT) AS end_ms,
         event_type || '_' || event_id AS text
  FROM events"""


def cues_sql(name: str, kind: str) -> str:
    return f"{name}_at AS (SELECT * REPLACE (start_ms % {SPAN} AS start_ms, start_ms % {SPAN} + end_ms - start_ms AS end_ms) FROM times WHERE event_type = '{kind}'), {name} AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY start_ms, event_id) AS ordinal FROM {name}_at)"


#: Invented spoken text: five characters, the k-th of the k-th set by the k-th base-4 digit of a number. No two sets share a character.
SETS = ("他它塔獅", "在再才菜", "林玲寧民", "新星心山", "問文聞飯")


def letter(number: Column, k: int) -> Column:
    """Character k (from 0) of the text of number."""
    return F.substring(F.lit(SETS[k]), (F.floor(number / 4**k) % 4 + 1).cast("int"), 1)


def spoken(number: Column) -> Column:
    return F.concat(*[letter(number, k) for k in range(len(SETS))])


def letter_sql(number: str, k: int) -> str:
    return f"substring('{SETS[k]}', CAST({number} // {4**k} % 4 AS INT) + 1, 1)"


def spoken_sql(number: str) -> str:
    return " || ".join(letter_sql(number, k) for k in range(len(SETS)))


def spoken_cues(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return event_cues(spark, sf_dir, kind).withColumn("text", spoken(F.col("event_id")))


TRACKS = f"WITH times AS ({EVENT_TIMES}), {cues_sql('cues', 'view')}, {cues_sql('refs', 'click')}"
