"""Cue tables as files: SRT, flag reports, JSON.

A file's text is one value, as the file is; files are put together in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.strings import first_of
from ..functions.times import srt_time


def numbered(df: DataFrame) -> DataFrame:
    """df with n, the 1-based place in the file by ordinal."""
    return df.withColumn("n", F.row_number().over(W.partitionBy("file_id").orderBy("ordinal")).cast("long"))


def _times() -> Column:
    return F.concat(srt_time("start_ms"), F.lit(" --> "), srt_time("end_ms"))


def _files(df: DataFrame, number: Column, block: Column) -> DataFrame:
    """Blocks of a file in order of number, one empty line between them. A file's text is one value, so it has to fit into one task."""
    blocks = F.array_sort(F.collect_list(F.struct(number.alias("number"), block.alias("block"))))
    return df.groupBy("file_id").agg(F.array_join(F.transform(blocks, lambda b: b["block"]), "\n").alias("content"))


def _block(number: Column, text: Column | str) -> Column:
    return F.concat(number.cast("string"), F.lit("\n"), _times(), F.lit("\n"), text if isinstance(text, Column) else F.col(text), F.lit("\n"))


def render_numbered(df: DataFrame, text: Column | str = "text") -> DataFrame:
    """file_id and content, cues numbered from 1 whatever their index."""
    return _files(numbered(df), F.col("n"), _block(F.col("n"), text))


def render_corrected(df: DataFrame) -> DataFrame:
    """As render_numbered, with the corrected text where there is one, else the noisy one."""
    return render_numbered(df, first_of("corrected", "noisy"))


def render_original_index(df: DataFrame, text: Column | str = "text") -> DataFrame:
    """file_id and content, cues with their own index, in file order."""
    return _files(df, F.col("ordinal"), _block(F.col("index"), text))


def flag_report(df: DataFrame) -> DataFrame:
    """file_id and content of the flagged cues, with their places among all cues. Files without flags have no row."""
    text = first_of("corrected", "noisy")
    block = F.concat(
        F.col("n").cast("string"), F.lit("\n"), _times(), F.lit("\n[FLAG: "), F.coalesce("flag_reason", F.lit("")), F.lit("]\nCORRECTED: "), text,
        F.lit("\nORIGINAL:  "), F.col("noisy"), F.lit("\nREFERENCE: "), F.col("ref"), F.lit("\n"),
    )
    return _files(numbered(df).filter("flagged"), F.col("n"), block)


def write_rendered(rendered: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder file_id=... with one text file for each row; nothing for no rows."""
    # the text writer ends the last line itself
    rendered.select("file_id", F.regexp_replace("content", r"\n\z", "").alias("value")).write.mode(mode).partitionBy("file_id").text(path)


def json_lines(df: DataFrame) -> DataFrame:
    """line: all columns of a row as one JSON object, nulls included."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))


def write_intermediate(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All columns as JSON lines."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def changes(df: DataFrame, old: str = "noisy", new: str = "corrected") -> DataFrame:
    """file_id, ordinal, old, new and whether they differ."""
    return df.select("file_id", "ordinal", F.col(old).alias("old"), F.col(new).alias("new"), (~F.col(old).eqNullSafe(F.col(new))).alias("changed"))
