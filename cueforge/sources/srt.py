"""SRT files as tables of cues.

A cue is (file_id, ordinal, index, start_ms, end_ms, text): ordinal is its place in the file from 1, index the number the
file gives it (any number, repeats allowed). Each file is one row until its blocks are exploded; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import lines, plain_newlines, strip, without_tags
from ..functions.times import is_time_line, parsed_time

_INTEGER = r"(?U)\A[+-]?[0-9]+(_[0-9]+)*\z"


def read_files(spark: SparkSession, path: str | list[str], by_name: bool = False) -> DataFrame:
    """file_id and value (the whole text) of each file. file_id is its address, or with by_name the last part of it,
    by which files of two folders belong together."""
    address = F.col("_metadata.file_path")
    return spark.read.text(path, wholetext=True).select((F.regexp_extract(address, r"[^/]+\z", 0) if by_name else address).alias("file_id"), "value")


def parse_cues(files: DataFrame) -> DataFrame:
    """Cues of (file_id, value) rows.

    Blocks are parted by two or more line ends and trimmed. A block needs three lines: a whole number, a time line
    (comma or dot, arrow with or without spaces, anything after), and text, whose lines are joined by a space, trimmed, and
    then stripped of tags. Other blocks are dropped. A byte order mark and any line ends are taken.
    """
    text = strip(plain_newlines(F.regexp_replace("value", r"\A\x{FEFF}", "")))
    block = lambda b: lines(strip(b))
    number = lambda ls: strip(F.get(ls, F.lit(0)))
    cue = lambda ls: F.struct(
        F.regexp_replace(number(ls), "_", "").try_cast("long").alias("index"),
        parsed_time(F.get(ls, F.lit(1)), 1).alias("start_ms"),
        parsed_time(F.get(ls, F.lit(1)), 5).alias("end_ms"),
        without_tags(strip(F.array_join(F.slice(ls, 3, F.greatest(F.size(ls), F.lit(3))), " "))).alias("text"),
    )
    blocks = F.transform(F.split(text, r"\n\n+"), block)
    # three lines are looked for first: the time and number of shorter blocks don't exist
    valid = F.filter(blocks, lambda ls: F.when(F.size(ls) >= 3, F.regexp_like(number(ls), F.lit(_INTEGER)) & is_time_line(F.get(ls, F.lit(1)))).otherwise(False))
    return files.select("file_id", F.posexplode(F.transform(valid, cue)).alias("at", "cue")).select("file_id", (F.col("at") + 1).alias("ordinal"), "cue.index", "cue.start_ms", "cue.end_ms", "cue.text")


def read_cues(spark: SparkSession, path: str | list[str], by_name: bool = False) -> DataFrame:
    return parse_cues(read_files(spark, path, by_name))


def text_only(files: DataFrame) -> DataFrame:
    """file_id and text: all lines but empty ones, whole numbers and comma-form time lines, joined by a space.

    This scan is looser than parse_cues: tags stay, as does a byte order mark; a cue of digits alone is lost.
    """
    kept = F.filter(
        F.transform(lines(plain_newlines("value")), strip),
        lambda x: (x != "") & ~F.regexp_like(x, F.lit(r"(?U)\A\d+\z")) & ~F.regexp_like(x, F.lit(r"(?U)\A\d{2}:\d{2}:\d{2},\d{3}\s*-->")),
    )
    return files.select("file_id", F.array_join(kept, " ").alias("text"))
