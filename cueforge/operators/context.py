"""Symmetric row-frame context of cues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MARKER, PLAIN = ">>> ", "    "
#: Places in one block of a file, see block in with_context.
BLOCK = 8192


def with_context(df: DataFrame, key: str = "file_id", order: str = "ordinal", text: str = "text", reach: int = 3, block: int | None = BLOCK, marker: str = MARKER, plain: str = PLAIN) -> DataFrame:
    """df with context: the texts from reach rows before to reach rows after, the row's own marked, cut at a file's ends.

    With block, order must be whole numbers without gaps in a key (as a scan gives them): a key's rows are then dealt to blocks of
    so many places, with reach rows of the neighbours copied in, so that a key with most of the rows is no single task.
    With block=None any order column will do.
    """
    if block is None:
        return _framed(df, [key], order, text, reach, marker, plain)
    own = F.floor(F.col(order) / block).cast("long")
    near = F.array_distinct(F.array(own, F.floor((F.col(order) - reach) / block).cast("long"), F.floor((F.col(order) + reach) / block).cast("long")))
    dealt = df.withColumn("_own", own).withColumn("_block", F.explode(near))
    return _framed(dealt, [key, "_block"], order, text, reach, marker, plain).filter("_own = _block").drop("_own", "_block")


def _framed(df: DataFrame, keys: list[str], order: str, text: str, reach: int, marker: str, plain: str) -> DataFrame:
    # rows of a frame are known by their place in it, so equal order values stay apart
    by = W.partitionBy(*keys).orderBy(order)
    numbered = df.withColumn("_n", F.row_number().over(by))
    frame = W.partitionBy(*keys).orderBy("_n").rowsBetween(-reach, reach)
    rows = F.collect_list(F.struct(F.col("_n").alias("n"), F.col(text).alias("text"))).over(frame)
    return numbered.withColumn("context", F.transform(rows, lambda r: F.concat(F.when(r["n"] == F.col("_n"), marker).otherwise(plain), F.coalesce(r["text"], F.lit(""))))).drop("_n")
