"""Quality flags and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import fixed
from ..functions.strings import col, first_of, latin_runs, length_ratio, strip

LONGEST, SHORTEST = 2.5, 0.3


def flag_kind(text: Column, noisy: Column) -> Column:
    """empty, latin or ratio, or null: the rule whose reason stands. A later rule takes the place of an earlier one."""
    ratio = length_ratio(text, noisy)
    return F.when(strip(text) == "", "empty").when(F.size(latin_runs(text)) > 0, "latin").when((ratio > LONGEST) | (ratio < SHORTEST), "ratio")


def with_flags(df: DataFrame) -> DataFrame:
    """df (corrected, noisy, flagged, flag_reason) with both flag columns brought up to date; a flag once set stays."""
    text = first_of("corrected", "noisy")
    kind = flag_kind(text, F.col("noisy"))
    reason = (
        F.when(kind == "empty", "Empty corrected text")
        .when(kind == "latin", F.concat(F.lit("Unexpected latin text: ['"), F.array_join(latin_runs(text), "', '"), F.lit("']")))
        .when(kind == "ratio", F.concat(F.lit("Length ratio suspicious ("), fixed(length_ratio(text, "noisy"), 1), F.lit("x)")))
        .otherwise(F.col("flag_reason"))
    )
    return df.withColumns({"flag_reason": reason, "flagged": F.col("flagged") | kind.isNotNull()})


def run_summary(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """total, avg_confidence (0 for no rows), flagged, flag_rate (null for no rows), no_ref, with_ref; one row, or one by group."""
    no_ref = F.coalesce(F.col("ref"), F.lit("")) == ""
    return df.groupBy(*by or []).agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("avg_confidence"), F.count_if("flagged").alias("flagged"),
        F.try_divide(F.count_if("flagged"), F.count(F.lit(1))).alias("flag_rate"), F.count_if(no_ref).alias("no_ref"), F.count_if(~no_ref).alias("with_ref"),
    )


def change_summary(df: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """total and changed of a change log."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(~col(old).eqNullSafe(col(new))).alias("changed"))
