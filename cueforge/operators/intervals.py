"""Interval joins of two cue tables by file.

A plain overlap condition would compare every pair of a file. Here each interval goes to the time bins that it covers and
an equi-join on (file, level, bin) brings together only neighbours. Bins come in levels, each WIDER times wider than the
one below: an interval's home is the first level where it covers at most WIDER bins, and it is entered there and at the
wider levels, so a very long cue costs no more than others. A pair meets at the higher of its homes, in the bin of the
later start: once. In wide bins only intervals that are at home there meet others. One file may hold most of the cues, since bins deal
it out by time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.strings import col

WIDER = 64
LEVELS = 4


def overlap_ms(s1: Column | str, e1: Column | str, s2: Column | str, e2: Column | str) -> Column:
    """Length of the common part, 0 if there is none; reversed intervals have none."""
    return F.greatest(F.lit(0).cast("long"), F.least(col(e1), col(e2)) - F.greatest(col(s1), col(s2)))


def distance_ms(s1: Column | str, e1: Column | str, s2: Column | str, e2: Column | str) -> Column:
    """The lesser distance from one's start to the other's end."""
    return F.least(F.abs(col(s1) - col(e2)), F.abs(col(e1) - col(s2)))


def near(s1: Column | str, e1: Column | str, s2: Column | str, e2: Column | str, window_ms: int) -> Column:
    """Whether two intervals overlap or stand at most window_ms apart."""
    return (overlap_ms(s1, e1, s2, e2) > 0) | (distance_ms(s1, e1, s2, e2) <= window_ms)


def _binned(df: DataFrame, lo: Column, hi: Column, bin_ms: int, own: str, wide: str) -> DataFrame:
    """df with lo, and a row for each (level, bin, turn) that it is entered at: for each letter of own at its home level, of wide above."""
    widths = [bin_ms * WIDER**k for k in range(LEVELS)]
    bins = lambda w: (F.floor(hi / w) - F.floor(lo / w)).cast("long")
    home = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        home = F.when(bins(widths[k]) < WIDER, k).otherwise(home)
    entry = lambda k, w, turn: F.transform(F.sequence(F.floor(lo / w), F.floor(hi / w)), lambda b: F.struct(F.lit(k).alias("level"), b.cast("long").alias("bin"), F.lit(turn).alias("turn")))
    none = F.array().cast("array<struct<level:int,bin:bigint,turn:string>>")
    entries = F.concat(*[F.when(F.col("home") == k, entry(k, w, t)).otherwise(none) for k, w in enumerate(widths) for t in own], *[F.when(F.col("home") < k, entry(k, w, t)).otherwise(none) for k, w in enumerate(widths) for t in wide])
    return df.withColumns({"lo": lo, "home": home}).withColumn("at", F.explode(entries))


def pairs(cues: DataFrame, refs: DataFrame, window_ms: int = 0, bin_ms: int = 10_000) -> DataFrame:
    """All pairs of one file that overlap, or with window_ms stand that near, each once.

    Columns: file_id, ordinal, start_ms, end_ms of the cue, and r_ordinal, r_start, r_end, r_text of the reference.
    """
    left = cues.select("file_id", "ordinal", "start_ms", "end_ms")
    # one of a pair is at home where it meets the other (turn a: the cue, turn b: only the reference), so two short ones never meet in a wide bin
    left = _binned(left, F.least("start_ms", "end_ms"), F.greatest("start_ms", "end_ms"), bin_ms, "a", "b").select("file_id", "ordinal", "start_ms", "end_ms", "lo", "at.level", "at.bin", "at.turn")
    right = refs.select("file_id", F.col("ordinal").alias("r_ordinal"), F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"), F.col("text").alias("r_text"))
    right = _binned(right, F.least("r_start", "r_end") - window_ms, F.greatest("r_start", "r_end") + window_ms, bin_ms, "ab", "a").select("file_id", "r_ordinal", "r_start", "r_end", "r_text", F.col("lo").alias("r_lo"), "at.level", "at.bin", "at.turn")
    width = F.lit(bin_ms) * F.pow(F.lit(WIDER), F.col("level")).cast("long")
    # few bytes make many pairs here, which a plan that goes by bytes would put into one task
    n = int(cues.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = left.repartition(n, "file_id", "level", "bin", "turn")
    once = F.col("bin") == F.floor(F.greatest("lo", "r_lo") / width)
    match = near("start_ms", "end_ms", "r_start", "r_end", window_ms) if window_ms else overlap_ms("start_ms", "end_ms", "r_start", "r_end") > 0
    return left.join(right, ["file_id", "level", "bin", "turn"]).filter(once & match).drop("level", "bin", "turn", "lo", "r_lo")


def align_overlap(cues: DataFrame, refs: DataFrame, strict_order: bool = False, bin_ms: int = 10_000) -> DataFrame:
    """Every cue with ref, the texts of all overlapping references in file order joined by a space, '' if there are none.

    With strict_order, references after the first one, in file order, that starts after the cue's end don't count, as for
    a scan that stops there; this differs only where references are not sorted by start.
    """
    found = pairs(cues, refs, 0, bin_ms)
    if strict_order:
        stop = first_later(cues, refs)
        found = found.join(stop, ["file_id", "ordinal"], "left").filter("stop is null or r_ordinal < stop").drop("stop")
    texts = F.array_sort(F.collect_list(F.struct("r_ordinal", "r_text")))
    grouped = found.groupBy("file_id", "ordinal").agg(F.array_join(F.transform(texts, lambda r: r["r_text"]), " ").alias("ref"))
    return cues.join(grouped, ["file_id", "ordinal"], "left").withColumn("ref", F.coalesce("ref", F.lit("")))


def first_later(cues: DataFrame, refs: DataFrame, bin_ms: int = 60_000) -> DataFrame:
    """For each cue, the least ordinal of the references that start after its end (references not reversed).

    Within a bin of time by a window over its rows, beyond it by the later bins' least ordinals: no task has all of a file's rows.
    """
    bin_of = F.floor(F.col("at") / bin_ms).cast("long").alias("bin")
    ends = cues.select("file_id", "ordinal", F.col("end_ms").alias("at"), F.lit(0).alias("kind"))
    starts = refs.filter("end_ms >= start_ms").select("file_id", "ordinal", F.col("start_ms").alias("at"), F.lit(1).alias("kind"))
    both = ends.unionByName(starts).select("*", bin_of)
    number = F.when(F.col("kind") == 1, F.col("ordinal"))
    # from the end of the bin backward; of equal times the cue comes first, since a start at the end doesn't count
    later = W.partitionBy("file_id", "bin").orderBy(F.desc("at"), F.asc("kind")).rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = both.withColumn("inner", F.min(number).over(later)).filter("kind = 0")
    beyond = W.partitionBy("file_id").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
    bins = both.groupBy("file_id", "bin").agg(F.min(number).alias("least")).withColumn("outer", F.min("least").over(beyond)).select("file_id", "bin", "outer")
    return inner.join(bins, ["file_id", "bin"]).select("file_id", "ordinal", F.least("inner", "outer").alias("stop"))


def nearest_refs(cues: DataFrame, refs: DataFrame, n: int = 5, window_ms: int = 5000, bin_ms: int = 20_000) -> DataFrame:
    """A row for each cue and each of its n nearest references: score, place (from 1).

    score is the overlap, or minus the distance where there is none and it is at most window_ms. Higher scores come first,
    of equal ones the earlier reference.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    scored = pairs(cues, refs, window_ms, bin_ms).withColumn("score", F.when((o := overlap_ms("start_ms", "end_ms", "r_start", "r_end")) > 0, o).otherwise(-distance_ms("start_ms", "end_ms", "r_start", "r_end")))
    place = F.row_number().over(W.partitionBy("file_id", "ordinal").orderBy(F.desc("score"), F.asc("r_ordinal")))
    return scored.withColumn("place", place).filter(F.col("place") <= n).drop("start_ms", "end_ms")


def with_nearest(cues: DataFrame, refs: DataFrame, n: int = 5, window_ms: int = 5000) -> DataFrame:
    """Every cue with refs, an array<struct<neg_score, ref_ordinal, start_ms, text>> of its nearest references, best first."""
    best = nearest_refs(cues, refs, n, window_ms)
    ref = F.struct((-F.col("score")).alias("neg_score"), F.col("r_ordinal").alias("ref_ordinal"), F.col("r_start").alias("start_ms"), F.col("r_text").alias("text"))
    grouped = best.groupBy("file_id", "ordinal").agg(F.array_sort(F.collect_list(ref)).alias("refs"))
    empty = F.array().cast(grouped.schema["refs"].dataType)
    return cues.join(grouped, ["file_id", "ordinal"], "left").withColumn("refs", F.coalesce("refs", empty))
