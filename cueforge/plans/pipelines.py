"""The four pipelines: correct, fix, transcribe, compare. Each is one lazy plan over all files at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import apply_substitutions, first_of, joined_texts, normalise_pairs, normalized_levenshtein, strip
from ..functions.times import srt_time_of_seconds
from ..operators.alignment import align_subs
from ..operators.context import with_context
from ..operators.filters import clean_refs
from ..operators.intervals import align_overlap, with_nearest
from ..operators.phonetic import SYLLABLES, Readings, syllable_map
from ..operators.prompts import evidence_prompt, fix_prompt, hint, messages
from ..operators.quality import with_flags
from ..operators.replies import apply_fixes, parse_correction, parse_fixes

KEYS = ["file_id", "ordinal"]
CORRECT_SYSTEM = "You edit subtitles. From a noisy transcription, a second transcription and a reference, give the corrected line as JSON: corrected, confidence from 0 to 1, notes."
FIX_SYSTEM = 'You find characters that speech recognition confused with others of the same or a similar sound. Answer with a JSON list of {"wrong", "correct"} of equal lengths, or [].'


def aligned(noisy: DataFrame, refs: DataFrame, strict_order: bool = False) -> DataFrame:
    """Cues with ref, and the columns that later stages fill."""
    out = align_overlap(noisy, refs, strict_order)
    return out.select(*KEYS, "index", "start_ms", "end_ms", F.col("text").alias("noisy"), "ref", F.lit("").alias("whisper"), F.lit("").alias("corrected"), F.lit(1.0).alias("confidence"), F.lit(False).alias("flagged"), F.lit("").alias("flag_reason"))


def transcription_requests(rows: DataFrame, media: Column) -> DataFrame:
    """What operators.providers.with_clips takes."""
    return rows.select(*KEYS, "start_ms", "end_ms", "noisy", hint("ref", "noisy").alias("hint"), media.alias("media"))


def correction_requests(rows: DataFrame, system: str = CORRECT_SYSTEM) -> DataFrame:
    """What operators.providers.with_replies takes."""
    return rows.select(*KEYS, messages(system, evidence_prompt("noisy", "whisper", "ref")).alias("messages"))


def heard(rows: DataFrame, second: DataFrame | None = None, missing_model: bool = False) -> DataFrame:
    """rows with whisper: from second (KEYS, whisper); without it the noisy text, or nothing if the model is missing."""
    if second is not None:
        return rows.drop("whisper").join(second.select(*KEYS, "whisper"), KEYS, "left").withColumn("whisper", F.coalesce("whisper", "noisy"))
    return rows if missing_model else rows.withColumn("whisper", F.col("noisy"))


def corrected(rows: DataFrame, replies: DataFrame | None = None, skip: bool = False) -> DataFrame:
    """rows with corrected, confidence and flags from replies (KEYS, raw, error).

    skip: the second transcription or the noisy text is taken as corrected. Neither (no key): corrected stays empty,
    so that writers give the noisy text and ignore the second one.
    """
    if skip:
        return rows.withColumn("corrected", first_of("whisper", "noisy"))
    if replies is None:
        return rows
    got = rows.drop("corrected", "confidence", "flagged", "flag_reason").join(replies.select(*KEYS, "raw", "error"), KEYS, "left")
    kept = [c for c in rows.columns if c not in ("corrected", "confidence", "flagged", "flag_reason")]
    return got.withColumn("_p", parse_correction("raw", "noisy", F.col("error"))).select(*kept, "_p.corrected", "_p.confidence", "_p.flagged", "_p.flag_reason")


def correct(noisy: DataFrame, refs: DataFrame, second: DataFrame | None = None, replies: DataFrame | None = None, skip_model: bool = False, strict_order: bool = False) -> DataFrame:
    """Alignment by overlap, second transcription, model corrections and quality flags of every cue."""
    return with_flags(corrected(heard(aligned(noisy, refs, strict_order), second), replies, skip_model))


def prepared(noisy: DataFrame, refs: DataFrame, n: int = 5, window_ms: int = 5000, reach: int = 3, **rules) -> DataFrame:
    """Cues with the nearest clean references, best first, and the context of the original texts."""
    return with_context(with_nearest(noisy, clean_refs(refs, **rules), n, window_ms), reach=reach)


def fix_requests(rows: DataFrame, system: str = FIX_SYSTEM) -> DataFrame:
    return rows.select(*KEYS, messages(system, fix_prompt("text", "context", "refs")).alias("messages"))


def fixed(rows: DataFrame, replies: DataFrame, syllables: dict[str, str] | Readings | None = None) -> DataFrame:
    """rows (text, refs) with new: model fixes that sound right, then substitutions by alignment, then pairs.

    A reply with an error, or a fix that is no text, leaves the cue as it was; a reply that can't be read is no fix. syllables: a
    small dictionary, a constant of the plan, or Readings of any size with phrases.
    """
    table = SYLLABLES if syllables is None else syllables
    got = rows.join(replies.select(*KEYS, "raw", "error"), KEYS, "left")
    got = got.withColumn("_fixes", parse_fixes("raw")).withColumn("_fixed", apply_fixes("text", "_fixes", table if isinstance(table, Readings) else syllable_map(table))).withColumn("_refs", joined_texts("refs"))
    got = got.withColumn("_subs", align_subs(F.col("_fixed.text"), "_refs", table))
    new = normalise_pairs(apply_substitutions(F.col("_fixed.text"), "_subs"), "_refs")
    new = F.when(F.col("error").isNotNull() | F.col("_fixed.failed"), F.col("text")).otherwise(new)
    return got.withColumn("new", new).withColumn("changed", ~F.col("text").eqNullSafe(F.col("new"))).drop("raw", "_fixes", "_fixed", "_refs", "_subs")


def fix(noisy: DataFrame, refs: DataFrame, replies: DataFrame, n: int = 5, window_ms: int = 5000, syllables: dict[str, str] | Readings | None = None, **rules) -> DataFrame:
    return fixed(prepared(noisy, refs, n, window_ms, **rules), replies, syllables)


def transcribed(segments: DataFrame) -> DataFrame:
    """file_id and content of an SRT file for each medium's segments (file_id, ordinal, start, end, text in seconds)."""
    block = F.concat(F.col("ordinal").cast("string"), F.lit("\n"), srt_time_of_seconds("start"), F.lit(" --> "), srt_time_of_seconds("end"), F.lit("\n"), strip("text"), F.lit("\n"))
    return segments.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", block.alias("block")))), lambda b: b["block"]), "\n").alias("content"))


def output_path(media: Column | str) -> Column:
    """The medium's path with its suffix changed to .srt."""
    c = F.col(media) if isinstance(media, str) else media
    return F.concat(F.regexp_replace(c, r"(?<=[^/])\.[^./]+\z", ""), F.lit(".srt"))


def compare(pairs: DataFrame) -> DataFrame:
    """file1, file2, len1, len2, distance and similarity of (file1, text1, file2, text2); parallel over pairs."""
    return pairs.select("file1", "file2", F.length("text1").alias("len1"), F.length("text2").alias("len2"), normalized_levenshtein("text1", "text2").alias("distance")).withColumn("similarity", F.lit(1.0) - F.col("distance"))
