"""Requests to models as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.strings import col, first_of
from ..functions.times import srt_time

HINT_CHARS = 224
NOT_AVAILABLE = "(not available)"


def hint(ref: Column | str, noisy: Column | str, chars: int = HINT_CHARS) -> Column:
    """The first characters of the reference, or of the noisy text if there is none: a speech model's vocabulary hint."""
    return F.substring(first_of(ref, noisy), 1, chars)


def evidence_prompt(noisy: Column | str, second: Column | str, ref: Column | str, labels=("NOISY TRANSCRIPTION", "SECOND TRANSCRIPTION", "REFERENCE")) -> Column:
    """Three labelled lines of evidence; what is empty is said to be not available."""
    line = lambda label, c: F.concat(F.lit(f"{label}: "), c)
    return F.concat_ws("\n", line(labels[0], col(noisy)), line(labels[1], first_of(second, F.lit(NOT_AVAILABLE))), line(labels[2], first_of(ref, F.lit(NOT_AVAILABLE))))


def reference_lines(refs: Column | str) -> Column:
    """A line '  [time] text' for each of a cue's references, in their order."""
    return F.array_join(F.transform(col(refs), lambda r: F.concat(F.lit("  ["), srt_time(r["start_ms"]), F.lit("] "), r["text"])), "\n")


def context_lines(context: Column | str) -> Column:
    return F.array_join(F.transform(col(context), lambda x: F.concat(F.lit("  "), x)), "\n")


def fix_prompt(text: Column | str, context: Column | str, refs: Column | str, labels=("TRANSCRIPTION", "CONTEXT", "REFERENCES")) -> Column:
    """The text, its context and its references under their labels."""
    return F.concat(F.lit(f"{labels[0]}: "), col(text), F.lit(f"\n\n{labels[1]}:\n"), context_lines(context), F.lit(f"\n\n{labels[2]}:\n"), reference_lines(refs))


def messages(system: str, user: Column | str) -> Column:
    """array<struct<role, content>> of a system and a user message."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(message("system", F.lit(system)), message("user", col(user)))
