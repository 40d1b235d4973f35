"""Row filters over cues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import col, strip

#: Marks of comments and of on-screen text in reference tracks; a parameter of clean_refs.
NOISE = "233|2：17|站台|站上行|品川方向|京急本線|平潟灣"


def is_clean(text: Column | str, most_chars: int = 60, most_marks: int = 2, noise: str | None = NOISE) -> Column:
    """Not blank, not long, at most so many full-width and so many ASCII exclamation marks, no match of noise."""
    t = strip(text)
    keep = (t != "") & (F.length(t) <= most_chars)
    for mark in ("！", "!"):
        keep &= F.regexp_count(t, F.lit(mark)) <= most_marks
    return keep & ~F.regexp_like(t, F.lit(noise)) if noise else keep


def clean_refs(refs: DataFrame, text: str = "text", **rules) -> DataFrame:
    """The rows of refs whose text is clean, unchanged."""
    return refs.filter(is_clean(col(text), **rules))
