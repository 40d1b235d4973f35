"""Times: whole milliseconds from the start of a medium, and their SRT form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import col

TIME_LINE = r"(?U)\A([0-9]{2}):([0-9]{2}):([0-9]{2})[,.]([0-9]{3})\s*-->\s*([0-9]{2}):([0-9]{2}):([0-9]{2})[,.]([0-9]{3})"


def _format(h: Column, m: Column, s: Column, ms: Column) -> Column:
    return F.format_string("%02d:%02d:%02d,%03d", h, m, s, ms)


def _over(a: Column, n: int) -> Column:
    return F.floor(a / F.lit(n)).cast("long")


def srt_time(ms: Column | str) -> Column:
    """HH:MM:SS,mmm of milliseconds that are not negative; hours take more places if they need them."""
    ms = col(ms).cast("long")
    return _format(_over(ms, 3_600_000), _over(ms % 3_600_000, 60_000), _over(ms % 60_000, 1000), ms % 1000)


def srt_time_of_seconds(seconds: Column | str) -> Column:
    """HH:MM:SS,mmm of binary floating-point seconds, the milliseconds cut off, not rounded."""
    s = col(seconds).cast("double")
    return _format(F.floor(s / 3600).cast("long"), F.floor((s % 3600) / 60).cast("long"), (s % 60).cast("long"), ((s % 1) * 1000).cast("long"))


def parsed_time(line: Column | str, at: int = 1) -> Column:
    """Milliseconds of a time line's start (at=1) or end (at=5); null if it is no time line."""
    line = col(line)
    h, m, s, ms = (F.regexp_extract(line, TIME_LINE, at + k).try_cast("long") for k in range(4))
    return (h * 3600 + m * 60 + s) * 1000 + ms


def is_time_line(line: Column | str) -> Column:
    return F.regexp_like(col(line), F.lit(TIME_LINE))
