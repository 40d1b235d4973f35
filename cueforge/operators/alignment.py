"""Character alignment of a cue with its references: the one operator that needs a backtrace, on Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.strings import cleaned, col
from .phonetic import SYLLABLES, Readings, similar

SUBS = "array<struct<wrong:string,correct:string>>"
LEAST_RATIO = 0.4


def edit_steps(t: str, r: str):
    """(t's character or None, r's character or None) of a least-cost alignment, from the end until one side is used up.

    Of equal costs a match comes first, then a substitution, a character of t alone, a character of r alone. Rows of the cost
    table are computed whole: what an insertion can save along a row is a running minimum.
    """
    a, b = np.array([ord(c) for c in t]), np.array([ord(c) for c in r])
    ramp = np.arange(len(b) + 1)
    cost = np.empty((len(a) + 1, len(b) + 1), np.int32)
    cost[0] = ramp
    for i in range(1, len(a) + 1):
        up = cost[i - 1]
        row = np.empty(len(b) + 1, np.int64)
        row[0] = i
        row[1:] = np.minimum(up[1:] + 1, up[:-1] + (b != a[i - 1]))
        cost[i] = np.minimum.accumulate(row - ramp) + ramp
    i, j = len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1] or cost[i, j] == cost[i - 1, j - 1] + 1:
            i, j = i - 1, j - 1
            yield t[i], r[j]
        elif cost[i, j] == cost[i - 1, j] + 1:
            i -= 1
            yield t[i], None
        else:
            j -= 1
            yield None, r[j]


def substitutions(t: str, r: str, syllables: dict[str, str], least_ratio: float = LEAST_RATIO) -> list[dict[str, str]]:
    """Similar-sounding substitutions of cleaned texts, right to left; none if too few steps are matches."""
    if not t or not r:
        return []
    steps = list(edit_steps(t, r))
    if sum(x == y for x, y in steps) / len(steps) < least_ratio:
        return []
    read = lambda c: syllables.get(c, c)
    return [{"wrong": x, "correct": y} for x, y in steps if x is not None and y is not None and x != y and similar(read(x), read(y))]


def align_subs(text: Column | str, refs: Column | str, syllables: dict[str, str] | Readings | None = None, least_ratio: float = LEAST_RATIO) -> Column:
    """SUBS between text and the joined reference text, both cleaned of spaces and marks first. Nulls count as empty."""
    table = syllables.chars if isinstance(syllables, Readings) else dict(SYLLABLES if syllables is None else syllables)

    @F.pandas_udf(SUBS)
    def run(t: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([substitutions(x or "", y or "", table, least_ratio) for x, y in zip(t, r, strict=True)])

    # not to be folded into the expressions that use its result: it would run once for each use
    return run.asNondeterministic()(cleaned(F.coalesce(col(text), F.lit(""))), cleaned(F.coalesce(col(refs), F.lit(""))))
