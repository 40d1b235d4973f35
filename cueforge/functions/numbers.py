"""Numbers as text, rounded as binary floating point is: exactly, ties to even."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(c: Column, places: int, percent: bool = False) -> Column:
    """c with so many places. The built-in formatter rounds the shortest decimal form half up, so this runs on Arrow batches."""
    form = f"{{:.{places}{'%' if percent else 'f'}}}"

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if pd.isna(v) else form.format(v))

    return run(c.cast("double"))
