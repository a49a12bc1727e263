"""Rounding as Python does it, where the last place of a result matters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F


def py_round(digits: int):
    """A vectorised function that rounds doubles like Python's round(): the exact binary value, ties to even."""

    @F.pandas_udf("double")
    def rounded(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if pd.isna(x) else round(x, digits))

    return rounded
