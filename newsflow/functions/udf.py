"""Arrow-batched wrappers for user model functions (the pluggable stages).

Deliberately without ``from __future__ import annotations``: pandas_udf reads
the real type hints of the wrapper to pick the scalar (Series -> Series)
evaluation type, whatever hints the user's own function carries.
"""

import pandas as pd
from pyspark.sql import functions as F


def series_udf(fn, return_type):
    """``fn(pd.Series) -> pd.Series`` as a scalar pandas UDF."""
    def call(s: pd.Series) -> pd.Series:
        return pd.Series(fn(s)).reset_index(drop=True)
    return F.pandas_udf(call, return_type)


def series2_udf(fn, return_type):
    """``fn(pd.Series, pd.Series) -> pd.Series`` as a scalar pandas UDF."""
    def call(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(fn(a, b)).reset_index(drop=True)
    return F.pandas_udf(call, return_type)
