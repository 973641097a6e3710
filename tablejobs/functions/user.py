"""User-written functions and filters, run on Arrow batches.

Use them only for logic the built-in column functions cannot express.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_function(
    df: DataFrame,
    function: Callable[..., pd.Series],
    inputs: Sequence[str],
    output: str,
    output_type: str | T.DataType,
) -> DataFrame:
    """Add a column computed by a function from pandas series to a pandas series of the same length."""

    def call(*batch: pd.Series) -> pd.Series:
        return function(*batch)

    computed = F.pandas_udf(call, output_type)
    return df.withColumn(output, computed(*[F.col(name) for name in inputs]))


def apply_filter(
    df: DataFrame, keep: Callable[..., pd.Series], inputs: Sequence[str]
) -> DataFrame:
    """Keep the rows for which a function from pandas series gives true (not false, not null)."""

    def call(*batch: pd.Series) -> pd.Series:
        return keep(*batch).eq(True).fillna(False).astype(bool)

    wanted = F.pandas_udf(call, "boolean")
    return df.where(wanted(*[F.col(name) for name in inputs]))
