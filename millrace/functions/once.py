"""Evaluating an expensive expression once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often they are used later.

    Filters are pushed through projections by copying the expressions they
    use, so a condition on a costly column computes it again. They are not
    pushed through a generator, here one that gives exactly one row.
    """
    values = F.struct(*(value.alias(name) for name, value in columns.items()))
    return df.select("*", F.inline(F.array(values)))
