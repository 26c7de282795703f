"""Expensive columns computed a single time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns that no later filter can repeat.

    A filter over a projected column is pushed below the projection together
    with the column's expression, which is then evaluated twice. A one-row
    generator is a boundary the optimizer does not move filters across.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
