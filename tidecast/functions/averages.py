"""Averages of rows, and of sums that were made of them before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

COUNT = "n_"


def mean(rows: DataFrame, name: str) -> Column:
    """The average of a column as an aggregate.  Where ``rows`` has the number of values beside it, the column holds their sum."""
    if COUNT + name in rows.columns:
        return F.try_divide(F.sum(name), F.sum(COUNT + name))
    return F.avg(name)
