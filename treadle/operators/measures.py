"""Pivot and growth helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from treadle.functions.scalars import ratio


def pivot_sum(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, measure: str,
              kind: str = "decimal(12,4)") -> DataFrame:
    """Sum ``measure`` into one column per listed value.

    The values are given, so there is no pass over the data to find them, and one
    conditional aggregation replaces pivot's two.  A sum too large for ``kind`` is an error,
    not a NULL.
    """
    return df.groupBy(*rows).agg(*[
        F.sum(F.when(F.col(column) == v, F.col(measure))).cast(kind).alias(str(v)) for v in values
    ])


def growth(df: DataFrame, series: Sequence[str], period: str, measure: str, name: str) -> DataFrame:
    """Percent change against the month before of each series (one row per month, by its first day).

    A month that follows a gap has no growth.
    """
    order = Window.partitionBy(*series).orderBy(period)
    before = F.when(F.add_months(F.lag(period).over(order), 1) == F.col(period), F.lag(measure).over(order))
    return df.withColumn(name, ratio(F.col(measure) - before, before, 100.0))
