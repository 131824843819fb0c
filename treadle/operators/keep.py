"""One row per key, by aggregation: map-side combine instead of a sorted window per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns of each key."""
    return _one(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one(df, keys, order, F.min_by)


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order: Sequence[str] = ()) -> DataFrame:
    """Last write wins.  ``incoming`` beats ``current``; ``order`` ranks rows within each."""
    both = current.withColumn("_gen", F.lit(0)).unionByName(incoming.withColumn("_gen", F.lit(1)))
    return keep_last(both, keys, ["_gen", *order]).drop("_gen")


def daily_state(df: DataFrame, key: Sequence[str], day: str, order: Sequence[str],
                attributes: Sequence[str]) -> DataFrame:
    """The last values of each key on each day.

    After this step a key has at most one row per calendar day however many rows it had, so
    later windows per key are bounded by the calendar and not by the data.
    """
    narrow = df.select(*key, day, *[c for c in order if c not in (*key, day)],
                       *[a for a in attributes if a not in (*key, day, *order)])
    last = F.max_by(F.struct(*attributes), F.struct(*order)).alias("_row")
    return narrow.groupBy(*key, day).agg(last).select(*key, day, "_row.*")
