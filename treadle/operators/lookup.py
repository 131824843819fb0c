"""Joins with a twist: point-in-time, band, orphan and cascade lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

UNKNOWN = -1

#: Calendar slices of the point-in-time lookup and the step from one to the next.
SLICES = {"year": "interval 1 year", "quarter": "interval 3 months", "month": "interval 1 month"}


#: Tasks that facts without a key are spread over, per slice.
_SPREAD = 1024


def _slice(day: Column, since: dt.date, until: dt.date, unit: str) -> Column:
    inside = F.least(F.greatest(day, F.lit(since)), F.lit(until))
    return F.trunc(inside, unit)


def asof_lookup(facts: DataFrame, versions: DataFrame, on: Mapping[str, str], at: str,
                take: Mapping[str, str], *, since: dt.date, until: dt.date,
                valid_from: str = "ValidFromDate", valid_to: str = "ValidToDate",
                closed: bool = False, slice_unit: str = "year") -> DataFrame:
    """Left join each fact to the version in force on its date.

    ``on`` maps fact columns to version columns, ``take`` maps new column names to version
    columns.  Intervals are ``[valid_from, valid_to)``, or inclusive of ``valid_to`` with
    ``closed``; a NULL end is open.  Versions of one key must not overlap.

    Versions are laid out once per calendar slice they touch, and the slice joins the
    equality key.  A hot key therefore spreads over its slices, every fact meets only the
    versions of its own slice, and AQE can split a slice that is still too big.  Both sides
    clamp dates to [since, until], so rows outside that span still meet: it bounds the
    layout, never the result.  Whether the versions are broadcast is Catalyst's choice.
    """
    first = F.col(valid_from).cast("date")
    last = F.col(valid_to).cast("date")
    if not closed:
        last = F.date_sub(last, 1)
    last = F.coalesce(last, F.lit(until))
    lo = _slice(first, since, until, unit=slice_unit)
    hi = F.greatest(_slice(last, since, until, unit=slice_unit), lo)
    step = F.expr(SLICES[slice_unit])

    def missing(names) -> Column:
        test = F.lit(False)
        for n in names:
            test = test | F.col(n).isNull()
        return test

    right = versions.select(
        *[F.col(v).alias(f"_k{i}") for i, v in enumerate(on.values())],
        F.when(missing(on.values()), 1).otherwise(0).alias("_known"),
        *[F.col(v).alias(f"_t{i}") for i, v in enumerate(take.values())],
        F.col(valid_from).cast("date").alias("_from"),
        F.col(valid_to).cast("date").alias("_to"),
        F.explode(F.sequence(lo, hi, step)).alias("_slice"),
    )
    when = F.col(at).cast("date")
    # a fact without a key finds no version; spread by its content, such facts don't meet in one task
    alone = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(_SPREAD)).cast("int") + 2
    left = facts.withColumn("_fslice", _slice(when, since, until, unit=slice_unit)).withColumn(
        "_fknown", F.when(missing(on), alone).otherwise(0))
    match = (F.col("_fslice") == F.col("_slice")) & (F.col("_fknown") == F.col("_known")) & (when >= F.col("_from"))
    end = when <= F.col("_to") if closed else when < F.col("_to")
    match = match & (F.col("_to").isNull() | end)
    for i, fact_column in enumerate(on):
        match = match & (F.col(fact_column) == F.col(f"_k{i}"))
    return left.join(right, match, "left").select(
        *[F.col(f"`{c}`") for c in facts.columns],
        *[F.col(f"_t{i}").alias(name) for i, name in enumerate(take)],
    )


def or_unknown(key: Column) -> Column:
    """Facts without a version keep their row and point at the unknown member."""
    return F.coalesce(key, F.lit(UNKNOWN).cast("long"))


def _magnitude(number: Column) -> Column:
    """A whole number that never falls as ``number`` rises: its binary order of magnitude."""
    size = F.floor(F.log2(F.abs(number.cast("double")) + 1)).cast("int")
    return F.when(number < 0, -1 - size).otherwise(size)


#: The magnitude of the largest double: where an open band's layout ends.
_LARGEST = 1024


def band_lookup(df: DataFrame, bands: DataFrame, value: str, take: Mapping[str, str], *,
                low: str, high: str) -> DataFrame:
    """Left join a number to the band ``low <= value <= high``; NULL high is open.

    Each band is laid out once per order of magnitude it touches, and the magnitude joins by
    equality with the range as a residual.  So fractions have a band like whole numbers, a band's
    width costs at most its magnitudes, and Catalyst broadcasts or shuffles by measured size.
    """
    number = F.col(value)
    end = F.coalesce(_magnitude(F.col(high)), F.lit(_LARGEST))
    right = bands.select(
        F.col(low).alias("_low"), F.col(high).alias("_high"),
        F.explode(F.sequence(_magnitude(F.col(low)), end)).alias("_band"),
        *[F.col(c).alias(n) for n, c in take.items()])
    match = (F.col("_own") == F.col("_band")) & (number >= F.col("_low")) & (
        F.col("_high").isNull() | (number <= F.col("_high")))
    return df.withColumn("_own", _magnitude(number)).join(right, match, "left").drop("_own", "_band", "_low", "_high")


def _not_null(columns: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in columns:
        test = test & F.col(c).isNotNull()
    return test


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame,
            parent_columns: Sequence[str]) -> DataFrame:
    """Child rows whose key has no parent.  A NULL key passes, as a foreign key does."""
    keys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_columns)])
    match = F.lit(True)
    for i, c in enumerate(columns):
        match = match & (F.col(c) == F.col(f"_p{i}"))
    return child.filter(_not_null(columns)).join(keys, match, "left_anti")


def orphan_counts(child: DataFrame, columns: Sequence[str], parent: DataFrame,
                  parent_columns: Sequence[str]) -> DataFrame:
    """Orphan keys with their row counts; keys are combined before any shuffle."""
    keys = child.filter(_not_null(columns)).groupBy(*columns).agg(F.count("*").alias("rows"))
    return orphans(keys, columns, parent, parent_columns)


def childless(parent: DataFrame, columns: Sequence[str], child: DataFrame,
              child_columns: Sequence[str]) -> DataFrame:
    """Parent rows that no child row points at.

    Child keys are made distinct first: the side of an anti join that is looked up cannot be
    split, so a parent with a third of all children must not reach it row by row.
    """
    keys = child.select(*[F.col(p).alias(f"_c{i}") for i, p in enumerate(child_columns)]).distinct()
    match = F.lit(True)
    for i, c in enumerate(columns):
        match = match & (F.col(c) == F.col(f"_c{i}"))
    return parent.join(keys, match, "left_anti")


def cascade(child: DataFrame, columns: Sequence[str], deleted: DataFrame,
            deleted_columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split child rows into (kept, deleted along with their parent)."""
    keys = deleted.select(*[F.col(p).alias(f"_d{i}") for i, p in enumerate(deleted_columns)])
    match = F.lit(True)
    for i, c in enumerate(columns):
        match = match & (F.col(c) == F.col(f"_d{i}"))
    return child.join(keys, match, "left_anti"), child.join(keys, match, "left_semi")
