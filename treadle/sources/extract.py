"""Classify source tables and extract them by date window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from treadle.sources.catalog import TableSpec

# Words that make a table a fact, and words that name a measure.
FACT_WORDS = ("order", "detail", "history", "transaction", "workorder",
              "inventory", "purchase", "salesorder")
MEASURE_WORDS = ("amount", "qty", "price", "total")

#: Default bounds; both are parameters of every extract.
DIMENSION_SINCE = dt.datetime(2000, 1, 1)
FACT_WINDOW = (dt.datetime(2012, 1, 1), dt.datetime(2014, 12, 31))

#: Tables whose rows should not leave the source.
DENIED = frozenset({"person.password"})

FULL_SCHEMA = "person"


def _has(text: Column, words: Iterable[str]) -> Column:
    test = F.lit(False)
    for w in words:
        test = test | text.contains(w)
    return test


def table_type(name: Column, columns: Column) -> Column:
    """fact or dimension, from a table's name and its array of column names."""
    low = F.transform(columns, F.lower)
    dated = F.exists(low, lambda c: c.contains("date"))
    measured = F.exists(low, lambda c: _has(c, MEASURE_WORDS))
    is_fact = _has(F.lower(name), FACT_WORDS) | (dated & measured)
    return F.when(is_fact, "fact").otherwise("dimension")


def classify(name: str, columns: Iterable[str]) -> str:
    """The same rule for one table spec on the driver."""
    low = [c.lower() for c in columns]
    named = any(w in name.lower() for w in FACT_WORDS)
    dated = any("date" in c for c in low)
    measured = any(w in c for c in low for w in MEASURE_WORDS)
    return "fact" if named or (dated and measured) else "dimension"


def first_date_column(columns: Iterable[str]) -> str | None:
    return next((c for c in columns if "date" in c.lower()), None)


@dataclass(frozen=True)
class TableExtract:
    df: DataFrame
    columns: tuple[str, ...]
    type: str


def changed_since(df: DataFrame, since: dt.datetime = DIMENSION_SINCE,
                  column: str = "modifieddate") -> DataFrame:
    return df.filter(F.col(column) > F.lit(since.isoformat(sep=" ")).cast(df.schema[column].dataType))


def within(df: DataFrame, column: str, low: dt.datetime, high: dt.datetime) -> DataFrame:
    """Both bounds belong to the window; a bare date as upper bound means its midnight."""
    kind = df.schema[column].dataType
    return df.filter(F.col(column).between(F.lit(low.isoformat(sep=" ")).cast(kind),
                                           F.lit(high.isoformat(sep=" ")).cast(kind)))


def extract_table(spec: TableSpec, df: DataFrame, since: dt.datetime = DIMENSION_SINCE,
                  window: tuple[dt.datetime, dt.datetime] = FACT_WINDOW) -> DataFrame | None:
    """The rows to load, or None when the table has no column to select by."""
    if spec.schema == FULL_SCHEMA:
        return df
    if classify(spec.name, spec.column_names) == "dimension":
        column = next((c for c in spec.column_names if c.lower() == "modifieddate"), None)
        return None if column is None else changed_since(df, since, column)
    column = first_date_column(spec.column_names)
    return None if column is None else within(df, column, *window)


def extract_all(catalog: Mapping[str, TableSpec], read: Callable[[str], DataFrame],
                since: dt.datetime = DIMENSION_SINCE,
                window: tuple[dt.datetime, dt.datetime] = FACT_WINDOW,
                denied: Iterable[str] = DENIED) -> dict[str, TableExtract]:
    """Lazy extracts by ``schema.table``; ``read`` opens one source table."""
    out = {}
    for name, spec in catalog.items():
        if name in denied:
            continue
        df = extract_table(spec, read(name), since, window)
        if df is not None:
            out[name] = TableExtract(df, spec.column_names, classify(spec.name, spec.column_names))
    return out
