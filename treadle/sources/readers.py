"""Readers: one callable that opens a source table by ``schema.table``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from treadle.sources.catalog import SCHEMAS, TableSpec, read_catalog
from treadle.sources.delimited import LATIN1, load_delimited

Reader = Callable[[str], DataFrame]


def parquet_reader(spark: SparkSession, folder: str) -> Reader:
    """``folder/<schema>.<table>.parquet``"""
    return lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_reader(spark: SparkSession) -> Reader:
    """Tables of the session catalog, one database per source schema."""
    return lambda name: spark.read.table(name)


def delimited_reader(spark: SparkSession, files: Mapping[str, str],
                     catalog: Mapping[str, TableSpec]) -> Reader:
    """Delimited files, given as table name -> path."""
    def read(name: str) -> DataFrame:
        encoding = "ISO-8859-1" if name in LATIN1 else "UTF-8"
        return load_delimited(spark, files[name], catalog[name], encoding=encoding)
    return read


def source_catalog(read: Reader, schemas: Sequence[str] = SCHEMAS) -> dict[str, TableSpec]:
    """Table specs from the information_schema views that ``read`` can open.

    With a JDBC reader they come from the live source; with a file reader, from an export.
    """
    views = ("tables", "columns", "table_constraints", "key_column_usage")
    return read_catalog(*[read(f"information_schema.{v}") for v in views], schemas)


def jdbc_options(url: str, table: str, properties: Mapping[str, str] | None = None, *,
                 column: str | None = None, low: int | str | None = None,
                 high: int | str | None = None, parts: int | None = None,
                 fetch: int = 10_000) -> dict[str, str]:
    """Options of a JDBC scan.

    With ``column`` the scan is read in ``parts`` ranges of it; without, it is one task, so
    give a column for every table of size.  Filters and columns are pushed by Catalyst.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch), **(properties or {})}
    if column is not None:
        if low is None or high is None or not parts:
            raise ValueError("a partitioned read needs column, low, high and parts")
        options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
                    "numPartitions": str(parts)}
    return options


def jdbc_reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None = None,
                ranges: Mapping[str, Mapping] | None = None) -> Reader:
    """Tables of a live source.  ``ranges`` gives the split of each large table."""
    def read(name: str) -> DataFrame:
        options = jdbc_options(url, name, properties, **(ranges or {}).get(name, {}))
        return spark.read.format("jdbc").options(**options).load()
    return read
