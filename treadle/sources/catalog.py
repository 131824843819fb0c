"""Source metadata, read from information_schema tables or from frames.

The source describes itself, so no table layout is written down here: point
:func:`read_catalog` at the information_schema views (over JDBC or an export of them).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

#: Schemas of the source database.
SCHEMAS = ("sales", "person", "production", "purchasing", "humanresources")

# Source type name -> Spark type.
SPARK_TYPES = {
    "smallint": "smallint",
    "integer": "int",
    "bigint": "bigint",
    "numeric": "decimal(19,4)",
    "money": "decimal(19,4)",
    "double precision": "double",
    "character": "string",
    "character varying": "string",
    "text": "string",
    "xml": "string",
    "uuid": "string",
    "time without time zone": "string",
    "boolean": "boolean",
    "date": "date",
    "timestamp without time zone": "timestamp_ntz",
    "bytea": "binary",
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    source_type: str
    nullable: bool = True
    length: int | None = None
    precision: int | None = None
    scale: int | None = None

    @property
    def spark_type(self) -> str:
        if self.source_type == "numeric" and self.precision:
            return f"decimal({self.precision},{self.scale or 0})"
        return SPARK_TYPES[self.source_type]


@dataclass(frozen=True)
class TableSpec:
    schema: str
    name: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...] = ()

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.name}"

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if not c.nullable)

    @property
    def lengths(self) -> dict[str, int]:
        return {c.name: c.length for c in self.columns if c.length}


def base_tables(tables: DataFrame, schemas: Sequence[str] = SCHEMAS) -> DataFrame:
    """Base tables of the given schemas, in order."""
    return (
        tables.filter(F.col("table_schema").isin(*schemas) & (F.col("table_type") == "BASE TABLE"))
        .select("table_schema", "table_name").orderBy("table_schema", "table_name")
    )


def table_columns(columns: DataFrame) -> DataFrame:
    """One row per table with its column names in ordinal order."""
    # a table has a bounded number of columns
    ordered = F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name")))
    return columns.groupBy("table_schema", "table_name").agg(
        F.transform(ordered, lambda c: c["column_name"]).alias("columns"))


def required_columns(columns: DataFrame) -> DataFrame:
    return columns.filter("is_nullable = 'NO'").select("table_schema", "table_name", "column_name")


def key_columns(constraints: DataFrame, usage: DataFrame) -> DataFrame:
    """Primary-key columns: constraints joined to their columns, per schema and table.

    Constraint names repeat between tables, so the table is part of the join.
    """
    by = ["table_schema", "table_name", "constraint_name"]
    return (
        constraints.filter("constraint_type = 'PRIMARY KEY'").select(*by)
        .join(usage.select(*by, "column_name", "ordinal_position"), by)
        .select("table_schema", "table_name", "column_name", "ordinal_position")
    )


def read_catalog(tables: DataFrame, columns: DataFrame, constraints: DataFrame, usage: DataFrame,
                 schemas: Sequence[str] = SCHEMAS) -> dict[str, TableSpec]:
    """Table specs by ``schema.table``.  Only metadata (one row per column) reaches the driver."""
    wanted = base_tables(tables, schemas)
    by = ["table_schema", "table_name"]
    keys: dict[tuple[str, str], list[str]] = {}
    for r in key_columns(constraints, usage).join(wanted, by, "left_semi").orderBy(*by, "ordinal_position").collect():
        keys.setdefault((r.table_schema, r.table_name), []).append(r.column_name)
    found: dict[tuple[str, str], list[ColumnSpec]] = {}
    for r in columns.join(wanted, by, "left_semi").orderBy(*by, "ordinal_position").collect():
        found.setdefault((r.table_schema, r.table_name), []).append(ColumnSpec(
            r.column_name, r.data_type, r.is_nullable == "YES", r.character_maximum_length,
            r.numeric_precision if r.data_type == "numeric" else None,
            r.numeric_scale if r.data_type == "numeric" else None))
    return {f"{s}.{t}": TableSpec(s, t, tuple(cols), tuple(keys.get((s, t), ())))
            for (s, t), cols in found.items()}


def describe(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None) -> dict[str, TableSpec]:
    """Table specs of frames at hand, from their Spark schemas."""
    names = {"int": "integer", "string": "character varying", "timestamp": "timestamp without time zone",
             "timestamp_ntz": "timestamp without time zone", "double": "double precision",
             "binary": "bytea"}
    specs = {}
    for full, df in tables.items():
        schema, _, name = full.rpartition(".")
        columns = []
        for f in df.schema.fields:
            kind = f.dataType.simpleString()
            decimal = isinstance(f.dataType, T.DecimalType)
            columns.append(ColumnSpec(
                f.name, "numeric" if decimal else names.get(kind, kind), f.nullable, None,
                f.dataType.precision if decimal else None, f.dataType.scale if decimal else None))
        specs[full] = TableSpec(schema, name, tuple(columns), tuple((keys or {}).get(full, ())))
    return specs
