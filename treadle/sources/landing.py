"""Landed copies of source tables, kept up by increments.

A landed table is filed by month: that of a date column, or for a child table that of its parent's row,
so the lines of an order lie beside it.  A batch reads of a table only the rows at or above its high-water
mark, once; checks and loads read the landed copy.  The months an increment touches are those of its rows
and those that held an earlier state of them, so a month that loses its last row is touched too.  Only
touched months are rewritten.

A table without a key or without a mark is read whole and compared by month: rows, and two sums of hashes.

A batch has two commits to the log: what was staged and which months it touches, and that it was applied.
A run that stops between them applies the staged rows again; one that stops before the first reads the
source again; a batch that is done reads nothing.  Rows that arrive later than rows with a higher mark are
not seen, nor are rows deleted from a table with a mark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from treadle.operators import sinks
from treadle.sources.catalog import TableSpec
from treadle.sources.extract import DENIED, classify, first_date_column

Reader = Callable[[str], DataFrame]

#: The month column of landed tables, its value for tables without a date and for rows without one.
MONTH, WHOLE, UNDATED = "filed_month", "all", "none"
#: True for rows of an increment that came from the source, not from a parent's move.
FRESH = "is_fresh"

# The column that names a row's last change, and child tables with their parents' key.
MARK = "modifieddate"
PARENTS = {
    "sales.salesorderdetail": ("sales.salesorderheader", "salesorderid"),
    "purchasing.purchaseorderdetail": ("purchasing.purchaseorderheader", "purchaseorderid"),
    "production.workorderrouting": ("production.workorder", "workorderid"),
}

#: Tables whose jobs are submitted side by side; most tables are small and would leave a cluster idle.
SIDE_BY_SIDE = 8

LOG = ("name string, seq long, batch string, mark string, months array<string>, staged string, applied boolean, "
       "twice boolean, columns string")


@dataclass(frozen=True)
class Filing:
    """How a table is landed: its key, its mark, and the date or the parent (table and key) it is filed by."""

    key: tuple[str, ...] = ()
    mark: str | None = None
    date: str | None = None
    parent: tuple[str, str] | None = None

    @property
    def by_increment(self) -> bool:
        return bool(self.key and self.mark)


def filing(spec: TableSpec, names: Iterable[str] = ()) -> Filing:
    """The filing that follows from a table's columns; ``names`` are the tables landed with it."""
    low = {c.lower(): c for c in spec.column_names}
    parent = PARENTS.get(spec.full_name)
    if parent and (parent[0] not in names or parent[1] not in low):
        parent = None
    dated = classify(spec.name, spec.column_names) == "fact" and not parent
    return Filing(tuple(spec.key), low.get(MARK), first_date_column(spec.column_names) if dated else None, parent)


def filings(specs: Mapping[str, TableSpec], denied: Iterable[str] = DENIED) -> dict[str, Filing]:
    names = [n for n in specs if n not in set(denied)]
    return {n: filing(specs[n], names) for n in names}


@dataclass(frozen=True)
class Entry:
    """What one batch brought to one table."""

    name: str
    seq: int
    batch: str
    mark: str | None
    months: list[str]
    staged: str
    applied: bool
    twice: bool
    columns: str = field(repr=False, default="")


def _all(tests: Iterable[Column]) -> Column:
    return reduce(Column.__and__, tests, F.lit(True))


def _renamed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(columns)])


def _meets(df: DataFrame, other: DataFrame, columns: Iterable[str], how: str, equal: bool = False) -> DataFrame:
    """Semi or anti join on columns that have the same names on both sides (NULLs are equal if ``equal``)."""
    columns = list(columns)
    test = _all((F.col(f"`{c}`").eqNullSafe(F.col(f"_{k}")) if equal else F.col(f"`{c}`") == F.col(f"_{k}"))
                for k, c in enumerate(columns))
    return df.join(_renamed(other, columns), test, how)


def _side_by_side(work: Callable, items: Iterable) -> list:
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return list(pool.map(work, items))


class Landing:
    """Landed tables below ``root``; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str, plans: Mapping[str, Filing]):
        self.spark, self.root, self.plans = spark, root.rstrip("/"), dict(plans)
        self.log = sinks.VersionedTable(spark, f"{self.root}/_log")
        # one row per table and batch that brought something
        rows = self.log.read().orderBy("name", "seq").collect() if self.log.exists() else []
        self.entries: dict[str, list[Entry]] = {}
        for r in rows:
            self.entries.setdefault(r.name, []).append(Entry(**r.asDict()))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def last(self, name: str) -> Entry | None:
        return self.entries.get(name, [None])[-1]

    def first(self, name: str) -> bool:
        return len(self.entries.get(name, [])) < 2

    def filed(self, name: str, months: Iterable[str] | None = None) -> DataFrame:
        """The landed rows with the month they are filed by; a list of months prunes the folders."""
        columns = T.StructType.fromDDL(self.last(name).columns).add(MONTH, "string")
        if not sinks.folder_exists(self.spark, self.path(name)):
            return self.spark.createDataFrame([], columns)
        df = self.spark.read.schema(columns).parquet(self.path(name))
        return df if months is None else df.filter(F.col(MONTH).isin(WHOLE, *months))

    def read(self, name: str, months: Iterable[str] | None = None) -> DataFrame:
        return self.filed(name, months).drop(MONTH)

    def increment(self, name: str) -> DataFrame:
        """The source's rows of the newest batch."""
        entry = self.last(name)
        columns = T.StructType.fromDDL(entry.columns).add(MONTH, "string").add(FRESH, "boolean")
        return self.spark.read.schema(columns).parquet(f"{entry.staged}/rows").filter(FRESH).drop(MONTH, FRESH)

    def touched(self, name: str, since: int) -> list[str] | None:
        """Months touched by batches after ``since``; None for all of them, as the table was not there."""
        if since == 0:
            return None
        return sorted({m for e in self.entries.get(name, []) if e.seq > since for m in e.months})

    # a batch

    def land(self, read: Reader, batch: str) -> None:
        """Bring the tables up to date; a batch that is done reads no source."""
        self._apply()
        todo = [n for n in self.plans if self.last(n) is None or self.last(n).batch != batch]
        staged: dict[str, Entry] = {}
        for child in (False, True):  # parents come first
            names = [n for n in todo if (self.plans[n].parent is not None) == child]
            staged |= zip(names, _side_by_side(lambda n: self._stage(n, read, batch, staged), names))
        if staged:
            for name, entry in staged.items():
                self.entries.setdefault(name, []).append(entry)
            self._commit()
            self._apply()

    def _commit(self) -> None:
        rows = [tuple(getattr(e, f) for f in T.StructType.fromDDL(LOG).fieldNames()) for es in self.entries.values() for e in es]
        self.log.write(self.spark.createDataFrame(rows, LOG).coalesce(1))
        self.log.prune()

    def _stage(self, name: str, read: Reader, batch: str, staged: Mapping[str, Entry]) -> Entry:
        plan, last = self.plans[name], self.last(name)
        seq = last.seq + 1 if last else 1
        folder = f"{self.root}/_staged/{name}/{seq:08d}"
        rows = read(name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        own = [f.name for f in rows.schema.fields]
        grown = plan.by_increment and last is not None
        if grown and last.mark is not None:
            rows = rows.filter((F.col(plan.mark) >= F.lit(last.mark).cast(rows.schema[plan.mark].dataType)) | F.col(plan.mark).isNull())
        sinks.drop_folder(self.spark, folder)  # of a run that stopped before its commit
        if last is not None and (grown or plan.parent):  # rows that are looked at more than once
            rows.write.parquet(f"{folder}/read")
            rows = self.spark.read.schema(T.StructType.fromDDL(columns)).parquet(f"{folder}/read")
        if grown:  # rows at the mark come again; those that have not changed touch nothing
            rows = _meets(rows, self.filed(name), own, "left_anti", equal=True)
        rows = rows.withColumn(FRESH, F.lit(True))
        if grown and plan.parent:
            rows = rows.unionByName(self._moved_children(name, rows, staged).withColumn(FRESH, F.lit(False)))
        self._filed_by(rows, name, staged).write.parquet(f"{folder}/rows")
        whole = self.spark.read.schema(T.StructType.fromDDL(columns).add(FRESH, "boolean").add(MONTH, "string")).parquet(f"{folder}/rows")
        mark, found = whole.agg((F.max(plan.mark) if plan.mark else F.lit(None)).cast("string"), F.collect_set(MONTH)).first()
        months = sorted(found) if last is None else self._months(name, whole, own, grown)
        if last is not None:
            self._write_moves(name, whole, folder)
        twice = bool(plan.key) and self._twice(name, whole, grown and last.twice)
        return Entry(name, seq, batch, mark or (last.mark if last else None), months, folder, False, twice, columns)

    def _filed_by(self, rows: DataFrame, name: str, staged: Mapping[str, Entry]) -> DataFrame:
        plan = self.plans[name]
        if plan.parent:
            table, key = plan.parent
            parents = self._rows_after(table, staged).select(F.col(key).alias("_key"), F.col(MONTH).alias("_month"))
            if self.last(name) is not None:  # only the parents of these rows are looked at; a first batch has all
                wanted = rows.select(F.col(key).alias("_wanted")).distinct()
                parents = parents.join(wanted, F.col("_key") == F.col("_wanted"), "left_semi")
            parents = parents.groupBy("_key").agg(F.max("_month").alias("_month"))  # each once
            return rows.join(parents, F.col(key) == F.col("_key"), "left").withColumn(
                MONTH, F.coalesce("_month", F.lit(UNDATED))).drop("_key", "_month")
        if plan.date:
            return rows.withColumn(MONTH, F.coalesce(F.date_format(F.col(plan.date), "yyyy-MM"), F.lit(UNDATED)))
        return rows.withColumn(MONTH, F.lit(WHOLE))

    def _rows_after(self, name: str, staged: Mapping[str, Entry]) -> DataFrame:
        """A table as it will be once what is staged has been applied."""
        entry = staged.get(name)
        if entry is None:
            return self.filed(name)
        columns = T.StructType.fromDDL(entry.columns).add(MONTH, "string")
        new = self.spark.read.schema(columns).parquet(f"{entry.staged}/rows")
        if self.last(name) is None or not self.plans[name].by_increment:
            return new
        return _meets(self.filed(name), new, self.plans[name].key, "left_anti").unionByName(new)

    def _write_moves(self, name: str, rows: DataFrame, folder: str) -> None:
        """Keys whose children have to be filed anew."""
        keys = {key for table, key in (p.parent for p in self.plans.values() if p.parent) if table == name}
        for key in keys:
            old = self.filed(name).select(F.col(key).alias("_key"), F.col(MONTH).alias("_month"))
            moved = rows.select(F.col(key).alias(key), MONTH).join(
                old, (F.col(key) == F.col("_key")) & (F.col(MONTH) != F.col("_month")), "left_semi")
            # a parent that comes later than its children takes them out of the undated ones
            born = rows.select(key, MONTH).join(old, F.col(key) == F.col("_key"), "left_anti")
            moved.unionByName(born).select(key).distinct().write.parquet(f"{folder}/moved/{key}")

    def _moved_children(self, name: str, rows: DataFrame, staged: Mapping[str, Entry]) -> DataFrame:
        table, key = self.plans[name].parent
        entry = staged.get(table)
        mine = self.filed(name).drop(MONTH)
        if entry is None or self.last(table) is None:
            return mine.limit(0)
        moved = self.spark.read.parquet(f"{entry.staged}/moved/{key}")
        return _meets(_meets(mine, moved, [key], "left_semi"), rows, self.plans[name].key, "left_anti")

    def _months(self, name: str, rows: DataFrame, own: list[str], grown: bool) -> list[str]:
        """Months that the staged rows change; their number is bounded by the calendar."""
        if grown:
            held = _meets(self.filed(name), rows, self.plans[name].key, "left_semi").select(MONTH)
            found = rows.select(MONTH).unionByName(held).distinct()
        else:
            def sums(df: DataFrame) -> DataFrame:
                hashed = [F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in own], F.lit(k)).cast("decimal(20,0)")) for k in (1, 2)]
                return df.groupBy(MONTH).agg(F.count("*").alias("n"), hashed[0].alias("a"), hashed[1].alias("b"))
            old, new = sums(self.filed(name)), sums(rows)
            found = old.unionByName(new).groupBy(MONTH, "n", "a", "b").agg(F.count("*").alias("sides")).filter(
                "sides = 1").select(MONTH).distinct()
        return sorted(r[0] for r in found.collect())

    def _twice(self, name: str, rows: DataFrame, before: bool) -> bool:
        """Whether two rows have one key: in what was staged, or still in the table that had such rows."""
        key = list(self.plans[name].key)
        frames = [rows]
        if before:
            frames.append(_meets(self.filed(name), rows, key, "left_anti"))
        return any(not f.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").isEmpty() for f in frames)

    def _apply(self) -> None:
        waiting = [es[-1] for es in self.entries.values() if not es[-1].applied]
        _side_by_side(self._apply_one, waiting)
        for entry in waiting:
            self.entries[entry.name][-1] = replace(entry, applied=True)
        if waiting:
            self._commit()
            for entry in waiting:
                sinks.drop_folder(self.spark, f"{entry.staged}/read")
                for old in self.entries[entry.name][:-1]:
                    sinks.drop_folder(self.spark, old.staged)

    def _apply_one(self, entry: Entry) -> None:
        """Rewrite the touched months; doing it again gives the same."""
        if not entry.months:
            return
        name, plan = entry.name, self.plans[entry.name]
        columns = T.StructType.fromDDL(entry.columns).add(MONTH, "string")
        rows = self.spark.read.schema(columns).parquet(f"{entry.staged}/rows").filter(F.col(MONTH).isin(*entry.months))
        if plan.by_increment and len(self.entries[name]) > 1:
            every = self.spark.read.schema(columns).parquet(f"{entry.staged}/rows")
            kept = _meets(self.filed(name).filter(F.col(MONTH).isin(*entry.months)), every, plan.key, "left_anti")
            rows = kept.unionByName(rows)
            # the months are read and replaced, so the new rows are written elsewhere first
            sinks.drop_folder(self.spark, f"{entry.staged}/next")
            rows.write.parquet(f"{entry.staged}/next")
            rows = self.spark.read.schema(columns).parquet(f"{entry.staged}/next")
        sinks.write_filed(rows, self.path(name), MONTH, plan.key, replaced=entry.months)
        sinks.drop_folder(self.spark, f"{entry.staged}/next")
