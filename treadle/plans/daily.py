"""The daily run: land, check, set bad rows aside, stage, load dimensions, facts, marts.

Source tables are read once, by increments, into landed copies; everything else reads those.  Facts and
marts are rebuilt for the months that the landed rows touched since they were last loaded.

Each step reads tables and writes tables, so a step that loses its executors is recomputed
from stored input and a whole run may be started again: dimensions get a new version folder,
facts and marts replace the months they touch, error records replace their batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterator, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from treadle.operators import checks, history, sinks
from treadle.operators.keys import numbered, with_keys
from treadle.operators.lookup import or_unknown
from treadle.plans import dims, facts, marts, staging
from treadle.plans.constraints import declared_rules
from treadle.session import run_folder
from treadle.sources.catalog import TableSpec
from treadle.sources.extract import DIMENSION_SINCE, FACT_WINDOW, classify, extract_all
from treadle.sources.landing import UNDATED, WHOLE, Landing, filings

Reader = Callable[[str], DataFrame]

#: Versions of a dimension after which its history is written anew as one.
COMPACT_AFTER = 30

#: Role frame of returned lines; the source has none, so a run without one has none to load.
RETURNED = ("return_id bigint, return_date date, product_id int, customer_id int, store_id int, reason string, "
            "quantity int, refund decimal(18,2)")

# When each mart is refreshed.
CADENCE = {
    "agg_daily_sales": "daily", "agg_weekly_sales": "sunday", "agg_monthly_sales": "first",
    "agg_daily_inventory": "daily", "agg_monthly_product_performance": "first", "agg_regional_sales": "first",
}


_SALES = ("sales.salesorderheader", "sales.salesorderdetail")
#: Landed tables whose months are the months of a fact, and the date column those have to be filed by.
FACT_SOURCES = {
    "FactSales": _SALES, "FactPromotionResponse": _SALES, "FactEmployeeSales": _SALES, "FactFinance": _SALES[:1],
    "FactPurchases": ("purchasing.purchaseorderheader", "purchasing.purchaseorderdetail"),
    "FactProduction": ("production.workorder", "production.workorderrouting"),
}
FILED_BY = {"sales.salesorderheader": "orderdate", "purchasing.purchaseorderheader": "orderdate",
            "production.workorder": "startdate"}
#: Dimensions whose surrogate keys a fact has.
FACT_DIMENSIONS = {
    "FactSales": ("DimCustomer", "DimProduct", "DimStore", "DimEmployee"), "FactPurchases": ("DimProduct", "DimVendor"),
    "FactInventory": ("DimProduct", "DimWarehouse"), "FactProduction": ("DimProduct",), "FactEmployeeSales": ("DimEmployee",),
    "FactPromotionResponse": ("DimProduct", "DimStore"), "FactFinance": ("DimCustomer", "DimStore"),
    "FactReturns": ("DimProduct", "DimCustomer", "DimStore"),
}
PRICES = ("production.productlistpricehistory", "production.productcosthistory")
#: Tables of which a changed row reaches all later months of a fact.
REACHES_ON = {"FactEmployeeSales": "sales.salespersonquotahistory"}
#: The months of a mart are those of its facts' tables; a change in one of the others reaches all months.
MART_SOURCES = {
    "agg_daily_sales": (_SALES, ()), "agg_weekly_sales": (_SALES, ()), "agg_monthly_sales": (_SALES, ()),
    "agg_monthly_product_performance": (_SALES, ("production.productreview",)), "agg_regional_sales": (_SALES, ()),
}
#: Marts whose refresh reads the touched months only, and takes earlier ones from its own rows.
OWN_PAST = ("agg_regional_sales",)
PROGRESS = "target string, name string, seq long"


def due_marts(day: dt.date) -> list[str]:
    """The marts to refresh on a day."""
    due = {"daily": True, "sunday": day.isoweekday() == 7, "first": day.day == 1}
    return [m for m, when in CADENCE.items() if due[when]]


def shift_month(month: str, by: int) -> str:
    year, number = divmod(int(month[:4]) * 12 + int(month[5:]) - 1 + by, 12)
    return f"{year:04d}-{number + 1:02d}"


class MissingTable(KeyError):
    """A table that a step needs is not there; any other KeyError is a fault of the code."""


class Whole(Mapping):
    """Tables read on demand."""

    def __init__(self, names, read: Reader):
        self._names, self._read = tuple(names), read

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise MissingTable(name)
        return self._read(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class CleanTables(Mapping):
    """Source tables without their rejected rows; a blocked or unknown table is missing.

    Rows whose only fault is a missing parent stay: they are on record as errors, and their
    keys resolve to the unknown member.
    """

    def __init__(self, frames: Mapping[str, DataFrame], rules: Mapping[str, checks.TableRules],
                 blocked: frozenset[str]):
        self._frames, self._rules, self._blocked = frames, rules, blocked

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._blocked:
            raise MissingTable(f"{name} is blocked")
        if name not in self._frames:
            raise MissingTable(name)
        df, rules = self._frames[name], self._rules.get(name)
        return checks.split(df, rules.rules)[0] if rules and rules.rules else df

    def limited(self, frames: Mapping[str, DataFrame]) -> CleanTables:
        """The same tables with some of them read otherwise."""
        return CleanTables({**self._frames, **{n: df for n, df in frames.items() if n in self._frames}}, self._rules, self._blocked)

    def __iter__(self) -> Iterator[str]:
        return iter(n for n in self._frames if n not in self._blocked)

    def __len__(self) -> int:
        return sum(1 for _ in self)


@dataclass
class DayReport:
    """What a run did, by step; ``skipped`` says why a step did not run, ``unchecked`` why a rule was
    not checked, and ``not_extracted`` names the tables the window or the policy leaves out."""

    done: list[str] = field(default_factory=list)
    skipped: dict[str, str] = field(default_factory=dict)
    unchecked: dict[str, str] = field(default_factory=dict)
    not_extracted: list[str] = field(default_factory=list)


def table_rules(specs: Mapping[str, TableSpec], frames: Mapping[str, DataFrame], as_of: dt.date,
                left_out: dict[str, str] | None = None) -> dict[str, checks.TableRules]:
    """Rules from the catalog's declarations together with the written ones.

    ``left_out`` gets the written rules and foreign keys that the tables at hand can't be checked for.
    """
    left_out = {} if left_out is None else left_out
    written = declared_rules(as_of)
    out = {}
    for name, df in frames.items():
        spec = specs[name]
        rules = checks.column_rules(df.schema, as_of, required=spec.required, lengths=spec.lengths,
                                    declared={c.name: c.spark_type for c in spec.columns})
        extra = written.get(name, checks.TableRules())
        have = {c.lower() for c in df.columns}
        usable = [r for r in extra.rules if _resolves(df, r.broken)]
        links = tuple(k for k in extra.foreign_keys if set(k.columns) <= have and k.parent in specs)
        left_out |= {f"{name}: {r.name}": f"does not resolve: {r.broken}" for r in extra.rules if r not in usable}
        left_out |= {f"{name}: {k.rule}": f"needs {', '.join(k.columns)} and {k.parent}"
                     for k in extra.foreign_keys if k not in links}
        out[name] = checks.TableRules(tuple(rules) + tuple(usable), spec.key or extra.key, links)
    return out


def _resolves(df: DataFrame, predicate: str) -> bool:
    """Whether a predicate's columns exist in the frame (analysis only, no job)."""
    try:
        df.filter(predicate).schema
    except AnalysisException:
        return False
    return True


class DailyRun:
    def __init__(self, spark: SparkSession, specs: Mapping[str, TableSpec], read: Reader, root: str,
                 as_of: dt.date, *, batch: str, window: tuple[dt.datetime, dt.datetime] = FACT_WINDOW,
                 since: dt.datetime = DIMENSION_SINCE, allow_failed: bool = False,
                 returns: DataFrame | None = None, months: list[str] | None = None, land: bool = True):
        """``returns`` is a role frame of returned lines, which the source itself lacks;
        ``months`` (``yyyy-MM``) limits the mart refresh to what those months touch; without ``land``
        the source is read anew by each step and everything in the window is rebuilt."""
        self.spark, self.specs, self.read, self.root = spark, specs, read, root.rstrip("/")
        self.as_of, self.batch, self.window, self.since = as_of, batch, window, since
        self.allow_failed, self.returns, self.months = allow_failed, returns, months
        self.at = dt.datetime.combine(as_of, dt.time())
        self.report = DayReport()
        self.land, self.landed, self.targets = land, None, None
        self.progress: dict[str, dict[str, int]] = {}
        self.scratch: list[str] = []  # folders of the step at hand

    def table(self, name: str) -> sinks.VersionedTable:
        versioned = name in dims.DIMENSIONS and dims.DIMENSIONS[name].policy == dims.SCD2
        if not versioned:
            return sinks.VersionedTable(self.spark, self.path(name))
        return sinks.HistoryTable(self.spark, self.path(name), key=[dims.DIMENSIONS[name].natural])

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # steps

    def bring_in(self) -> None:
        """Land the source; from here on tables are the landed ones."""
        self.landed = Landing(self.spark, self.path("_landing"), filings(self.specs))
        self.landed.land(self.read, self.batch)
        known = sinks.VersionedTable(self.spark, self.path("_progress"))
        for r in known.read().collect() if known.exists() else []:  # a row per target and source table
            self.progress.setdefault(r.target, {})[r.name] = r.seq

    def source(self, name: str) -> DataFrame:
        return self.landed.read(name) if self.landed and name in self.landed.plans else self.read(name)

    def arrived(self, name: str) -> DataFrame:
        """What is to be checked of a table: its new rows, or all of it while it holds a key twice."""
        if self.landed is None:
            return self.read(name)
        return self.landed.read(name) if self.landed.last(name).twice else self.landed.increment(name)

    def extract(self) -> dict[str, DataFrame]:
        found = extract_all(self.specs, self.arrived, self.since, self.window)
        return {n: e.df for n, e in found.items()}

    def stale(self, target: str, names: tuple[str, ...], whole: tuple[str, ...] = ()) -> list[str] | None:
        """Months to rebuild of a fact or mart, as its tables have changed since; None for all of them."""
        if self.landed is None or target not in self.progress or not sinks.folder_exists(self.spark, self.path(target)):
            return None
        done, months = self.progress[target], set()
        for name in (*names, *whole):
            if name not in self.landed.plans:
                continue
            found = self.landed.touched(name, done.get(name, 0))
            plan = self.landed.plans[name]
            filed = plan.parent is not None or (plan.date or "").lower() == FILED_BY.get(name)
            if found is None or found and (name in whole or not filed):
                return None
            months |= set(found)
        for low, high in (n.split("~")[1:] for n in done if n.startswith("~")):  # see reopen()
            held = sinks.stored_months(self.spark, self.landed.path(names[0]), "filed_month")
            months |= {m for m in held if low <= m <= high}
        later = REACHES_ON.get(target)
        if later in self.landed.plans:
            found = self.landed.touched(later, done.get(later, 0))
            if found is None or UNDATED in found or WHOLE in found:
                return None
            if found:
                months |= {m for m in sinks.stored_months(self.spark, self.landed.path(names[0]), "filed_month") if m >= found[0]}
        return sorted(months - {UNDATED})

    def advance(self, target: str, names: tuple[str, ...]) -> None:
        """A target has taken in all that was landed of its tables."""
        if self.landed is not None:
            self.progress[target] = {n: self.landed.last(n).seq for n in names if n in self.landed.plans}

    def save_progress(self) -> None:
        if self.landed is not None:
            rows = [(t, n, s) for t, by in self.progress.items() for n, s in (by or {"": 0}).items()]
            table = sinks.VersionedTable(self.spark, self.path("_progress"))
            table.write(self.spark.createDataFrame(rows, PROGRESS).coalesce(1))
            table.prune()

    def validate(self, frames: Mapping[str, DataFrame],
                 rules: Mapping[str, checks.TableRules]) -> dict[str, checks.TableRules]:
        """Write findings and summary; returns, per table, the rules that were broken.

        What follows looks at those only, so a clean table is not scanned for errors again.
        """
        found = self.table("validation_findings")
        found.write(checks.findings(frames, rules, Whole(self.specs, self.source)))
        checks.summarize(found.read()).write.mode("overwrite").parquet(self.path("validation_summary"))
        # at most one row per rule
        hit = {(r.table_name, r.rule) for r in found.read().filter("violations > 0").select("table_name", "rule").collect()}
        return {
            name: checks.TableRules(
                tuple(x for x in r.rules if (name, x.name) in hit),
                r.key if (name, "primary_key") in hit else (),
                tuple(k for k in r.foreign_keys if (name, k.rule) in hit))
            for name, r in rules.items() if any(t == name for t, _ in hit)}

    def quarantine(self, frames: Mapping[str, DataFrame], rules: Mapping[str, checks.TableRules],
                   broken: Mapping[str, checks.TableRules]) -> None:
        """Error records of every broken rule, replacing those of this batch and table."""
        parents = Whole(self.specs, self.source)
        parts = []
        for name, r in broken.items():
            key = list(rules[name].key) or frames[name].columns[:1]
            if r.rules or r.key or r.foreign_keys:
                parts.append(checks.table_error_records(frames[name], name, r, key, self.batch, "validate", self.at, parents))
        if parts:
            sinks.replace_records(checks.union_all(parts), self.path("error_records"), self.batch, even=True)

    def error_state(self) -> DataFrame:
        """All error records in their newest state."""
        records = self.spark.read.parquet(self.path("error_records"))
        return checks.latest(records, sinks.BatchTable(self.spark, self.path("error_attempts")).read(checks.ATTEMPT))

    def retry(self, rules: Mapping[str, checks.TableRules]) -> None:
        """Try the open records of earlier batches again: their rules only, on their rows only."""
        log = sinks.BatchTable(self.spark, self.path("error_attempts"))
        if not sinks.folder_exists(self.spark, self.path("error_records")) or self.batch in log.batches():
            return
        folder = self.passing("open-errors")
        self.error_state().filter((~F.col("IsResolved")) & (F.col("ProcessingBatchID") != self.batch)).select(
            "ErrorID", "SourceTable", "RecordNaturalKey", "ErrorType", "ErrorMessage", "ErrorDetails").write.parquet(folder)
        open_ = self.spark.read.parquet(folder)
        names: dict[str, list[str]] = {}  # a row per table and rule
        for r in open_.select("SourceTable", checks.rule_name().alias("rule")).distinct().collect():
            names.setdefault(r.SourceTable, []).append(r.rule)
        parts = []
        for name, wanted in names.items():
            if name in rules and name in self.specs:
                own, df = open_.filter(F.col("SourceTable") == name), self.source(name)
                broken, there = checks.recheck(df, rules[name], wanted, list(rules[name].key) or df.columns[:1], own,
                                               Whole(self.specs, self.source))
                parts.append(checks.attempt(own, broken, there, self.at))
        if parts:
            log.append(checks.union_all(parts), self.batch)
        self.tidy()

    def record(self, source: str, records: DataFrame) -> None:
        sinks.replace_records(records, self.path("error_records"), self.batch, source)

    def step(self, name: str, work: Callable[[], None]) -> None:
        """Run a step; one whose tables are missing or blocked is reported, not fatal."""
        if self.targets is not None and name not in self.targets and name not in CADENCE:
            return
        try:
            work()
        except (MissingTable, staging.MissingTables) as missing:
            self.report.skipped[name] = f"needs {missing.args[0]}"
        else:
            self.report.done.append(name)

    def load_dimension(self, name: str, full: Mapping[str, DataFrame]) -> None:
        spec, table = dims.DIMENSIONS[name], self.table(name)
        if name in dims.STATIC_ROWS:
            if not table.exists():
                table.write(dims.static_dimension(self.spark, name))
            return
        staged, opening = dims.STAGES[name](full, self.as_of), self.window[0].date()
        if spec.policy == dims.SCD2:
            self.load_versions(spec, table, staged, full, opening)
        else:
            current = table.read() if table.exists() else None
            table.write(dims.load_dimension(spec, current, staged, self.as_of, opening))
            table.prune()

    def passing(self, label: str) -> str:
        """A new folder that goes when the step has written its table."""
        self.scratch.append(run_folder(self.spark, label))
        return self.scratch[-1]

    def tidy(self) -> None:
        while self.scratch:
            sinks.drop_folder(self.spark, self.scratch.pop())

    def kept(self, df: DataFrame, label: str) -> DataFrame:
        """Rows that several jobs of a step read, written once."""
        folder = self.passing(label)
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def load_versions(self, spec: dims.DimensionSpec, table: sinks.HistoryTable, staged: DataFrame,
                      full: Mapping[str, DataFrame], opening: dt.date) -> None:
        """A versioned dimension after the day: open rows merged, states of the past cut into its history."""
        key = [spec.natural]
        staged = dims.conform(staged, spec) if spec.name != "DimEmployee" else staged
        current = table.read_open() if table.exists() else None
        states, ahead, whole = None, None, set()
        if spec.name == "DimProduct" and all(n in full for n in PRICES):
            # a first load opens with the prices of its opening day; those since then are cut in
            staged, states = dims.priced(staged, dims.price_states(full), opening if current is None else self.as_of, self.as_of,
                                         lambda df: self.kept(df, "prices"))
        if current is not None:  # keys whose open version starts after this day: the day lies in their past
            keys = current.filter(F.col("ValidFromDate") > F.lit(self.as_of)).select(*key)
            if not keys.isEmpty():
                ahead = self.kept(dims.conform(staged, spec).join(keys, key, "left_semi").withColumn("_day", F.lit(self.as_of)), "ahead")
            if states is not None:
                current, whole = self.cut_in(spec, table, current, states, "day", whole)
        merged = dims.load_dimension(spec, current, staged, self.as_of, opening, history.key_later)
        if current is None and states is not None:
            merged, whole = self.cut_in(spec, table, merged, states, "day", whole)
        if ahead is not None:
            merged, whole = self.cut_in(spec, table, merged, ahead, "_day", whole)
        # keys are handed out once for the stored rows
        stored = self.kept(numbered(merged), spec.name)
        keyed = with_keys(self.spark, self.path(f"_keys/{spec.name}"), stored, [*key, "ValidFromDate"], spec.surrogate)
        if spec.name == "DimEmployee":
            keyed = dims.with_manager_keys(keyed, staged.select("EmployeeID", "ManagerID"))
        table.write_step(keyed, whole=sorted(whole) if table.exists() else ())
        self.tidy()
        if table.since_full() > COMPACT_AFTER:
            table.write_full(table.read())
            table.prune()

    def cut_in(self, spec: dims.DimensionSpec, table: sinks.HistoryTable, merged: DataFrame, late: DataFrame, day: str,
               whole: set[int]) -> tuple[DataFrame, set[int]]:
        """``merged`` with observations of the past, and the buckets of closed rows it now holds whole."""
        key, merged = [spec.natural], self.kept(merged, "merged")
        others = [b for b in range(table.buckets) if b not in whole]
        closed = table.read_closed(others) if table.exists() else None
        versions = merged if closed is None else merged.unionByName(closed)
        low, high = self.window[0].date(), max(self.window[1].date(), self.as_of)
        folder = self.passing("late")
        history.unlike(versions, late, key, spec.tracked, day, low, high).select(
            *key, F.col(day).cast("date").alias("_day"), table.bucket().alias("_bucket")).write.parquet(folder)
        unlike = self.spark.read.parquet(folder)
        buckets = {r[0] for r in unlike.select("_bucket").distinct().collect()}  # at most the table's number of them
        if not buckets:
            return merged, whole
        # all states of such keys: one that is as the history has it may be so no more beside the others
        new = late.join(unlike.select(*key).distinct(), key, "left_semi")
        closed = table.read_closed(sorted(buckets - whole)) if table.exists() else None
        rows = merged if closed is None else merged.unionByName(closed)
        keys = new.select(*key).distinct()
        spliced = history.splice(rows.join(keys, key, "left_semi"), new, key, spec.tracked, spec.surrogate,
                                 day, self.as_of, history.key_later)
        # from the first such day to the end of the last version that is cut
        ends = unlike.join(versions.select(*key, "ValidFromDate", F.coalesce("ValidToDate", F.lit(high)).alias("_end")), key).filter(
            "ValidFromDate <= _day and _day < _end").agg(F.max("_end")).first()[0]
        self.reopen(spec.name, unlike.agg(F.min("_day")).first()[0], ends or high)
        return rows.join(keys, key, "left_anti").unionByName(spliced), whole | buckets

    def reopen(self, dimension: str, low: dt.date, high: dt.date) -> None:
        """Facts and marts that were loaded with the old versions of these days are to be rebuilt.

        Put on record before the dimension is written, so a run that stops in between is made up for.
        """
        targets = [f for f, names in FACT_DIMENSIONS.items() if dimension in names] + list(MART_SOURCES)
        for target in targets:
            if target in self.progress:
                self.progress[target][f"~{low:%Y-%m}~{high:%Y-%m}"] = 1
        self.save_progress()

    def load_calendar(self) -> None:
        bounds = self.spark.range(1).select(F.lit(self.window[0].date()).alias("low"),
                                            F.lit(self.window[1].date()).alias("high"))
        self.table("DimDate").write(dims.dim_date(bounds), keys=["DateKey"])

    def stage_customers(self, full: Mapping[str, DataFrame]) -> None:
        """Staging table (full refresh), and its comparison with the customer dimension."""
        staging.customer_staging(full, self.as_of).write.mode("overwrite").parquet(self.path("StagingCustomer"))
        staged = self.spark.read.parquet(self.path("StagingCustomer"))
        dim = self.table("DimCustomer")
        if not dim.exists():
            changes = staged.withColumn("change_type", F.lit("new"))
        else:
            current = dim.read_open().withColumnRenamed("CustomerID", "customerid")
            changes = history.change_set(staged, current, ["customerid"],
                                         {c: staging.TO_DIMENSION[c] for c in staging.TRACKED})
        changes.write.mode("overwrite").parquet(self.path("CustomerChanges"))

    def links(self, *names: str) -> dict[str, facts.Link]:
        out = {}
        for name in names:
            spec = dims.DIMENSIONS[name]
            out[spec.surrogate] = facts.Link(self.table(name).read(), spec.natural, spec.surrogate,
                                             spec.policy == dims.SCD2)
        return out

    def keyed(self, name: str, fact: DataFrame, date: str) -> DataFrame:
        links = self.links(*[n for n in FACT_DIMENSIONS[name] if self.table(n).exists()])
        return facts.with_surrogates(fact, date, links, self.window[0].date(), self.as_of)

    def member(self, df: DataFrame, column: str, dimension: str, name: str) -> DataFrame:
        """Replace a member's name by its key in a reference dimension; an unknown name is member -1."""
        table = self.table(dimension)
        if not table.exists():
            raise MissingTable(dimension)
        members = table.read().groupBy(F.col(name).alias("_name")).agg(
            F.min(dims.DIMENSIONS[dimension].surrogate).alias("_member"))
        return df.join(members, F.col(column) == F.col("_name"), "left").select(*[
            or_unknown(F.col("_member")).alias(c) if c == column else F.col(c) for c in df.columns])

    def store(self, name: str, df: DataFrame, date: str, keys: list[str], write: Callable = sinks.write_months) -> None:
        """Write a fact or mart in its declared types.

        Values that do not fit are counted while writing; only if there are any is the plan
        run again for their warning records.
        """
        rules = facts.overflow_rules(df)
        if not rules:
            write(df, self.path(name), date, keys)
            return
        seen = Observation()
        watched = df.observe(seen, F.count_if(facts.overflows(df)).alias("lost"))
        write(facts.stored(watched), self.path(name), date, keys)
        if sinks.observed(seen, "lost", 0):
            self.record(name, checks.error_records(df, name, rules, keys, self.batch, "store", self.at))

    def load_fact(self, name: str, fact: DataFrame, date: str, keys: list[str], write: Callable = sinks.write_months,
                  months: list[str] | None = None) -> None:
        """Write the window's months (or days), or those given; the date filter reaches the scans.

        Months that are rebuilt and have no rows any more lose their old ones.
        """
        low, high = self.window[0].date(), max(self.window[1].date(), self.as_of)
        in_window = fact.filter(F.col(date).between(F.lit(low), F.lit(high)))
        if write is sinks.write_months:
            inside = lambda m: f"{low:%Y-%m}" <= m <= f"{high:%Y-%m}"
            held = sinks.stored_months(self.spark, self.path(name)) if months is None else months
            write = partial(write, replaced=[m for m in held if inside(m)])
        self.store(name, in_window, date, keys, write)

    def load_facts(self, tables: Mapping[str, DataFrame]) -> None:
        whole = tables if isinstance(tables, CleanTables) else CleanTables(tables, {}, frozenset())
        low, high = self.window[0].date(), self.as_of
        t, months = whole, None  # of the fact being loaded

        def sales():
            lines = facts.sales_lines_from_source(t)
            fact = self.keyed("FactSales", facts.fact_sales(lines), "SalesDateKey")
            self.load_fact("FactSales", fact, "SalesDateKey", ["SalesDateKey", "CustomerKey", "ProductKey"],
                           months=months)

        def purchases():
            fact = self.keyed("FactPurchases", facts.fact_purchases(facts.purchase_lines_from_source(t)), "PurchaseDateKey")
            self.load_fact("FactPurchases", fact, "PurchaseDateKey", ["PurchaseDateKey", "ProductKey"], months=months)

        def inventory():
            fact = facts.fact_inventory(facts.stock_from_source(t), self.as_of)
            fact = self.keyed("FactInventory", fact, "InventoryDateKey")
            self.load_fact("FactInventory", fact, "InventoryDateKey", ["ProductKey", "WarehouseKey"], sinks.write_days)

        def production():
            fact = self.keyed("FactProduction", facts.fact_production(*facts.runs_from_source(t)), "ProductionDateKey")
            self.load_fact("FactProduction", fact, "ProductionDateKey", ["ProductionDateKey", "ProductKey"], months=months)

        def employee_sales():
            fact = facts.fact_employee_sales(facts.sales_lines_from_source(t), facts.quotas_from_source(t),
                                             facts.sellers_from_source(t), low, high)
            fact = self.keyed("FactEmployeeSales", fact, "SalesDateKey")
            self.load_fact("FactEmployeeSales", fact, "SalesDateKey", ["SalesDateKey", "EmployeeKey"], months=months)

        def feedback():
            fact = facts.fact_customer_feedback(facts.feedback_from_source(t))
            fact = self.member(fact, "FeedbackCategoryKey", "DimFeedbackCategory", "CategoryName")
            self.load_fact("FactCustomerFeedback", fact, "FeedbackDateKey", ["FeedbackID"])

        def promotions():
            fact = facts.fact_promotion_response(facts.sales_lines_from_source(t))
            fact = self.keyed("FactPromotionResponse", fact, "PromotionDateKey")
            self.load_fact("FactPromotionResponse", fact, "PromotionDateKey", ["PromotionDateKey", "ProductKey"], months=months)

        def finance():
            fact = self.keyed("FactFinance", facts.fact_finance(facts.invoices_from_source(t)), "InvoiceDateKey")
            fact = self.member(fact, "FinanceCategoryKey", "DimFinanceCategory", "CategoryName")
            self.load_fact("FactFinance", fact, "InvoiceDateKey", ["InvoiceID"], months=months)

        def returned():
            if self.returns is None and sinks.folder_exists(self.spark, self.path("FactReturns")):
                return  # nothing was handed over; what is there stays
            if self.returns is None:
                self.returns = self.spark.createDataFrame([], RETURNED)
            fact = self.keyed("FactReturns", facts.fact_returns(self.returns), "ReturnDateKey")
            fact = self.member(fact, "ReturnReasonKey", "DimReturnReason", "ReturnReasonName")
            # a frame of returns replaces the months it has rows of
            self.load_fact("FactReturns", fact, "ReturnDateKey", ["ReturnID"], months=[])

        for name, work in {"FactSales": sales, "FactPurchases": purchases, "FactInventory": inventory,
                           "FactProduction": production, "FactEmployeeSales": employee_sales,
                           "FactCustomerFeedback": feedback, "FactPromotionResponse": promotions,
                           "FactFinance": finance, "FactReturns": returned}.items():
            sources = FACT_SOURCES.get(name, ())
            months = self.stale(name, sources) if sources else None
            t = whole if months is None else whole.limited(
                {n: self.landed.read(n, months) for n in sources if n in self.landed.plans})

            def load():
                if months != []:
                    work()
                self.advance(name, (*sources, REACHES_ON[name]) if name in REACHES_ON else sources)

            self.step(name, load)
        self.save_progress()

    def load_marts(self, t: Mapping[str, DataFrame], names: list[str]) -> None:
        def stored(name: str, months: list[str] | None = None) -> DataFrame:
            if name not in self.report.done:
                raise MissingTable(name)
            return sinks.read_months(self.spark, self.path(name), months)

        def ratings() -> DataFrame:
            reviews = facts.feedback_from_source(t).select("product_id", F.col("score").alias("FeedbackScore"))
            keys = self.table("DimProduct").read().select(F.col("ProductID").alias("product_id"), "ProductKey")
            return reviews.join(keys, "product_id")

        def places() -> DataFrame:
            state = t["person.stateprovince"].select(
                F.col("stateprovinceid").cast("long").alias("RegionKey"),
                F.col("territoryid").cast("long").alias("SalesTerritoryKey"))
            own = self.table("DimCustomer").read().select(
                "CustomerKey", F.col("CustomerSegment").alias("SegmentKey"),
                or_unknown(F.col("StateProvince").try_cast("long")).alias("RegionKey")).join(state, "RegionKey", "left")
            return self.member(own, "SegmentKey", "DimCustomerSegment", "SegmentName")

        def products() -> DataFrame:
            own = self.table("DimProduct").read().select(
                "ProductKey", F.col("Category").alias("ProductCategoryKey"), F.col("Cost").alias("UnitCost"))
            return self.member(own, "ProductCategoryKey", "DimProductCategory", "CategoryName")

        def categories() -> DataFrame:
            return products().drop("UnitCost")

        def inventory(read: list[str] | None) -> DataFrame:
            day = stored("FactInventory").filter(F.col("InventoryDateKey") == F.lit(self.as_of))
            return marts.daily_inventory(day, products(), self.table("DimAgingTier").read())

        def regional(months: list[str] | None) -> DataFrame:
            sales = stored("FactSales", months)
            if months is None or "agg_regional_sales" not in mart_folders:
                return marts.regional_sales(stored("FactSales"), places())
            mart = sinks.read_months(self.spark, self.path("agg_regional_sales"))
            fresh = marts.regional_refresh(mart, sales, places(), months)
            # the mart is read and replaced, so the new rows are written elsewhere first
            folder = run_folder(self.spark, "agg_regional_sales")
            fresh.write.parquet(folder)
            return self.spark.read.parquet(folder)

        mart_folders = [n for n in names if sinks.folder_exists(self.spark, self.path(n))]
        # plan over the months it has to read, date column, and the (months before, months
        # after) that a touched month reaches
        plans = {
            "agg_daily_sales": (lambda ms: marts.daily_sales(stored("FactSales", ms), categories()), "SalesDateKey", (0, 0)),
            "agg_weekly_sales": (lambda ms: marts.weekly_sales(stored("FactSales", ms), places(), categories()),
                                 "WeekStartDateKey", (1, 0)),
            "agg_monthly_sales": (lambda ms: marts.monthly_sales(stored("FactSales", ms), places()),
                                  "MonthStartDateKey", (0, 0)),
            "agg_daily_inventory": (inventory, "InventoryDateKey", (0, 0)),
            "agg_monthly_product_performance": (lambda ms: marts.monthly_product_performance(
                stored("FactSales", ms), stored("FactReturns", ms), ratings()), "MonthStartDateKey", (0, 0)),
            "agg_regional_sales": (regional, "MonthStartDateKey", (0, 1)),
        }
        for name in names:
            plan, date, reach = plans[name]
            sources, others = MART_SOURCES.get(name, ((), ()))
            months = self.months if self.months is not None else self.stale(name, sources, others) if sources else None
            if name == "agg_monthly_product_performance" and self.returns is not None and self.months is None:
                months = None  # returns may have come to any month

            def refresh():
                if name == "agg_daily_inventory":
                    self.store(name, plan(None), date, [date], sinks.write_days)
                elif months is None:
                    held = sinks.stored_months(self.spark, self.path(name))
                    self.store(name, plan(None), date, [date], partial(sinks.write_months, replaced=held))
                elif months:
                    written = sorted({shift_month(m, n) for m in months for n in range(-reach[0], reach[1] + 1)})
                    # the growth mart finds the months before among its own rows
                    read = months if name in OWN_PAST else sorted({shift_month(m, n) for m in written for n in (-1, 0, 1)})
                    fresh = plan(read).filter(F.date_format(date, "yyyy-MM").isin(*written))
                    self.store(name, fresh, date, [date], partial(sinks.write_months, replaced=written))
                self.advance(name, (*sources, *others))

            self.step(name, refresh)
        self.save_progress()

    def run(self, mart_names: list[str] | None = None, targets: Collection[str] | None = None) -> DayReport:
        """A day's run; ``targets`` names the dimensions and facts to load where not all are wanted."""
        self.targets = targets
        if self.land:
            self.bring_in()
        frames = self.extract()
        self.report.not_extracted = sorted(set(self.specs) - set(frames))
        rules = table_rules(self.specs, frames, self.as_of, self.report.unchecked)
        broken = self.validate(frames, rules)
        self.quarantine(frames, rules, broken)
        self.retry(rules)
        blocked = frozenset() if self.allow_failed else frozenset(n for n, r in broken.items() if r.key)
        for name in sorted(blocked):
            self.report.skipped[name] = "duplicate primary keys"
        # the extract's window is for checking; loads read whole tables, since a windowed
        # product or offer table would lose rows that facts point at
        # (of a windowed table, and of increments, only part was checked, so all rules apply to the whole)
        partly = {n for n in frames if self.landed or classify(self.specs[n].name, self.specs[n].column_names) == "fact"}
        full = CleanTables({n: self.source(n) for n in frames},
                           {n: rules[n] if n in partly else broken.get(n) for n in frames}, blocked)
        self.step("StagingCustomer", lambda: self.stage_customers(full))
        for name in dims.DIMENSIONS:
            self.step(name, lambda: self.load_dimension(name, full))
        self.step("DimDate", self.load_calendar)
        self.load_facts(full)
        self.load_marts(full, due_marts(self.as_of) if mart_names is None else mart_names)
        return self.report
