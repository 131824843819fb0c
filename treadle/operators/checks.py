"""Data-quality engine: rules, one-pass counts, key checks, error records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from treadle.operators.lookup import orphan_counts, orphans

ERROR, WARNING = "ERROR", "WARNING"

FINDING = ("table_name string, rule string, kind string, severity string, message string, "
           "violations long")

# Columns of the error-record table.
ERROR_RECORD = [
    ("ErrorID", "bigint"), ("ErrorDate", "timestamp"), ("SourceTable", "string"),
    ("RecordNaturalKey", "string"), ("ErrorType", "string"), ("ErrorSeverity", "string"),
    ("ErrorMessage", "string"), ("ErrorDetails", "string"), ("FailedData", "string"),
    ("ProcessingBatchID", "string"), ("TaskName", "string"), ("IsRecoverable", "boolean"),
    ("RetryCount", "int"), ("LastAttemptDate", "timestamp"), ("IsResolved", "boolean"),
    ("ResolutionComment", "string"),
]

# Words that name a column which must not be negative.
NEGATIVE_WORDS = ("amount", "price", "total")


@dataclass(frozen=True)
class Rule:
    """A row rule.  ``broken`` is a SQL predicate that is true for a bad row."""

    name: str
    kind: str
    broken: str
    message: str
    severity: str = ERROR


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    cascade: bool = False

    @property
    def rule(self) -> str:
        return "fk_" + "_".join(self.columns)


@dataclass(frozen=True)
class TableRules:
    """Everything that is checked on one table."""

    rules: tuple[Rule, ...] = ()
    key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = field(default=())


def _quoted(name: str) -> str:
    return f"`{name}`"


def check_rule(name: str, predicate: str) -> Rule:
    """A CHECK constraint: it passes when the predicate is true or NULL."""
    return Rule(name, "check", f"NOT coalesce(({predicate}), true)", f"Check failed: {name}")


def required_rule(column: str) -> Rule:
    return Rule(f"required_{column}", "required", f"{_quoted(column)} IS NULL", f"Nulls in {column}")


def length_rule(column: str, limit: int) -> Rule:
    return Rule(f"length_{column}", "length", f"length({_quoted(column)}) > {limit}",
                f"Longer than {limit}: {column}")


def column_rules(schema: T.StructType, as_of: dt.date, *, required: Iterable[str] = (),
                 lengths: Mapping[str, int] | None = None,
                 declared: Mapping[str, str] | None = None) -> list[Rule]:
    """The rules that follow from names, types and declarations.

    ``declared`` gives the type a column should have; a text column that should be numeric
    is checked value by value.
    """
    rules = []
    needed = {c.lower() for c in required}
    lengths = {k.lower(): v for k, v in (lengths or {}).items()}
    declared = {k.lower(): v for k, v in (declared or {}).items()}
    for f in schema.fields:
        name, low = f.name, f.name.lower()
        numeric = isinstance(f.dataType, T.NumericType)
        dated = isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
        if low in needed:
            rules.append(required_rule(name))
        want = declared.get(low)
        if want and isinstance(f.dataType, T.StringType) and want.split("(")[0] in (
                "tinyint", "smallint", "int", "bigint", "decimal", "double", "float"):
            rules.append(Rule(f"numeric_{name}", "numeric",
                              f"{_quoted(name)} IS NOT NULL AND try_cast({_quoted(name)} AS {want}) IS NULL",
                              f"Bad numeric type: {name}"))
        if numeric and any(w in low for w in NEGATIVE_WORDS):
            rules.append(Rule(f"negative_{name}", "negative", f"{_quoted(name)} < 0",
                              f"Negative values in {name}"))
        if dated and "date" in low:
            rules.append(Rule(f"future_{name}", "future", f"{_quoted(name)} > timestamp '{as_of.isoformat()}'"
                              if not isinstance(f.dataType, T.DateType)
                              else f"{_quoted(name)} > date '{as_of.isoformat()}'",
                              f"Future dates in {name}", WARNING))
        if low in lengths and isinstance(f.dataType, T.StringType):
            rules.append(length_rule(name, lengths[low]))
    return rules


def _finding(table: str, rule: str, kind: str, severity: str, message: str, count: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(kind).alias("kind"),
                    F.lit(severity).alias("severity"), F.lit(message).alias("message"),
                    F.coalesce(count, F.lit(0)).cast("long").alias("violations"))


def count_violations(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of every row rule of a table in one pass over it."""
    counts = df.agg(*[F.count_if(F.expr(r.broken)).alias(f"v{i}") for i, r in enumerate(rules)])
    return counts.select(F.inline(F.array(*[
        _finding(table, r.name, r.kind, r.severity, r.message, F.col(f"v{i}")) for i, r in enumerate(rules)
    ])))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row counts."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of many frames, paired up level by level so that the plan stays flat."""
    level = list(parts)
    while len(level) > 1:
        level = [a.unionByName(b) for a, b in zip(level[::2], level[1::2])] + level[len(level) & ~1:]
    return level[0]


def _common(types: Iterable[T.DataType]) -> str | None:
    """The type keys are compared in: long for whole numbers, their own if all are alike, else text."""
    kinds = list(types)
    if all(isinstance(t, T.IntegralType) for t in kinds):
        return "bigint"
    return None if all(t == kinds[0] for t in kinds) else "string"


def _key_hashes(columns: Sequence[str], kinds: Sequence[str | None]) -> list[Column]:
    """Two hashes of a key; which of its columns are NULL is part of them."""
    values = [F.col(_quoted(c)) if k is None else F.col(_quoted(c)).cast(k) for c, k in zip(columns, kinds)]
    nulls = [v.isNull() for v in values]
    return [F.xxhash64(*values, *nulls, F.lit(seed)) for seed in (1, 2)]


#: Rules whose outcomes share a number.
_BITS = 60


@dataclass
class _KeySpace:
    """Keys that are counted together: those of one table, and of the foreign keys that point at them."""

    number: int
    columns: tuple[str, ...]
    own: tuple[str, str]  # the frame that holds the keys
    primary: str | None = None
    links: list[tuple[str, ForeignKey]] = field(default_factory=list)


def findings(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules],
             parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per table and rule with its violation count (zero included).

    ``parents`` are the whole tables that foreign keys point at, where ``tables`` are windows of them.

    Every table is scanned once.  A row gives an entry per rule it breaks, one for its own key and one per
    foreign key, as two hashes (128 bits) in the key space of the parent; entries are counted by key before
    and after one shuffle of all tables, and a second, small count sums up doubled and orphaned keys.
    """
    spark = SparkSession.active()
    frames: dict[tuple[str, str], DataFrame] = {("own", n): tables[n] for n in tables if n in rules}
    spaces: dict[tuple, _KeySpace] = {}
    listed: list[tuple] = []  # (space, measure, table, rule, kind, severity, message)

    def space(frame: tuple[str, str], columns: Sequence[str]) -> _KeySpace:
        return spaces.setdefault((frame, tuple(columns)), _KeySpace(len(spaces), tuple(columns), frame))

    for name in [n for n in tables if n in rules]:
        wanted = rules[name]
        if wanted.key:
            found = space(("own", name), wanted.key)
            found.primary = name
            listed.append((found.number, "doubled", name, "primary_key", "primary_key", ERROR, "Duplicate primary keys"))
        for fk in wanted.foreign_keys:
            if parents is None and fk.parent in tables:
                at = ("own", fk.parent)
                frames.setdefault(at, tables[fk.parent])
            elif parents is not None and fk.parent in parents:
                at = ("whole", fk.parent)
                if at not in frames:
                    frames[at] = parents[fk.parent]
            else:
                continue
            found = space(at, fk.parent_columns)
            listed.append((found.number, f"orphans{len(found.links)}", name, fk.rule, "foreign_key", ERROR,
                           f"No row in {fk.parent} for {', '.join(fk.columns)}"))
            found.links.append((name, fk))
    width = max((len(s.links) for s in spaces.values()), default=0)
    entries: dict[tuple[str, str], list[Column]] = {at: [] for at in frames}

    def entry(number: int, side: int, hashes: Sequence[Column]) -> Column:
        return F.struct(F.lit(number).alias("space"), F.lit(side).alias("side"), hashes[0].alias("h1"), hashes[1].alias("h2"))

    def type_of(df: DataFrame, column: str) -> T.DataType:
        return df.select(F.col(_quoted(column))).schema[0].dataType

    for s in spaces.values():
        sides = [(frames[s.own], s.columns), *[(frames["own", n], fk.columns) for n, fk in s.links]]
        kinds = [_common(type_of(df, cs[i]) for df, cs in sides) for i in range(len(s.columns))]
        entries[s.own].append(entry(s.number, -1, _key_hashes(s.columns, kinds)))
        for side, (name, fk) in enumerate(s.links):
            known = F.lit(True)
            for c in fk.columns:
                known = known & F.col(_quoted(c)).isNotNull()
            entries["own", name].append(F.when(known, entry(s.number, side, _key_hashes(fk.columns, kinds))))
    # the rules a row breaks are bits of one number, so a row gives one entry for all of them
    number = len(spaces)
    for name in [n for n in tables if n in rules]:
        own = rules[name].rules
        for at in range(0, len(own), _BITS):
            broken = F.lit(0).cast("long")
            for k, r in enumerate(own[at:at + _BITS]):
                broken = broken + F.when(F.expr(r.broken), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
                listed.append((number, f"rule{k}", name, r.name, r.kind, r.severity, r.message))
            entries["own", name].append(F.struct(F.lit(number).alias("space"), F.lit(-1).alias("side"), broken.alias("h1"),
                                                 F.lit(0).cast("long").alias("h2")))
            number += 1
    keyed = len(spaces)
    parts = [df.select(F.inline(F.array(*entries[at]))).filter(
        F.col("space").isNotNull() & ((F.col("space") < keyed) | (F.col("h1") != 0))) for at, df in frames.items() if entries[at]]
    if not listed:
        return spark.createDataFrame([], FINDING)
    sums = union_all(parts).groupBy("space", "h1", "h2").agg(
        F.count_if(F.col("side") == -1).alias("own"), *[F.count_if(F.col("side") == k).alias(f"c{k}") for k in range(width)])
    most = min(_BITS, max((len(rules[n].rules) for n in tables if n in rules), default=0))
    by_space = sums.groupBy("space").agg(
        F.count_if(F.col("own") > 1).alias("doubled"),
        *[F.sum(F.when(F.col("own") == 0, F.col(f"c{k}")).otherwise(0)).alias(f"orphans{k}") for k in range(width)],
        *[F.sum(F.when((F.col("space") >= keyed) & (F.col("h1").bitwiseAND(F.lit(1 << k)) != 0), F.col("own")).otherwise(0)).alias(f"rule{k}")
          for k in range(most)])
    measures = ["doubled", *[f"orphans{k}" for k in range(width)], *[f"rule{k}" for k in range(most)]]
    counted = by_space.unpivot(["space"], measures, "measure", "violations")
    listing = spark.createDataFrame(listed, "space int, measure string, table_name string, rule string, kind string, "
                                            "severity string, message string")
    # a row per rule on either side
    return listing.join(counted, ["space", "measure"], "left").select(
        "table_name", "rule", "kind", "severity", "message", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


def summarize(found: DataFrame) -> DataFrame:
    """One row per table: PASS if it has no error; warnings do not fail it."""
    def messages(severity: str) -> Column:
        hit = (F.col("violations") > 0) & (F.col("severity") == severity)
        return F.array_sort(F.collect_list(F.when(hit, F.col("message"))))

    # collect_list holds one short text per broken rule, bounded by the rule list
    return (
        found.groupBy("table_name")
        .agg(messages(ERROR).alias("errors"), messages(WARNING).alias("warnings"))
        .select("table_name", F.when(F.size("errors") == 0, "PASS").otherwise("FAIL").alias("status"),
                "errors", "warnings")
    )


# --- error records -------------------------------------------------------------------------


def _broken(rules: Sequence[Rule]) -> Column:
    """The rules a row breaks, as an array of structs."""
    hits = [F.when(F.expr(r.broken), F.struct(
        F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.severity).alias("severity"),
        F.lit(r.message).alias("message"), F.lit(r.broken).alias("details"))) for r in rules]
    return F.array_compact(F.array(*hits))


def is_bad(rules: Sequence[Rule]) -> Column:
    """True for a row that breaks an error rule, false for any other; never NULL."""
    bad = F.lit(False)
    for r in rules:
        if r.severity == ERROR:
            bad = bad | F.coalesce(F.expr(r.broken), F.lit(False))
    return bad


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): complementary filters, so no row is lost or doubled."""
    bad = is_bad(rules)
    return df.filter(~bad), df.filter(bad)


def balance(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Input, accepted and rejected row counts from one scan."""
    bad = is_bad(rules)
    counts = df.agg(F.count("*").alias("input"), F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("rejected"))
    return counts.unpivot([], ["input", "accepted", "rejected"], "part", "n_rows")


def _records(hits: DataFrame, columns: Sequence[str], table: str, natural_key: Sequence[str], batch: str,
             task: str, at: dt.datetime) -> DataFrame:
    """Turn rows that carry a ``_hit`` struct into error records."""
    payload = F.to_json(F.struct(*[F.col(_quoted(c)) for c in columns]))
    key = F.concat_ws("|", *[F.col(_quoted(k)).cast("string") for k in natural_key])
    moment = F.lit(at).cast("timestamp")
    values = {
        "ErrorID": F.xxhash64(F.lit(batch), F.lit(table), key, F.col("_hit.rule"), payload),
        "ErrorDate": moment, "SourceTable": F.lit(table), "RecordNaturalKey": key,
        "ErrorType": F.col("_hit.kind"), "ErrorSeverity": F.col("_hit.severity"),
        "ErrorMessage": F.col("_hit.message"), "ErrorDetails": F.col("_hit.details"),
        "FailedData": payload, "ProcessingBatchID": F.lit(batch), "TaskName": F.lit(task),
        "IsRecoverable": F.col("_hit.kind").isin("foreign_key", "required"),
        "RetryCount": F.lit(0), "LastAttemptDate": moment, "IsResolved": F.lit(False),
        "ResolutionComment": F.lit(None),
    }
    return hits.select(*[values[n].cast(t).alias(n) for n, t in ERROR_RECORD])


def error_records(df: DataFrame, table: str, rules: Sequence[Rule], natural_key: Sequence[str],
                  batch: str, task: str, at: dt.datetime) -> DataFrame:
    """One record per row and broken rule, from a single scan."""
    hits = df.select("*", F.explode(_broken(rules)).alias("_hit"))
    return _records(hits, df.columns, table, natural_key, batch, task, at)


def key_error_records(df: DataFrame, table: str, key: Sequence[str], batch: str, task: str,
                      at: dt.datetime) -> DataFrame:
    """Every row of a duplicated key."""
    bad = df.join(duplicate_keys(df, key).drop("rows"), list(key), "left_semi").select(*df.columns)
    hit = F.struct(F.lit("primary_key").alias("rule"), F.lit("primary_key").alias("kind"),
                   F.lit(ERROR).alias("severity"), F.lit("Duplicate primary keys").alias("message"),
                   F.lit(", ".join(key)).alias("details"))
    return _records(bad.withColumn("_hit", hit), df.columns, table, key, batch, task, at)


def orphan_error_records(df: DataFrame, table: str, fk: ForeignKey, parent: DataFrame,
                         natural_key: Sequence[str], batch: str, task: str, at: dt.datetime) -> DataFrame:
    bad = orphans(df, fk.columns, parent, fk.parent_columns)
    hit = F.struct(F.lit(fk.rule).alias("rule"), F.lit("foreign_key").alias("kind"),
                   F.lit(ERROR).alias("severity"), F.lit(f"No row in {fk.parent}").alias("message"),
                   F.lit(", ".join(fk.columns)).alias("details"))
    return _records(bad.withColumn("_hit", hit), df.columns, table, natural_key, batch, task, at)


def table_error_records(df: DataFrame, table: str, rules: TableRules, natural_key: Sequence[str], batch: str, task: str,
                        at: dt.datetime, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Error records of a table for rules of every kind, from one reading of its rows.

    Doubled and orphaned keys are found from the key columns alone; the few bad ones are joined to the rows
    as flags, and all rules a row breaks, of whatever kind, become records together.
    """
    def tell(*texts: str) -> Column:
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(("rule", "kind", "severity", "message", "details"), texts)])

    hits = [F.expr(r.broken) for r in rules.rules]
    told = [tell(r.name, r.kind, r.severity, r.message, r.broken) for r in rules.rules]
    rows, columns = df, df.columns
    bad: list[tuple[Sequence[str], DataFrame, str, str, str]] = []
    if rules.key:
        bad.append((rules.key, duplicate_keys(df, rules.key).drop("rows"), "primary_key", "primary_key", "Duplicate primary keys"))
    for fk in rules.foreign_keys:
        if fk.parent in parents:
            keys = orphan_counts(df, fk.columns, parents[fk.parent], fk.parent_columns).drop("rows")
            bad.append((fk.columns, keys, fk.rule, "foreign_key", f"No row in {fk.parent}"))
    for n, (key, keys, rule, kind, message) in enumerate(bad):
        named = keys.select(*[F.col(_quoted(c)).alias(f"_b{n}_{k}") for k, c in enumerate(key)], F.lit(True).alias(f"_bad{n}"))
        match = F.lit(True)
        for k, c in enumerate(key):
            match = match & (F.col(_quoted(c)) == F.col(f"_b{n}_{k}"))
        rows = rows.join(named, match, "left")
        hits.append(F.col(f"_bad{n}"))
        told.append(tell(rule, kind, ERROR, message, ", ".join(key)))
    # a row goes once, with the numbers of the rules it breaks, however many those are
    broken = F.array_compact(F.array(*[F.when(h, F.lit(i)) for i, h in enumerate(hits)]))
    found = rows.select(*[F.col(_quoted(c)) for c in columns], broken.alias("_broken")).filter(F.size("_broken") > 0)
    # evenly sized before the payloads are built, which are larger than the rows and costly to make
    even = found.hint("rebalance", *[F.col(_quoted(k)) for k in natural_key]).withColumn("_at", F.explode("_broken"))
    known = F.array(*told)
    return _records(even.withColumn("_hit", F.get(known, F.col("_at"))), columns, table, natural_key, batch, task, at)


# --- retries -------------------------------------------------------------------------------

#: One row per attempt at an open error record; the log is only ever added to.
ATTEMPT = "ErrorID bigint, AttemptDate timestamp, Passed boolean, Comment string"


def rule_name() -> Column:
    """What tells the rules of a table apart in its error records."""
    details = F.when(F.col("ErrorType") == "foreign_key", F.col("ErrorDetails"))
    return F.concat_ws("|", "ErrorType", "ErrorMessage", details)


def rule_names(rules: TableRules) -> dict[str, Rule | ForeignKey | None]:
    """The same names from a table's rules; None stands for its primary key."""
    found: dict[str, Rule | ForeignKey | None] = {f"{r.kind}|{r.message}": r for r in rules.rules}
    found |= {f"foreign_key|No row in {k.parent}|{', '.join(k.columns)}": k for k in rules.foreign_keys}
    return found | ({"primary_key|Duplicate primary keys": None} if rules.key else {})


def latest(records: DataFrame, attempts: DataFrame) -> DataFrame:
    """Error records with their state after all attempts: aggregates of the log, joined by error."""
    passed = F.min(F.when(F.col("Passed"), F.struct("AttemptDate", "Comment")))
    tries = attempts.groupBy("ErrorID").agg(F.count("*").alias("_tries"), F.max("AttemptDate").alias("_last"), passed.alias("_passed"))
    return records.join(tries, "ErrorID", "left").select(*[{
        "RetryCount": F.col("RetryCount") + F.coalesce("_tries", F.lit(0)),
        "LastAttemptDate": F.coalesce("_last", "LastAttemptDate"),
        "IsResolved": F.col("IsResolved") | F.col("_passed").isNotNull(),
        "ResolutionComment": F.coalesce("_passed.Comment", "ResolutionComment"),
    }.get(n, F.col(n)).cast(t).alias(n) for n, t in ERROR_RECORD])


def recheck(df: DataFrame, rules: TableRules, names: Iterable[str], key: Sequence[str], wanted: DataFrame,
            parents: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(key and rule of rows that still break one of the named rules, keys that are there).

    Only rows with a ``wanted`` key are looked at, and only for those rules.
    """
    natural = F.concat_ws("|", *[F.col(_quoted(k)).cast("string") for k in key])
    rows = df.withColumn("_natural", natural).join(
        wanted.select(F.col("RecordNaturalKey").alias("_natural")).distinct(), "_natural", "left_semi")
    known, parts = rule_names(rules), []
    hits = [F.when(F.expr(known[n].broken), F.lit(n)) for n in names if isinstance(known.get(n), Rule)]
    if hits:
        parts.append(rows.select("_natural", F.explode(F.array_compact(F.array(*hits))).alias("_rule")))
    for n in names:
        if n not in known or isinstance(known[n], Rule):
            continue
        if known[n] is None:
            parts.append(rows.groupBy("_natural").agg(F.count("*").alias("n")).filter("n > 1").select("_natural", F.lit(n).alias("_rule")))
        elif known[n].parent in parents:
            bad = orphans(rows, known[n].columns, parents[known[n].parent], known[n].parent_columns)
            parts.append(bad.select("_natural", F.lit(n).alias("_rule")))
    there = rows.select("_natural").distinct()
    broken = union_all(parts).distinct() if parts else there.select("_natural", F.lit("").alias("_rule")).limit(0)
    return broken, there


def attempt(open_: DataFrame, broken: DataFrame, there: DataFrame, at: dt.datetime) -> DataFrame:
    """One attempt at each open record of a table, as rows of the log."""
    named = open_.select("ErrorID", F.col("RecordNaturalKey").alias("_natural"), rule_name().alias("_rule"))
    tested = named.join(broken.withColumn("_broken", F.lit(True)), ["_natural", "_rule"], "left").join(
        there.withColumn("_there", F.lit(True)), "_natural", "left")
    passed = F.col("_broken").isNull()
    comment = F.when(passed, F.when(F.col("_there"), "passed on retry").otherwise("the row is gone"))
    return tested.select("ErrorID", F.lit(at).cast("timestamp").alias("AttemptDate"), passed.alias("Passed"), comment.alias("Comment"))


def record_retry(records: DataFrame, solved: DataFrame, at: dt.datetime, comment: str) -> DataFrame:
    """Bookkeeping after a retry of the open records.

    ``solved`` holds SourceTable and RecordNaturalKey of records that now pass.
    """
    good = solved.select("SourceTable", "RecordNaturalKey").distinct().withColumn("_good", F.lit(True))
    joined = records.join(good, ["SourceTable", "RecordNaturalKey"], "left")
    open_ = ~F.col("IsResolved")
    now_good = open_ & F.coalesce(F.col("_good"), F.lit(False))
    return joined.select(*[{
        "RetryCount": F.when(open_, F.col("RetryCount") + 1).otherwise(F.col("RetryCount")),
        "LastAttemptDate": F.when(open_, F.lit(at).cast("timestamp")).otherwise(F.col("LastAttemptDate")),
        "IsResolved": F.col("IsResolved") | now_good,
        "ResolutionComment": F.when(now_good, F.lit(comment)).otherwise(F.col("ResolutionComment")),
    }.get(n, F.col(n)).cast(t).alias(n) for n, t in ERROR_RECORD])
