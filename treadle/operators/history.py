"""Slowly changing dimensions as pure functions from frames to frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from treadle.operators.keep import upsert
from treadle.operators.lookup import asof_lookup

VALID = ("ValidFromDate", "ValidToDate", "IsCurrent")
#: Load-time interval, kept by dimensions that have these columns.
EFFECTIVE = ("EffectiveStartDate", "EffectiveEndDate")
KeyOf = Callable[[Sequence[Column], Column], Column]


def surrogate_key(natural: Sequence[Column], valid_from: Column) -> Column:
    """Repeatable 64-bit key of (natural key, start date): no counter, no single task."""
    return F.xxhash64(*natural, valid_from.cast("date"))


def key_later(natural: Sequence[Column], valid_from: Column) -> Column:
    """No key yet: it is handed out when the version is stored (see ``operators.keys``)."""
    return F.lit(None).cast("bigint")


def differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """NULL-safe: NULL against NULL is no change, NULL against a value is one."""
    test = F.lit(False)
    for new, old in pairs:
        test = test | ~new.eqNullSafe(old)
    return test


def change_set(staging: DataFrame, current: DataFrame, key: Sequence[str],
               tracked: Mapping[str, str]) -> DataFrame:
    """Staging rows with ``change_type`` new, changed or unchanged.

    ``tracked`` maps staging columns to the dimension columns they are compared with.
    """
    old = current.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
                         *[F.col(c).alias(f"_o{i}") for i, c in enumerate(tracked.values())])
    match = F.lit(True)
    for i, k in enumerate(key):
        match = match & (F.col(k) == F.col(f"_k{i}"))
    changed = differs([(F.col(n), F.col(f"_o{i}")) for i, n in enumerate(tracked)])
    kind = (F.when(F.col("_k0").isNull(), "new").when(changed, "changed").otherwise("unchanged"))
    return staging.join(old, match, "left").select(*staging.columns, kind.alias("change_type"))


def versions(states: DataFrame, key: Sequence[str], day: str, tracked: Sequence[str]) -> DataFrame:
    """Version rows from one state per key and day (see ``keep.daily_state``).

    The window holds at most one row per calendar day of a key.
    """
    by_key = Window.partitionBy(*key).orderBy(day)
    changed = differs([(F.col(c), F.lag(c).over(by_key)) for c in tracked])
    starts = (
        states.withColumn("_first", F.row_number().over(by_key) == 1)
        .withColumn("_changed", changed)
        .filter(F.col("_first") | F.col("_changed"))
        .drop("_first", "_changed")
    )
    end = F.lead(day).over(by_key)
    return (
        starts.withColumn("ValidToDate", end)
        .withColumnRenamed(day, "ValidFromDate")
        .withColumn("IsCurrent", F.col("ValidToDate").isNull())
    )


def scd1(current: DataFrame, staging: DataFrame, key: Sequence[str],
         order: Sequence[str] = ()) -> DataFrame:
    """Overwrite by key: one row per key, staging wins."""
    return upsert(current, staging, key, order)


def first_load(staging: DataFrame, key: Sequence[str], surrogate: str, as_of: dt.date,
               opening: dt.date | None = None, effective: bool = False, key_of: KeyOf = surrogate_key) -> DataFrame:
    """All staging rows as their first version, valid from ``opening`` (or the run date)."""
    start = F.lit(opening or as_of)
    loaded = [F.lit(as_of).alias(EFFECTIVE[0]), F.lit(None).cast("date").alias(EFFECTIVE[1])] if effective else []
    return staging.select(
        key_of([F.col(k) for k in key], start).alias(surrogate),
        *staging.columns,
        start.alias("ValidFromDate"),
        F.lit(None).cast("date").alias("ValidToDate"),
        F.lit(True).alias("IsCurrent"),
        *loaded,
    )


def scd2(current: DataFrame, staging: DataFrame, key: Sequence[str], tracked: Sequence[str],
         surrogate: str, as_of: dt.date, *, close_missing: bool = False, key_of: KeyOf = surrogate_key) -> DataFrame:
    """The dimension after one day's staging.

    Changed keys get their open row closed and a new one; a key changed again on the same
    day keeps one row, so a re-run is a no-op.  Untracked columns of an unchanged key are
    refreshed in place.  Closed rows pass through untouched; one full outer join on the
    natural key does the rest.  An ``as_of`` before the open row's start changes nothing
    here: such rows go to :func:`splice`, together with the closed versions.
    """
    attributes = [c for c in current.columns if c not in (surrogate, *VALID, *EFFECTIVE, *key)]
    closed = current.filter(~F.col("IsCurrent"))
    old = current.filter("IsCurrent").select(*[F.col(c).alias(f"o_{c}") for c in current.columns])
    new = staging.select(*[F.col(c).alias(f"n_{c}") for c in (*key, *attributes)])
    match = F.lit(True)
    for k in key:
        match = match & (F.col(f"o_{k}") == F.col(f"n_{k}"))

    day = F.lit(as_of)
    types = {f.name: f.dataType for f in current.schema.fields}

    def row(values: Mapping[str, Column]) -> Column:
        return F.struct(*[values[c].cast(types[c]).alias(c) for c in current.columns])

    kept = {c: F.col(f"o_{c}") for c in current.columns}
    refreshed = {**kept, **{a: F.col(f"n_{a}") for a in attributes}}
    ended = {**kept, "ValidToDate": day, "IsCurrent": F.lit(False), EFFECTIVE[1]: day}
    fresh = {
        surrogate: key_of([F.col(f"n_{k}") for k in key], day),
        **{c: F.col(f"n_{c}") for c in (*key, *attributes)},
        "ValidFromDate": day, "ValidToDate": F.lit(None), "IsCurrent": F.lit(True),
        EFFECTIVE[0]: day, EFFECTIVE[1]: F.lit(None),
    }
    changed = differs([(F.col(f"n_{t}"), F.col(f"o_{t}")) for t in tracked])
    late = F.col("o_ValidFromDate") > day
    gone = F.array(row(ended)) if close_missing else F.array(row(kept))
    same_day = F.col("o_ValidFromDate") == day
    rows = (
        F.when(F.col(f"o_{key[0]}").isNull(), F.array(row(fresh)))
        .when(F.col(f"n_{key[0]}").isNull(), gone)
        .when(late, F.array(row(kept)))
        .when(~changed | same_day, F.array(row(refreshed)))
        .otherwise(F.array(row(ended), row(fresh)))
    )
    merged = old.join(new, match, "full_outer").select(F.inline(rows))
    return closed.unionByName(merged)


def absorb_late(current: DataFrame, observed: DataFrame, key: Sequence[str], tracked: Sequence[str],
                surrogate: str, day: str) -> DataFrame:
    """Rebuild version rows after observations dated before the open version.

    Existing starts and the observations are put together, a later observation of the same
    day wins, and :func:`versions` cuts new intervals.  Only keys that were observed are
    rebuilt.
    """
    attributes = [c for c in current.columns if c not in (surrogate, *VALID, *key)]
    seen = [c for c in attributes if c in observed.columns]
    touched = current.join(observed.select(*key).distinct(), list(key), "left_semi")
    untouched = current.join(observed.select(*key).distinct(), list(key), "left_anti")
    starts = touched.select(*key, F.col("ValidFromDate").alias(day), *attributes)
    late = observed.select(*key, F.col(day).cast("date").alias(day), *seen)
    for c in attributes:
        if c not in seen:
            late = late.withColumn(c, F.lit(None).cast(current.schema[c].dataType))
    states = upsert(starts, late, [*key, day])
    rebuilt = versions(states, key, day, tracked)
    rebuilt = rebuilt.withColumn(surrogate, surrogate_key([F.col(k) for k in key], F.col("ValidFromDate")))
    return untouched.unionByName(rebuilt.select(*current.columns))


def unlike(versions: DataFrame, late: DataFrame, key: Sequence[str], tracked: Sequence[str], day: str,
           since: dt.date, until: dt.date) -> DataFrame:
    """Observations that differ from the version in force on their day, or find none."""
    seen = [c for c in tracked if c in late.columns]
    marked = versions.withColumn("_there", F.lit(True))
    found = asof_lookup(late, marked, {k: k for k in key}, day, {"_there": "_there", **{f"_v_{c}": c for c in seen}},
                        since=since, until=until)
    changed = differs([(F.col(c).cast(versions.schema[c].dataType), F.col(f"_v_{c}")) for c in seen])
    return found.filter(F.col("_there").isNull() | changed).select(*late.columns)


_END = dt.date(9999, 12, 31)


def splice(rows: DataFrame, late: DataFrame, key: Sequence[str], tracked: Sequence[str], surrogate: str, day: str,
           loaded: dt.date, key_of: KeyOf = surrogate_key) -> DataFrame:
    """All versions of some keys after observations of any day, also between two closed versions.

    ``late`` has the key, ``day`` and some or all attributes; those it lacks are the ones in force on that
    day (of the first version, if the day lies before it).  An observation that differs from the version
    in force in a tracked attribute cuts it in two; one on a version's own start day replaces its
    attributes; any other changes nothing.  Versions that were there keep their start and their key.

    The window holds one row per version of a key, at most one per calendar day.
    """
    attributes = [c for c in rows.columns if c not in (surrogate, *VALID, *EFFECTIVE, *key)]
    seen = [c for c in attributes if c in late.columns]
    rest = [c for c in attributes if c not in seen]
    loads = [c for c in EFFECTIVE if c in rows.columns]
    types = {f.name: f.dataType for f in rows.schema.fields}
    end = F.lit(_END)

    def group(names: Sequence[str]) -> Column:
        return F.struct(F.lit(1).alias("_"), *[F.col(c).cast(types[c]).alias(c) for c in names])

    held = rows.select(*key, F.col("ValidFromDate").alias("_day"), F.col(surrogate).alias("_key"), F.lit(True).alias("_held"),
                       F.coalesce("ValidToDate", end).alias("_to"), group(seen).alias("_old"), group(rest).alias("_rest"),
                       *loads)
    one = late.groupBy(*key, F.col(day).cast("date").alias("_day")).agg(F.max(group(seen)).alias("_new"))
    both = held.join(one, [*key, "_day"], "full_outer")
    before = Window.partitionBy(*key).orderBy("_day")
    past = before.rowsBetween(Window.unboundedPreceding, 0)
    after = before.rowsBetween(0, Window.unboundedFollowing)
    told = both.withColumn("_seen", F.coalesce("_new", "_old")).withColumn(
        "_rest", F.coalesce("_rest", F.last("_rest", True).over(past), F.first("_rest", True).over(after)))
    tests = [(F.col(f"_seen.{c}"), F.lag(f"_seen.{c}").over(before)) if c in seen else
             (F.col(f"_rest.{c}"), F.lag(f"_rest.{c}").over(before)) for c in tracked if c in attributes]
    told = told.withColumn("_first", F.row_number().over(before) == 1).withColumn("_changed", differs(tests))
    # where the version in force had ended before the day, the first observation since starts a new one
    ended = F.last(F.when(F.col("_held"), F.col("_to")), True).over(past)
    told = told.withColumn("_gap", (ended <= F.col("_day")) & (F.lag("_day").over(before) < ended))
    cut = told.filter(F.coalesce("_held", F.lit(False)) | F.col("_first") | F.col("_changed") | F.coalesce("_gap", F.lit(False)))
    limit = F.last(F.when(F.col("_held"), F.col("_to")), True).over(past)
    limit = F.when(limit > F.col("_day"), limit).otherwise(end)
    to = F.least(F.coalesce(F.lead("_day").over(before), end), limit)
    cut = cut.withColumn("_to", to)
    values = {
        surrogate: F.coalesce(F.col("_key"), key_of([F.col(k) for k in key], F.col("_day"))),
        **{k: F.col(k) for k in key}, **{c: F.col(f"_seen.{c}") for c in seen}, **{c: F.col(f"_rest.{c}") for c in rest},
        "ValidFromDate": F.col("_day"), "ValidToDate": F.nullif(F.col("_to"), end), "IsCurrent": F.col("_to") == end,
    }
    if loads:
        values[EFFECTIVE[0]] = F.when(F.col("_held"), F.col(EFFECTIVE[0])).otherwise(F.lit(loaded))
        closed_now = (F.col("_to") < end) & F.col(EFFECTIVE[1]).isNull()
        values[EFFECTIVE[1]] = F.when(closed_now, F.lit(loaded)).otherwise(F.col(EFFECTIVE[1]))
    return cut.select(*[values[c].cast(types[c]).alias(c) for c in rows.columns])
