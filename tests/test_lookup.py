import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from treadle.operators import keep, lookup

D = dt.date
SPAN = {"since": D(2010, 1, 1), "until": D(2015, 1, 1)}


@pytest.fixture
def versions(frame):
    return frame([
        (1, "a", D(2011, 1, 1), D(2012, 6, 1)), (1, "b", D(2012, 6, 1), None),
        (2, "c", D(2000, 1, 1), D(2020, 1, 1)), (2, "d", D(2020, 1, 1), None),
    ], "nk int, v string, ValidFromDate date, ValidToDate date")


@pytest.mark.parametrize("unit", ["year", "month"])
def test_asof_boundaries(frame, rows, versions, unit):
    facts = frame([(1, D(2010, 12, 31)), (1, D(2011, 1, 1)), (1, D(2012, 5, 31)), (1, D(2012, 6, 1)),
                   (1, D(2014, 1, 1)), (3, D(2014, 1, 1))], "k int, d date")
    got = lookup.asof_lookup(facts, versions, {"k": "nk"}, "d", {"v": "v"}, slice_unit=unit, **SPAN)
    assert rows(got) == [(1, D(2010, 12, 31), None), (1, D(2011, 1, 1), "a"), (1, D(2012, 5, 31), "a"),
                         (1, D(2012, 6, 1), "b"), (1, D(2014, 1, 1), "b"), (3, D(2014, 1, 1), None)]


def test_asof_outside_the_span_is_still_exact(frame, rows, versions):
    facts = frame([(2, D(1999, 1, 1)), (2, D(2000, 1, 1)), (2, D(2019, 12, 31)), (2, D(2020, 1, 1)),
                   (1, D(2030, 1, 1))], "k int, d date")
    got = lookup.asof_lookup(facts, versions, {"k": "nk"}, "d", {"v": "v"}, **SPAN)
    assert rows(got) == [(1, D(2030, 1, 1), "b"), (2, D(1999, 1, 1), None), (2, D(2000, 1, 1), "c"),
                         (2, D(2019, 12, 31), "c"), (2, D(2020, 1, 1), "d")]


def test_asof_with_inclusive_end(frame, rows):
    prices = frame([(1, 10, D(2012, 1, 1), D(2012, 12, 31)), (1, 12, D(2013, 1, 1), None)],
                   "p int, price int, s date, e date")
    sold = frame([(1, D(2012, 12, 31)), (1, D(2013, 1, 1))], "p2 int, d date")
    got = lookup.asof_lookup(sold, prices, {"p2": "p"}, "d", {"price": "price"}, valid_from="s", valid_to="e",
                             closed=True, **SPAN)
    assert rows(got, "d", "price") == [(D(2012, 12, 31), 10), (D(2013, 1, 1), 12)]


def test_asof_same_column_names_and_two_keys(frame, rows):
    v = frame([(1, "x", 7, D(2012, 1, 1), None)], "a int, b string, out int, ValidFromDate date, ValidToDate date")
    f = frame([(1, "x", D(2012, 1, 1)), (1, "y", D(2012, 1, 1))], "a int, b string, d date")
    got = lookup.asof_lookup(f, v, {"a": "a", "b": "b"}, "d", {"out": "out"}, **SPAN)
    assert rows(got, "b", "out") == [("x", 7), ("y", None)]


def test_facts_without_a_key_stay(frame, rows):
    versions = frame([(1, dt.date(2020, 1, 1), None, 7), (None, dt.date(2020, 1, 1), None, 8)],
                     "k int, ValidFromDate date, ValidToDate date, out int")
    facts = frame([(1, dt.date(2020, 2, 1)), (None, dt.date(2020, 2, 1)), (None, None), (1, None)] * 3, "a int, d date")
    got = lookup.asof_lookup(facts, versions, {"a": "k"}, "d", {"out": "out"}, **SPAN)
    assert sorted((r.a or 0, r.out or 0) for r in got.collect()) == [(0, 0)] * 6 + [(1, 0)] * 3 + [(1, 7)] * 3


def test_band_lookup(frame, rows):
    bands = frame([("fresh", 0, 30), ("aged", 31, 90), ("old", 91, None)], "name string, lo int, hi int")
    df = frame([(-1,), (0,), (30,), (31,), (90,), (91,), (5000,), (None,)], "n int")
    got = lookup.band_lookup(df, bands, "n", {"tier": "name"}, low="lo", high="hi")
    assert rows(got, "n", "tier") == [
        (-1, None), (0, "fresh"), (30, "fresh"), (31, "aged"), (5000, "old"), (90, "aged"), (91, "old"), (None, None)]


def test_band_lookup_of_fractions_and_negatives(frame, rows):
    bands = frame([("deep", -1e12, -8.5), ("low", -8.0, 30.0), ("mid", 31.0, 64.0), ("top", 1e9, None)],
                  "name string, lo double, hi double")
    df = frame([(-9e11,), (-8.25,), (-8.0,), (-0.5,), (30.5,), (30.0,), (63.9,), (64.0,), (1e300,)], "n double")
    got = lookup.band_lookup(df, bands, "n", {"tier": "name"}, low="lo", high="hi")
    assert {r.n: r.tier for r in got.collect()} == {
        -9e11: "deep", -8.25: None, -8.0: "low", -0.5: "low", 30.5: None, 30.0: "low", 63.9: "mid", 64.0: "mid", 1e300: "top"}
    assert got.count() == 9


def test_band_lookup_without_open_band(frame, rows):
    bands = frame([("a", 0, 10), ("b", 11, 20)], "name string, lo int, hi int")
    got = lookup.band_lookup(frame([(20,), (21,), (99,)], "n int"), bands, "n", {"t": "name"}, low="lo", high="hi")
    assert rows(got, "n", "t") == [(20, "b"), (21, None), (99, None)]


def test_orphans_pass_null_keys(frame, rows):
    child = frame([(1, 10), (2, None), (3, 30), (4, 30)], "id int, p int")
    parent = frame([(10,), (10,)], "p int")
    assert rows(lookup.orphans(child, ["p"], parent, ["p"])) == [(3, 30), (4, 30)]
    assert rows(lookup.orphan_counts(child, ["p"], parent, ["p"])) == [(30, 2)]


def test_cascade_splits_children(frame, rows):
    child = frame([(1, 10), (2, 20), (3, None)], "id int, p int")
    kept, gone = lookup.cascade(child, ["p"], frame([(10,)], "p int"), ["p"])
    assert rows(kept, "id") == [(2,), (3,)] and rows(gone, "id") == [(1,)]


def test_childless(frame, rows):
    assert rows(lookup.childless(frame([(1,), (2,)], "k int"), ["k"], frame([(1,), (1,)], "c int"), ["c"])) == [(2,)]


def test_keep_last_and_first(frame, rows):
    df = frame([("a", 1, 5, "x"), ("a", 2, 1, "y"), ("a", 2, 3, "z"), ("b", 1, 1, None)], "k string, t int, i int, v string")
    assert rows(keep.keep_last(df, ["k"], ["t", "i"])) == [("a", 2, 3, "z"), ("b", 1, 1, None)]
    assert rows(keep.keep_first(df, ["k"], ["t", "i"])) == [("a", 1, 5, "x"), ("b", 1, 1, None)]


def test_upsert_prefers_incoming(frame, rows):
    old = frame([(1, "a"), (2, "b")], "k int, v string")
    new = frame([(2, "B"), (3, "c")], "k int, v string")
    once = keep.upsert(old, new, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(keep.upsert(once, new, ["k"])) == rows(once)


def test_daily_state_has_one_row_per_day(frame, rows):
    df = frame([(1, D(2012, 1, 1), 1, "a"), (1, D(2012, 1, 1), 2, "b"), (1, D(2012, 1, 2), 3, "b")],
               "k int, d date, o int, v string")
    assert rows(keep.daily_state(df, ["k"], "d", ["o"], ["v"])) == [(1, D(2012, 1, 1), "b"), (1, D(2012, 1, 2), "b")]


def test_hot_key_spreads_over_slices(spark, versions):
    """A key with almost all facts does not end up in one shuffle partition."""
    facts = spark.range(4000).select(F.lit(1).alias("k"), F.date_add(F.lit(D(2011, 1, 1)), (F.col("id") % 1400).cast("int")).alias("d"))
    got = lookup.asof_lookup(facts, versions, {"k": "nk"}, "d", {"v": "v"}, **SPAN)
    assert got.filter("v IS NULL").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_fslice" in plan and "Cartesian" not in plan


DAYS = st.integers(0, 2600).map(lambda n: D(2009, 6, 1) + dt.timedelta(days=n))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), DAYS), max_size=12, unique=True), st.booleans(),
       st.lists(st.tuples(st.integers(1, 3), DAYS), max_size=20), st.sampled_from(["year", "quarter", "month"]))
def test_asof_against_brute_force(spark, starts, last_is_open, facts, unit):
    """Cut points per key give versions; every fact must find exactly the one that covers it."""
    versions = []
    for k in {k for k, _ in starts}:
        cuts = sorted(d for key, d in starts if key == k)
        for i, d in enumerate(cuts):
            end = cuts[i + 1] if i + 1 < len(cuts) else (None if last_is_open else d + dt.timedelta(days=40))
            versions.append((k, f"{k}@{d}", d, end))
    v = spark.createDataFrame(versions, "nk int, v string, ValidFromDate date, ValidToDate date")
    f = spark.createDataFrame(facts, "k int, d date")
    got = lookup.asof_lookup(f, v, {"k": "nk"}, "d", {"v": "v"}, slice_unit=unit, **SPAN)

    def cover(k, d):
        return next((x for key, x, a, b in versions if key == k and a <= d and (b is None or d < b)), None)

    assert sorted((r.k, r.d, str(r.v)) for r in got.collect()) == sorted((k, d, str(cover(k, d))) for k, d in facts)
