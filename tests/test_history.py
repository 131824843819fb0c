import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from treadle.operators import history, keep

D = dt.date
KEY, TRACKED = ["id"], ["v"]


def dim(df, day, **kw):
    return history.first_load(df, KEY, "sk", day, **kw)


def step(current, df, day, **kw):
    return history.scd2(current, df, KEY, TRACKED, "sk", day, **kw)


@pytest.fixture
def staged(frame):
    return lambda rows: frame(rows, "id int, v string, note string")


def test_new_changed_unchanged(staged, rows):
    d1 = dim(staged([(1, "a", "n"), (2, "b", "n"), (3, None, "n"), (4, "z", "n")]), D(2020, 1, 1))
    d2 = step(d1, staged([(1, "a", "other"), (2, "B", "n"), (3, None, "n"), (5, "e", "n")]), D(2020, 1, 2))
    assert rows(d2, "id", "v", "note", "ValidFromDate", "ValidToDate", "IsCurrent") == [
        (1, "a", "other", D(2020, 1, 1), None, True),
        (2, "B", "n", D(2020, 1, 2), None, True),
        (2, "b", "n", D(2020, 1, 1), D(2020, 1, 2), False),
        (3, None, "n", D(2020, 1, 1), None, True),
        (4, "z", "n", D(2020, 1, 1), None, True),
        (5, "e", "n", D(2020, 1, 2), None, True)]
    assert len({r.sk for r in d2.collect()}) == 6


def test_null_to_value_is_a_change(staged, rows):
    d2 = step(dim(staged([(1, None, "n")]), D(2020, 1, 1)), staged([(1, "x", "n")]), D(2020, 1, 2))
    assert rows(d2, "v", "IsCurrent") == [("x", True), (None, False)]


def test_same_day_run_is_a_no_op_and_keeps_one_row(staged, rows):
    d1 = dim(staged([(1, "a", "n")]), D(2020, 1, 1))
    second = staged([(1, "b", "n")])
    d2 = step(d1, second, D(2020, 1, 2))
    assert rows(step(d2, second, D(2020, 1, 2))) == rows(d2)
    d3 = step(d2, staged([(1, "c", "n")]), D(2020, 1, 2))
    assert rows(d3, "v", "ValidFromDate", "IsCurrent") == [("a", D(2020, 1, 1), False), ("c", D(2020, 1, 2), True)]


def test_close_missing(staged, rows):
    d2 = step(dim(staged([(1, "a", "n"), (2, "b", "n")]), D(2020, 1, 1)), staged([(1, "a", "n")]), D(2020, 1, 5),
              close_missing=True)
    assert rows(d2, "id", "ValidToDate", "IsCurrent") == [(1, None, True), (2, D(2020, 1, 5), False)]


def test_key_comes_back_after_closing(staged, rows):
    d1 = dim(staged([(1, "a", "n")]), D(2020, 1, 1))
    d2 = step(d1, staged([]), D(2020, 1, 2), close_missing=True)
    d3 = step(d2, staged([(1, "a", "n")]), D(2020, 1, 3))
    assert rows(d3, "ValidFromDate", "ValidToDate", "IsCurrent") == [
        (D(2020, 1, 1), D(2020, 1, 2), False), (D(2020, 1, 3), None, True)]


def test_load_time_interval(staged, rows):
    d1 = dim(staged([(1, "a", "n")]), D(2020, 1, 1), opening=D(2000, 1, 1), effective=True)
    d2 = step(d1, staged([(1, "b", "n")]), D(2020, 1, 9))
    assert rows(d2, "ValidFromDate", "ValidToDate", "EffectiveStartDate", "EffectiveEndDate") == [
        (D(2000, 1, 1), D(2020, 1, 9), D(2020, 1, 1), D(2020, 1, 9)), (D(2020, 1, 9), None, D(2020, 1, 9), None)]


def test_late_day_changes_nothing_in_the_merge(staged, rows):
    d1 = dim(staged([(1, "a", "n")]), D(2020, 1, 10))
    assert rows(step(d1, staged([(1, "old", "n")]), D(2020, 1, 5))) == rows(d1)


def test_absorb_late(staged, frame, rows):
    d2 = step(dim(staged([(1, "a", "n"), (2, "k", "n")]), D(2020, 1, 1)), staged([(1, "c", "n"), (2, "k", "n")]), D(2020, 1, 10))
    late = frame([(1, "b", "n", D(2020, 1, 5))], "id int, v string, note string, day date")
    got = history.absorb_late(d2, late, KEY, TRACKED, "sk", "day")
    assert rows(got, "id", "v", "ValidFromDate", "ValidToDate", "IsCurrent") == [
        (1, "a", D(2020, 1, 1), D(2020, 1, 5), False), (1, "b", D(2020, 1, 5), D(2020, 1, 10), False),
        (1, "c", D(2020, 1, 10), None, True), (2, "k", D(2020, 1, 1), None, True)]


def test_change_set_counts_every_staging_row_once(frame, rows):
    new = frame([(1, "a", None), (2, "x", "p"), (3, "n", "p"), (4, None, None)], "id int, v string, w string")
    old = frame([(1, "a", None), (2, "y", "p"), (4, "q", None)], "id int, V string, W string")
    got = history.change_set(new, old, ["id"], {"v": "V", "w": "W"})
    assert rows(got, "id", "change_type") == [(1, "unchanged"), (2, "changed"), (3, "new"), (4, "changed")]


def test_scd1(frame, rows):
    got = history.scd1(frame([(1, "a"), (2, "b")], "k int, v string"), frame([(2, "c")], "k int, v string"), ["k"])
    assert rows(got) == [(1, "a"), (2, "c")]


OBSERVED = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 12), st.sampled_from(["a", "b", None])), max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(OBSERVED)
def test_versions_against_brute_force(spark, observed):
    """Intervals never overlap, one row is open per key, and neighbours differ."""
    start = D(2020, 1, 1)
    rows = [(k, start + dt.timedelta(days=d), i, v) for i, (k, d, v) in enumerate(observed)]
    df = spark.createDataFrame(rows, "id int, day date, n int, v string")
    got = history.versions(keep.daily_state(df, KEY, "day", ["n"], ["v"]), KEY, "day", TRACKED)
    got = sorted((r.id, r.ValidFromDate, r.ValidToDate, r.v, r.IsCurrent) for r in got.collect())
    want = []
    for k in sorted({r[0] for r in rows}):
        last = {}
        for _, day, n, v in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
            last[day] = v
        cuts = []
        for day in sorted(last):
            if not cuts or cuts[-1][1] != last[day]:
                cuts.append((day, last[day]))
        want += [(k, day, cuts[i + 1][0] if i + 1 < len(cuts) else None, v, i + 1 == len(cuts))
                 for i, (day, v) in enumerate(cuts)]
    assert got == sorted(want, key=lambda r: (r[0], r[1]))


def naive_splice(versions, late, tracked_all=True):
    """Versions as (start, end, v) after late (day, v), one by one."""
    out = sorted(versions)
    for day, v in sorted(late):
        starts = [o[0] for o in out]
        if day in starts:
            k = starts.index(day)
            out[k] = (day, out[k][1], v)
            continue
        held = next((o for o in out if o[0] < day and (o[1] is None or day < o[1])), None)
        later = min((s for s in starts if s > day), default=None)
        if held:
            if held[2] == v:
                continue
            out.remove(held)
            out += [(held[0], day, held[2]), (day, held[1], v)]
        else:
            out.append((day, later, v))
        out.sort()
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(1, 20), st.sampled_from("abc")), min_size=1, max_size=5), min_size=1, max_size=8),
       st.lists(st.lists(st.tuples(st.integers(1, 22), st.sampled_from("abc")), max_size=3), min_size=8, max_size=8), st.booleans())
def test_splice_equals_one_cut_after_the_other(spark, versions, late, ended):
    rows, want, seen = [], {}, []
    for k, starts in enumerate(versions):
        own = sorted(dict(starts).items())
        own = [(D(2020, 1, s), D(2020, 1, own[i + 1][0]) if i + 1 < len(own) else (D(2020, 1, 21) if ended else None), v)
               for i, (s, v) in enumerate(own)]
        rows += [(100 * k + i, k, v, "n", s, e, e is None) for i, (s, e, v) in enumerate(own)]
        new = [(D(2020, 1, s), v) for s, v in dict(late[k]).items()]
        seen += [(k, d, v) for d, v in new]
        want[k] = naive_splice(own, new)
    df = spark.createDataFrame(rows, "sk bigint, id int, v string, note string, ValidFromDate date, ValidToDate date, IsCurrent boolean")
    got = history.splice(df, spark.createDataFrame(seen, "id int, day date, v string"), KEY, TRACKED, "sk", "day", D(2020, 2, 1))
    assert got.columns == df.columns
    by, old = {}, {(r[1], r[4]): r[0] for r in rows}
    for r in got.collect():
        by.setdefault(r.id, []).append((r.ValidFromDate, r.ValidToDate, r.v))
        assert r.IsCurrent == (r.ValidToDate is None) and r.note == "n"
        assert old.get((r.id, r.ValidFromDate), r.sk) == r.sk
    assert {k: sorted(v, key=lambda x: x[0]) for k, v in by.items()} == want


def test_splice_carries_what_was_not_observed(spark, rows):
    df = spark.createDataFrame([(1, 5, "a", "old", D(2020, 1, 5), D(2020, 1, 9), False, D(2020, 1, 5), D(2020, 1, 9)),
                                (2, 5, "b", None, D(2020, 1, 9), None, True, D(2020, 1, 9), None)],
                               "sk bigint, id int, v string, note string, ValidFromDate date, ValidToDate date, IsCurrent boolean, "
                               "EffectiveStartDate date, EffectiveEndDate date")
    late = spark.createDataFrame([(5, D(2020, 1, 2), "z"), (5, D(2020, 1, 7), "c"), (5, D(2020, 1, 12), None)], "id int, day date, v string")
    got = history.splice(df, late, KEY, TRACKED, "sk", "day", D(2020, 2, 1), history.key_later)
    assert rows(got, "ValidFromDate", "ValidToDate", "v", "note", "sk", "IsCurrent", "EffectiveEndDate") == [
        (D(2020, 1, 2), D(2020, 1, 5), "z", "old", None, False, D(2020, 2, 1)),
        (D(2020, 1, 5), D(2020, 1, 7), "a", "old", 1, False, D(2020, 1, 9)),
        (D(2020, 1, 7), D(2020, 1, 9), "c", "old", None, False, D(2020, 2, 1)),
        (D(2020, 1, 9), D(2020, 1, 12), "b", None, 2, False, D(2020, 2, 1)),
        (D(2020, 1, 12), None, None, None, None, True, None)]
