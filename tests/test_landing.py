import datetime as dt

import pytest

from treadle.sources.landing import Filing, Landing, filing
from treadle.sources.catalog import ColumnSpec, TableSpec

T = dt.datetime
HEAD = Filing(("id",), "modifieddate", "orderdate")
PLANS = {"head": HEAD, "line": Filing(("id", "no"), "modifieddate", None, ("head", "id")), "plain": Filing()}


class Source:
    """Tables that may change between batches, and the names that were read."""

    def __init__(self, spark):
        self.spark, self.tables, self.reads = spark, {}, []

    def __call__(self, name):
        self.reads.append(name)
        return self.spark.createDataFrame(*self.tables[name])


@pytest.fixture
def source(spark):
    out = Source(spark)
    heads = [(1, T(2012, 1, 5), "a", T(2012, 1, 5)), (2, T(2012, 2, 5), "b", T(2012, 2, 5)), (3, T(2012, 3, 5), "c", T(2012, 3, 5)),
             (4, None, "d", T(2012, 3, 5))]
    lines = [(1, 1, 10, T(2012, 1, 5)), (2, 1, 20, T(2012, 2, 5)), (3, 1, 30, T(2012, 3, 5)), (3, 2, 31, T(2012, 3, 5)), (9, 1, 90, T(2012, 1, 1))]
    out.tables = {"head": (heads, "id int, orderdate timestamp_ntz, v string, modifieddate timestamp_ntz"),
                  "line": (lines, "id int, no int, amount int, modifieddate timestamp_ntz"),
                  "plain": ([("x", 1), ("x", 1), (None, 2)], "k string, n int")}
    return out


def change(source, name, old, new):
    rows, schema = source.tables[name]
    source.tables[name] = ([r for r in rows if r not in old] + new, schema)


def files(root, name):
    return {str(p.relative_to(root)) for p in (root / name).rglob("*.parquet")}


def state(landing, rows):
    return {n: rows(landing.read(n)) for n in PLANS}


def matches(landing, source, rows):
    for name, (given, _) in source.tables.items():
        assert rows(landing.read(name)) == sorted(given, key=lambda r: tuple((x is None, str(x)) for x in r)), name


def test_increments_touch_their_months_only(spark, source, rows, tmp_path):
    landing = Landing(spark, str(tmp_path), PLANS)
    landing.land(source, "b1")
    matches(landing, source, rows)
    assert sorted(source.reads) == ["head", "line", "plain"]
    assert landing.last("head").months == ["2012-01", "2012-02", "2012-03", "none"]
    assert landing.last("line").months == ["2012-01", "2012-02", "2012-03", "none"] and landing.touched("head", 0) is None
    before = files(tmp_path, "head") | files(tmp_path, "line") | files(tmp_path, "plain")

    # order 1 moves to March, which empties January; a line comes to order 2; order 9 of the lone line appears
    change(source, "head", [(1, T(2012, 1, 5), "a", T(2012, 1, 5))], [(1, T(2012, 3, 9), "a", T(2012, 4, 1)), (9, T(2012, 3, 1), "z", T(2012, 4, 1))])
    change(source, "line", [], [(1, 2, 11, T(2012, 4, 1))])
    landing = Landing(spark, str(tmp_path), PLANS)
    landing.land(source, "b2")
    matches(landing, source, rows)
    assert landing.last("head").months == ["2012-01", "2012-03"] and landing.touched("head", 1) == ["2012-01", "2012-03"]
    assert landing.last("line").months == ["2012-01", "2012-03", "none"] and landing.last("plain").months == []
    assert rows(landing.increment("head"), "id") == [(1,), (9,)] and rows(landing.increment("line"), "id", "no") == [(1, 2)]
    assert rows(landing.read("line", ["2012-03"]), "id", "no") == [(1, 1), (1, 2), (3, 1), (3, 2), (9, 1)]
    kept = {f for f in before if "2012-02" in f or "plain" in f or f.startswith("head/filed_month=none")}
    after = files(tmp_path, "head") | files(tmp_path, "line") | files(tmp_path, "plain")
    assert kept <= after and not any("filed_month=2012-01" in f for f in after)
    assert not (before - kept) & after  # every touched month has new files

    source.reads.clear()
    again = Landing(spark, str(tmp_path), PLANS)
    again.land(source, "b2")  # the batch is done
    assert source.reads == [] and state(again, rows) == state(landing, rows)
    again.land(source, "b3")  # nothing has changed
    assert all(again.last(n).months == [] for n in PLANS) and again.touched("head", 2) == []


def test_a_first_batch_is_staged_without_a_copy(spark, source, rows, tmp_path, monkeypatch):
    """Its rows are looked at once, so they are filed as they are read; a later batch looks at them again."""
    landing, given = Landing(spark, str(tmp_path), PLANS), {}
    staged = landing._stage

    def stage(name, *rest):
        entry = staged(name, *rest)
        given[name, entry.seq] = (tmp_path / "_staged" / name / f"{entry.seq:08d}" / "read").exists()
        return entry

    monkeypatch.setattr(landing, "_stage", stage)
    landing.land(source, "b1")
    matches(landing, source, rows)
    assert given == {("head", 1): False, ("line", 1): False, ("plain", 1): False} and sorted(source.reads) == ["head", "line", "plain"]
    landing.land(source, "b2")
    matches(landing, source, rows)
    assert given["head", 2] and given["line", 2]


def test_tables_without_a_key_are_compared_by_month(spark, source, rows, tmp_path):
    landing = Landing(spark, str(tmp_path), PLANS)
    landing.land(source, "b1")
    source.tables["plain"] = ([("x", 1), (None, 2), ("y", 3)], "k string, n int")
    landing.land(source, "b2")
    matches(landing, source, rows)
    assert landing.last("plain").months == ["all"]


def test_a_stopped_batch_goes_on_from_what_was_staged(spark, source, rows, tmp_path, monkeypatch):
    Landing(spark, str(tmp_path), PLANS).land(source, "b1")
    change(source, "head", [(2, T(2012, 2, 5), "b", T(2012, 2, 5))], [(2, T(2012, 5, 5), "B", T(2012, 5, 5))])
    stopped = Landing(spark, str(tmp_path), PLANS)
    done = []

    def stop(entry):
        if done:
            raise RuntimeError("lost")
        done.append(entry.name)
        original(entry)
    original = stopped._apply_one
    monkeypatch.setattr(stopped, "_apply_one", stop)
    monkeypatch.setattr("treadle.sources.landing.SIDE_BY_SIDE", 1)
    with pytest.raises(RuntimeError):
        stopped.land(source, "b2")
    source.reads.clear()
    landing = Landing(spark, str(tmp_path), PLANS)
    landing.land(source, "b2")
    assert source.reads == []
    matches(landing, source, rows)
    assert landing.last("line").months == ["2012-02", "2012-05"] and all(e.applied for es in landing.entries.values() for e in es)


def test_doubled_keys_are_seen_until_they_are_mended(spark, source, rows, tmp_path):
    rows_, schema = source.tables["head"]
    source.tables["head"] = (rows_ + [(2, T(2012, 2, 6), "B", T(2012, 2, 6))], schema)
    landing = Landing(spark, str(tmp_path), PLANS)
    landing.land(source, "b1")
    assert landing.last("head").twice and not landing.last("line").twice
    landing.land(source, "b2")
    assert landing.last("head").twice
    change(source, "head", [r for r in source.tables["head"][0] if r[0] == 2], [(2, T(2012, 2, 7), "b", T(2012, 6, 1))])
    landing.land(source, "b3")
    assert not landing.last("head").twice
    matches(landing, source, rows)


def test_an_empty_table(spark, source, rows, tmp_path):
    source.tables["head"] = ([], source.tables["head"][1])
    landing = Landing(spark, str(tmp_path), PLANS)
    landing.land(source, "b1")
    assert landing.read("head").count() == 0 and landing.last("line").months == ["none"]
    source.tables["head"] = ([(1, T(2012, 1, 5), "a", T(2012, 1, 5))], source.tables["head"][1])
    landing.land(source, "b2")
    matches(landing, source, rows)
    assert landing.last("line").months == ["2012-01", "none"]


def test_filing_follows_from_the_columns():
    def spec(schema, name, *columns, key=("id",)):
        return TableSpec(schema, name, tuple(ColumnSpec(c, "integer") for c in columns), key)
    header = spec("sales", "salesorderheader", "id", "OrderDate", "ModifiedDate")
    detail = spec("sales", "salesorderdetail", "salesorderid", "modifieddate")
    assert filing(header) == Filing(("id",), "ModifiedDate", "OrderDate")
    assert filing(detail, ["sales.salesorderheader"]).parent == ("sales.salesorderheader", "salesorderid")
    assert filing(detail) == Filing(("id",), "modifieddate", "modifieddate")
    assert filing(spec("person", "person", "id", "modifieddate")).date is None
