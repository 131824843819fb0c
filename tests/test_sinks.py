import datetime as dt

import pytest

from treadle.operators import sinks
from treadle.session import run_folder, shared_folder

D = dt.date


def test_write_months_replaces_only_its_months(spark, tmp_path, frame, rows):
    path = str(tmp_path / "m")
    schema = "d date, v int"
    sinks.write_months(frame([(D(2014, 1, 5), 1), (D(2014, 2, 5), 2), (D(2031, 7, 1), 3)], schema), path, "d", ["d"])
    again = frame([(D(2014, 2, 6), 20), (D(2014, 2, 7), 21)], schema)
    for _ in range(2):
        sinks.write_months(again, path, "d", ["d"])
    assert rows(sinks.read_months(spark, path), "d", "v", "month") == [
        (D(2014, 1, 5), 1, "2014-01"), (D(2014, 2, 6), 20, "2014-02"), (D(2014, 2, 7), 21, "2014-02"),
        (D(2031, 7, 1), 3, "2031-07")]
    assert rows(sinks.read_months(spark, path, ["2014-01"]), "v") == [(1,)]


def test_write_days_keeps_other_days_of_the_month(spark, tmp_path, frame, rows):
    path = str(tmp_path / "d")
    for day, v in ((1, 10), (2, 20), (2, 21)):
        sinks.write_days(frame([(D(2014, 6, day), v)], "d date, v int"), path, "d", ["v"])
    assert rows(sinks.read_months(spark, path, ["2014-06"]), "d", "v") == [(D(2014, 6, 1), 10), (D(2014, 6, 2), 21)]


def test_month_filter_prunes_folders(spark, tmp_path, frame):
    path = str(tmp_path / "m")
    sinks.write_months(frame([(D(2014, m, 5), m) for m in range(1, 7)], "d date, v int"), path, "d")
    plan = sinks.read_months(spark, path, ["2014-03"])._jdf.queryExecution().executedPlan().toString()
    assert "(month" in plan.split("PartitionFilters: ")[1].split("]")[0] and "= 2014-03" in plan


def test_a_batch_is_added_once(spark, tmp_path, frame, rows):
    table = sinks.BatchTable(spark, str(tmp_path / "b"))
    assert table.read("d date, v int").count() == 0 and not table.exists()
    one = frame([(D(2014, 1, 5), 1), (D(2014, 2, 5), 2), (None, 3)], "d date, v int")
    assert table.append(one, "b1", "d") and not table.append(one, "b1", "d")
    assert table.append(frame([(D(2014, 2, 6), 4)], "d date, v int"), "b2", "d") and table.batches() == ["b1", "b2"]
    assert rows(table.read(), "v") == [(1,), (2,), (3,), (4,)]
    assert rows(table.read(months=["2014-02"]), "v") == [(2,), (4,)] and table.read(months=["2013-01"]).count() == 0
    # what a failed job left does not count
    dead = tmp_path / "b" / "v00000009-dead"
    one.write.parquet(str(dead))
    assert rows(table.read(), "v") == [(1,), (2,), (3,), (4,)] and table.prune() == []


def test_a_batch_whose_task_failed_halfway_adds_its_rows_once(spark, tmp_path, frame, rows):
    table = sinks.BatchTable(spark, str(tmp_path / "b"))
    table.append(frame([(1,)], "v int"), "b1")
    broken = frame([(k,) for k in range(100)], "v int").repartition(4).selectExpr("assert_true(v < 99) as t", "v").drop("t").filter("v >= 0")
    failing = broken.selectExpr("if(v = 99, raise_error('lost'), v) as v")
    try:
        table.append(failing, "b2")
    except Exception as lost:  # noqa: BLE001
        assert "lost" in str(lost)
    assert table.batches() == ["b1"] and rows(table.read()) == [(1,)]
    assert table.append(frame([(2,)], "v int"), "b2") and rows(table.read()) == [(1,), (2,)]
    table.append(frame([(3,)], "v int"), "b3")
    table.compact()
    assert len(table.notes()) == 1 and table.batches() == ["b1", "b2", "b3"] and rows(table.read()) == [(1,), (2,), (3,)]
    assert not table.append(frame([(2,)], "v int"), "b2")


def test_a_splice_rewrites_its_buckets_only(spark, tmp_path, frame, rows):
    from treadle.operators import history

    table = sinks.HistoryTable(spark, str(tmp_path / "dim"), key=["id"], buckets=8)
    for day in (1, 5, 9):
        staged = frame([(i, f"v{day}") for i in range(30)], "id int, v string")
        step = (history.first_load(staged, ["id"], "sk", D(2020, 1, day)) if not table.exists()
                else history.scd2(table.read_open(), staged, ["id"], ["v"], "sk", D(2020, 1, day)))
        table.write_step(step)
    before, files = rows(table.read()), {str(p) for p in (tmp_path / "dim").rglob("*.parquet")}
    late = frame([(7, D(2020, 1, 3), "x")], "id int, day date, v string")
    bucket = late.select(table.bucket()).first()[0]
    closed = table.read_closed([bucket])
    own = closed.unionByName(table.read_open()).filter("id = 7")
    spliced = history.splice(own, late, ["id"], ["v"], "sk", "day", D(2020, 1, 10))
    table.write_step(table.read_open().filter("id <> 7").unionByName(closed.filter("id <> 7")).unionByName(spliced), whole=[bucket])
    after = rows(table.read())
    assert [r for r in after if r[1] != 7] == [r for r in before if r[1] != 7]
    assert [tuple(r[2:5]) for r in sorted((r for r in after if r[1] == 7), key=lambda r: r[3])] == [
        ("v1", D(2020, 1, 1), D(2020, 1, 3)), ("x", D(2020, 1, 3), D(2020, 1, 5)), ("v5", D(2020, 1, 5), D(2020, 1, 9)), ("v9", D(2020, 1, 9), None)]
    now = {str(p) for p in (tmp_path / "dim").rglob("*.parquet")}
    assert files <= now  # nothing of before was touched
    new = [p for p in now - files if "IsCurrent=false" in p]
    assert new and all(f"KeyBucket={bucket}" in p for p in new)
    table.write_full(table.read())
    assert rows(table.read()) == after


def test_out_of_range(frame, rows):
    from pyspark.sql import functions as F

    df = frame([(D(2013, 12, 31),), (D(2014, 1, 1),), (D(2015, 1, 1),), (None,)], "d date")
    assert rows(df.filter(sinks.out_of_range(F.col("d"), None, D(2015, 1, 1)))) == [(D(2015, 1, 1),), (None,)]
    assert len(rows(df.filter(sinks.out_of_range(F.col("d"), D(2014, 1, 1), None)))) == 2


def test_versions_switch_when_complete(spark, tmp_path, frame, rows):
    table = sinks.VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    assert table.read("id int").count() == 0
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(frame([(1,)], "id int"), keys=["id"])
    # a version may be built from the one it replaces
    table.write(table.read().union(frame([(2,)], "id int")), keys=["id"])
    assert rows(table.read()) == [(1,), (2,)] and len(table.versions()) == 2
    # a version without its commit marker does not count
    (tmp_path / "t" / "v00000009-dead").mkdir()
    assert rows(table.read()) == [(1,), (2,)]


def test_history_table_keeps_closed_rows_of_every_run(spark, tmp_path, frame, rows):
    from treadle.operators import history

    table = sinks.HistoryTable(spark, str(tmp_path / "dim"))
    def staged(*r):
        return frame(list(r), "id int, v string")

    days = [(D(2020, 1, 1), [(1, "a"), (2, "x")]), (D(2020, 1, 2), [(1, "b"), (2, "x")]), (D(2020, 1, 3), [(1, "c"), (2, "x")]),
            (D(2020, 1, 3), [(1, "c"), (2, "y")]), (D(2020, 1, 3), [(1, "c"), (2, "y")])]
    for day, data in days:
        step = (history.first_load(staged(*data), ["id"], "sk", day) if not table.exists()
                else history.scd2(table.read_open(), staged(*data), ["id"], ["v"], "sk", day))
        table.write_step(step, keys=["id"])
    want = [(1, "a", D(2020, 1, 1), D(2020, 1, 2), False), (1, "b", D(2020, 1, 2), D(2020, 1, 3), False),
            (1, "c", D(2020, 1, 3), None, True), (2, "x", D(2020, 1, 1), D(2020, 1, 3), False), (2, "y", D(2020, 1, 3), None, True)]
    columns = ["id", "v", "ValidFromDate", "ValidToDate", "IsCurrent"]
    assert rows(table.read(), *columns) == want
    assert table.read().columns == ["sk", *columns]
    # a run that did not commit adds nothing
    dead = tmp_path / "dim" / "v00000099-dead" / "IsCurrent=false"
    dead.mkdir(parents=True)
    assert rows(table.read(), *columns) == want
    # a full rewrite replaces what earlier runs closed
    late = frame([(1, "a2", D(2020, 1, 1))], "id int, v string, day date")
    table.write_full(history.absorb_late(table.read(), late, ["id"], ["v"], "sk", "day"))
    assert rows(table.read(), *columns) == [(1, "a2", D(2020, 1, 1), D(2020, 1, 2), False), *want[1:]]
    table.write_step(history.scd2(table.read_open(), staged((1, "c"), (2, "z")), ["id"], ["v"], "sk", D(2020, 1, 4)))
    assert len(rows(table.read())) == 6


def test_prune_keeps_what_readers_need(spark, tmp_path, frame, rows):
    from treadle.operators import history

    plain = sinks.VersionedTable(spark, str(tmp_path / "t"))
    for i in range(4):
        plain.write(frame([(i,)], "id int"))
    assert len(plain.prune(keep=2)) == 2 and len(plain.versions()) == 2 and rows(plain.read()) == [(3,)]

    dim = sinks.HistoryTable(spark, str(tmp_path / "dim"))
    for day, value in enumerate("abcd", 1):
        staged = frame([(1, value)], "id int, v string")
        dim.write_step(history.first_load(staged, ["id"], "sk", D(2020, 1, day)) if not dim.exists()
                       else history.scd2(dim.read_open(), staged, ["id"], ["v"], "sk", D(2020, 1, day)))
    before = rows(dim.read())
    dim.prune(keep=1)
    assert rows(dim.read()) == before and len(before) == 4
    dim.write_full(dim.read())
    assert dim.prune(keep=1) and rows(dim.read()) == before and len(dim.versions()) == 1


def test_a_month_that_comes_out_empty_is_cleared(spark, tmp_path, frame, rows):
    path, schema = str(tmp_path / "m"), "k int, day date"
    sinks.write_months(frame([(1, D(2020, 1, 5)), (2, D(2020, 2, 5)), (3, D(2020, 3, 5))], schema), path, "day")
    sinks.write_months(frame([(4, D(2020, 1, 6))], schema), path, "day", replaced=["2020-01", "2020-02"])
    assert rows(sinks.read_months(spark, path), "k") == [(3,), (4,)]
    sinks.write_months(frame([], schema), path, "day", replaced=["2020-03"])
    assert rows(sinks.read_months(spark, path), "k") == [(4,)]


def test_a_read_costs_the_same_calls_at_any_number_of_versions(spark, tmp_path, frame, monkeypatch):
    from treadle.operators import history

    dim = sinks.HistoryTable(spark, str(tmp_path / "dim"))
    calls = []
    for day in range(1, 7):
        staged = frame([(1, str(day))], "id int, v string")
        dim.write_step(history.first_load(staged, ["id"], "sk", D(2020, 1, day)) if not dim.exists()
                       else history.scd2(dim.read_open(), staged, ["id"], ["v"], "sk", D(2020, 1, day)))
        if day in (2, 6):
            with monkeypatch.context() as m:
                seen = []
                m.setattr(sinks, "folder_exists", lambda *a: seen.append("exists"))
                m.setattr(sinks.VersionedTable, "_path", lambda self, *p, own=sinks.VersionedTable._path: seen.append(p) or own(self, *p))
                assert dim.read().count() == day
                calls.append(len(seen))
    assert calls[0] == calls[1] == 2


def test_empty_history_table_is_not_loaded(spark, tmp_path, frame):
    from treadle.operators import history

    table = sinks.HistoryTable(spark, str(tmp_path / "dim"))
    table.write_step(history.first_load(frame([], "id int, v string"), ["id"], "sk", D(2020, 1, 1)))
    assert not table.exists()


def test_history_table_with_all_rows_closed(spark, tmp_path, frame, rows):
    from treadle.operators import history

    table = sinks.HistoryTable(spark, str(tmp_path / "dim"))
    table.write_step(history.first_load(frame([(1, "a")], "id int, v string"), ["id"], "sk", D(2020, 1, 1)))
    none = frame([], "id int, v string")
    table.write_step(history.scd2(table.read_open(), none, ["id"], ["v"], "sk", D(2020, 1, 2), close_missing=True))
    assert table.read_open().count() == 0
    assert rows(table.read(), "id", "ValidToDate", "IsCurrent") == [(1, D(2020, 1, 2), False)]


def test_sorted_write(spark, tmp_path, frame):
    path = str(tmp_path / "s")
    sinks.write_sorted(frame([(3,), (1,), (2,)], "k int"), path, ["k"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    a, b = run_folder(spark, "x"), run_folder(spark, "x")
    assert a != b and a.startswith(folder)
