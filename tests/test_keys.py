import datetime as dt

from treadle.operators.keys import KeyMap, numbered, with_keys

D = dt.date
BY = ["id", "ValidFromDate"]


def versions(spark, *ids, day=D(2020, 1, 1), parts=3):
    return spark.createDataFrame([(i, day) for i in ids], "id int, ValidFromDate date").repartition(parts)


def test_keys_have_no_gaps_and_stay(spark, tmp_path):
    keys = KeyMap(spark, str(tmp_path / "k"))
    first = {r.id: r.sk for r in keys.keys_of(versions(spark, *range(40)), BY, "sk").collect()}
    assert sorted(first.values()) == list(range(1, 41))
    again = {r.id: r.sk for r in KeyMap(spark, str(tmp_path / "k")).keys_of(versions(spark, *range(20, 60), parts=5), BY, "sk").collect()}
    assert {i: again[i] for i in range(20, 40)} == {i: first[i] for i in range(20, 40)}
    assert sorted(again[i] for i in range(40, 60)) == list(range(41, 61))
    assert keys.keys_of(versions(spark), BY, "sk").count() == 0
    total = keys.table.read()
    assert total.count() == 60 == total.select("sk").distinct().count()


def test_repeated_wishes_get_one_key(spark, tmp_path):
    got = KeyMap(spark, str(tmp_path / "k")).keys_of(versions(spark, 1, 1, 2, 2, 2), BY, "sk").collect()
    assert sorted(r.sk for r in got) == [1, 2]


def test_only_rows_without_a_key_get_one(spark, tmp_path, rows):
    df = spark.createDataFrame([(7, D(2020, 1, 1), None, "a"), (8, D(2020, 1, 1), 99, "b"), (9, D(2020, 1, 1), None, "c")],
                               "id int, ValidFromDate date, sk bigint, v string")
    got = with_keys(spark, str(tmp_path / "k"), df, BY, "sk")
    assert got.columns == df.columns and [r[:1] + r[3:] for r in rows(got)] == [(7, "a"), (8, "b"), (9, "c")]
    assert sorted(r.sk for r in got.collect()) == [1, 2, 99]
    assert rows(with_keys(spark, str(tmp_path / "k"), got, BY, "sk")) == rows(got)


def test_the_map_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("treadle.operators.keys.COMPACT_AFTER", 2)
    keys = KeyMap(spark, str(tmp_path / "k"))
    for i in range(5):
        keys.keys_of(versions(spark, i), BY, "sk")
    assert sorted((r.id, r.sk) for r in keys.table.read().collect()) == [(i, i + 1) for i in range(5)]
    assert len(keys.table.notes()) <= 2


def test_first_keys_follow_from_the_places_of_stored_rows(spark, tmp_path, rows):
    def stored(name, given):
        df = numbered(spark.createDataFrame(given, "id int, ValidFromDate date, sk bigint, v string").repartition(3))
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    day = D(2020, 1, 1)
    plain = with_keys(spark, str(tmp_path / "k"), stored("a", [(i, day, None, f"v{i}") for i in range(40)]), BY, "sk")
    assert plain.columns == [*BY, "sk", "v"] and sorted(r.sk for r in plain.collect()) == list(range(1, 41))
    assert "Exchange hashpartitioning" not in plain._jdf.queryExecution().executedPlan().toString()
    assert rows(KeyMap(spark, str(tmp_path / "k")).table.read()) == rows(plain.select(*BY, "sk"))
    # with keys in the map, as with rows that share a version, rows find theirs there
    more = with_keys(spark, str(tmp_path / "k"), stored("b", [(i, day, None, "w") for i in range(30, 50)]), BY, "sk")
    held = {r.id: r.sk for r in plain.collect()}
    assert {r.id: r.sk for r in more.collect() if r.id < 40} == {i: held[i] for i in range(30, 40)}
    twice = with_keys(spark, str(tmp_path / "t"), stored("c", [(1, day, None, "a"), (1, day, None, "b"), (2, day, None, "c")]), BY, "sk")
    found = {(r.id, r.v): r.sk for r in twice.collect()}
    assert len(found) == 3 and found[1, "a"] == found[1, "b"] and set(found.values()) == {1, 2} and twice.columns == plain.columns
    lacking = with_keys(spark, str(tmp_path / "n"), stored("d", [(None, day, None, "a"), (2, day, None, "c")]), BY, "sk")
    assert lacking.filter("id is null").first().sk is None
    assert with_keys(spark, str(tmp_path / "e"), stored("e", []), BY, "sk").columns == plain.columns
