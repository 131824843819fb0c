import datetime as dt

import pytest

from treadle.operators import checks
from treadle.plans import constraints

AT = dt.datetime(2020, 1, 2, 3)
DAY = dt.date(2020, 1, 2)


@pytest.fixture
def bad(frame):
    return frame([
        (1, "ok", 5.0, dt.date(2019, 1, 1), "12"),
        (2, None, -1.0, dt.date(2021, 1, 1), "x"),
        (2, "toolong", None, None, None),
    ], "id int, name string, unitprice double, orderdate date, qty string")


def rules_for(df):
    return checks.column_rules(df.schema, DAY, required=["name"], lengths={"name": 5}, declared={"qty": "int"}) + [
        checks.check_rule("CK_price", "unitprice >= 0"), checks.check_rule("CK_qty", "qty = '12'")]


def test_counts_in_one_pass(bad, rows):
    got = checks.count_violations("t", bad, rules_for(bad))
    assert rows(got, "rule", "severity", "violations") == [
        ("CK_price", "ERROR", 1), ("CK_qty", "ERROR", 1), ("future_orderdate", "WARNING", 1),
        ("length_name", "ERROR", 1), ("negative_unitprice", "ERROR", 1), ("numeric_qty", "ERROR", 1),
        ("required_name", "ERROR", 1)]


def test_check_passes_on_null(frame):
    df = frame([(None,)], "x int")
    assert checks.count_violations("t", df, [checks.check_rule("c", "x > 0")]).collect()[0].violations == 0


def test_duplicates_and_orphans(bad, frame, rows):
    parent = frame([(1,)], "pid int")
    rules = {"t": checks.TableRules((), ("id",), (checks.ForeignKey(("id",), "p", ("pid",)),))}
    got = checks.findings({"t": bad, "p": parent}, rules)
    assert rows(got, "kind", "violations") == [("foreign_key", 2), ("primary_key", 1)]


def test_summary_warnings_do_not_fail(frame, rows):
    df = frame([(1, dt.date(2030, 1, 1))], "id int, duedate date")
    found = checks.findings({"t": df}, {"t": checks.TableRules(tuple(checks.column_rules(df.schema, DAY)), ("id",))})
    got = checks.summarize(found).collect()[0]
    assert (got.status, got.errors, got.warnings) == ("PASS", [], ["Future dates in duedate"])


def test_summary_lists_errors(bad, rows):
    found = checks.findings({"t": bad}, {"t": checks.TableRules(tuple(rules_for(bad)), ("id",))})
    got = checks.summarize(found).collect()[0]
    assert got.status == "FAIL"
    assert got.errors == ["Bad numeric type: qty", "Check failed: CK_price", "Check failed: CK_qty",
                          "Duplicate primary keys", "Longer than 5: name", "Negative values in unitprice",
                          "Nulls in name"]


def test_split_keeps_every_row(bad):
    rules = rules_for(bad)
    good, rejected = checks.split(bad, rules)
    assert (good.count(), rejected.count()) == (1, 2)
    assert {r.part: r.n_rows for r in checks.balance(bad, rules).collect()} == {"input": 3, "accepted": 1, "rejected": 2}


def test_error_records_layout_and_repeatable_ids(bad, rows):
    make = lambda: checks.error_records(bad, "t", rules_for(bad), ["id"], "b1", "validate", AT)
    got = make()
    assert got.dtypes == checks.ERROR_RECORD
    assert got.count() == 7
    assert rows(got, "ErrorID") == rows(make(), "ErrorID")
    first = got.filter("ErrorMessage = 'Check failed: CK_price'").collect()[0]
    assert first.RecordNaturalKey == "2" and '"unitprice":-1.0' in first.FailedData and not first.IsResolved


def test_key_and_orphan_records(bad, frame, rows):
    keyed = checks.key_error_records(bad, "t", ["id"], "b", "v", AT)
    assert rows(keyed, "RecordNaturalKey", "ErrorType") == [("2", "primary_key")] * 2
    fk = checks.ForeignKey(("id",), "p", ("pid",))
    lost = checks.orphan_error_records(bad, "t", fk, frame([(2,)], "pid int"), ["id"], "b", "v", AT)
    assert rows(lost, "RecordNaturalKey", "ErrorMessage") == [("1", "No row in p")]


def test_retry_bookkeeping(bad, frame, rows):
    records = checks.error_records(bad, "t", [checks.required_rule("name"), checks.length_rule("name", 5)], ["id", "name"],
                                   "b", "v", AT)
    solved = frame([("t", "2")], "SourceTable string, RecordNaturalKey string")  # the row without a name
    later = AT + dt.timedelta(days=1)
    once = checks.record_retry(records, solved, later, "reloaded")
    assert rows(once, "RecordNaturalKey", "RetryCount", "IsResolved", "ResolutionComment") == [
        ("2", 1, True, "reloaded"), ("2|toolong", 1, False, None)]
    twice = checks.record_retry(once, solved, later, "again")
    assert rows(twice, "RecordNaturalKey", "RetryCount", "ResolutionComment") == [
        ("2", 1, "reloaded"), ("2|toolong", 2, None)]


def test_declared_rule_counts():
    assert len(constraints.primary_keys()) == 68
    assert sum(map(len, constraints.foreign_keys().values())) == 90
    assert sum(map(len, constraints.check_rules(DAY).values())) == 88
    assert [f.cascade for fks in constraints.foreign_keys().values() for f in fks].count(True) == 2


CASES = [
    ("person.person", "persontype string, emailpromotion int", ("em", 2), ("xx", 3)),
    ("humanresources.employee", "birthdate date, maritalstatus string, gender string, hiredate date, vacationhours smallint, sickleavehours smallint",
     (dt.date(1980, 1, 1), "m", "F", dt.date(2020, 1, 3), 240, 0), (dt.date(2010, 1, 1), "x", "x", dt.date(2020, 1, 4), 241, -1)),
    ("production.billofmaterials", "productassemblyid int, componentid int, startdate date, enddate date, bomlevel smallint, perassemblyqty double",
     (None, 5, dt.date(2010, 1, 1), None, 0, 1.0), (5, 5, dt.date(2010, 1, 1), dt.date(2010, 1, 1), 0, 0.5)),
    ("sales.specialoffer", "startdate date, enddate date, discountpct double, minqty int, maxqty int",
     (dt.date(2010, 1, 1), dt.date(2010, 1, 1), 0.0, 0, None), (dt.date(2010, 1, 2), dt.date(2010, 1, 1), -0.1, -1, -1)),
]


@pytest.mark.parametrize("table,schema,good,broken", CASES)
def test_check_rules_of_wide_tables(frame, table, schema, good, broken):
    rules = constraints.check_rules(DAY)[table]
    df = frame([good, broken], schema)
    counts = {r.rule: r.violations for r in checks.count_violations(table, df, rules).collect()}
    assert set(counts.values()) == {1}, counts


def test_every_check_rule_parses(spark):
    names = {r.name for rules in constraints.check_rules(DAY).values() for r in rules}
    assert len(names) == 88
    for rules in constraints.check_rules(DAY).values():
        for r in rules:
            spark._jsparkSession.sessionState().sqlParser().parseExpression(r.broken)


def test_attempts_add_up_to_the_latest_state(frame, rows):
    rule, fk = checks.required_rule("v"), checks.ForeignKey(("p",), "parent", ("id",))
    rules = checks.TableRules((rule,), ("id",), (fk,))
    df = frame([(1, None, 1), (2, None, 9), (3, "x", 8), (4, "a", 1), (4, "b", 1), (5, None, 1)], "id int, v string, p int")
    parent = frame([(1,)], "id int")
    run = ("b1", "validate", dt.datetime(2020, 1, 1))
    records = checks.union_all([checks.error_records(df, "t", [rule], ["id"], *run), checks.key_error_records(df, "t", ["id"], *run),
                                checks.orphan_error_records(df, "t", fk, parent, ["id"], *run)])
    assert records.count() == 7
    names = {r[0] for r in records.select(checks.rule_name()).distinct().collect()}
    assert names == set(checks.rule_names(rules))
    # row 1 is filled, row 3's parent comes, one of the two rows 4 and row 5 go
    now = frame([(1, "v", 1), (2, None, 9), (3, "x", 8), (4, "a", 1), (7, None, 1)], "id int, v string, p int")
    log = None
    for n in (2, 3):
        state = records if log is None else checks.latest(records, log)
        open_ = state.filter("not IsResolved")
        broken, there = checks.recheck(now, rules, names, ["id"], open_, {"parent": frame([(1,), (8,)], "id int")})
        assert rows(broken, "_natural") == [("2",), ("2",)]
        more = checks.attempt(open_, broken, there, dt.datetime(2020, 1, n))
        log = more if log is None else log.unionByName(more)
    got = checks.latest(records, log)
    assert rows(got, "RecordNaturalKey", "ErrorType", "RetryCount", "IsResolved", "ResolutionComment") == [
        ("1", "required", 1, True, "passed on retry"), ("2", "foreign_key", 2, False, None), ("2", "required", 2, False, None),
        ("3", "foreign_key", 1, True, "passed on retry"), ("4", "primary_key", 1, True, "passed on retry"),
        ("4", "primary_key", 1, True, "passed on retry"), ("5", "required", 1, True, "the row is gone")]
    assert {r.LastAttemptDate.day for r in got.filter("RetryCount = 2").collect()} == {3}
    assert rows(checks.latest(records, log.limit(0))) == rows(records)


def test_findings_scan_each_table_once(spark):
    from treadle.retail import jobs

    plan = jobs.q_summary(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 5


def test_more_rules_than_bits(frame, monkeypatch):
    monkeypatch.setattr(checks, "_BITS", 3)
    df = frame([(k, None if k % 2 else k) for k in range(20)], "id int, v int")
    rules = [checks.check_rule(f"r{n}", f"v IS NOT NULL AND id <> {n}") for n in range(8)]
    own = frame([(1,), (2,)], "id bigint")
    found = checks.findings({"t": df, "p": own}, {"t": checks.TableRules(tuple(rules), ("id",), (checks.ForeignKey(("v",), "p", ("id",)),)),
                                                  "p": checks.TableRules((), ("id",))}).collect()
    got = {(r.table_name, r.rule): r.violations for r in found}
    assert all(got["t", f"r{n}"] == 10 + (n % 2 == 0) for n in range(8))
    assert got["t", "primary_key"] == got["p", "primary_key"] == 0 and got["t", "fk_v"] == 9 and len(got) == 11


def test_a_row_that_breaks_many_rules_is_dealt_out_once(spark):
    df = spark.createDataFrame([(1, -1), (1, None), (2, 5)], "k int, v int")
    named = [checks.Rule(f"r{i}", "check", "v < 0", f"below {i}", checks.ERROR) for i in range(9)]
    rules = checks.TableRules((*named, checks.Rule("gone", "required", "v is null", "no v", checks.ERROR)), ("k",), ())
    got = checks.table_error_records(df, "t", rules, ["k"], "b", "v", dt.datetime(2001, 1, 1), {})
    kinds = {(r.ErrorType, r.ErrorMessage): r["count"] for r in got.groupBy("ErrorType", "ErrorMessage").count().collect()}
    assert kinds == {**{("check", f"below {i}"): 1 for i in range(9)}, ("required", "no v"): 1, ("primary_key", "Duplicate primary keys"): 2}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RebalancePartitions")  # the rows are laid out by rule behind the exchange
