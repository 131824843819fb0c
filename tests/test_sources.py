import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from treadle.sources import catalog, delimited, extract, readers
from treadle.sources.catalog import ColumnSpec as C, TableSpec

LOAD = dt.datetime(2020, 1, 1)


@pytest.fixture
def information_schema(frame):
    tables = frame([("person", "contact", "BASE TABLE"), ("person", "vcontact", "VIEW"),
                    ("sales", "orders", "BASE TABLE"), ("other", "x", "BASE TABLE")],
                   "table_schema string, table_name string, table_type string")
    columns = frame([
        ("person", "contact", "name", 2, "character varying", "NO", 50, None, None),
        ("person", "contact", "id", 1, "integer", "NO", None, 32, 0),
        ("sales", "orders", "id", 1, "integer", "NO", None, 32, 0),
        ("sales", "orders", "total", 2, "numeric", "YES", None, 8, 2),
        ("sales", "orders", "fee", 3, "numeric", "YES", None, None, None),
        ("other", "x", "id", 1, "integer", "NO", None, 32, 0),
    ], "table_schema string, table_name string, column_name string, ordinal_position int, data_type string, "
       "is_nullable string, character_maximum_length int, numeric_precision int, numeric_scale int")
    constraints = frame([("person", "contact", "pk", "PRIMARY KEY"), ("sales", "orders", "pk", "PRIMARY KEY"),
                         ("sales", "orders", "fk", "FOREIGN KEY")],
                        "table_schema string, table_name string, constraint_name string, constraint_type string")
    usage = frame([("person", "contact", "pk", "id", 1), ("sales", "orders", "pk", "id", 1), ("sales", "orders", "fk", "total", 1)],
                  "table_schema string, table_name string, constraint_name string, column_name string, ordinal_position int")
    return tables, columns, constraints, usage


def test_catalog_from_information_schema(information_schema):
    got = catalog.read_catalog(*information_schema)
    assert list(got) == ["person.contact", "sales.orders"]
    contact = got["person.contact"]
    assert contact.column_names == ("id", "name") and contact.key == ("id",)
    assert contact.required == ("id", "name") and contact.lengths == {"name": 50}
    assert [c.spark_type for c in got["sales.orders"].columns] == ["int", "decimal(8,2)", "decimal(19,4)"]


def test_catalog_through_a_reader(information_schema):
    names = ("tables", "columns", "table_constraints", "key_column_usage")
    views = {f"information_schema.{n}": df for n, df in zip(names, information_schema)}
    assert list(readers.source_catalog(views.__getitem__)) == ["person.contact", "sales.orders"]
    assert list(readers.source_catalog(views.__getitem__, ["sales"])) == ["sales.orders"]


def test_metadata_frames(information_schema, rows):
    tables, columns, constraints, usage = information_schema
    assert [tuple(r) for r in catalog.base_tables(tables).collect()] == [("person", "contact"), ("sales", "orders")]
    assert ("person", "contact", ["id", "name"]) in rows(catalog.table_columns(columns))
    assert len(rows(catalog.required_columns(columns))) == 4
    assert rows(catalog.key_columns(constraints, usage), "table_name", "column_name") == [("contact", "id"), ("orders", "id")]


CLASSES = [
    ("productcosthistory", ["startdate"], "fact"), ("specialoffer", ["startdate", "minqty"], "fact"),
    ("product", ["sellstartdate", "listprice"], "fact"), ("shoppingcartitem", ["quantity", "datecreated"], "dimension"),
    ("store", ["name", "modifieddate"], "dimension"), ("TransactionLog", ["x"], "fact"),
]


@pytest.mark.parametrize("name,columns,kind", CLASSES)
def test_classify(name, columns, kind):
    assert extract.classify(name, columns) == kind


def test_classify_as_a_frame(frame):
    df = frame([(n, c) for n, c, _ in CLASSES], "n string, c array<string>")
    got = [r[0] for r in df.select(extract.table_type(F.col("n"), F.col("c"))).collect()]
    assert got == [k for _, _, k in CLASSES]


def test_extract_rules(frame, rows):
    stamp = "timestamp_ntz"
    frames = {
        "person.person": frame([(1,), (2,)], "id int"),
        "person.password": frame([(1,)], "id int"),
        "sales.store": frame([(1, dt.datetime(2000, 1, 1)), (2, dt.datetime(2000, 1, 1, 0, 0, 1))], f"id int, modifieddate {stamp}"),
        "sales.reason": frame([(1,)], "id int"),
        "sales.orderlog": frame([(1,)], "id int"),
        "sales.orderheader": frame([(1, dt.datetime(2011, 12, 31, 23)), (2, dt.datetime(2012, 1, 1)),
                                    (3, dt.datetime(2014, 12, 31)), (4, dt.datetime(2014, 12, 31, 0, 0, 1))],
                                   f"id int, orderdate {stamp}"),
    }
    got = extract.extract_all(catalog.describe(frames), frames.__getitem__)
    assert sorted(got) == ["person.person", "sales.orderheader", "sales.store"]
    assert rows(got["sales.orderheader"].df, "id") == [(2,), (3,)]
    assert rows(got["sales.store"].df, "id") == [(2,)]
    assert got["sales.orderheader"].type == "fact"


def test_filters_reach_the_scan(spark, tmp_path, frame):
    path = str(tmp_path / "o")
    frame([(1, dt.datetime(2013, 1, 1))], "id int, orderdate timestamp_ntz").write.parquet(path)
    got = extract.within(spark.read.parquet(path), "orderdate", *extract.FACT_WINDOW)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(orderdate" in plan and "LessThanOrEqual(orderdate" in plan


SPEC = TableSpec("person", "thing", (
    C("id", "integer", False), C("code", "character", False, 3), C("flag", "boolean"), C("name", "character varying", True, 50),
    C("cost", "numeric", True, None, 8, 2), C("opens", "time without time zone"), C("born", "date"),
    C("rowguid", "uuid"), C("modifieddate", "timestamp without time zone")))
FILE = (
    "1\tAB \t0\tÅland\t.00\t07:00:00.0000000\t1999-12-31\t{298C2880-AB1C-4982-A5AD-A36EB4BA0D34}\t2014-02-08 10:17:21.587000000\n"
    "2\t   \t1\t\t12.5\t\t\t\t2008-04-30 00:00:00\n"
    "3\tC\t\t\"a\tb\"\t\t23:00:00\t\t\t\n")
#: Lines that can't be loaded, and why.
FAULTY = [("4\tC\t\tx\tbad\t23:00:00\t\t\t\n", ["cost"]), ("5\tC\tmaybe\tx\t3.14159\t25:00:00\t\t\t\n", ["flag", "cost", "opens"]),
          ("6\tC\t\tx\t1\t\t\t\t\tmore\n", ["number of fields"]), ("7\tC\n", ["number of fields"])]


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1"])
def test_delimited_file(spark, tmp_path, encoding):
    path = tmp_path / "thing.csv"
    path.write_bytes(FILE.encode(encoding))
    df = delimited.load_delimited(spark, str(path), SPEC, encoding=encoding.upper())
    got = [tuple(r) for r in df.orderBy("id").collect()]
    assert got == [
        (1, "AB", False, "Åland", Decimal("0.00"), "07:00:00", dt.date(1999, 12, 31),
         "298c2880-ab1c-4982-a5ad-a36eb4ba0d34", dt.datetime(2014, 2, 8, 10, 17, 21, 587000)),
        (2, "", True, None, Decimal("12.50"), None, None, None, dt.datetime(2008, 4, 30)),
        (3, "C", None, "a\tb", None, "23:00:00", None, None, None)]


def test_lines_that_do_not_fit_are_rejects(spark, tmp_path):
    path = tmp_path / "thing.csv"
    path.write_text(FILE + "".join(line for line, _ in FAULTY))
    rows, rejects = delimited.load_with_rejects(spark, str(path), SPEC, loaded_at=LOAD)
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3]
    assert sorted(list(r.reasons) for r in rejects.collect()) == sorted(why for _, why in FAULTY)
    for line, _ in FAULTY:
        path.write_text(FILE + line)
        with pytest.raises(Exception, match="can't load"):
            delimited.load_delimited(spark, str(path), SPEC).collect()


def test_quoted_line_breaks(spark, tmp_path):
    spec = TableSpec("person", "note", (C("id", "integer"), C("note", "text")))
    path = tmp_path / "note.csv"
    path.write_text('1\t"two\nlines"\n2\tone\n')
    got = delimited.load_delimited(spark, str(path), spec, line_breaks=True).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "two\nlines"), (2, "one")]


def test_defaults_fill_nulls_only(spark, frame):
    df = frame([(1, None, None, None, None), (2, "g", True, 7, dt.datetime(2001, 1, 1))],
               "businessentityid int, rowguid string, namestyle boolean, emailpromotion int, modifieddate timestamp_ntz")
    a, b = delimited.with_defaults(df, "person.person", LOAD).orderBy("businessentityid").collect()
    assert (a.namestyle, a.emailpromotion, a.modifieddate) == (False, 0, LOAD) and len(a.rowguid) == 36
    assert (b.rowguid, b.namestyle, b.emailpromotion, b.modifieddate) == ("g", True, 7, dt.datetime(2001, 1, 1))


def test_load_only_columns_and_hex_codes(spark, tmp_path):
    spec = TableSpec("production", "productdocument", (C("productid", "integer"), C("doc", "character varying"),
                                                       C("modifieddate", "timestamp without time zone")))
    path = tmp_path / "d.csv"
    path.write_text("317\t6AC0\t2013-12-29 13:51:58.103000000\n")
    got = delimited.load_delimited(spark, str(path), spec).collect()[0]
    assert (got.productid, got.documentnode) == (317, "/2/1/") and "doc" not in got.asDict()


def test_records_that_span_lines(spark, tmp_path):
    spec = TableSpec("production", "productreview", (C("id", "integer"), C("who", "character varying"),
                                                     C("comments", "text"), C("modifieddate", "timestamp without time zone")))
    path = tmp_path / "r.csv"
    path.write_text("1\tAnn\tfirst line\nsecond 3 line\n\nlast\t2013-09-18 00:00:00\n2\tBob\t\t2013-11-13 00:00:00\n")
    got = [tuple(r) for r in delimited.load_records(spark, str(path), spec).orderBy("id").collect()]
    assert got == [(1, "Ann", "first line\nsecond 3 line\n\nlast", dt.datetime(2013, 9, 18)),
                   (2, "Bob", None, dt.datetime(2013, 11, 13))]


def test_records_across_file_blocks(spark, tmp_path):
    """Files read in many small blocks give the same records."""
    spec = TableSpec("production", "productreview", (C("id", "integer"), C("comments", "text"), C("mark", "character varying")))
    want = []
    for f in range(2):
        text = ""
        for i in range(40):
            body = "\n".join(f"line {k} of {i}" for k in range(i % 7))
            text += f"{f * 100 + i}\t{body}\tend\n"
            want.append((f * 100 + i, body or None, "end"))
        (tmp_path / f"r{f}.csv").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opening = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = delimited.load_records(spark, str(tmp_path), spec)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert sorted(tuple(r) for r in df.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", opening)


def test_load_source_picks_the_right_loader(spark, tmp_path):
    specs = {"person.address": TableSpec("person", "address", (C("addressid", "integer"), C("city", "character varying"))),
             "person.thing": SPEC}
    (tmp_path / "a.csv").write_bytes("1\tMünchen\n".encode("iso-8859-1"))
    (tmp_path / "t.csv").write_text(FILE)
    files = {"person.address": str(tmp_path / "a.csv"), "person.thing": str(tmp_path / "t.csv")}
    got = delimited.load_source(spark, files, specs)
    assert got["person.address"].collect()[0].city == "München" and got["person.thing"].count() == 3
    read = readers.delimited_reader(spark, files, specs)
    assert read("person.address").collect()[0].city == "München"


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "person.person", {"user": "u"})
    assert plain == {"url": "jdbc:x", "dbtable": "person.person", "fetchsize": "10000", "user": "u"}
    split = readers.jdbc_options("jdbc:x", "t", column="id", low=1, high=9, parts=4)
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "4")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", column="id")


def test_parquet_and_table_readers(spark, tmp_path, frame):
    frame([(1,)], "id int").write.parquet(str(tmp_path / "person.thing.parquet"))
    assert readers.parquet_reader(spark, str(tmp_path))("person.thing").count() == 1
    frame([(1,), (2,)], "id int").createOrReplaceTempView("thing_view")
    assert readers.table_reader(spark)("thing_view").count() == 2
