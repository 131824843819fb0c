import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from treadle.functions import hierarchy, scalars, xml


def one(df):
    return tuple(df.collect()[0])


def test_names(frame):
    df = frame([("Ann", None, "Lee"), (None, "B", None)], "f string, m string, l string")
    got = df.select(scalars.short_name(F.col("f"), F.col("l")), scalars.full_name(F.col("f"), F.col("m"), F.col("l")))
    assert [tuple(r) for r in got.collect()] == [("Ann Lee", "Ann Lee"), ("", None)]


def test_full_name_with_middle(frame):
    df = frame([("Ann", "Q.", "Lee")], "f string, m string, l string")
    assert one(df.select(scalars.full_name(F.col("f"), F.col("m"), F.col("l")))) == ("Ann Q. Lee",)


def test_fiscal_year_turns_on_first_of_july(frame):
    df = frame([(dt.date(2013, 6, 30),), (dt.date(2013, 7, 1),)], "d date")
    assert [r[0] for r in df.select(scalars.fiscal_year(F.col("d"))).collect()] == [2013, 2014]


def test_week_starts_on_sunday(frame):
    df = frame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),)], "d date")  # Saturday, Sunday
    assert [r[0] for r in df.select(scalars.week_start(F.col("d"))).collect()] == [
        dt.date(2023, 12, 31), dt.date(2024, 1, 7)]


def test_formulas(frame):
    df = frame([(Decimal("10.0000"), Decimal("0.1000"), 3, None)],
               "p decimal(19,4), d decimal(19,4), q int, x decimal(19,4)")
    got = df.select(
        scalars.line_total(F.col("p"), F.col("d"), F.col("q")), scalars.line_total(F.col("x"), F.col("d"), F.col("q")),
        scalars.total_due(F.col("p"), F.col("p"), F.col("d")), scalars.order_number(F.lit(43659)),
        scalars.account_number(F.lit(1)), scalars.account_number(F.lit(1234567890)), scalars.stocked(F.lit(5), F.lit(2)))
    assert one(got) == (Decimal("27.0000"), Decimal("0.0000"), Decimal("20.1000"), "SO43659", "AW00000001",
                        "AW1234567890", 3)


def test_text_cleaning(frame):
    df = frame([("{AB-CD}", "$1,234.50", "1", "07:00:00.0000000")], "u string, m string, f string, t string")
    got = df.select(scalars.clean_uuid(F.col("u")), scalars.money(F.col("m")), scalars.flag(F.col("f")),
                    scalars.clock(F.col("t")))
    assert one(got) == ("ab-cd", Decimal("1234.5000"), True, "07:00:00")


def test_years_since_and_ratio(frame):
    df = frame([(dt.date(2009, 12, 31), 1, 0), (None, 1, 4)], "d date, a int, b int")
    got = df.select(scalars.years_since(F.col("d"), F.lit(dt.date(2014, 1, 1))), scalars.ratio(F.col("a"), F.col("b"), 100.0))
    assert [tuple(r) for r in got.collect()] == [(5, None), (0, 25.0)]


def test_pick_fills_missing_columns(frame):
    got = scalars.pick(frame([(1,)], "A int"), [("a", "bigint"), ("b", "string")])
    assert got.dtypes == [("a", "bigint"), ("b", "string")]
    assert one(got) == (1, None)


def test_without_ignores_case_and_absent_names(frame):
    assert scalars.without(frame([(1, 2)], "id int, ModifiedDate int"), "modifieddate", "x").columns == ["id"]


def test_hierarchy_known_codes(frame):
    known = {"5AC0": "/1/1/", "6AC0": "/2/1/", "7AC0": "/3/1/", "7B40": "/3/2/", "7BC0": "/3/3/", "7C20": "/3/4/",
             None: "/", "": "/"}
    df = frame([(k,) for k in known], "h string")
    got = {r.h: r.p for r in df.select("h", hierarchy.decode(F.col("h")).alias("p")).collect()}
    assert got == known


def test_hierarchy_round_trip_over_all_code_ranges(frame):
    paths = [[n] for n in (0, 3, 4, 7, 8, 15, 16, 17, 31, 32, 79, 80, 81, 127, 500, 1103)]
    paths += [[1, 2, 3], [79, 80, 1103, 0, 4, 8, 16], [1103] * 12]
    df = frame([(p,) for p in paths], "p array<bigint>")
    got = df.select("p", hierarchy.decode(hierarchy.encode(F.col("p"))).alias("d")).collect()
    assert all(r.d == "/" + "".join(f"{n}/" for n in r.p) for r in got)


def test_hierarchy_dotted_label(frame):
    # 01 01 0 (1.) 01 10 1 (2/) -> 0101 0011 01 padded to 0101001101000000
    df = frame([("5340",)], "h string")
    assert one(df.select(hierarchy.decode(F.col("h")))) == ("/1.2/",)


def test_tree_counts_descendants(frame, rows):
    df = frame([("/1/",), ("/1/2/",), ("/1/2/3/",), ("/4/",)], "path string")
    assert rows(hierarchy.tree(df, "path"), "path", "depth", "parent_path", "descendants") == [
        ("/1/", 1, "/", 2), ("/1/2/", 2, "/1/", 1), ("/1/2/3/", 3, "/1/2/", 0), ("/4/", 1, "/", 0)]


def test_tree_counts_all_rows_below_the_root(frame, rows):
    df = frame([("/",), ("/1/",), ("/1/2/",)], "path string")
    assert rows(hierarchy.tree(df, "path"), "path", "depth", "parent_path", "descendants") == [
        ("/", 0, None, 2), ("/1/", 1, "/", 1), ("/1/2/", 2, "/1/", 0)]


def test_texts_are_parsed_whole(frame):
    got = frame([("07:00:00.7500000",), ("07:00:00.0000000",), ("23:59:59",), ("07:00:00x",), ("25:00:00",)], "x string")
    assert [r[0] for r in got.select(scalars.clock(F.col("x"))).collect()] == ["07:00:00.75", "07:00:00", "23:59:59", None, None]
    days = frame([("2000-06-01garbage",), ("2000-06-01+02:00",)], "x string")
    assert [r[0] for r in days.select(xml.day(F.col("x"))).collect()] == [None, dt.date(2000, 6, 1)]
    flags = frame([("Y",), ("0",), ("maybe",)], "x string")
    assert [r[0] for r in flags.select(scalars.flag(F.col("x"))).collect()] == [True, False, None]


def test_first_text(frame):
    cases = {"<b>x<b>y</b>z</b>real": "real", "<a><b><a>1</a></b>2</a> end": " end", "plain": "plain", "Insert <m>sheet</m> into <t a='1'>x</t>.": "Insert ", "<b>x</b> after": " after",
             "<b>x</b>": None, "a<br/>b": "a"}
    df = frame([(k,) for k in cases], "x string")
    assert {r.x: r.t for r in df.select("x", xml.first_text(F.col("x")).alias("t")).collect()} == cases


def test_fields_are_first_text_nodes(frame):
    cases = {
        "p &lt;c&gt;x&lt;/c&gt; d": "p <c>x</c> d", "<![CDATA[a <b>&amp; ]]>c<b>x</b>d": "a <b>&amp; c", "one<!-- two --> three": "one",
        "<b>x</b><!-- y -->z": "z", "&#8211;&#x41;&quot;&apos;&amp;lt;": "\u2013A\"'&lt;", "": None, "<b/>": None, "a &#233;": "a \xe9",
        "x<![CDATA[]]>y": "xy", "<![CDATA[<!-- no comment -->]]>": "<!-- no comment -->",
    }
    for around in ("<r>%s</r>", "<?xml version='1.0'?><!-- start --><r><!-- c -->%s</r><!-- end -->"):
        df = frame([(k, around % f"<a>{k}</a><l><i>{k}</i><i>2</i></l>") for k in cases], "k string, x string")
        got = df.select("k", xml.shred(F.col("x"), "a string, l struct<i:array<string>>, gone string").alias("r")).collect()
        assert {g.k: g.r.a for g in got} == cases
        assert {g.k: g.r.l.i[0] for g in got} == cases and all(g.r.l.i[1] == "2" and g.r.gone is None for g in got)


def test_first_text_is_linear_in_its_children(frame):
    inner = "<i>x</i>" * 20_000 + "end" + "<i>y</i>"
    assert one(frame([(inner,)], "x string").select(xml.first_text(F.col("x")))) == ("end",)


def test_xml_date_with_zone(frame):
    assert one(frame([("2000-06-01Z",)], "x string").select(xml.day(F.col("x")))) == (dt.date(2000, 6, 1),)
