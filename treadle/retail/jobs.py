"""Every job of the library, run over the benchmark tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from treadle.functions import hierarchy, scalars
from treadle.operators import bands, checks, history, keep, lookup, measures, sinks
from treadle.plans import dims, facts, marts, shorthand, staging, views, xml_views
from treadle.retail import runs, tables as r
from treadle.retail.source import SourceTables
from treadle.retail.tables import AS_OF, SINCE, STOCK_DAY, UNTIL, load
from treadle.session import run_folder, stored_bytes
from treadle.sources import catalog, delimited, extract

Job = Callable[[SparkSession, str], DataFrame]

#: Extract window of the registered jobs.
WINDOW = (dt.datetime(1996, 1, 1), dt.datetime(1998, 12, 31))


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- sources -------------------------------------------------------------------------------


def s_dim_extract(spark, folder):
    """Customers whose last order came after a bound, which stands for their change date."""
    touched = load(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("ModifiedDate"))
    customers = scalars.lower_names(load(spark, folder, "customer").join(touched, "c_custkey"))
    recent = extract.changed_since(customers, dt.datetime(2001, 6, 1))
    return scalars.without(recent, "modifieddate")


def s_fact_extract(spark, folder):
    orders = load(spark, folder, "orders")
    column = extract.first_date_column(orders.columns)
    out = extract.within(orders, column, *WINDOW)
    return out.select("o_orderkey", "o_custkey", F.col(column).cast("date").alias("o_orderdate"), "o_totalprice")


def s_classify(spark, folder):
    """Type, column count and extracted rows of every table."""
    frames = {f"retail.{n}": load(spark, folder, n) for n in r.TABLES}
    specs = catalog.describe(frames)
    layout = spark.createDataFrame(
        [("retail", s.name, list(s.column_names)) for s in specs.values()],
        "table_schema string, table_name string, columns array<string>")
    typed = layout.select("table_name", extract.table_type(F.col("table_name"), F.col("columns")).alias("table_type"),
                          F.size("columns").cast("long").alias("column_count"))
    extracts = extract.extract_all(specs, lambda n: frames[n], window=WINDOW)
    counts = _union(e.df.agg(F.count("*").alias("extracted_rows")).withColumn("table_name", F.lit(n.split(".")[1]))
                    for n, e in extracts.items())
    return typed.join(counts, "table_name", "left")


def _delimited_spec() -> catalog.TableSpec:
    c = catalog.ColumnSpec
    return catalog.TableSpec("retail", "orderfile", (
        c("orderid", "bigint", False), c("status", "character", False, 3), c("openflag", "boolean", False),
        c("guid", "uuid"), c("placed", "timestamp without time zone"), c("clerk", "character varying", True, 50),
        c("share", "numeric", True, None, 8, 2), c("at", "time without time zone"), c("doc", "character varying")))


def s_delimited_load(spark, folder):
    """Orders written as a tab-separated dump in the source's format, then loaded."""
    path = run_folder(spark, "orderfile")
    code = hierarchy.encode(F.array((F.col("o_custkey") % 1104), (F.col("o_orderkey") % 80)))
    dump = load(spark, folder, "orders").select(
        F.concat_ws(
            "\t", F.col("o_orderkey"), F.rpad("o_orderstatus", 3, " "),
            F.when(F.col("o_orderstatus") == "O", "1").otherwise("0"),
            F.concat(F.lit("{"), F.upper(F.md5(F.col("o_orderkey").cast("string"))), F.lit("}")),
            F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(".587000000")),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(F.col("o_orderpriority")),
            F.concat(F.lit("."), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0")),
            F.lit("07:30:00.0000000"), code).alias("value"))
    dump.write.text(path)
    loaded = delimited.load_delimited(spark, path, _delimited_spec())
    return hierarchy.with_paths(loaded, "doc", "node").withColumn("placed", F.col("placed").cast("string"))


def s_load_rejects(spark, folder):
    """Orders written with bad numbers, flags, fractions and extra or missing fields, by what became of them."""
    path = run_folder(spark, "faulty")
    key = F.col("o_orderkey")
    dump = load(spark, folder, "orders").select(
        F.concat(
            key.cast("string"), F.lit("\t"),
            F.when(key % 5 == 1, F.lit("12x")).otherwise(F.col("o_custkey").cast("string")), F.lit("\t"),
            F.when(key % 7 == 2, F.lit("maybe")).otherwise(F.lit("1")), F.lit("\t"),
            F.when(key % 11 == 3, F.lit("3.14159")).otherwise(F.lit(".25")),
            F.when(key % 13 == 4, F.lit("\tmore\tfields")).otherwise(F.lit("")),
            ).alias("value"), key.alias("key"))
    missing = F.regexp_replace("value", "\t[^\t]*$", "")
    dump.select(F.when(F.col("key") % 17 == 5, missing).otherwise(F.col("value")).alias("value")).write.text(path)
    c = catalog.ColumnSpec
    spec = catalog.TableSpec("retail", "faulty", (
        c("orderid", "bigint", False), c("customer", "integer"), c("flag", "boolean"), c("share", "numeric", True, None, 8, 2)))
    rows, rejects = delimited.load_with_rejects(spark, path, spec)
    cents = (F.col("share") * 100).cast("long")
    return rows.agg(F.lit("").alias("reasons"), F.count("*").alias("n_rows"), F.sum("orderid").alias("order_sum"),
                    F.sum(cents).alias("cents")).unionByName(
        rejects.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(
            F.count("*").alias("n_rows"),
            F.sum(F.coalesce(F.split(F.col("line"), "\t")[0], F.col("fields.orderid")).cast("long")).alias("order_sum"),
            F.lit(None).cast("long").alias("cents")))


def s_record_load(spark, folder):
    """Documents written as records whose text spans lines, then put together again."""
    path = run_folder(spark, "records")
    plain = F.translate("text", "\t\r", "  ")
    load(spark, folder, "documents").select(F.concat_ws("\t", "doc_id", "lang", plain, F.lit("end")).alias("value")) \
        .write.text(path)
    c = catalog.ColumnSpec
    spec = catalog.TableSpec("retail", "document", (
        c("doc_id", "bigint", False), c("lang", "character varying"), c("text", "text"), c("mark", "character varying")))
    loaded = delimited.load_records(spark, path, spec)
    return loaded.select("doc_id", "lang", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"), "mark")


# --- projections and joins -----------------------------------------------------------------


def p_order_totals(spark, folder):
    """Line totals summed per order and reconciled with the order's own total."""
    totals = load(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.sum(r.net()).cast("decimal(18,2)").alias("sub_total"))
    order = load(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").cast(r.CASH).alias("total_due"))
    zero = F.lit(0).cast("decimal(18,2)")
    return order.join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("order_id"), scalars.order_number(F.col("o_orderkey")).alias("order_number"),
        F.coalesce("sub_total", zero).alias("sub_total"), F.col("total_due").cast("decimal(18,2)").alias("total_due"),
        (F.col("total_due").cast("decimal(18,2)") == F.coalesce("sub_total", zero)).alias("reconciled"))


def p_computed(spark, folder):
    """The load's computed columns: totals, stocked quantities, numbers of orders and accounts, and NaN as NULL."""
    money = "decimal(19,4)"
    line = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("salesorderid"), F.col("l_extendedprice").cast(money).alias("subtotal"),
        F.when(F.col("l_linestatus") == "O", F.col("l_tax").cast(money)).alias("taxamt"), F.col("l_discount").cast(money).alias("freight"),
        F.col("l_quantity").cast("decimal(8,2)").alias("received"),
        F.when(F.col("l_returnflag") != "N", F.lit(1).cast("decimal(8,2)")).alias("rejected"), F.col("l_suppkey").alias("customerid"),
        F.when(F.col("l_returnflag") == "R", float("nan")).otherwise(F.col("l_tax")).alias("share"))
    done = line.select(
        scalars.order_number(F.col("salesorderid")).alias("salesordernumber"), scalars.account_number(F.col("customerid")).alias("accountnumber"),
        scalars.total_due(F.col("subtotal"), F.col("taxamt"), F.col("freight")).alias("totaldue"),
        scalars.stocked(F.col("received"), F.col("rejected")).alias("stockedqty"), scalars.no_nan(F.col("share")).alias("share"))
    return done.groupBy("salesordernumber", "accountnumber").agg(
        F.count("*").alias("n_lines"), F.sum("totaldue").cast(money).alias("totaldue"), F.sum("stockedqty").cast("decimal(18,2)").alias("stockedqty"),
        F.count("share").alias("shares"))


def q_numeric_type(spark, folder):
    """Text columns of orders that are declared as numbers, checked value by value."""
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.col("o_orderpriority").substr(1, 1).alias("o_rank"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice").cast("string")).otherwise("n/a").alias("o_amount"),
        F.col("o_orderstatus").alias("o_code"))
    declared = {"o_orderkey": "bigint", "o_rank": "smallint", "o_amount": "decimal(19,4)", "o_code": "int"}
    rules = checks.column_rules(orders.schema, QUALITY_DAY, declared=declared)
    return checks.findings({"orders": orders}, {"orders": checks.TableRules(tuple(rules))}).select("table_name", "rule", "message", "violations")


def j_orphans_anti(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lookup.childless(orders, ["o_orderkey"], load(spark, folder, "lineitem"), ["l_orderkey"])


def j_children_semi(spark, folder):
    """Lines that go when urgent open orders are deleted."""
    deleted = load(spark, folder, "orders").filter("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return lookup.cascade(lines, ["l_orderkey"], deleted, ["o_orderkey"])[1]


def _priority_states(spark, folder) -> DataFrame:
    orders = load(spark, folder, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey", "o_orderpriority")
    return keep.daily_state(orders, ["o_custkey"], "day", ["o_orderkey"], ["o_orderpriority"])


def _priority_versions(spark, folder) -> DataFrame:
    return history.versions(_priority_states(spark, folder), ["o_custkey"], "day", ["o_orderpriority"])


def j_asof_lookup(spark, folder):
    """Each order line's customer version in force on its ship date."""
    versions = _priority_versions(spark, folder).withColumnRenamed("o_custkey", "CustomerID")
    found = lookup.asof_lookup(r.lines(spark, folder).select("order_id", "line_no", "customer_id", "ship_date"), versions,
                               {"customer_id": "CustomerID"}, "ship_date",
                               {"priority": "o_orderpriority", "valid_from": "ValidFromDate"},
                               since=SINCE, until=UNTIL)
    return found


def aging_tiers(spark) -> DataFrame:
    return dims.static_dimension(spark, "DimAgingTier")


def j_price_in_force(spark, folder):
    """Each line's price of the year, from intervals that include their last day."""
    line = load(spark, folder, "lineitem")
    year = F.trunc(F.col("l_shipdate").cast("date"), "year")
    prices = (
        line.groupBy(F.col("l_partkey").alias("ProductID"), year.alias("StartDate"))
        .agg(F.max(r.gross()).alias("Price")).withColumn("EndDate", F.date_sub(F.add_months("StartDate", 12), 1))
    )
    sold = line.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("ship_date"))
    return lookup.asof_lookup(sold, prices, {"l_partkey": "ProductID"}, "ship_date", {"price": "Price", "since": "StartDate"},
                              since=SINCE, until=UNTIL, valid_from="StartDate", valid_to="EndDate", closed=True)


def j_band_tier(spark, folder):
    snapshot = facts.fact_inventory(r.stock(spark, folder), STOCK_DAY)
    tiered = lookup.band_lookup(snapshot, aging_tiers(spark), "StockAgingDays",
                                {"AgingTierKey": "AgingTierKey", "AgingTierName": "AgingTierName"},
                                low="MinAgingDays", high="MaxAgingDays")
    return tiered.groupBy("AgingTierKey", "AgingTierName").agg(
        F.count("*").alias("stock_rows"), F.sum("QuantityOnHand").alias("units"))


def j_band_fraction(spark, folder):
    """Prices in bands with gaps between them: a price between two bands has none."""
    price = load(spark, folder, "part").select("p_partkey", F.col("p_retailprice").cast(r.CASH).alias("price"))
    low = (F.floor(F.col("price") / 100) * 100).cast(r.CASH)
    bands = price.groupBy(low.alias("low")).agg(F.count("*").alias("parts")).withColumn(
        "high", (F.col("low") + F.lit("74.5").cast(r.CASH)).cast(r.CASH))
    found = lookup.band_lookup(price, bands, "price", {"band": "low"}, low="low", high="high")
    return found.groupBy("band").agg(F.count("*").alias("parts"), F.sum("price").cast("decimal(18,2)").alias("worth"))


def j_band_index(spark, folder):
    """Lines by the bands of 20.00 that start at the orders' totals: as many bands as totals, some of them overlapping."""
    def cents(c):
        return (F.col(c).cast("decimal(14,2)") * 100).cast("long")
    given = load(spark, folder, "orders").select(cents("o_totalprice").alias("low")).distinct().withColumn("high", F.col("low") + 1999)
    line = load(spark, folder, "lineitem").select(cents("l_extendedprice").alias("price"), cents("l_quantity").alias("quantity"))
    return bands.BandIndex(spark, given, "low", "high").totals(line, "price", {"band": "low"}, "n_lines", {"quantity": "quantity"})


def j_self_manager(spark, folder):
    """Sellers and their managers: the first seller of a nation leads it."""
    staff = load(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("EmployeeID"), F.col("s_name").alias("EmployeeName"), "s_nationkey")
    lead = staff.groupBy("s_nationkey").agg(F.min("EmployeeID").alias("ManagerID"))
    return dims.with_managers(staff.join(lead, "s_nationkey"), "EmployeeID", "ManagerID", "EmployeeName")


# --- aggregates and windows ----------------------------------------------------------------


def a_pivot_fiscal(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderpriority", scalars.fiscal_year(F.col("o_orderdate")).alias("fy"),
        F.col("o_totalprice").cast(r.CASH).alias("total"))
    return measures.pivot_sum(orders, ["o_orderpriority"], "fy", (1997, 1998, 1999), "total", "decimal(24,2)") \
        .withColumnsRenamed({str(y): f"fy{y}" for y in (1997, 1998, 1999)})


def a_ratio_metrics(spark, folder):
    qty = F.col("l_quantity").cast("long")
    month = scalars.month_start(F.col("l_shipdate").cast("date"))
    return (
        load(spark, folder, "lineitem").groupBy("l_partkey", month.alias("month"))
        .agg(F.sum(qty).alias("units"), F.sum(F.when(F.col("l_returnflag") == "R", qty).otherwise(0)).alias("returned"))
        .select("l_partkey", "month", "units", scalars.ratio(F.col("returned"), F.col("units")).alias("return_rate"))
    )


def w_growth(spark, folder):
    """Order value of each nation by month with its growth."""
    places = r.places(spark, folder)
    orders = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("CustomerKey"), F.col("o_orderdate").cast("date").alias("SalesDateKey"),
        F.col("o_totalprice").cast(r.CASH).alias("SalesRevenue"))
    return marts.regional_sales(orders, places)


def w_keep_last(spark, folder):
    last = keep.keep_last(load(spark, folder, "events"), ["user_id"], ["ts", "event_id"])
    return last.select("user_id", "event_id", "event_type", "value")


# --- quality -------------------------------------------------------------------------------

QUALITY_DAY = dt.date(2001, 6, 1)


def _rules(spark, folder) -> tuple[dict[str, DataFrame], dict[str, checks.TableRules]]:
    frames = {n: load(spark, folder, n) for n in ("customer", "supplier", "part", "orders", "lineitem")}
    limits = {"customer": {"c_mktsegment": 9}, "part": {"p_name": 10}, "orders": {"o_orderpriority": 10}}
    needed = {"customer": ["c_custkey", "c_name"], "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
              "lineitem": ["l_orderkey", "l_shipdate"], "part": ["p_partkey"], "supplier": ["s_suppkey"]}
    keys = {"customer": ("c_custkey",), "supplier": ("s_suppkey",), "part": ("p_partkey",),
            "orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_linenumber")}
    extra = {
        "customer": [checks.check_rule("CK_customer_balance", "c_acctbal >= 0.00")],
        "lineitem": [checks.check_rule("CK_lineitem_quantity", "l_quantity BETWEEN 1 AND 48"),
                     checks.check_rule("CK_lineitem_discount", "l_discount < 0.10 OR l_discount IS NULL"),
                     checks.check_rule("CK_lineitem_flag", "UPPER(l_returnflag) IN ('A', 'N')")],
        "orders": [checks.check_rule("CK_orders_status", "UPPER(o_orderstatus) IN ('F', 'O')"),
                   checks.check_rule("CK_orders_total", "o_totalprice >= 2000.00")],
    }
    links = {"lineitem": (checks.ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
                          checks.ForeignKey(("l_partkey",), "part", ("p_partkey",))),
             "orders": (checks.ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)}
    rules = {}
    for n, df in frames.items():
        found = checks.column_rules(df.schema, QUALITY_DAY, required=needed[n], lengths=limits.get(n))
        rules[n] = checks.TableRules(tuple(found + extra.get(n, [])), keys[n], links.get(n, ()))
    return frames, rules


def _row_findings(spark, folder, kinds) -> DataFrame:
    frames, rules = _rules(spark, folder)
    picked = {n: checks.TableRules(tuple(x for x in v.rules if x.kind in kinds)) for n, v in rules.items()}
    return checks.findings(frames, {n: v for n, v in picked.items() if v.rules})


def q_column_rules(spark, folder):
    found = _row_findings(spark, folder, ("required", "negative", "future", "length", "numeric"))
    return found.select("table_name", "message", "severity", "violations")


def q_check_rules(spark, folder):
    return _row_findings(spark, folder, ("check",)).select("table_name", "rule", "violations")


def q_pk_duplicates(spark, folder):
    return checks.duplicate_keys(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]) \
        .withColumnRenamed("rows", "n_rows")


def q_fk_orphans(spark, folder):
    """Users of events that are no supplier, with their rows."""
    bad = lookup.orphan_counts(load(spark, folder, "events"), ["user_id"],
                               load(spark, folder, "supplier"), ["s_suppkey"])
    return bad.withColumnRenamed("rows", "n_rows")


def q_fk_window(spark, folder):
    """Lines of a year whose orders are of the year before: no orphans against whole parents."""
    year = (dt.datetime(1997, 1, 1), dt.datetime(1997, 12, 31))
    frames = {"orders": extract.within(load(spark, folder, "orders"), "o_orderdate", *year),
              "lineitem": extract.within(load(spark, folder, "lineitem"), "l_shipdate", *year)}
    link = checks.ForeignKey(("l_orderkey",), "orders", ("o_orderkey",))
    rules = {"lineitem": checks.TableRules((), (), (link,))}
    whole = {n: load(spark, folder, n) for n in frames}
    return _union(checks.findings(frames, rules, parents).select(F.lit(name).alias("parents"), "table_name", "violations")
                  for name, parents in (("whole", whole), ("window", frames)))


def q_retry(spark, folder):
    """Error records of large line discounts after a retry in which those of returned lines passed."""
    lines = load(spark, folder, "lineitem")
    rule = checks.Rule("large_discount", "check", "l_discount > 0.08", "Discount above 8 %", checks.ERROR)
    key = ["l_orderkey", "l_linenumber"]
    records = checks.error_records(lines, "lineitem", [rule], key, "batch-1", "validate", dt.datetime(2001, 12, 31, 6, 0))
    natural = records.select("SourceTable", "RecordNaturalKey")
    passed = checks.error_records(lines.filter("l_returnflag = 'R'"), "lineitem", [rule], key, "batch-1", "validate",
                                  dt.datetime(2001, 12, 31, 6, 0)).select(*natural.columns)
    again = checks.record_retry(records, passed, dt.datetime(2002, 1, 1, 6, 0), "passed on retry")
    return again.groupBy("IsResolved", "RetryCount", "ResolutionComment").agg(F.count("*").alias("records"))


def q_summary(spark, folder):
    frames, rules = _rules(spark, folder)
    out = checks.summarize(checks.findings(frames, rules))
    return out.select("table_name", "status", F.concat_ws("; ", "errors").alias("errors"),
                      F.concat_ws("; ", "warnings").alias("warnings"))


def q_key_records(spark, folder):
    """Error records of the rows behind duplicated line keys, per key."""
    records = checks.key_error_records(load(spark, folder, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"],
                                       "batch-1", "validate", dt.datetime(2001, 12, 31, 6, 0))
    return records.groupBy("RecordNaturalKey", "ErrorType", "ErrorSeverity").agg(
        F.count("FailedData").alias("records"))


def q_error_records(spark, folder):
    """Quarantine of all tables with rules, for rules of every kind, through the run's writer, with its balance.

    One table is written twice, as by a second run: its records are replaced, not doubled.
    """
    frames, rules = _rules(spark, folder)
    run = ("batch-1", "validate", dt.datetime(2001, 12, 31, 6, 0))
    keys = {n: list(rules[n].key) for n in frames}
    path = run_folder(spark, "error_records")
    records = {n: checks.table_error_records(frames[n], n, rules[n], keys[n], *run, frames) for n in keys}
    sinks.replace_records(checks.union_all(list(records.values())), path, run[0], even=True)
    sinks.replace_records(records["orders"], path, run[0], even=True)
    counted = (
        sinks.read_months(spark, path).groupBy("SourceTable", "ErrorType", "ErrorSeverity", "ErrorMessage")
        .agg(F.count("*").alias("records"), F.count("FailedData").alias("payloads"))
    )

    balance = [
        checks.balance(frames[n], rules[n].rules).select(
            F.lit(n).alias("SourceTable"), F.lit("rows").alias("ErrorType"), F.lit("INFO").alias("ErrorSeverity"),
            F.col("part").alias("ErrorMessage"), F.col("n_rows").alias("records"),
            F.lit(0).cast("long").alias("payloads"))
        for n in keys]
    return _union([counted, *balance])


# --- staging and dimensions ----------------------------------------------------------------


def d_customer_staging(spark, folder):
    return staging.customer_staging(SourceTables(spark, folder), AS_OF)


def d_dim_customer(spark, folder):
    """First load of the customer dimension; the surrogate key is left out."""
    spec = dims.DIMENSIONS["DimCustomer"]
    staged = dims.stage_customer(SourceTables(spark, folder), AS_OF)
    return dims.load_dimension(spec, None, staged, AS_OF, SINCE).drop(spec.surrogate)


def _dimension(name: str, *drop: str) -> Job:
    """First load of a dimension; hashed surrogate keys are left out."""
    def run(spark, folder):
        spec = dims.DIMENSIONS[name]
        staged = dims.STAGES[name](SourceTables(spark, folder), AS_OF)
        out = dims.load_dimension(spec, None, staged, AS_OF, SINCE)
        return out.drop(*drop, *([spec.surrogate] if spec.policy == dims.SCD2 else []))
    return run


def d_vendor_scores(spark, folder):
    """On-time and quality shares of each vendor, unrounded."""
    return dims.vendor_scores(SourceTables(spark, folder))


def d_manager_keys(spark, folder):
    """Employees with the employee their manager key points at."""
    spec = dims.DIMENSIONS["DimEmployee"]
    staged = dims.stage_employee(SourceTables(spark, folder), AS_OF)
    dim = dims.load_dimension(spec, None, staged, AS_OF, SINCE)
    keyed = dims.with_manager_keys(dim, staged.select("EmployeeID", "ManagerID"))
    boss = dim.select(F.col("EmployeeKey").alias("ReportingManagerKey"), F.col("EmployeeID").alias("ManagerID"))
    return keyed.join(boss, "ReportingManagerKey", "left").select("EmployeeID", "EmployeeName", "ManagerID")


def d_product_history(spark, folder):
    """Versions of two attributes of a part that change on different days."""
    line = load(spark, folder, "lineitem")
    day = F.col("l_shipdate").cast("date").alias("startdate")

    def observed(rows, name, value):
        return rows.groupBy(F.col("l_partkey").alias("productid"), day).agg(F.max(value).cast("decimal(19,4)").alias(name))

    t = {"production.productlistpricehistory": observed(line.filter("l_linestatus = 'O'"), "listprice", r.rate()),
         "production.productcosthistory": observed(line.filter("l_linestatus = 'F'"), "standardcost",
                                                   F.col("l_tax").cast(r.RATE))}
    return dims.product_history(t)


def d_change_set(spark, folder):
    """Customers' priority at the end of 1998 against the end of 1997."""
    orders = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("customerid"), "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("priority"))

    def snapshot(day):
        before = orders.filter(F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz"))
        return keep.keep_last(before, ["customerid"], ["o_orderdate", "o_orderkey"]).select("customerid", "priority")

    return history.change_set(snapshot("1999-01-01"), snapshot("1998-01-01"), ["customerid"],
                              {"priority": "priority"})


def d_scd2_history(spark, folder):
    return _priority_versions(spark, folder)


def d_scd2_merge(spark, folder):
    """Three daily runs of the merge, from an empty dimension."""
    orders = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("CustomerID"), "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("Priority"))
    dim = None
    for day in (dt.date(1997, 1, 1), dt.date(1998, 1, 1), dt.date(1999, 1, 1)):
        before = orders.filter(F.col("o_orderdate") < F.lit(day.isoformat()).cast("timestamp_ntz"))
        snap = keep.keep_last(before, ["CustomerID"], ["o_orderdate", "o_orderkey"]).select("CustomerID", "Priority")
        dim = (history.first_load(snap, ["CustomerID"], "CustomerKey", day) if dim is None
               else history.scd2(dim, snap, ["CustomerID"], ["Priority"], "CustomerKey", day))
    return dim.select("CustomerID", "Priority", "ValidFromDate", "ValidToDate", "IsCurrent")


def d_scd1_upsert(spark, folder):
    """Nations as territories; those with customers get their segment count written over."""
    nation = load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("TerritoryID"), F.col("n_name").alias("TerritoryName"), F.lit(0).cast("long").alias("Customers"))
    fresh = load(spark, folder, "customer").filter("c_acctbal > 0").groupBy(F.col("c_nationkey").alias("TerritoryID")).agg(
        F.lit("renamed").alias("TerritoryName"), F.count("*").alias("Customers"))
    return history.scd1(nation, fresh, ["TerritoryID"])


def d_date(spark, folder):
    """The calendar from the first to the last order date."""
    bounds = load(spark, folder, "orders").agg(F.min("o_orderdate").cast("date").alias("low"),
                                               F.max("o_orderdate").cast("date").alias("high"))
    return dims.dim_date(bounds)


# --- facts ---------------------------------------------------------------------------------


def k1_fact_sales(spark, folder):
    return facts.fact_sales(r.lines(spark, folder))


#: Stored tables per slice of the sales whose keys are looked up at a time, and the most slices.
_SLICE_BYTES, _MOST_SLICES = 16 << 20, 4


def k1_fact_sales_keyed(spark, folder):
    """Sales with the keys of customer, product, store and employee, all looked up at once, by version found.

    Customers have versions by priority, products by price and cost, employees by quota, stores none.
    A key is checked by its way back: it has to lead to one version, of the sale's own member.
    """
    folders = []

    def keep(df):
        folders.append(run_folder(spark, "keyed"))
        df.write.parquet(folders[-1])
        return spark.read.schema(df.schema).parquet(folders[-1])

    def versions(df, natural):
        return keep(df.select(natural, "ValidFromDate", "ValidToDate", history.surrogate_key(
            [F.col(natural)], F.col("ValidFromDate")).alias("sk")))

    store = load(spark, folder, "supplier").select("s_suppkey", F.xxhash64("s_suppkey").alias("sk"))
    links = {
        "CustomerKey": facts.Link(versions(_priority_versions(spark, folder), "o_custkey"), "o_custkey", "sk"),
        "ProductKey": facts.Link(versions(d_product_history(spark, folder), "ProductID"), "ProductID", "sk"),
        "StoreKey": facts.Link(store, "s_suppkey", "sk", versioned=False),
        "EmployeeKey": facts.Link(versions(r.quotas(spark, folder), "employee_id"), "employee_id", "sk"),
    }
    own = {c: f"own_{c}" for c in links}
    sales = k1_fact_sales(spark, folder).select("*", *[F.col(c).cast("long").alias(n) for c, n in own.items()])
    slices = max(1, min(_MOST_SLICES, stored_bytes(spark, folder) // _SLICE_BYTES))
    sales, given = keep(sales), folders[-1]
    keyed = facts.with_surrogates_by_slices(sales, "SalesDateKey", links, SINCE, UNTIL, slices, keep)
    sinks.drop_folder(spark, given)
    each = keyed.select("SalesRevenue", F.inline(F.array(*[F.struct(
        F.lit(c).alias("dimension"), F.col(c).alias("sk"), F.col(n).alias("member")) for c, n in own.items()])))
    sums = each.groupBy("dimension", "sk", "member").agg(
        F.count("*").alias("sales"), F.sum("SalesRevenue").cast("decimal(18,2)").alias("revenue"))
    back = _union(k.dimension.select(
        F.lit(c).alias("dimension"), "sk", F.col(k.natural).cast("long").alias("found"),
        (F.col("ValidFromDate") if k.versioned else F.lit(None).cast("date")).alias("valid_from")) for c, k in links.items())
    return sums.join(back, ["dimension", "sk"], "left").select(
        "dimension", "member", "found", "valid_from", "sales", "revenue")


def k2_fact_purchases(spark, folder):
    return facts.fact_purchases(r.purchase_lines(spark, folder))


def k3_fact_inventory(spark, folder):
    return facts.fact_inventory(r.stock(spark, folder), STOCK_DAY)


def k4_fact_production(spark, folder):
    return facts.fact_production(*r.runs(spark, folder), key=("order_id", "product_id"))


def k5_fact_employee_sales(spark, folder):
    return facts.fact_employee_sales(r.lines(spark, folder), r.quotas(spark, folder), r.sellers(spark, folder),
                                     SINCE, UNTIL)


def k6_fact_customer_feedback(spark, folder):
    return facts.fact_customer_feedback(r.feedback(spark, folder))


def k7_fact_promotion_response(spark, folder):
    return facts.fact_promotion_response(r.lines(spark, folder))


def k8_fact_finance(spark, folder):
    return facts.fact_finance(r.invoices(spark, folder))


def k9_fact_returns(spark, folder):
    return facts.fact_returns(r.returns(r.lines(spark, folder)))


# --- marts ---------------------------------------------------------------------------------


def _categorised(spark, folder) -> DataFrame:
    """Sales that carry their product category."""
    return facts.fact_sales(r.lines(spark, folder, category=True), {"category": "ProductCategoryKey"})


def g1_daily_sales(spark, folder):
    return marts.daily_sales(_categorised(spark, folder))


def g2_weekly_sales(spark, folder):
    return marts.weekly_sales(_categorised(spark, folder), r.places(spark, folder))


def g3_monthly_sales(spark, folder):
    return marts.monthly_sales(k1_fact_sales(spark, folder), r.places(spark, folder))


def g4_daily_inventory(spark, folder):
    return marts.daily_inventory(k3_fact_inventory(spark, folder), r.products(spark, folder), aging_tiers(spark))


def g5_monthly_product_performance(spark, folder):
    ratings = k6_fact_customer_feedback(spark, folder).select(F.col("CustomerKey").alias("ProductKey"), "FeedbackScore")
    return marts.monthly_product_performance(k1_fact_sales(spark, folder), r.returned_units(spark, folder), ratings)


def g6_regional_sales(spark, folder):
    return marts.regional_sales(k1_fact_sales(spark, folder), r.places(spark, folder))


def g_partition_refresh(spark, folder):
    """A written mart of which two months are recomputed, one of them without rows; the others stay."""
    path = run_folder(spark, "agg_regional")
    lines, places = r.lines(spark, folder), r.places(spark, folder)
    by = ["MonthStartDateKey", "RegionKey"]

    def mart(part):
        sums = facts.fact_sales(part).groupBy(
            "CustomerKey", scalars.month_start(F.col("SalesDateKey")).alias("MonthStartDateKey")).agg(
            F.sum("SalesRevenue").alias("s"))
        return sums.join(places, "CustomerKey").groupBy(*by).agg(F.sum("s").cast("decimal(18,2)").alias("TotalRevenue"))

    sinks.write_months(mart(lines.filter("return_flag <> 'R'")), path, "MonthStartDateKey", by)
    late = marts.only_months(lines, "order_date", ["1997-06-01"])
    sinks.write_months(mart(late), path, "MonthStartDateKey", by, replaced=["1997-06", "1997-07"])
    return sinks.read_months(spark, path).select(*by, "TotalRevenue", "month")


# --- views ---------------------------------------------------------------------------------


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("modifieddate", F.col("modifieddate").cast("date"))


def _view(build: Callable, drop: tuple[str, ...] = (), dated: bool = False) -> Job:
    def run(spark, folder):
        out = build(SourceTables(spark, folder)).drop(*drop)
        return _dated(out) if dated else out
    return run


def _plain_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(".", "_").lower() for c in df.columns])


def v_fiscal_pivot(spark, folder):
    out = views.v_sales_person_sales_by_fiscal_years(SourceTables(spark, folder), (1997, 1998, 1999), "decimal(24,4)")
    return out.withColumnsRenamed({str(y): f"fy{y}" for y in (1997, 1998, 1999)})


def v_hierarchy(spark, folder):
    """Regions, nations and customers as one coded tree, decoded and rolled up."""
    nation = load(spark, folder, "nation")
    customer = load(spark, folder, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey", "n_nationkey")

    def digit(power):
        return F.floor(F.col("c_custkey") / F.lit(1104 ** power)) % 1104

    nodes = _union([
        spark.range(1).select(F.lit("company").alias("name"), F.array().cast("array<bigint>").alias("n")),
        load(spark, folder, "region").select(F.col("r_name").alias("name"), F.array(F.col("r_regionkey").cast("long")).alias("n")),
        nation.select(F.col("n_name").alias("name"), F.array(F.col("n_regionkey").cast("long"), F.col("n_nationkey").cast("long")).alias("n")),
        customer.select(F.concat(F.lit("C"), F.col("c_custkey")).alias("name"), F.array(
            F.col("n_regionkey").cast("long"), F.col("n_nationkey").cast("long"), digit(2), digit(1), digit(0)).alias("n")),
    ])
    coded = nodes.select("name", hierarchy.encode(F.col("n")).alias("code"))
    return hierarchy.tree(hierarchy.with_paths(coded, "code", "path"), "path").select(
        "name", "path", "parent_path", "depth", "descendants")


def v_shorthand(spark, folder):
    """The id column of every table under its shorthand, summed up."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
            "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id",
            "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id",
            "labels": "doc_id", "conversations": "conv_id"}
    return _union(
        shorthand.with_id(load(spark, folder, n), k).agg(
            F.lit(n).alias("table_name"), F.count("*").alias("n_rows"),
            F.sum(F.col("id").cast("decimal(38,0)")).cast("long").alias("id_sum"),
            F.count_if(F.col("id") == F.col(k)).alias("same"))
        for n, k in keys.items())


def v_materialized_refresh(spark, folder):
    """A materialized view written twice; readers see the second version."""
    t = SourceTables(spark, folder)
    root = run_folder(spark, "views")
    views.refresh_view(spark, "production.vproductanddescription", t, root)
    return views.refresh_view(spark, "production.vproductanddescription", t, root)


QUERIES: dict[str, Job] = {
    "s_dim_extract": s_dim_extract,
    "s_fact_extract": s_fact_extract,
    "s_classify": s_classify,
    "s_delimited_load": s_delimited_load,
    "s_load_rejects": s_load_rejects,
    "s_record_load": s_record_load,
    "p_order_totals": p_order_totals,
    "p_computed": p_computed,
    "j_orphans_anti": j_orphans_anti,
    "j_children_semi": j_children_semi,
    "j_asof_lookup": j_asof_lookup,
    "j_price_in_force": j_price_in_force,
    "j_band_tier": j_band_tier,
    "j_band_fraction": j_band_fraction,
    "j_band_index": j_band_index,
    "j_self_manager": j_self_manager,
    "a_pivot_fiscal": a_pivot_fiscal,
    "a_ratio_metrics": a_ratio_metrics,
    "w_growth": w_growth,
    "w_keep_last": w_keep_last,
    "q_column_rules": q_column_rules,
    "q_check_rules": q_check_rules,
    "q_numeric_type": q_numeric_type,
    "q_pk_duplicates": q_pk_duplicates,
    "q_fk_orphans": q_fk_orphans,
    "q_fk_window": q_fk_window,
    "q_retry": q_retry,
    "q_summary": q_summary,
    "q_key_records": q_key_records,
    "q_error_records": q_error_records,
    "d_customer_staging": d_customer_staging,
    "d_dim_customer": d_dim_customer,
    "d_dim_product": _dimension("DimProduct"),
    "d_dim_store": _dimension("DimStore"),
    "d_dim_employee": _dimension("DimEmployee"),
    "d_manager_keys": d_manager_keys,
    "d_dim_vendor": _dimension("DimVendor", "OnTimeDeliveryRate", "QualityScore"),
    "d_vendor_scores": d_vendor_scores,
    "d_dim_warehouse": _dimension("DimWarehouse"),
    "d_dim_promotion": _dimension("DimPromotion"),
    "d_dim_sales_territory": _dimension("DimSalesTerritory"),
    "d_dim_region": _dimension("DimRegion"),
    "d_dim_product_category": _dimension("DimProductCategory"),
    "d_product_history": d_product_history,
    "d_change_set": d_change_set,
    "d_scd2_history": d_scd2_history,
    "d_scd2_merge": d_scd2_merge,
    "d_scd1_upsert": d_scd1_upsert,
    "d_date": d_date,
    "k1_fact_sales": k1_fact_sales,
    "k1_fact_sales_keyed": k1_fact_sales_keyed,
    "k2_fact_purchases": k2_fact_purchases,
    "k3_fact_inventory": k3_fact_inventory,
    "k4_fact_production": k4_fact_production,
    "k5_fact_employee_sales": k5_fact_employee_sales,
    "k6_fact_customer_feedback": k6_fact_customer_feedback,
    "k7_fact_promotion_response": k7_fact_promotion_response,
    "k8_fact_finance": k8_fact_finance,
    "k9_fact_returns": k9_fact_returns,
    "g1_daily_sales": g1_daily_sales,
    "g2_weekly_sales": g2_weekly_sales,
    "g3_monthly_sales": g3_monthly_sales,
    "g4_daily_inventory": g4_daily_inventory,
    "g5_monthly_product_performance": g5_monthly_product_performance,
    "g6_regional_sales": g6_regional_sales,
    "g_partition_refresh": g_partition_refresh,
    "v_employee": _view(views.v_employee, ("additionalcontactinfo",)),
    "v_employee_department": _view(views.v_employee_department),
    "v_employee_department_history": _view(views.v_employee_department_history),
    "v_individual_customer": _view(views.v_individual_customer, ("demographics",)),
    "v_product_and_description": _view(views.v_product_and_description),
    "v_sales_person": _view(views.v_sales_person),
    "v_fiscal_data": _view(views.v_sales_person_sales_by_fiscal_years_data),
    "v_fiscal_pivot": v_fiscal_pivot,
    "v_state_province_country_region": _view(views.v_state_province_country_region),
    "v_store_with_contacts": _view(views.v_store_with_contacts),
    "v_store_with_addresses": _view(views.v_store_with_addresses),
    "v_vendor_with_contacts": _view(views.v_vendor_with_contacts),
    "v_vendor_with_addresses": _view(views.v_vendor_with_addresses),
    "v_additional_contact_info": _view(xml_views.v_additional_contact_info, dated=True),
    "v_person_demographics": _view(xml_views.v_person_demographics),
    "v_job_candidate": _view(lambda t: _plain_names(xml_views.v_job_candidate(t)), dated=True),
    "v_job_candidate_employment": _view(lambda t: _plain_names(xml_views.v_job_candidate_employment(t))),
    "v_job_candidate_education": _view(lambda t: _plain_names(xml_views.v_job_candidate_education(t))),
    "v_product_model_catalog": _view(xml_views.v_product_model_catalog_description, dated=True),
    "v_product_model_instructions": _view(xml_views.v_product_model_instructions, dated=True),
    "v_store_with_demographics": _view(xml_views.v_store_with_demographics),
    "v_hierarchy": v_hierarchy,
    "v_shorthand": v_shorthand,
    "v_materialized_refresh": v_materialized_refresh,
    **runs.QUERIES,
}
