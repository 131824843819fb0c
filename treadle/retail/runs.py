"""Whole daily runs over source-shaped tables made from the benchmark tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treadle.operators import sinks
from treadle.plans.daily import DailyRun
from treadle.retail import tables as r
from treadle.retail.tables import load
from treadle.session import run_folder
from treadle.sources import catalog

WINDOW = (dt.datetime(1995, 1, 1), dt.datetime(2001, 12, 31))
KEYS = {
    "sales.salesorderheader": ("salesorderid",), "sales.salesorderdetail": ("salesorderid", "salesorderdetailid"),
    "sales.specialoffer": ("specialofferid",), "sales.customer": ("customerid",), "production.product": ("productid",),
    "production.productsubcategory": ("productsubcategoryid",), "production.productcategory": ("productcategoryid",),
    "production.productmodel": ("productmodelid",),
}


def _changed(day: Column | str) -> Column:
    return (F.lit(day) if isinstance(day, str) else day).cast("timestamp_ntz").alias("modifieddate")


def shop(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Orders, their lines, offers, customers and products; the day of an order is its last change."""
    order, line, part = (load(spark, folder, n) for n in ("orders", "lineitem", "part"))
    money = "decimal(19,4)"
    started = "1995-01-01"
    dates = order.select("o_orderkey", "o_orderdate")
    offer = (r.rate() * 100).cast("int").alias("specialofferid")
    return {
        "sales.salesorderheader": order.select(
            F.col("o_orderkey").alias("salesorderid"), F.col("o_orderdate").cast("timestamp_ntz").alias("orderdate"),
            F.date_add("o_orderdate", 30).cast("timestamp_ntz").alias("duedate"), F.date_add("o_orderdate", 7).cast("timestamp_ntz").alias("shipdate"),
            F.col("o_custkey").alias("customerid"), F.lit(None).cast("int").alias("salespersonid"),
            F.lit(None).cast("int").alias("territoryid"), F.col("o_totalprice").cast(money).alias("totaldue"),
            _changed(F.col("o_orderdate"))),
        "sales.salesorderdetail": line.join(dates, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("salesorderid"), F.col("l_linenumber").alias("salesorderdetailid"),
            F.col("l_partkey").alias("productid"), offer, F.col("l_quantity").cast("smallint").alias("orderqty"),
            F.col("l_extendedprice").cast(money).alias("unitprice"), F.lit(0).cast(money).alias("unitpricediscount"),
            _changed(F.col("o_orderdate"))),
        "sales.specialoffer": line.select(offer, r.rate().cast(money).alias("discountpct")).distinct().select(
            "specialofferid", F.concat(F.lit("Offer "), F.col("specialofferid")).alias("description"), "discountpct",
            F.lit("Discount").alias("type"), F.lit("Reseller").alias("category"),
            F.lit(started).cast("timestamp_ntz").alias("startdate"), F.lit("2005-12-31").cast("timestamp_ntz").alias("enddate"),
            _changed(started)),
        "sales.customer": load(spark, folder, "customer").select(
            F.col("c_custkey").alias("customerid"), F.col("c_custkey").alias("personid"), F.lit(None).cast("int").alias("storeid"),
            F.col("c_nationkey").alias("territoryid"), _changed(started)),
        "production.product": part.select(
            F.col("p_partkey").alias("productid"), F.col("p_name").alias("name"), F.col("p_brand").alias("productnumber"),
            F.lit(None).cast("string").alias("color"), F.lit(None).cast("string").alias("size"), F.lit(None).cast("decimal(8,2)").alias("weight"),
            F.lit(1).cast("smallint").alias("safetystocklevel"), F.lit(1).cast("smallint").alias("reorderpoint"),
            F.col("p_size").cast(money).alias("standardcost"), F.col("p_retailprice").cast(money).alias("listprice"),
            F.col("p_size").alias("productsubcategoryid"), F.lit(None).cast("int").alias("productmodelid"),
            F.lit(started).cast("timestamp_ntz").alias("sellstartdate"), F.lit(None).cast("timestamp_ntz").alias("sellenddate"),
            F.lit(None).cast("timestamp_ntz").alias("discontinueddate"), _changed(started)),
        "production.productsubcategory": part.select(F.col("p_size").alias("productsubcategoryid"), (F.col("p_size") % 5).alias(
            "productcategoryid"), F.concat(F.lit("Sub "), F.col("p_size")).alias("name"), _changed(started)).distinct(),
        "production.productcategory": part.select((F.col("p_size") % 5).alias("productcategoryid")).distinct().select(
            "productcategoryid", F.concat(F.lit("Category "), F.col("productcategoryid")).alias("name"), _changed(started)),
        "production.productmodel": part.select(F.col("p_partkey").alias("productmodelid"), F.col("p_brand").alias("name"), _changed(started)),
    }


def day(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, as_of: dt.date, marts: list[str],
        targets: Sequence[str]) -> DailyRun:
    """One daily run; line keys of the benchmark are not unique, so tables with doubled keys are let through."""
    specs = catalog.describe(tables, KEYS)
    run = DailyRun(spark, specs, tables.__getitem__, root, as_of, batch=f"b-{as_of}", window=WINDOW, allow_failed=True)
    run.run(marts, targets)
    return run


def g_incremental_day(spark: SparkSession, folder: str) -> DataFrame:
    """Two daily runs, between which the orders of a month move into the next one.

    The second run lands those orders only, empties the one month and rebuilds the other; ``rebuilt`` says
    which months of fact and mart have other files than before.
    """
    root, tables, marts = run_folder(spark, "increment"), shop(spark, folder), ["agg_daily_sales"]
    targets = ("DimProduct", "DimProductCategory", "FactSales")
    day(spark, tables, root, dt.date(2001, 12, 30), marts, targets)

    def files(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/{name}").select("month", F.col("_metadata.file_name").alias("file")).distinct()

    before = {n: run_folder(spark, "files") for n in ("FactSales", *marts)}
    for name, path in before.items():  # a row per file
        files(name).write.parquet(path)
    head = tables["sales.salesorderheader"]
    late = F.date_format("orderdate", "yyyy-MM") == "1997-06"
    moved = head.withColumn("modifieddate", F.when(late, F.lit("2001-12-31").cast("timestamp_ntz")).otherwise(F.col("modifieddate"))) \
        .withColumns({c: F.when(late, F.lit(to).cast("timestamp_ntz")).otherwise(F.col(c)) for c, to in (
            ("orderdate", "1997-07-15"), ("shipdate", "1997-07-20"), ("duedate", "1997-08-15"))})
    run = day(spark, {**tables, "sales.salesorderheader": moved}, root, dt.date(2001, 12, 31), marts, targets)
    landed = run.landed.increment("sales.salesorderheader").agg(F.count("*").alias("landed"))

    def months(name: str, amount: str) -> DataFrame:
        sums = spark.read.parquet(f"{root}/{name}").groupBy("month").agg(
            F.count("*").alias("n_rows"), F.sum(amount).cast("decimal(18,2)").alias("revenue"))
        fresh = files(name).join(spark.read.parquet(before[name]), ["month", "file"], "left_anti").select("month").distinct()
        return sums.join(fresh.withColumn("rebuilt", F.lit(True)), "month", "left").select(
            F.lit(name).alias("name"), "month", "n_rows", "revenue", F.coalesce("rebuilt", F.lit(False)).alias("rebuilt"))

    return months("FactSales", "SalesRevenue").unionByName(months("agg_daily_sales", "TotalRevenue")).join(F.broadcast(landed))


def _products(spark: SparkSession, folder: str, price: Column, changed: str) -> dict[str, DataFrame]:
    """The product tables with a list price, changed on a day."""
    tables = shop(spark, folder)
    given = tables["production.product"].withColumn("listprice", price.cast("decimal(19,4)")).withColumn(
        "modifieddate", F.lit(changed).cast("timestamp_ntz"))
    names = ("production.productsubcategory", "production.productcategory", "production.productmodel")
    return {"production.product": given, **{n: tables[n] for n in names}}


def d_late_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Product versions after three daily runs and a fourth for a day between two closed versions."""
    root, part = run_folder(spark, "late"), F.col("productid")
    for n, as_of in enumerate((dt.date(1997, 1, 1), dt.date(1998, 1, 1), dt.date(1999, 1, 1)), 1):
        day(spark, _products(spark, folder, F.col("listprice") + n * (part % 3), f"2002-01-0{n}"), root, as_of, [], ("DimProduct",))
    late = F.col("listprice") + F.when(part % 5 == 0, 7).otherwise(part % 3)
    run = day(spark, _products(spark, folder, late, "2002-01-04"), root, dt.date(1997, 7, 1), [], ("DimProduct",))
    return run.table("DimProduct").read().select("ProductID", "ListPrice", "ValidFromDate", "ValidToDate", "IsCurrent")


def d_dense_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of versions and keys of the product dimension after two days, the second run twice."""
    root, part = run_folder(spark, "keys"), F.col("productid")
    out = []
    for n, as_of in enumerate((dt.date(1997, 1, 1), dt.date(1998, 1, 1), dt.date(1998, 1, 1)), 1):
        run = day(spark, _products(spark, folder, F.col("listprice") + min(n, 2) * (part % 3), f"2002-01-0{n}"), root, as_of, [], ("DimProduct",))
        out.append(run.table("DimProduct").read().agg(
            F.lit(n).alias("run"), F.count("*").alias("versions"), F.countDistinct("ProductKey").alias("keys"),
            F.min("ProductKey").alias("least"), F.max("ProductKey").alias("largest"),
            F.countDistinct("ProductID", "ValidFromDate").alias("starts")))
    return reduce(DataFrame.unionByName, out)


def k1_sales_by_price(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per product version, whose price and cost follow two histories of their own."""
    tables, line = shop(spark, folder), load(spark, folder, "lineitem")

    def observed(status: str, name: str, value: Column) -> DataFrame:
        return line.filter(F.col("l_linestatus") == status).groupBy(
            F.col("l_partkey").alias("productid"), F.col("l_shipdate").cast("date").cast("timestamp_ntz").alias("startdate")).agg(
            F.max(value).cast("decimal(19,4)").alias(name)).withColumn("modifieddate", F.col("startdate"))

    tables |= {"production.productlistpricehistory": observed("O", "listprice", r.rate() + 1),
               "production.productcosthistory": observed("F", "standardcost", F.col("l_tax").cast(r.RATE) + 1)}
    root = run_folder(spark, "prices")
    run = day(spark, tables, root, dt.date(2001, 12, 31), [], ("DimProduct", "FactSales"))
    sums = sinks.read_months(spark, f"{root}/FactSales").groupBy("ProductKey").agg(
        F.count("*").alias("sales"), F.sum("SalesRevenue").cast("decimal(18,2)").alias("revenue"))
    version = run.table("DimProduct").read().select("ProductKey", "ProductID", "ListPrice", "Cost", "ValidFromDate")
    return sums.join(version, "ProductKey", "left").drop("ProductKey")


def q_retry_run(spark: SparkSession, folder: str) -> DataFrame:
    """Error records after three daily runs: products without a fair price, of which some are mended."""
    root, part, price = run_folder(spark, "retry"), F.col("productid"), F.col("listprice")
    bad = F.when(part % 7 == 0, -price).otherwise(price)
    mended = F.when((part % 7 == 0) & (part % 2 == 1), -price).otherwise(price)
    for n, listed in enumerate((bad, mended, mended), 1):
        tables = _products(spark, folder, listed, "2002-01-01")
        if n > 1:  # mended rows have changed since, the others have not
            late = F.when((part % 14 == 0), F.lit("2002-01-02").cast("timestamp_ntz")).otherwise(F.col("modifieddate"))
            tables["production.product"] = tables["production.product"].withColumn("modifieddate", late)
        run = day(spark, tables, root, dt.date(2002, 1, n), [], ())
    return run.error_state().groupBy("SourceTable", "ErrorType", "ErrorMessage", "IsResolved", "RetryCount", "ResolutionComment").agg(
        F.count("*").alias("records"), F.max("LastAttemptDate").cast("date").alias("last_attempt"))


QUERIES = {f.__name__: f for f in (g_incremental_day, d_late_versions, d_dense_keys, k1_sales_by_price, q_retry_run)}
