"""The benchmark tables and the role frames the facts are computed from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: The run date of the staging jobs and the day of the inventory snapshot.
AS_OF = dt.date(2001, 12, 31)
STOCK_DAY = dt.date(2001, 11, 30)
#: Calendar span that point-in-time lookups lay versions out over.
SINCE, UNTIL = dt.date(1995, 1, 1), dt.date(2001, 12, 31)

CASH = "decimal(14,2)"
RATE = "decimal(3,2)"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def gross() -> Column:
    return F.col("l_extendedprice").cast(CASH)


def rate() -> Column:
    return F.col("l_discount").cast(RATE)


def net() -> Column:
    """Price after discount.  Both factors are decimals that keep the product in 64 bits."""
    return (gross() * (F.lit(1).cast("decimal(1,0)") - rate()).cast(RATE)).cast("decimal(18,2)")


def lines(spark: SparkSession, folder: str, category: bool = False) -> DataFrame:
    """Order lines with their order's date and customer, and their part's category if asked.

    The order join comes last: what follows finds the lines partitioned by order.  Amounts are
    computed after it, where the work is spread by shuffle partition and not by file split.
    """
    line = load(spark, folder, "lineitem")
    extra = []
    if category:
        part = load(spark, folder, "part").select("p_partkey", F.col("p_type").alias("category"))
        line = line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        extra = ["category"]
    order = load(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("order_date"))
    joined = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    return _line_columns(joined, "customer_id", "order_date", *extra)


def _line_columns(line: DataFrame, *extra: str) -> DataFrame:
    return line.select(
        *extra,
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id"),
        F.col("l_suppkey").alias("employee_id"), F.col("l_quantity").cast("int").alias("quantity"),
        net().alias("revenue"), (gross() * rate()).cast("decimal(18,2)").alias("discount_amount"),
        (rate() * 100).cast("int").alias("offer_id"), F.col("l_returnflag").alias("return_flag"),
        F.col("l_shipdate").cast("date").alias("ship_date"))


def places(spark: SparkSession, folder: str) -> DataFrame:
    nation = load(spark, folder, "nation").select("n_nationkey", F.col("n_regionkey").alias("RegionKey"))
    return (
        load(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("CustomerKey"), F.col("c_mktsegment").alias("SegmentKey"),
                "RegionKey", F.col("c_nationkey").alias("SalesTerritoryKey"))
    )


def purchase_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines seen from the vendor's side; the receipt date is the ship date."""
    return load(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("purchase_date"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("vendor_id"), gross().alias("amount"),
        F.col("l_quantity").cast("int").alias("quantity"))


def stock(spark: SparkSession, folder: str) -> DataFrame:
    """Stock per part and supplier, last moved on the newest ship date."""
    moved = (
        load(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("warehouse_id"))
        .agg(F.sum(F.col("l_quantity").cast("int")).alias("quantity"),
             F.max("l_shipdate").cast("date").alias("last_receipt"))
    )
    product = load(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_size").alias("reorder_level"),
        (F.col("p_size") * 2).alias("safety_stock"))
    return moved.join(product, "product_id").withColumn("store_id", F.col("warehouse_id"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("ProductKey"), F.col("p_type").alias("ProductCategoryKey"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("UnitCost"))


def runs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A run makes the units of one part in one order; its lines are the routing steps."""
    line = load(spark, folder, "lineitem")
    key = [F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")]
    made = line.groupBy(*key).agg(
        F.sum(F.col("l_quantity").cast("int")).alias("ordered"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("int")).otherwise(0)).alias("scrapped"),
        F.min("l_shipdate").cast("date").alias("start_date"), F.min("l_suppkey").alias("employee_id"))
    steps = line.select(*key, (F.col("l_quantity").cast("decimal(9,4)") * F.lit("0.25").cast("decimal(3,2)")).alias("hours"))
    return made, steps


def quotas(spark: SparkSession, folder: str) -> DataFrame:
    """A seller's quota of a year is the revenue shipped the year before, in force all year."""
    year = F.trunc("ship_date", "year")
    return (
        _line_columns(load(spark, folder, "lineitem"))
        .groupBy("employee_id", F.add_months(year, 12).alias("ValidFromDate"))
        .agg(F.sum("revenue").cast("decimal(18,2)").alias("quota"))
        .withColumn("ValidToDate", F.add_months("ValidFromDate", 12))
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("employee_id"), F.col("s_suppkey").alias("store_id"),
        F.col("s_nationkey").alias("territory_id"))


def feedback(spark: SparkSession, folder: str) -> DataFrame:
    score = F.least(F.lit(5), F.floor(F.col("value") / 50) + 1).cast("int")
    return load(spark, folder, "events").select(
        F.col("event_id").alias("feedback_id"), F.col("ts").cast("date").alias("feedback_date"),
        F.col("user_id").alias("customer_id"), F.lit(-1).cast("long").alias("employee_id"),
        F.col("event_type").alias("category"), score.alias("score"),
        (F.col("event_type") == "error").alias("complaint"),
        F.lit(None).cast("decimal(10,2)").alias("resolution_hours"))


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    """One invoice per order; it is paid when the last line has shipped."""
    shipped = load(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").cast("date").alias("paid"), F.min("l_suppkey").alias("store_id"))
    limit = load(spark, folder, "customer").select("c_custkey", F.col("c_acctbal").cast(CASH).alias("credit_limit"))
    order = load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("invoice_date"),
        F.col("o_totalprice").cast(CASH).alias("amount"))
    return (
        order.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(limit, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(F.col("o_orderkey").alias("invoice_id"), "invoice_date", F.col("o_custkey").alias("customer_id"),
                "store_id", "amount", F.datediff("paid", "invoice_date").alias("delay_days"), "credit_limit")
    )


def returned_units(spark: SparkSession, folder: str) -> DataFrame:
    """Returned quantities by part, store and day; needs no order."""
    return _line_columns(load(spark, folder, "lineitem")).filter("return_flag = 'R'").select(
        F.col("ship_date").alias("ReturnDateKey"), F.col("product_id").alias("ProductKey"),
        F.col("store_id").alias("StoreKey"), F.col("quantity").alias("ReturnedQuantity"))


def returns(sales_lines: DataFrame) -> DataFrame:
    return sales_lines.filter("return_flag = 'R'").select(
        (F.col("order_id") * 10 + F.col("line_no")).alias("return_id"), F.col("ship_date").alias("return_date"),
        "product_id", "customer_id", "store_id", F.lit("Unspecified").alias("reason"), "quantity",
        F.col("revenue").alias("refund"))
