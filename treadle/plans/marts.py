"""Aggregate marts over the facts.

Sums, minima and counts combine map-side, so a hot store or month reaches the shuffle as
one row per task.  Keys have whatever type the dimension frames give them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from treadle.functions.scalars import month_start, ratio, week_start
from treadle.operators.lookup import band_lookup
from treadle.operators.measures import growth

MONEY = "decimal(18,2)"


def with_category(sales: DataFrame, categories: DataFrame | None) -> DataFrame:
    """Sales with their category; None when the sales already carry it.

    Lookups in the marts are left joins: a sale without a match is summed under NULL, so the
    totals of a mart are the totals of its facts.
    """
    return sales if categories is None else sales.join(categories, "ProductKey", "left")


def daily_sales(sales: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Store x category x day.

    The distinct count works on (group, order): sales that arrive partitioned by order, with
    their category on them, need no shuffle for that step.

    sales: fact_sales; categories: ProductKey, ProductCategoryKey
    """
    return (
        with_category(sales, categories)
        .groupBy("SalesDateKey", "StoreKey", "ProductCategoryKey")
        .agg(F.sum("SalesRevenue").cast(MONEY).alias("TotalRevenue"),
             F.sum("QuantitySold").alias("TotalQuantity"),
             F.sum("DiscountAmount").cast(MONEY).alias("TotalDiscount"),
             F.countDistinct("SalesOrderID").alias("TransactionCount"))
    )


def weekly_sales(sales: DataFrame, places: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Region x category x week; weeks start on Sunday.

    Lines are first brought to customer x category x week, so a customer with a third of the
    lines meets the customer lookup as one row per week and category.

    places: CustomerKey, RegionKey
    """
    by = ["WeekStartDateKey", "RegionKey", "ProductCategoryKey"]
    weekly = (
        with_category(sales, categories)
        .groupBy("CustomerKey", "ProductCategoryKey", week_start(F.col("SalesDateKey")).alias("WeekStartDateKey"))
        .agg(F.sum("SalesRevenue").alias("s"), F.count("SalesRevenue").alias("n"),
             F.min("SalesRevenue").alias("low"), F.max("SalesRevenue").alias("high"))
    )
    return (
        weekly.join(places.select("CustomerKey", "RegionKey"), "CustomerKey", "left").groupBy(*by)
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.min("low").alias("MinRevenue"),
             F.max("high").alias("MaxRevenue"))
        .select(*by, F.col("s").cast(MONEY).alias("SumRevenue"), ratio(F.col("s"), F.col("n")).alias("AvgRevenue"),
                "MinRevenue", "MaxRevenue")
    )


def monthly_sales(sales: DataFrame, places: DataFrame) -> DataFrame:
    """Segment x region x month.

    Two exact distinct counts at once would copy every line; instead lines are summed to
    orders, orders to customer-months, and those are counted.

    places: CustomerKey, SegmentKey, RegionKey
    """
    orders = sales.groupBy("SalesOrderID", "CustomerKey", month_start(F.col("SalesDateKey")).alias("MonthStartDateKey")).agg(
        F.sum("SalesRevenue").alias("revenue"))
    customers = orders.groupBy("CustomerKey", "MonthStartDateKey").agg(
        F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))
    by = ["MonthStartDateKey", "SegmentKey", "RegionKey"]
    return (
        customers.join(places.select("CustomerKey", "SegmentKey", "RegionKey"), "CustomerKey", "left")
        .groupBy(*by)
        .agg(F.sum("revenue").alias("s"), F.sum("orders").alias("n"), F.count("*").alias("c"))
        .select("MonthStartDateKey", F.col("SegmentKey").alias("CustomerSegmentKey"), "RegionKey",
                F.col("s").cast(MONEY).alias("TotalRevenue"), ratio(F.col("s"), F.col("n")).alias("AvgOrderValue"),
                F.col("c").alias("DistinctCustomerCount"))
    )


def daily_inventory(inventory: DataFrame, products: DataFrame, tiers: DataFrame) -> DataFrame:
    """Warehouse x category x aging tier x day: average value of the stock rows.

    products: ProductKey, ProductCategoryKey, UnitCost; tiers: AgingTierKey, MinAgingDays,
    MaxAgingDays
    """
    tiered = band_lookup(inventory, tiers, "StockAgingDays", {"AgingTierKey": "AgingTierKey"},
                         low="MinAgingDays", high="MaxAgingDays")
    by = ["InventoryDateKey", "WarehouseKey", "ProductCategoryKey", "AgingTierKey"]
    value = F.col("QuantityOnHand") * F.col("UnitCost")
    return (
        tiered.join(products, "ProductKey", "left").groupBy(*by)
        .agg(F.sum(value).alias("s"), F.count(value).alias("n"))
        .select(*by, ratio(F.col("s"), F.col("n")).alias("AvgInventoryValue"))
    )


def monthly_product_performance(sales: DataFrame, returns: DataFrame, ratings: DataFrame) -> DataFrame:
    """Product x store x month.

    Sales and returns are summed together, so returns of a month without a sale stay (their rate
    is NULL), and a missing store is one group.  Ratings are brought to their own grain first.

    returns: fact_returns; ratings: ProductKey, FeedbackScore
    """
    by = ["MonthStartDateKey", "ProductKey", "StoreKey"]
    none = F.lit(0).cast("long")
    sold = sales.select(month_start(F.col("SalesDateKey")).alias(by[0]), *by[1:], "SalesRevenue",
                        F.col("QuantitySold").cast("long").alias("units"), none.alias("back"))
    back = returns.select(month_start(F.col("ReturnDateKey")).alias(by[0]), *by[1:],
                          F.lit(0).cast(sales.schema["SalesRevenue"].dataType).alias("SalesRevenue"), none.alias("units"),
                          F.col("ReturnedQuantity").cast("long").alias("back"))
    rated = ratings.groupBy("ProductKey").agg(
        F.sum("FeedbackScore").alias("points"), F.count("FeedbackScore").alias("votes"))
    return (
        sold.unionByName(back).groupBy(*by)
        .agg(F.sum("SalesRevenue").cast(MONEY).alias("TotalRevenue"), F.sum("units").alias("UnitsSold"),
             F.sum("back").alias("UnitsReturned"))
        .join(rated, "ProductKey", "left")
        .select(*by, "TotalRevenue", "UnitsSold", "UnitsReturned",
                ratio(F.col("UnitsReturned"), F.col("UnitsSold"), 100.0).alias("ReturnRate"),
                ratio(F.col("points"), F.col("votes")).alias("AvgRating"))
    )


def regional_totals(sales: DataFrame, places: DataFrame) -> DataFrame:
    """Region x territory x month revenue.

    Sums are taken per customer and month before the customer lookup.

    places: CustomerKey, RegionKey, SalesTerritoryKey
    """
    monthly = sales.groupBy("CustomerKey", month_start(F.col("SalesDateKey")).alias("MonthStartDateKey")).agg(
        F.sum("SalesRevenue").alias("revenue"))
    by = ["MonthStartDateKey", "RegionKey", "SalesTerritoryKey"]
    return (
        monthly.join(places.select("CustomerKey", "RegionKey", "SalesTerritoryKey"), "CustomerKey", "left")
        .groupBy(*by).agg(F.sum("revenue").cast(MONEY).alias("TotalRevenue"))
    )


def with_growth(totals: DataFrame) -> DataFrame:
    """Growth against the month before; NULL if that month has no sales."""
    return growth(totals, ["RegionKey", "SalesTerritoryKey"], "MonthStartDateKey", "TotalRevenue", "GrowthRate")


def regional_sales(sales: DataFrame, places: DataFrame) -> DataFrame:
    """Region x territory x month with revenue and growth; see :func:`regional_totals`."""
    return with_growth(regional_totals(sales, places))


def regional_refresh(mart: DataFrame, sales: DataFrame, places: DataFrame, months: Sequence[str]) -> DataFrame:
    """The whole mart after some months' sales changed.

    Only those months' sales are read; growth is cut anew over the mart's own rows, since a
    changed month moves the growth of whichever month comes next.
    """
    fresh = regional_totals(sales, places)
    rest = mart.filter(~F.date_format("MonthStartDateKey", "yyyy-MM").isin(*months)).select(*fresh.columns)
    return with_growth(fresh.unionByName(rest))


def only_months(sales: DataFrame, day: str, months: Sequence[str]) -> DataFrame:
    """The rows of the given months (first days), as a range filter the scan can use."""
    test = F.lit(False)
    for m in months:
        low = F.lit(m).cast("date")
        test = test | ((F.col(day) >= low) & (F.col(day) < F.add_months(low, 1)))
    return sales.filter(test)
