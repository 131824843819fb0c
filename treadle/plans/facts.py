"""Fact tables.

A fact is computed from a *role frame*: a frame with the columns named in each docstring.
Role frames come from the source tables (``*_from_source``) or from any other binding.
Keys in the result are natural keys until :func:`with_surrogates` replaces them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from treadle.functions.scalars import line_total, ratio
from treadle.operators.checks import WARNING, Rule
from treadle.operators.lookup import UNKNOWN, asof_lookup, or_unknown

Tables = Mapping[str, DataFrame]

MONEY = "decimal(18,2)"


def _unknown() -> Column:
    return F.lit(UNKNOWN).cast("long")


# --- role frames from the source tables ----------------------------------------------------


#: The source's type of the offer that is no promotion.
NO_DISCOUNT = "No Discount"


def sales_lines_from_source(t: Tables) -> DataFrame:
    """Order lines with their header's date and parties; offer 0 stands for no promotion."""
    offers = t["sales.specialoffer"].select(
        "specialofferid", ((F.col("type") == NO_DISCOUNT) | (F.col("discountpct") == 0)).alias("none"))
    detail = t["sales.salesorderdetail"].join(offers, "specialofferid", "left").select(
        F.col("salesorderid").alias("order_id"), F.col("salesorderdetailid").alias("line_no"),
        F.col("productid").alias("product_id"),
        F.when(F.coalesce("none", F.lit(False)), F.lit(0)).otherwise(F.col("specialofferid")).alias("offer_id"),
        F.col("orderqty").cast("int").alias("quantity"),
        (F.col("unitprice") * F.col("orderqty")).cast(MONEY).alias("list_amount"),
        line_total(F.col("unitprice"), F.col("unitpricediscount"), F.col("orderqty")).cast(MONEY).alias("revenue"),
        (F.col("unitprice") * F.col("unitpricediscount") * F.col("orderqty")).cast(MONEY).alias("discount_amount"))
    header = t["sales.salesorderheader"].select(
        F.col("salesorderid").alias("order_id"), F.col("orderdate").cast("date").alias("order_date"),
        F.col("shipdate").cast("date").alias("ship_date"), F.col("customerid").alias("customer_id"),
        F.col("salespersonid").alias("employee_id"), F.col("territoryid").alias("territory_id"))
    stores = t["sales.customer"].select(F.col("customerid").alias("customer_id"),
                                        F.col("storeid").alias("store_id"))
    # the store is put on the orders, which are fewer than the lines
    return detail.join(header.join(stores, "customer_id", "left"), "order_id")


def purchase_lines_from_source(t: Tables) -> DataFrame:
    detail = t["purchasing.purchaseorderdetail"].select(
        "purchaseorderid", F.col("productid").alias("product_id"),
        F.col("orderqty").cast("int").alias("quantity"),
        (F.col("orderqty") * F.col("unitprice")).cast(MONEY).alias("amount"))
    header = t["purchasing.purchaseorderheader"].select(
        "purchaseorderid", F.col("orderdate").cast("date").alias("purchase_date"),
        F.col("vendorid").alias("vendor_id"))
    return detail.join(header, "purchaseorderid").drop("purchaseorderid")


def stock_from_source(t: Tables) -> DataFrame:
    """Stock per product and location, with the last receipt from the vendors."""
    product = t["production.product"].select(
        "productid", F.col("reorderpoint").cast("int").alias("reorder_level"),
        F.col("safetystocklevel").cast("int").alias("safety_stock"),
        F.col("standardcost").alias("unit_cost"))
    receipt = (
        t["purchasing.productvendor"].groupBy("productid")
        .agg(F.max(F.col("lastreceiptdate").cast("date")).alias("last_receipt"))
    )
    stock = t["production.productinventory"].groupBy("productid", F.col("locationid").alias("warehouse_id")).agg(
        F.sum("quantity").alias("quantity"))
    return (
        stock.join(product, "productid").join(receipt, "productid", "left")
        .withColumnRenamed("productid", "product_id").withColumn("store_id", _unknown())
    )


def runs_from_source(t: Tables) -> tuple[DataFrame, DataFrame]:
    runs = t["production.workorder"].select(
        F.col("workorderid").alias("run_id"), F.col("productid").alias("product_id"),
        F.col("startdate").cast("date").alias("start_date"), F.col("orderqty").alias("ordered"),
        F.col("scrappedqty").cast("int").alias("scrapped"), _unknown().alias("employee_id"))
    steps = t["production.workorderrouting"].select(
        F.col("workorderid").alias("run_id"), F.col("actualresourcehrs").alias("hours"))
    return runs, steps


def quotas_from_source(t: Tables) -> DataFrame:
    """Quota intervals of each sales person."""
    # a person has a handful of quotas a year
    later = F.lead(F.col("quotadate").cast("date")).over(
        Window.partitionBy("businessentityid").orderBy("quotadate"))
    return t["sales.salespersonquotahistory"].select(
        F.col("businessentityid").alias("employee_id"), F.col("quotadate").cast("date").alias("ValidFromDate"),
        later.alias("ValidToDate"), F.col("salesquota").cast(MONEY).alias("quota"))


def sellers_from_source(t: Tables) -> DataFrame:
    return t["sales.salesperson"].select(
        F.col("businessentityid").alias("employee_id"), _unknown().alias("store_id"),
        F.col("territoryid").alias("territory_id"))


def feedback_from_source(t: Tables) -> DataFrame:
    """Product reviews: the nearest the source has; it names no handler and no resolution."""
    return t["production.productreview"].select(
        F.col("productreviewid").cast("long").alias("feedback_id"),
        F.col("reviewdate").cast("date").alias("feedback_date"), _unknown().alias("customer_id"),
        _unknown().alias("employee_id"), F.lit("Product Quality").alias("category"),
        F.col("rating").cast("int").alias("score"), (F.col("rating") <= 2).alias("complaint"),
        F.lit(None).cast("decimal(10,2)").alias("resolution_hours"),
        F.col("productid").alias("product_id"))


def invoices_from_source(t: Tables) -> DataFrame:
    header = t["sales.salesorderheader"].select(
        F.col("salesorderid").cast("long").alias("invoice_id"),
        F.col("orderdate").cast("date").alias("invoice_date"), F.col("customerid").alias("customer_id"),
        F.col("totaldue").cast("decimal(14,2)").alias("amount"),
        F.datediff(F.col("shipdate").cast("date"), F.col("duedate").cast("date")).alias("delay_days"),
        F.lit(None).cast(MONEY).alias("credit_limit"))
    stores = t["sales.customer"].select(F.col("customerid").alias("customer_id"),
                                        F.col("storeid").alias("store_id"))
    return header.join(stores, "customer_id", "left")


# --- facts ---------------------------------------------------------------------------------


def fact_sales(lines: DataFrame, carry: Mapping[str, str] | None = None) -> DataFrame:
    """One row per order line; the order id stays as a degenerate column.

    lines: order_id, order_date, customer_id, product_id, store_id, employee_id, revenue,
    quantity, discount_amount.  ``carry`` keeps further line columns under new names.
    """
    return lines.select(
        F.col("order_date").alias("SalesDateKey"), F.col("customer_id").alias("CustomerKey"),
        F.col("product_id").alias("ProductKey"), F.col("store_id").alias("StoreKey"),
        F.col("employee_id").alias("EmployeeKey"), F.col("revenue").alias("SalesRevenue"),
        F.col("quantity").alias("QuantitySold"), F.col("discount_amount").alias("DiscountAmount"),
        F.col("order_id").alias("SalesOrderID"), *[F.col(c).alias(n) for c, n in (carry or {}).items()])


def fact_purchases(lines: DataFrame) -> DataFrame:
    """One row per purchase line.  The source has no purchase discount, so it is zero.

    lines: purchase_date, product_id, vendor_id, amount, quantity
    """
    unit = F.col("amount") / F.nullif(F.col("quantity").cast("decimal(10,0)"), F.lit(0).cast("decimal(10,0)"))
    return lines.select(
        F.col("purchase_date").alias("PurchaseDateKey"), F.col("product_id").alias("ProductKey"),
        F.col("vendor_id").alias("VendorKey"), F.col("amount").cast(MONEY).alias("PurchaseAmount"),
        F.col("quantity").alias("PurchaseQuantity"), F.lit(0).cast(MONEY).alias("DiscountAmount"),
        unit.cast(MONEY).alias("UnitCost"))


def fact_inventory(stock: DataFrame, day: dt.date) -> DataFrame:
    """The stock snapshot of one day: one row per product and warehouse.

    stock: product_id, warehouse_id, store_id, quantity, last_receipt, reorder_level,
    safety_stock
    """
    return stock.select(
        F.lit(day).alias("InventoryDateKey"), F.col("product_id").alias("ProductKey"),
        F.col("store_id").alias("StoreKey"), F.col("warehouse_id").alias("WarehouseKey"),
        F.col("quantity").cast("long").alias("QuantityOnHand"),
        F.datediff(F.lit(day), F.col("last_receipt")).alias("StockAgingDays"),
        F.col("reorder_level").alias("ReorderLevel"), F.col("safety_stock").alias("SafetyStock"))


def fact_production(runs: DataFrame, steps: DataFrame, key: Sequence[str] = ("run_id",)) -> DataFrame:
    """One row per production run; hours are summed over its routing steps.

    runs: the key, product_id, start_date, ordered, scrapped, employee_id
    steps: the key, hours
    """
    hours = steps.groupBy(*key).agg(F.sum("hours").alias("hours"))
    return runs.join(hours, list(key), "left").select(
        F.col("start_date").alias("ProductionDateKey"), F.col("product_id").alias("ProductKey"),
        F.col("employee_id").alias("EmployeeKey"), F.col("hours").cast(MONEY).alias("ProductionTimeHours"),
        (F.col("ordered") - F.col("scrapped")).alias("UnitsProduced"),
        ratio(F.col("scrapped"), F.col("ordered"), 100.0).alias("ScrapRate"),
        F.col("scrapped").alias("DefectCount"))


def fact_employee_sales(lines: DataFrame, quotas: DataFrame, sellers: DataFrame, since: dt.date,
                        until: dt.date) -> DataFrame:
    """One row per employee and day, with the quota in force and the customers met.

    Lines are reduced to that grain before any lookup.

    lines: order_date, employee_id, revenue, customer_id
    quotas: employee_id, ValidFromDate, ValidToDate, quota
    sellers: employee_id, store_id, territory_id
    """
    daily = (
        lines.filter("employee_id IS NOT NULL").groupBy("order_date", "employee_id")
        .agg(F.sum("revenue").cast(MONEY).alias("revenue"), F.countDistinct("customer_id").alias("contacts"))
    )
    targeted = asof_lookup(daily, quotas, {"employee_id": "employee_id"}, "order_date",
                           {"target": "quota"}, since=since, until=until)
    return targeted.join(sellers, "employee_id", "left").select(
        F.col("order_date").alias("SalesDateKey"), F.col("employee_id").alias("EmployeeKey"),
        F.col("store_id").alias("StoreKey"), F.col("territory_id").alias("SalesTerritoryKey"),
        F.col("revenue").alias("SalesAmount"), F.col("target").cast(MONEY).alias("SalesTarget"),
        F.col("contacts").alias("CustomerContactsCount"))


def fact_customer_feedback(feedback: DataFrame) -> DataFrame:
    """One row per submission; CSAT is the score as a share of five.

    feedback: feedback_id, feedback_date, customer_id, employee_id, category, score,
    complaint, resolution_hours
    """
    return feedback.select(
        F.col("feedback_id").alias("FeedbackID"), F.col("feedback_date").alias("FeedbackDateKey"),
        F.col("customer_id").alias("CustomerKey"), F.col("employee_id").alias("EmployeeKey"),
        F.col("category").alias("FeedbackCategoryKey"), F.col("score").alias("FeedbackScore"),
        F.col("complaint").cast("int").alias("ComplaintCount"),
        F.col("resolution_hours").cast("decimal(10,2)").alias("ResolutionTimeHours"),
        (F.col("score") * 20).cast("decimal(5,2)").alias("CSATScore"))


def fact_promotion_response(lines: DataFrame) -> DataFrame:
    """One row per product, promotion, store and day.

    Uptake is the promoted share of all lines of that product, store and day; ROI is the
    revenue earned per unit of discount, less the discount.  Lines without a promotion carry
    offer 0 and only count towards the denominator, which is summed over the aggregated
    rows: at most one per promotion.

    lines: order_date, product_id, store_id, offer_id, revenue, discount_amount
    """
    cell = ["order_date", "product_id", "store_id"]
    per_offer = lines.groupBy(*cell, "offer_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("discount_amount").alias("discount"),
        F.count("*").alias("uses"))
    everyone = F.sum("uses").over(Window.partitionBy(*cell))
    return per_offer.withColumn("everyone", everyone).filter("offer_id <> 0").select(
        F.col("order_date").alias("PromotionDateKey"), F.col("product_id").alias("ProductKey"),
        F.col("store_id").alias("StoreKey"), F.col("offer_id").alias("PromotionKey"),
        F.col("revenue").cast(MONEY).alias("SalesDuringCampaign"), F.col("uses").alias("DiscountUsageCount"),
        ratio(F.col("uses"), F.col("everyone"), 100.0).alias("CustomerUptakeRate"),
        ratio(F.col("revenue") - F.col("discount"), F.col("discount")).alias("PromotionROI"))


#: Interest per day on an invoice paid after its grace days.
DAILY_INTEREST = "0.0005"
GRACE_DAYS = 30
INVOICE = "Invoice"


def fact_finance(invoices: DataFrame) -> DataFrame:
    """One row per invoice.

    invoices: invoice_id, invoice_date, customer_id, store_id, amount, delay_days,
    credit_limit
    """
    late = F.greatest(F.col("delay_days") - GRACE_DAYS, F.lit(0)).cast("decimal(6,0)")
    interest = F.col("amount") * F.lit(DAILY_INTEREST).cast("decimal(4,4)") * late
    return invoices.select(
        F.col("invoice_id").alias("InvoiceID"), F.col("invoice_date").alias("InvoiceDateKey"),
        F.col("customer_id").alias("CustomerKey"), F.col("store_id").alias("StoreKey"),
        F.lit(INVOICE).alias("FinanceCategoryKey"), F.col("amount").cast(MONEY).alias("InvoiceAmount"),
        F.col("delay_days").alias("PaymentDelayDays"),
        ratio(F.col("amount"), F.col("credit_limit"), 100.0).alias("CreditUsage"),
        interest.cast("decimal(18,2)").alias("InterestCharges"))


RESTOCKING_SHARE = "0.10"


def fact_returns(returns: DataFrame) -> DataFrame:
    """One row per returned line; a fixed share of the refund is kept as restocking fee.

    returns: return_id, return_date, product_id, customer_id, store_id, reason, quantity,
    refund
    """
    fee = F.col("refund") * F.lit(RESTOCKING_SHARE).cast("decimal(2,2)")
    return returns.select(
        F.col("return_id").alias("ReturnID"), F.col("return_date").alias("ReturnDateKey"),
        F.col("product_id").alias("ProductKey"), F.col("customer_id").alias("CustomerKey"),
        F.col("store_id").alias("StoreKey"), F.col("reason").alias("ReturnReasonKey"),
        F.col("quantity").alias("ReturnedQuantity"), F.col("refund").cast(MONEY).alias("RefundAmount"),
        fee.cast(MONEY).alias("RestockingFee"))


# --- dimension keys and declared types -----------------------------------------------------


@dataclass(frozen=True)
class Link:
    """How one key column of a fact finds its dimension row."""

    dimension: DataFrame
    natural: str
    surrogate: str
    versioned: bool = True


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _dimension_keys(links: Mapping[str, Link], kind: str) -> DataFrame:
    """The versions of all linked dimensions in one frame; a dimension without versions is in force always."""
    parts = []
    for at, link in enumerate(links.values()):
        valid = (F.col("ValidFromDate"), F.col("ValidToDate")) if link.versioned else (F.lit(None), F.lit(None))
        parts.append(link.dimension.select(
            F.lit(at).alias("_at"), F.col(link.natural).cast(kind).alias("_nk"), F.col(link.surrogate).alias("_sk"),
            F.coalesce(valid[0].cast("date"), F.lit("0001-01-01").cast("date")).alias("ValidFromDate"), valid[1].cast("date").alias("ValidToDate")))
    return reduce(DataFrame.unionByName, parts)


def with_surrogates(fact: DataFrame, date: str, links: Mapping[str, Link], since: dt.date,
                    until: dt.date) -> DataFrame:
    """Replace natural keys by surrogate keys; no match gives the unknown member.

    All keys of a fact are looked up at once: a row becomes one small row per key, of which the first
    carries the other columns, these meet the versions of all dimensions in one point-in-time join, and
    are folded back to one row.  So a fact is shuffled twice, whatever the number of its keys.  Rows are
    told apart by two hashes of all their columns, which a repeated task gives again; equal rows fold
    into one with a count and come out as often as they went in.  A single key is looked up by the rows
    themselves, in one shuffle.
    """
    if not links:
        return fact
    columns = fact.columns
    types = dict(fact.dtypes)
    naturals = [types[c] for c in links] + [dict(v.dimension.dtypes)[v.natural] for v in links.values()]
    kind = "bigint" if all(t in _WHOLE for t in naturals) else "string"
    if len(links) == 1:
        [column] = links
        rows = fact.select(*[F.col(f"`{c}`").cast(kind).alias("_k") if c == column else F.col(f"`{c}`") for c in columns])
        found = asof_lookup(rows, _dimension_keys(links, kind), {"_k": "_nk"}, date, {"_sk": "_sk"},
                            since=since, until=until)
        return found.select(*[or_unknown(F.col("_sk")).alias(c) if c == column else F.col(f"`{c}`") for c in columns])
    marked = fact.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)],
                         F.col(date).cast("date").alias("_day"),
                         *[F.xxhash64(*[F.col(f"`{c}`") for c in columns], F.lit(seed)).alias(f"_id{seed}") for seed in (1, 2)])
    place = {c: f"_c{i}" for i, c in enumerate(columns)}
    entries = F.array(*[F.struct(F.lit(at).alias("_at"), F.col(place[c]).cast(kind).alias("_k"))
                        for at, c in enumerate(links)])
    # a key that is NULL has no version; the first entry stays, as it carries the row
    entries = F.filter(entries, lambda e: e["_k"].isNotNull() | (e["_at"] == 0))
    first = F.col("_at") == 0
    each = marked.select("*", F.inline(entries)).select(
        "_id1", "_id2", "_day", "_at", "_k", *[F.when(first, F.col(p)).alias(p) for p in place.values()])
    found = asof_lookup(each, _dimension_keys(links, kind), {"_at": "_at", "_k": "_nk"}, "_day", {"_sk": "_sk"},
                        since=since, until=until)
    folded = found.groupBy("_id1", "_id2").agg(
        F.count_if(first).alias("_n"), *[F.first(p, ignorenulls=True).alias(p) for p in place.values()],
        *[F.max(F.when(F.col("_at") == at, F.col("_sk"))).alias(f"_s{at}") for at in range(len(links))])
    again = F.when(F.col("_n") > 1, F.sequence(F.lit(1).cast("long"), F.col("_n"))).otherwise(F.array(F.lit(1).cast("long")))
    at = {c: f"_s{i}" for i, c in enumerate(links)}
    return folded.select("*", F.explode(again).alias("_copy")).select(*[
        (or_unknown(F.col(at[c])) if c in at else F.col(place[c])).alias(c) for c in columns])


def with_surrogates_by_slices(fact: DataFrame, date: str, links: Mapping[str, Link], since: dt.date, until: dt.date,
                              slices: int, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """:func:`with_surrogates` for a slice of the rows at a time, so disk holds the shuffles of one slice only.

    ``keep`` stores a slice's result; ``fact`` and the dimensions are read by each and should be stored.
    Equal rows are of one slice.
    """
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns], F.lit(3)), F.lit(slices))
    return reduce(DataFrame.unionByName, [
        keep(with_surrogates(fact.filter(own == n) if slices > 1 else fact, date, links, since, until)) for n in range(slices)])


#: Stored types of ratio and count columns: wider than the source's, so that sums of any size fit.
RATE = "decimal(38,6)"
STORED_TYPES = {
    "ScrapRate": RATE, "ProductionTimeHours": RATE, "CustomerUptakeRate": RATE, "PromotionROI": RATE,
    "CreditUsage": RATE, "InterestCharges": RATE, "RestockingFee": RATE, "QuantityOnHand": "bigint",
    "DiscountUsageCount": "bigint", "CustomerContactsCount": "bigint", "TransactionCount": "bigint",
    "TotalQuantity": "bigint", "DistinctCustomerCount": "bigint", "UnitsSold": "bigint",
    "UnitsReturned": "bigint", "AvgRevenue": RATE, "AvgOrderValue": RATE, "AvgInventoryValue": RATE,
    "ReturnRate": RATE, "AvgRating": RATE, "GrowthRate": RATE,
}


def stored(df: DataFrame) -> DataFrame:
    """Columns in the types the warehouse declares."""
    return df.select(*[
        (F.col(c).try_cast(STORED_TYPES[c]) if c in STORED_TYPES else F.col(c)).alias(c) for c in df.columns])


def overflow_rules(df: DataFrame) -> list[Rule]:
    """Warnings for values that :func:`stored` cannot keep."""
    return [Rule(f"overflow_{c}", "overflow", f"`{c}` IS NOT NULL AND try_cast(`{c}` AS {STORED_TYPES[c]}) IS NULL",
                 f"Does not fit {STORED_TYPES[c]}: {c}", WARNING)
            for c in df.columns if c in STORED_TYPES]


def overflows(df: DataFrame) -> Column:
    """True for rows that lose a value in :func:`stored`."""
    test = F.lit(False)
    for rule in overflow_rules(df):
        test = test | F.expr(rule.broken)
    return test
