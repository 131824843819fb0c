"""Customer staging: one row per customer from person, contact, address and order tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from treadle.functions.scalars import lower_names, pick, short_name, without, years_since
from treadle.operators.keep import keep_first

Tables = Mapping[str, DataFrame]

# Columns of the staging table.
CUSTOMER = [
    ("customerid", "bigint"), ("customername", "string"), ("emailaddress", "string"),
    ("phonenumber", "string"), ("city", "string"), ("stateprovinceid", "bigint"),
    ("countryregioncode", "string"), ("postalcode", "string"), ("customersegment", "string"),
    ("customertype", "string"), ("accountstatus", "string"), ("creditlimit", "bigint"),
    ("annualincome", "bigint"), ("yearssincefirstpurchase", "bigint"),
]

#: Years since the first purchase from which a customer is premium.
PREMIUM_YEARS = 5

# The two tracked sets in use: the warehouse rule and the wider one of the daily run.
TRACKED = ["customername", "emailaddress", "city", "countryregioncode", "customersegment", "accountstatus"]
TRACKED_WIDE = ["customername", "emailaddress", "phonenumber", "city", "postalcode", "customersegment",
                "customertype", "accountstatus"]

# Staging column -> column of the customer dimension.
TO_DIMENSION = {
    "customerid": "CustomerID", "customername": "CustomerName", "emailaddress": "Email",
    "phonenumber": "Phone", "city": "City", "stateprovinceid": "StateProvince",
    "countryregioncode": "Country", "postalcode": "PostalCode", "customersegment": "CustomerSegment",
    "customertype": "CustomerType", "accountstatus": "AccountStatus", "creditlimit": "CreditLimit",
    "annualincome": "AnnualIncome", "yearssincefirstpurchase": "YearsSinceFirstPurchase",
}

ID = "businessentityid"


class MissingTables(KeyError, ValueError):
    """Tables a plan cannot do without."""


def _source(t: Tables, name: str) -> DataFrame | None:
    df = t.get(name)
    return None if df is None else without(lower_names(df), "modifieddate")


def first_purchases(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customerid").agg(F.min("orderdate").alias("firstpurchase"))


def customer_staging(t: Tables, as_of: dt.date) -> DataFrame:
    """One row per customer.

    A person with several e-mails, phones or addresses gives the one with the lowest id or
    type; each is chosen by aggregation before the joins, so no join fans out.  Optional
    inputs that are absent leave typed NULLs.
    """
    customers, persons = _source(t, "sales.customer"), _source(t, "person.person")
    if customers is None or persons is None:
        raise MissingTables("sales.customer and person.person")

    out = customers.select("customerid", "personid", "storeid").join(
        persons.select(F.col(ID).alias("personid"),
                       short_name(F.col("firstname"), F.col("lastname")).alias("customername")),
        "personid", "left")

    email = _source(t, "person.emailaddress")
    if email is not None:
        first = keep_first(email.select(ID, "emailaddressid", "emailaddress"), [ID], ["emailaddressid"])
        out = out.join(first.select(F.col(ID).alias("personid"), "emailaddress"), "personid", "left")

    phone = _source(t, "person.personphone")
    if phone is not None:
        first = keep_first(phone.select(ID, "phonenumbertypeid", "phonenumber"), [ID],
                           ["phonenumbertypeid", "phonenumber"])
        out = out.join(first.select(F.col(ID).alias("personid"), "phonenumber"), "personid", "left")

    link, address = _source(t, "person.businessentityaddress"), _source(t, "person.address")
    if link is not None and address is not None:
        first = keep_first(link.select(ID, "addresstypeid", "addressid"), [ID], ["addresstypeid", "addressid"])
        place = address.select("addressid", "city", "stateprovinceid", "postalcode")
        state = _source(t, "person.stateprovince")
        if state is not None:
            place = place.join(state.select("stateprovinceid", "countryregioncode"), "stateprovinceid", "left")
        located = first.join(place, "addressid").drop("addressid", "addresstypeid")
        out = out.join(located.withColumnRenamed(ID, "personid"), "personid", "left")

    orders = _source(t, "sales.salesorderheader")
    if orders is not None and "customerid" in orders.columns:
        out = out.join(first_purchases(orders.select("customerid", "orderdate")), "customerid", "left")
        years = years_since(F.col("firstpurchase"), F.lit(as_of))
    else:
        years = F.lit(0)

    derived = (
        out.withColumn("customertype", F.when(F.col("storeid").isNotNull(), "Corporate").otherwise("Individual"))
        .withColumn("yearssincefirstpurchase", years)
        .withColumn("customersegment", F.when(F.col("yearssincefirstpurchase") >= PREMIUM_YEARS, "Premium")
                    .otherwise("Standard"))
        .withColumn("customername", F.coalesce("customername", F.lit("")))
        .withColumn("accountstatus", F.lit("Active"))
        .withColumn("creditlimit", F.lit(0)).withColumn("annualincome", F.lit(0))
    )
    return pick(derived, CUSTOMER)
