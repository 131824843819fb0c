"""Dimensions: declared layout and policy, staging plans, load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from treadle.functions.hierarchy import parent
from treadle.functions.scalars import pick, ratio, short_name
from treadle.functions.xml import shred, whole
from treadle.operators import history
from treadle.operators.keep import keep_first
from treadle.plans.staging import TO_DIMENSION, customer_staging

Tables = Mapping[str, DataFrame]

STATIC, SCD1, SCD2 = "static", "scd1", "scd2"


@dataclass(frozen=True)
class DimensionSpec:
    """``columns`` are the business columns after the surrogate key, as (name, type)."""

    name: str
    surrogate: str
    natural: str
    policy: str
    columns: tuple[tuple[str, str], ...]
    tracked: tuple[str, ...] = ()


def _spec(name: str, surrogate: str, policy: str, columns: str, tracked: str = "") -> DimensionSpec:
    pairs = tuple(tuple(c.strip().split(" ", 1)) for c in columns.split(";"))
    return DimensionSpec(name, surrogate, pairs[0][0], policy, pairs,
                         tuple(t.strip() for t in tracked.split(",") if t.strip()))


# Columns of the dimensions and the attributes whose change makes a version.
# The first column is the natural key.  Keys are 64 bits wide, as the facts' keys are.
DIMENSIONS = {d.name: d for d in (
    _spec("DimCustomer", "CustomerKey", SCD2,
          "CustomerID bigint; CustomerName string; Email string; Phone string; City string; "
          "StateProvince string; Country string; PostalCode string; CustomerSegment string; "
          "CustomerType string; AccountStatus string; CreditLimit decimal(18,2); "
          "AnnualIncome decimal(18,2); YearsSinceFirstPurchase int; SourceUpdateDate date",
          "CustomerName, Email, City, Country, CustomerSegment, AccountStatus"),
    _spec("DimProduct", "ProductKey", SCD2,
          "ProductID bigint; ProductName string; SKU string; Category string; SubCategory string; "
          "Brand string; ListPrice decimal(18,2); Cost decimal(18,2); ProductStatus string; Color string; "
          "Size string; Weight decimal(10,3); SourceUpdateDate date",
          "ListPrice, Cost, Category, ProductStatus"),
    _spec("DimStore", "StoreKey", SCD2,
          "StoreID bigint; StoreName string; StoreNumber bigint; Address string; City string; "
          "StateProvince string; Country string; PostalCode string; Region string; Territory string; "
          "StoreType string; StoreStatus string; ManagerName string; OpeningDate date; SquareFootage int; "
          "SourceUpdateDate date",
          "Address, Region, Territory, ManagerName, StoreStatus"),
    _spec("DimEmployee", "EmployeeKey", SCD2,
          "EmployeeID bigint; EmployeeName string; JobTitle string; Department string; "
          "ReportingManagerKey bigint; HireDate date; EmployeeStatus string; Region string; "
          "Territory string; SalesQuota decimal(18,2); SourceUpdateDate date",
          "JobTitle, Department, Region, Territory, SalesQuota"),
    _spec("DimVendor", "VendorKey", SCD2,
          "VendorID bigint; VendorName string; ContactPerson string; Email string; Phone string; "
          "Address string; City string; Country string; VendorRating decimal(3,2); "
          "OnTimeDeliveryRate decimal(5,2); QualityScore decimal(5,2); PaymentTerms string; "
          "VendorStatus string; SourceUpdateDate date",
          "VendorRating, OnTimeDeliveryRate, QualityScore, VendorStatus"),
    _spec("DimWarehouse", "WarehouseKey", SCD2,
          "WarehouseID bigint; WarehouseName string; Location string; WarehouseType string; ManagerKey bigint",
          "WarehouseName, Location, WarehouseType, ManagerKey"),
    _spec("DimPromotion", "PromotionKey", SCD1,
          "PromotionID bigint; PromotionName string; PromotionDescription string; PromotionType string; "
          "DiscountPercentage decimal(5,2); DiscountAmount decimal(18,2); StartDate date; EndDate date; "
          "IsActive boolean; PromotionStatus string; CampaignID int; TargetProductKey bigint; "
          "TargetCustomerSegment string"),
    _spec("DimSalesTerritory", "TerritoryKey", SCD1,
          "TerritoryID bigint; TerritoryName string; SalesRegion string; Country string; Manager string; "
          "SalesTarget decimal(18,2)"),
    _spec("DimRegion", "RegionKey", STATIC,
          "RegionID bigint; RegionName string; Country string; Continent string; TimeZone string"),
    _spec("DimProductCategory", "ProductCategoryKey", STATIC,
          "ProductCategoryID bigint; CategoryName string; CategoryDescription string"),
    _spec("DimFeedbackCategory", "FeedbackCategoryKey", STATIC,
          "FeedbackCategoryID bigint; CategoryName string; CategoryDescription string"),
    _spec("DimReturnReason", "ReturnReasonKey", STATIC,
          "ReturnReasonID bigint; ReturnReasonName string; ReturnReasonDescription string"),
    _spec("DimCustomerSegment", "SegmentKey", STATIC,
          "SegmentID bigint; SegmentName string; SegmentDescription string; "
          "DiscountTierStart decimal(5,2); DiscountTierEnd decimal(5,2)"),
    _spec("DimAgingTier", "AgingTierKey", STATIC,
          "AgingTierID bigint; AgingTierName string; MinAgingDays int; MaxAgingDays int"),
    _spec("DimFinanceCategory", "FinanceCategoryKey", STATIC,
          "FinanceCategoryID bigint; CategoryName string; CategoryDescription string"),
)}

# Members of the static dimensions, natural id first.
STATIC_ROWS = {
    "DimFeedbackCategory": [(1, "Product Quality", None), (2, "Delivery", None), (3, "Customer Service", None),
                            (4, "Price", None)],
    "DimReturnReason": [(1, "Defective", None), (2, "Wrong Item", None), (3, "Changed Mind", None),
                        (4, "Damaged", None)],
    "DimCustomerSegment": [(1, "Premium", None, None, None), (2, "Standard", None, None, None),
                           (3, "Budget", None, None, None), (4, "VIP", None, None, None)],
    "DimAgingTier": [(1, "Fresh (0-30 days)", 0, 30), (2, "Aged (31-90 days)", 31, 90),
                     (3, "Very Aged (90+ days)", 91, None)],
    "DimFinanceCategory": [(1, "Invoice", None), (2, "Payment", None), (3, "Credit Memo", None),
                           (4, "Adjustment", None)],
}


def static_dimension(spark: SparkSession, name: str) -> DataFrame:
    """A small reference dimension; its key is the natural id."""
    spec = DIMENSIONS[name]
    # typed SELECTs, so that the optimizer sees the true (tiny) size and may broadcast it
    rows = [f"({', '.join(_literal(v) for v in row)})" for row in STATIC_ROWS[name]]
    names = [c for c, _ in spec.columns]
    df = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({', '.join(names)})")
    return pick(df.withColumn(spec.surrogate, F.col(spec.natural)),
                [(spec.surrogate, "bigint"), *spec.columns])


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


# --- calendar ------------------------------------------------------------------------------

#: Default holidays as (month, day, name).
HOLIDAYS = ((1, 1, "New Year's Day"), (7, 4, "Independence Day"), (12, 25, "Christmas Day"))


def dim_date(bounds: DataFrame, holidays: Sequence[tuple[int, int, str]] = HOLIDAYS) -> DataFrame:
    """One row per day between ``low`` and ``high`` of the one-row frame ``bounds``."""
    days = bounds.select(F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias("FullDate"))
    d = F.col("FullDate")
    month, weekday = F.month(d), F.dayofweek(d)
    shifted = F.add_months(d, 6)
    holiday = F.lit(None).cast("string")
    for m, n, name in holidays:
        holiday = F.when((month == m) & (F.dayofmonth(d) == n), name).otherwise(holiday)
    season = (F.when(month.isin(12, 1, 2), "Winter").when(month.isin(3, 4, 5), "Spring")
              .when(month.isin(6, 7, 8), "Summer").otherwise("Autumn"))
    # weeks of the calendar year that begin on Sunday; the first may be short
    week = F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 2) / 7) + 1
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("DateKey"), "FullDate",
        F.year(d).cast("smallint").alias("Year"), F.quarter(d).cast("tinyint").alias("Quarter"),
        month.cast("tinyint").alias("Month"), F.date_format(d, "MMMM").alias("MonthName"),
        week.cast("smallint").alias("Week"), weekday.cast("tinyint").alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"), F.dayofmonth(d).cast("tinyint").alias("DayOfMonth"),
        F.dayofyear(d).cast("smallint").alias("DayOfYear"), F.weekofyear(d).cast("smallint").alias("WeekOfYear"),
        weekday.isin(1, 7).alias("IsWeekend"), holiday.isNotNull().alias("IsHoliday"),
        holiday.alias("HolidayName"), F.year(shifted).cast("smallint").alias("FiscalYear"),
        F.quarter(shifted).cast("tinyint").alias("FiscalQuarter"),
        F.month(shifted).cast("tinyint").alias("FiscalMonth"), season.alias("Season"))


# --- staging plans -------------------------------------------------------------------------

ID = "businessentityid"


def _changed(t: Tables, name: str) -> Column:
    """The change date of a row, where the table has one."""
    has = "modifieddate" in t[name].columns
    return (F.col("modifieddate") if has else F.lit(None)).cast("date").alias("SourceUpdateDate")


def _first_address(t: Tables) -> DataFrame:
    """One address per entity: the lowest type, then the lowest id."""
    link = keep_first(t["person.businessentityaddress"].select(ID, "addresstypeid", "addressid"),
                      [ID], ["addresstypeid", "addressid"])
    state = t["person.stateprovince"].select("stateprovinceid", F.col("name").alias("StateProvince"),
                                             "countryregioncode")
    country = t["person.countryregion"].select("countryregioncode", F.col("name").alias("Country"))
    place = t["person.address"].select(
        "addressid", F.col("addressline1").alias("Address"), F.col("city").alias("City"),
        F.col("postalcode").alias("PostalCode"), "stateprovinceid")
    return (
        link.join(place, "addressid").join(state, "stateprovinceid").join(country, "countryregioncode")
        .select(ID, "Address", "City", "StateProvince", "Country", "PostalCode")
    )


def _names(t: Tables, key: str, name: str) -> DataFrame:
    return t["person.person"].select(F.col(ID).alias(key),
                                     short_name(F.col("firstname"), F.col("lastname")).alias(name))


def _territories(t: Tables) -> DataFrame:
    return t["sales.salesterritory"].select(
        "territoryid", F.col("name").alias("Territory"), F.col("group").alias("Region"))


def stage_customer(t: Tables, as_of: dt.date) -> DataFrame:
    staged = customer_staging(t, as_of)
    return staged.select(*[F.col(s).alias(d) for s, d in TO_DIMENSION.items()],
                         F.lit(as_of).alias("SourceUpdateDate"))


def stage_product(t: Tables, as_of: dt.date) -> DataFrame:
    category = t["production.productcategory"].select("productcategoryid", F.col("name").alias("Category"))
    sub = t["production.productsubcategory"].select(
        "productsubcategoryid", "productcategoryid", F.col("name").alias("SubCategory"))
    model = t["production.productmodel"].select("productmodelid", F.col("name").alias("Brand"))
    today = F.lit(as_of)
    status = (F.when(F.col("discontinueddate").isNotNull() | (F.col("sellenddate").cast("date") < today), "Discontinued")
              .when(F.col("sellstartdate").cast("date") > today, "Coming Soon").otherwise("Active"))
    product = t["production.product"].select(
        F.col("productid").alias("ProductID"), F.col("name").alias("ProductName"),
        F.col("productnumber").alias("SKU"), "productsubcategoryid", "productmodelid",
        F.col("listprice").alias("ListPrice"), F.col("standardcost").alias("Cost"),
        status.alias("ProductStatus"), F.col("color").alias("Color"), F.col("size").alias("Size"),
        F.col("weight").alias("Weight"), _changed(t, "production.product"))
    return (
        product.join(sub, "productsubcategoryid", "left").join(category, "productcategoryid", "left")
        .join(model, "productmodelid", "left")
    )


def stage_store(t: Tables, as_of: dt.date) -> DataFrame:
    manager = _names(t, "salespersonid", "ManagerName")
    seller = t["sales.salesperson"].select(F.col(ID).alias("salespersonid"), "territoryid")
    survey = shred(F.col("demographics"), "YearOpened string, SquareFeet string")
    store = t["sales.store"].select(
        F.col(ID).alias("StoreID"), F.col("name").alias("StoreName"), F.col(ID).alias("StoreNumber"),
        "salespersonid", F.lit("Retail").alias("StoreType"), F.lit("Open").alias("StoreStatus"),
        survey.alias("d"), _changed(t, "sales.store"))
    store = store.select("*", F.make_date(whole(F.col("d.YearOpened")), F.lit(1), F.lit(1)).alias("OpeningDate"),
                         whole(F.col("d.SquareFeet")).alias("SquareFootage")).drop("d")
    return (
        store.join(_first_address(t).withColumnRenamed(ID, "StoreID"), "StoreID", "left")
        .join(manager, "salespersonid", "left").join(seller, "salespersonid", "left")
        .join(_territories(t), "territoryid", "left")
    )


def with_managers(staff: DataFrame, key: str, manager: str, name: str) -> DataFrame:
    """Self join: each row with its manager's name; a row without manager stays."""
    boss = staff.select(F.col(key).alias("_boss"), F.col(name).alias("ManagerName"))
    return staff.join(boss, F.col(manager) == F.col("_boss"), "left").drop("_boss")


def stage_employee(t: Tables, as_of: dt.date) -> DataFrame:
    """Employees with the manager found one level up in the organization path."""
    e = t["humanresources.employee"]
    path = F.col("organizationnode") if "organizationnode" in e.columns else F.lit(None).cast("string")
    current = F.col("currentflag") if "currentflag" in e.columns else F.lit(True)
    hired = (F.col("hiredate") if "hiredate" in e.columns else F.lit(None)).cast("date")
    staff = e.select(F.col(ID).alias("EmployeeID"), F.col("jobtitle").alias("JobTitle"), path.alias("_path"),
                     hired.alias("HireDate"), F.when(current, "Active").otherwise("Terminated").alias("EmployeeStatus"),
                     _changed(t, "humanresources.employee"))
    # one manager per node: the one with the least id
    boss = staff.groupBy(F.col("_path").alias("_boss_path")).agg(F.min("EmployeeID").alias("ManagerID"))
    department = t["humanresources.department"].select("departmentid", F.col("name").alias("Department"))
    posts = (
        t["humanresources.employeedepartmenthistory"].filter("enddate IS NULL")
        .groupBy(F.col(ID).alias("EmployeeID")).agg(F.max_by("departmentid", "startdate").alias("departmentid"))
        .join(department, "departmentid").drop("departmentid")
    )
    seller = t["sales.salesperson"].select(F.col(ID).alias("EmployeeID"), "territoryid",
                                           F.col("salesquota").alias("SalesQuota"))
    return (
        staff.join(boss, parent(F.col("_path")) == F.col("_boss_path"), "left").drop("_boss_path", "_path")
        .join(_names(t, "EmployeeID", "EmployeeName"), "EmployeeID", "left")
        .join(posts, "EmployeeID", "left").join(seller, "EmployeeID", "left")
        .join(_territories(t), "territoryid", "left")
    )


def vendor_scores(t: Tables) -> DataFrame:
    """Per vendor: percent of shipped lines that met their due date, and of received units kept."""
    header = t["purchasing.purchaseorderheader"].select(
        "purchaseorderid", F.col("vendorid").alias("VendorID"), F.col("shipdate").alias("_shipped"))
    lines = t["purchasing.purchaseorderdetail"].select("purchaseorderid", "duedate", "receivedqty", "rejectedqty")
    counts = lines.join(header, "purchaseorderid").groupBy("VendorID").agg(
        F.count_if(F.col("_shipped") <= F.col("duedate")).alias("met"), F.count("_shipped").alias("shipped"),
        F.sum(F.col("receivedqty") - F.col("rejectedqty")).alias("kept"), F.sum("receivedqty").alias("received"))
    return counts.select("VendorID", ratio(F.col("met"), F.col("shipped"), 100.0).alias("OnTimeDeliveryRate"),
                         ratio(F.col("kept"), F.col("received"), 100.0).alias("QualityScore"))


def stage_vendor(t: Tables, as_of: dt.date) -> DataFrame:
    """Vendors; the source scores 1 (best) to 5, the dimension 5 (best) to 1."""
    status = (F.when(~F.col("activeflag"), "Inactive").when(F.col("preferredvendorstatus"), "Preferred")
              .otherwise("Active"))
    vendor = t["purchasing.vendor"].select(
        F.col(ID).alias("VendorID"), F.col("name").alias("VendorName"),
        (F.lit(6) - F.col("creditrating")).alias("VendorRating"), status.alias("VendorStatus"),
        _changed(t, "purchasing.vendor"))
    contact = keep_first(t["person.businessentitycontact"].select(ID, "contacttypeid", "personid"),
                         [ID], ["contacttypeid", "personid"])
    person = (
        contact.select(F.col(ID).alias("VendorID"), "personid")
        .join(_names(t, "personid", "ContactPerson"), "personid", "left")
    )
    email = keep_first(t["person.emailaddress"].select(ID, "emailaddressid", "emailaddress"), [ID], ["emailaddressid"])
    phone = keep_first(t["person.personphone"].select(ID, "phonenumbertypeid", "phonenumber"), [ID],
                       ["phonenumbertypeid", "phonenumber"])
    reach = (
        person.join(email.select(F.col(ID).alias("personid"), F.col("emailaddress").alias("Email")), "personid", "left")
        .join(phone.select(F.col(ID).alias("personid"), F.col("phonenumber").alias("Phone")), "personid", "left")
    )
    return (
        vendor.join(reach, "VendorID", "left").join(vendor_scores(t), "VendorID", "left")
        .join(_first_address(t).withColumnRenamed(ID, "VendorID"), "VendorID", "left")
    )


def stage_warehouse(t: Tables, as_of: dt.date) -> DataFrame:
    return t["production.location"].select(
        F.col("locationid").alias("WarehouseID"), F.col("name").alias("WarehouseName"),
        F.col("name").alias("Location"),
        F.when(F.col("availability") > 0, "Production").otherwise("Storage").alias("WarehouseType"))


def stage_promotion(t: Tables, as_of: dt.date) -> DataFrame:
    today = F.lit(as_of)
    start, end = F.col("startdate").cast("date"), F.col("enddate").cast("date")
    status = F.when(end < today, "Ended").when(start > today, "Planned").otherwise("Running")
    return t["sales.specialoffer"].select(
        F.col("specialofferid").alias("PromotionID"), F.col("description").alias("PromotionName"),
        F.concat_ws(" / ", "category", "description").alias("PromotionDescription"),
        F.col("type").alias("PromotionType"), (F.col("discountpct") * 100).alias("DiscountPercentage"),
        start.alias("StartDate"), end.alias("EndDate"), (status == "Running").alias("IsActive"),
        status.alias("PromotionStatus"))


def stage_sales_territory(t: Tables, as_of: dt.date) -> DataFrame:
    country = t["person.countryregion"].select("countryregioncode", F.col("name").alias("Country"))
    target = (
        t["sales.salesperson"].groupBy(F.col("territoryid").alias("TerritoryID"))
        .agg(F.sum("salesquota").alias("SalesTarget"))
    )
    return (
        t["sales.salesterritory"].select(
            F.col("territoryid").alias("TerritoryID"), F.col("name").alias("TerritoryName"),
            F.col("group").alias("SalesRegion"), "countryregioncode")
        .join(country, "countryregioncode", "left").join(target, "TerritoryID", "left")
    )


def stage_region(t: Tables, as_of: dt.date) -> DataFrame:
    """States by country; the territory group stands for the continent."""
    country = t["person.countryregion"].select("countryregioncode", F.col("name").alias("Country"))
    group = t["sales.salesterritory"].select("territoryid", F.col("group").alias("Continent"))
    return (
        t["person.stateprovince"].select(
            F.col("stateprovinceid").alias("RegionID"), F.col("name").alias("RegionName"),
            "countryregioncode", "territoryid")
        .join(country, "countryregioncode", "left").join(group, "territoryid", "left")
    )


def stage_product_category(t: Tables, as_of: dt.date) -> DataFrame:
    return t["production.productcategory"].select(
        F.col("productcategoryid").alias("ProductCategoryID"), F.col("name").alias("CategoryName"))


STAGES = {
    "DimCustomer": stage_customer, "DimProduct": stage_product, "DimStore": stage_store,
    "DimEmployee": stage_employee, "DimVendor": stage_vendor, "DimWarehouse": stage_warehouse,
    "DimPromotion": stage_promotion, "DimSalesTerritory": stage_sales_territory,
    "DimRegion": stage_region, "DimProductCategory": stage_product_category,
}


# --- load ----------------------------------------------------------------------------------

#: Dimensions that keep the load-time interval next to the business-time one.
WITH_LOAD_TIME = ("DimCustomer", "DimProduct")


def price_states(t: Tables) -> DataFrame:
    """Price and cost of each product from each day on which either starts; NULL where a history has none.

    Both timelines are laid over each other; the windows hold one row per price or cost change of a product.
    """
    price = t["production.productlistpricehistory"].select(
        F.col("productid").alias("ProductID"), F.col("startdate").cast("date").alias("day"),
        F.col("listprice").alias("ListPrice"), F.lit(None).cast("decimal(19,4)").alias("Cost"))
    cost = t["production.productcosthistory"].select(
        F.col("productid").alias("ProductID"), F.col("startdate").cast("date").alias("day"),
        F.lit(None).cast("decimal(19,4)").alias("ListPrice"), F.col("standardcost").alias("Cost"))
    both = price.unionByName(cost).groupBy("ProductID", "day").agg(
        F.max("ListPrice").alias("ListPrice"), F.max("Cost").alias("Cost"))
    so_far = Window.partitionBy("ProductID").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return both.select("ProductID", "day", F.last("ListPrice", True).over(so_far).alias("ListPrice"),
                       F.last("Cost", True).over(so_far).alias("Cost"))


def product_history(t: Tables) -> DataFrame:
    """List price and cost of each product over time, as versions."""
    return history.versions(price_states(t), ["ProductID"], "day", ["ListPrice", "Cost"])


def priced(staged: DataFrame, states: DataFrame, day: dt.date, until: dt.date,
           keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Products with price and cost of a day, and the states of all days until another.

    What a history does not say is as the product has it.  ``keep`` stores the states, which are read several times.
    """
    known = states.filter(F.col("day") <= F.lit(until))
    own = staged.select(F.col("ProductID").alias("_id"), F.col("ListPrice").alias("_price"), F.col("Cost").alias("_cost"))
    full = known.join(own, F.col("ProductID") == F.col("_id")).select(
        "ProductID", "day", F.coalesce(F.col("ListPrice").cast("decimal(18,2)"), "_price").alias("ListPrice"),
        F.coalesce(F.col("Cost").cast("decimal(18,2)"), "_cost").alias("Cost"))
    full = keep(full)
    last = full.filter(F.col("day") <= F.lit(day)).groupBy("ProductID").agg(F.max_by(F.struct("ListPrice", "Cost"), "day").alias("_last"))
    return staged.join(last, "ProductID", "left").select(*[
        F.coalesce(F.col(f"_last.{c}"), F.col(c)).alias(c) if c in ("ListPrice", "Cost") else F.col(c) for c in staged.columns]), full


def conform(staging: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Staging in the declared columns; a column it lacks becomes a typed NULL."""
    return pick(staging, spec.columns)


def load_dimension(spec: DimensionSpec, current: DataFrame | None, staging: DataFrame, as_of: dt.date,
                   opening: dt.date | None = None, key_of: history.KeyOf = history.surrogate_key) -> DataFrame:
    """The dimension after a run, by its policy.

    ``current`` is None on the first run, whose versions are valid from ``opening``.
    """
    staged = conform(staging, spec)
    key = [spec.natural]
    if spec.policy == SCD2:
        if current is None:
            return history.first_load(staged, key, spec.surrogate, as_of, opening, spec.name in WITH_LOAD_TIME, key_of)
        return history.scd2(current, staged, key, spec.tracked, spec.surrogate, as_of, key_of=key_of)
    keyed = staged.withColumn(spec.surrogate, F.col(spec.natural).cast("bigint")).select(
        spec.surrogate, *[c for c, _ in spec.columns])
    return keyed if current is None else history.scd1(current, keyed, key)


def with_manager_keys(employees: DataFrame, managers: DataFrame) -> DataFrame:
    """Fill ReportingManagerKey from the current rows of the same dimension.

    managers: EmployeeID, ManagerID
    """
    boss = employees.filter("IsCurrent").select(F.col("EmployeeID").alias("ManagerID"),
                                                F.col("EmployeeKey").alias("_key"))
    keyed = managers.join(boss, "ManagerID").select("EmployeeID", "_key")
    return employees.join(keyed, "EmployeeID", "left").select(*[
        F.when(F.col("IsCurrent"), F.col("_key")).otherwise(F.col(c)).alias(c)
        if c == "ReportingManagerKey" else F.col(c) for c in employees.columns])
