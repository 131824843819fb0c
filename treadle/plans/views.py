"""Analytic views over the source tables: joins, fiscal-year totals, pivot.

``t`` maps ``schema.table`` to frames.  Every building block selects its columns first, so
scans read only what a view returns, and lookups are joined before they fan out.  Join
strategies are left to Catalyst: lookups below its size threshold are broadcast, larger
ones are shuffled and AQE splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from treadle.functions.scalars import fiscal_year, full_name
from treadle.operators.measures import pivot_sum

Tables = Mapping[str, DataFrame]

ID = "businessentityid"
NAME = ["title", "firstname", "middlename", "lastname", "suffix"]
PLACE = ["addressline1", "addressline2", "city", "stateprovincename", "postalcode", "countryregionname"]


def _named(df: DataFrame, key: str, name: str) -> DataFrame:
    """A lookup table as (key, its name under the name ``name``)."""
    return df.select(key, F.col("name").alias(name))


def states(t: Tables) -> DataFrame:
    country = _named(t["person.countryregion"], "countryregioncode", "countryregionname")
    state = t["person.stateprovince"].select(
        "stateprovinceid", "stateprovincecode", "isonlystateprovinceflag",
        F.col("name").alias("stateprovincename"), "territoryid", "countryregioncode")
    return state.join(country, "countryregioncode")


def addresses(t: Tables) -> DataFrame:
    """Entity addresses with state and country names."""
    link = t["person.businessentityaddress"].select(ID, "addressid", "addresstypeid")
    address = t["person.address"].select(
        "addressid", "addressline1", "addressline2", "city", "postalcode", "stateprovinceid")
    return link.join(address, "addressid").join(states(t), "stateprovinceid").select(
        ID, "addresstypeid", *PLACE)


def typed_addresses(t: Tables) -> DataFrame:
    kinds = _named(t["person.addresstype"], "addresstypeid", "addresstype")
    return addresses(t).join(kinds, "addresstypeid")


def phones(t: Tables) -> DataFrame:
    kinds = _named(t["person.phonenumbertype"], "phonenumbertypeid", "phonenumbertype")
    return (
        t["person.personphone"].select(ID, "phonenumber", "phonenumbertypeid")
        .join(kinds, "phonenumbertypeid", "left").drop("phonenumbertypeid")
    )


def emails(t: Tables) -> DataFrame:
    return t["person.emailaddress"].select(ID, "emailaddress")


def people(t: Tables, *extra: str) -> DataFrame:
    return t["person.person"].select(ID, *NAME, *extra)


def reachable(df: DataFrame, t: Tables) -> DataFrame:
    """Add phones and e-mails, keeping people without any."""
    return df.join(phones(t), ID, "left").join(emails(t), ID, "left")


def v_employee(t: Tables) -> DataFrame:
    staff = t["humanresources.employee"].select(ID, "jobtitle")
    person = people(t, "emailpromotion", "additionalcontactinfo")
    return reachable(staff.join(person, ID).join(addresses(t), ID), t).select(
        ID, *NAME, "jobtitle", "phonenumber", "phonenumbertype", "emailaddress", "emailpromotion",
        *PLACE, "additionalcontactinfo")


def _assignments(t: Tables) -> DataFrame:
    staff = t["humanresources.employee"].select(ID, "jobtitle")
    history = t["humanresources.employeedepartmenthistory"].select(
        ID, "departmentid", "shiftid", "startdate", "enddate")
    department = t["humanresources.department"].select(
        "departmentid", F.col("name").alias("department"), "groupname")
    return history.join(staff, ID).join(people(t), ID).join(department, "departmentid")


def v_employee_department(t: Tables) -> DataFrame:
    """Current assignments only."""
    return _assignments(t).filter("enddate IS NULL").select(
        ID, *NAME, "jobtitle", "department", "groupname", "startdate")


def v_employee_department_history(t: Tables) -> DataFrame:
    shift = _named(t["humanresources.shift"], "shiftid", "shift")
    return _assignments(t).join(shift, "shiftid").select(
        ID, *NAME, "shift", "department", "groupname", "startdate", "enddate")


def v_individual_customer(t: Tables) -> DataFrame:
    buyers = t["sales.customer"].filter("storeid IS NULL").select(F.col("personid").alias(ID))
    person = people(t, "emailpromotion", "demographics")
    return reachable(buyers.join(person, ID).join(typed_addresses(t), ID), t).select(
        ID, *NAME, "phonenumber", "phonenumbertype", "emailaddress", "emailpromotion",
        "addresstype", *PLACE, "demographics")


def v_product_and_description(t: Tables) -> DataFrame:
    product = t["production.product"].select("productid", "name", "productmodelid")
    model = _named(t["production.productmodel"], "productmodelid", "productmodel")
    link = t["production.productmodelproductdescriptionculture"].select(
        "productmodelid", "productdescriptionid", "cultureid")
    text = t["production.productdescription"].select("productdescriptionid", "description")
    return (
        product.join(model, "productmodelid").join(link, "productmodelid")
        .join(text, "productdescriptionid")
        .select("productid", "name", "productmodel", "cultureid", "description")
    )


def v_sales_person(t: Tables) -> DataFrame:
    seller = t["sales.salesperson"].select(ID, "territoryid", "salesquota", "salesytd", "saleslastyear")
    staff = t["humanresources.employee"].select(ID, "jobtitle")
    territory = t["sales.salesterritory"].select(
        "territoryid", F.col("name").alias("territoryname"), F.col("group").alias("territorygroup"))
    core = (
        seller.join(staff, ID).join(people(t, "emailpromotion"), ID).join(addresses(t), ID)
        .join(territory, "territoryid", "left")
    )
    return reachable(core, t).select(
        ID, *NAME, "jobtitle", "phonenumber", "phonenumbertype", "emailaddress", "emailpromotion",
        *PLACE, "territoryname", "territorygroup", "salesquota", "salesytd", "saleslastyear")


def v_sales_person_sales_by_fiscal_years_data(t: Tables) -> DataFrame:
    """Sales per person and fiscal year.

    Orders are summed to (person, year) before they meet the lookups, whose keys are unique,
    so the order table is shuffled once and only as partial sums.
    """
    totals = (
        t["sales.salesorderheader"].filter("salespersonid IS NOT NULL")
        .groupBy("salespersonid", fiscal_year(F.col("orderdate")).alias("fiscalyear"))
        .agg(F.sum("subtotal").alias("salestotal"))
    )
    seller = t["sales.salesperson"].select(F.col(ID).alias("salespersonid"), "territoryid")
    territory = _named(t["sales.salesterritory"], "territoryid", "salesterritory")
    staff = t["humanresources.employee"].select(F.col(ID).alias("salespersonid"), "jobtitle")
    names = t["person.person"].select(
        F.col(ID).alias("salespersonid"),
        full_name(F.col("firstname"), F.col("middlename"), F.col("lastname")).alias("fullname"))
    return (
        totals.join(seller, "salespersonid").join(territory, "territoryid")
        .join(staff, "salespersonid").join(names, "salespersonid")
        .select("salespersonid", "fullname", "jobtitle", "salesterritory", "salestotal", "fiscalyear")
    )


def v_sales_person_sales_by_fiscal_years(t: Tables, years=(2012, 2013, 2014),
                                         kind: str = "decimal(12,4)") -> DataFrame:
    """One column per listed fiscal year; a person without any of them stays with NULLs."""
    return pivot_sum(v_sales_person_sales_by_fiscal_years_data(t),
                     ["salespersonid", "fullname", "jobtitle", "salesterritory"],
                     "fiscalyear", years, "salestotal", kind)


def v_state_province_country_region(t: Tables) -> DataFrame:
    return states(t).select("stateprovinceid", "stateprovincecode", "isonlystateprovinceflag",
                            "stateprovincename", "territoryid", "countryregioncode", "countryregionname")


def _with_contacts(owner: DataFrame, t: Tables) -> DataFrame:
    contact = t["person.businessentitycontact"].select(ID, "personid", "contacttypeid")
    kinds = _named(t["person.contacttype"], "contacttypeid", "contacttype")
    person = reachable(people(t, "emailpromotion"), t).withColumnRenamed(ID, "personid")
    return (
        owner.select(ID, "name").join(contact, ID).join(kinds, "contacttypeid").join(person, "personid")
        .select(ID, "name", "contacttype", *NAME, "phonenumber", "phonenumbertype", "emailaddress",
                "emailpromotion")
    )


def _with_addresses(owner: DataFrame, t: Tables) -> DataFrame:
    return owner.select(ID, "name").join(typed_addresses(t), ID).select(ID, "name", "addresstype", *PLACE)


def v_store_with_contacts(t: Tables) -> DataFrame:
    return _with_contacts(t["sales.store"], t)


def v_store_with_addresses(t: Tables) -> DataFrame:
    return _with_addresses(t["sales.store"], t)


def v_vendor_with_contacts(t: Tables) -> DataFrame:
    return _with_contacts(t["purchasing.vendor"], t)


def v_vendor_with_addresses(t: Tables) -> DataFrame:
    return _with_addresses(t["purchasing.vendor"], t)


#: Views kept as written tables, with the unique key each is clustered on.
MATERIALIZED = {
    "production.vproductanddescription": (v_product_and_description, ("cultureid", "productid")),
    "person.vstateprovincecountryregion": (
        v_state_province_country_region, ("stateprovinceid", "countryregioncode")),
}


def refresh_view(spark, name: str, t: Tables, root: str):
    """Rebuild a materialized view next to its old version and switch to it."""
    from treadle.operators.sinks import VersionedTable

    build, key = MATERIALIZED[name]
    table = VersionedTable(spark, f"{root.rstrip('/')}/{name}")
    table.write(build(t), keys=key)
    return table.read()
