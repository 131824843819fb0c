"""Shorthand views: every source table under a short name, with its key as ``id``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

# Short schema, short name, table, id column ("-" for none).
SHORTHAND = """
pe a person.address addressid
pe at person.addresstype addresstypeid
pe be person.businessentity businessentityid
pe bea person.businessentityaddress businessentityid
pe bec person.businessentitycontact businessentityid
pe ct person.contacttype contacttypeid
pe cr person.countryregion -
pe e person.emailaddress emailaddressid
pe pa person.password businessentityid
pe p person.person businessentityid
pe pp person.personphone businessentityid
pe pnt person.phonenumbertype phonenumbertypeid
pe sp person.stateprovince stateprovinceid
hr d humanresources.department departmentid
hr e humanresources.employee businessentityid
hr edh humanresources.employeedepartmenthistory businessentityid
hr eph humanresources.employeepayhistory businessentityid
hr jc humanresources.jobcandidate jobcandidateid
hr s humanresources.shift shiftid
pr bom production.billofmaterials billofmaterialsid
pr c production.culture cultureid
pr d production.document -
pr i production.illustration illustrationid
pr l production.location locationid
pr p production.product productid
pr pc production.productcategory productcategoryid
pr pch production.productcosthistory productid
pr pd production.productdescription productdescriptionid
pr pdoc production.productdocument productid
pr pi production.productinventory productid
pr plph production.productlistpricehistory productid
pr pm production.productmodel productmodelid
pr pmi production.productmodelillustration -
pr pmpdc production.productmodelproductdescriptionculture -
pr pp production.productphoto productphotoid
pr ppp production.productproductphoto -
pr pr production.productreview productreviewid
pr psc production.productsubcategory productsubcategoryid
pr sr production.scrapreason scrapreasonid
pr th production.transactionhistory transactionid
pr tha production.transactionhistoryarchive transactionid
pr um production.unitmeasure unitmeasurecode
pr w production.workorder workorderid
pr wr production.workorderrouting workorderid
pu pv purchasing.productvendor productid
pu pod purchasing.purchaseorderdetail purchaseorderdetailid
pu poh purchasing.purchaseorderheader purchaseorderid
pu sm purchasing.shipmethod shipmethodid
pu v purchasing.vendor businessentityid
sa crc sales.countryregioncurrency -
sa cc sales.creditcard creditcardid
sa cu sales.currency currencycode
sa cr sales.currencyrate -
sa c sales.customer customerid
sa pcc sales.personcreditcard businessentityid
sa sod sales.salesorderdetail salesorderdetailid
sa soh sales.salesorderheader salesorderid
sa sohsr sales.salesorderheadersalesreason -
sa sp sales.salesperson businessentityid
sa spqh sales.salespersonquotahistory businessentityid
sa sr sales.salesreason salesreasonid
sa tr sales.salestaxrate salestaxrateid
sa st sales.salesterritory territoryid
sa sth sales.salesterritoryhistory territoryid
sa sci sales.shoppingcartitem shoppingcartitemid
sa so sales.specialoffer specialofferid
sa sop sales.specialofferproduct specialofferid
sa s sales.store businessentityid
"""


def shorthand_map() -> dict[str, tuple[str, str | None]]:
    """``pe.a`` -> (``person.address``, ``addressid``)."""
    rows = (line.split() for line in SHORTHAND.strip().splitlines())
    return {f"{s}.{v}": (t, None if i == "-" else i) for s, v, t, i in rows}


def with_id(df: DataFrame, key: str | None) -> DataFrame:
    return df if key is None else df.select(F.col(key).alias("id"), "*")


def shorthand(name: str, read: Callable[[str], DataFrame]) -> DataFrame:
    table, key = shorthand_map()[name]
    return with_id(read(table), key)


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """Temp views ``pe_a``, ``hr_e``, ... for the tables at hand."""
    made = []
    for name, (table, key) in shorthand_map().items():
        if table in tables:
            view = name.replace(".", "_")
            with_id(tables[table], key).createOrReplaceTempView(view)
            made.append(view)
    return made
