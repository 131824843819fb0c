"""Declared integrity rules of the source database."""

from __future__ import annotations

import datetime as dt

from treadle.operators.checks import ForeignKey, Rule, TableRules, check_rule

# Primary keys, one table per line.
PRIMARY_KEYS = """
person.businessentity: businessentityid
person.person: businessentityid
person.stateprovince: stateprovinceid
person.address: addressid
person.addresstype: addresstypeid
person.businessentityaddress: businessentityid, addressid, addresstypeid
person.contacttype: contacttypeid
person.businessentitycontact: businessentityid, personid, contacttypeid
person.emailaddress: businessentityid, emailaddressid
person.password: businessentityid
person.phonenumbertype: phonenumbertypeid
person.personphone: businessentityid, phonenumber, phonenumbertypeid
person.countryregion: countryregioncode
humanresources.department: departmentid
humanresources.employee: businessentityid
humanresources.employeedepartmenthistory: businessentityid, startdate, departmentid, shiftid
humanresources.employeepayhistory: businessentityid, ratechangedate
humanresources.jobcandidate: jobcandidateid
humanresources.shift: shiftid
production.billofmaterials: billofmaterialsid
production.culture: cultureid
production.document: documentnode
production.productcategory: productcategoryid
production.productsubcategory: productsubcategoryid
production.productmodel: productmodelid
production.product: productid
production.productcosthistory: productid, startdate
production.productdescription: productdescriptionid
production.productdocument: productid, documentnode
production.location: locationid
production.productinventory: productid, locationid
production.productlistpricehistory: productid, startdate
production.illustration: illustrationid
production.productmodelillustration: productmodelid, illustrationid
production.productmodelproductdescriptionculture: productmodelid, productdescriptionid, cultureid
production.productphoto: productphotoid
production.productproductphoto: productid, productphotoid
production.productreview: productreviewid
production.scrapreason: scrapreasonid
production.transactionhistory: transactionid
production.transactionhistoryarchive: transactionid
production.unitmeasure: unitmeasurecode
production.workorder: workorderid
production.workorderrouting: workorderid, productid, operationsequence
purchasing.productvendor: productid, businessentityid
purchasing.purchaseorderdetail: purchaseorderid, purchaseorderdetailid
purchasing.purchaseorderheader: purchaseorderid
purchasing.shipmethod: shipmethodid
purchasing.vendor: businessentityid
sales.countryregioncurrency: countryregioncode, currencycode
sales.creditcard: creditcardid
sales.currency: currencycode
sales.currencyrate: currencyrateid
sales.customer: customerid
sales.personcreditcard: businessentityid, creditcardid
sales.salesorderdetail: salesorderid, salesorderdetailid
sales.salesorderheader: salesorderid
sales.salesorderheadersalesreason: salesorderid, salesreasonid
sales.salesperson: businessentityid
sales.salespersonquotahistory: businessentityid, quotadate
sales.salesreason: salesreasonid
sales.salestaxrate: salestaxrateid
sales.salesterritory: territoryid
sales.salesterritoryhistory: businessentityid, startdate, territoryid
sales.shoppingcartitem: shoppingcartitemid
sales.specialoffer: specialofferid
sales.specialofferproduct: specialofferid, productid
sales.store: businessentityid
"""

# Foreign keys, child columns -> parent columns; * marks a cascading delete.
FOREIGN_KEYS = """
person.address (stateprovinceid) -> person.stateprovince (stateprovinceid)
production.billofmaterials (productassemblyid) -> production.product (productid)
production.billofmaterials (componentid) -> production.product (productid)
production.billofmaterials (unitmeasurecode) -> production.unitmeasure (unitmeasurecode)
person.businessentityaddress (addressid) -> person.address (addressid)
person.businessentityaddress (addresstypeid) -> person.addresstype (addresstypeid)
person.businessentityaddress (businessentityid) -> person.businessentity (businessentityid)
person.businessentitycontact (personid) -> person.person (businessentityid)
person.businessentitycontact (contacttypeid) -> person.contacttype (contacttypeid)
person.businessentitycontact (businessentityid) -> person.businessentity (businessentityid)
sales.countryregioncurrency (countryregioncode) -> person.countryregion (countryregioncode)
sales.countryregioncurrency (currencycode) -> sales.currency (currencycode)
sales.currencyrate (fromcurrencycode) -> sales.currency (currencycode)
sales.currencyrate (tocurrencycode) -> sales.currency (currencycode)
sales.customer (personid) -> person.person (businessentityid)
sales.customer (storeid) -> sales.store (businessentityid)
sales.customer (territoryid) -> sales.salesterritory (territoryid)
production.document (owner) -> humanresources.employee (businessentityid)
person.emailaddress (businessentityid) -> person.person (businessentityid)
humanresources.employee (businessentityid) -> person.person (businessentityid)
humanresources.employeedepartmenthistory (departmentid) -> humanresources.department (departmentid)
humanresources.employeedepartmenthistory (businessentityid) -> humanresources.employee (businessentityid)
humanresources.employeedepartmenthistory (shiftid) -> humanresources.shift (shiftid)
humanresources.employeepayhistory (businessentityid) -> humanresources.employee (businessentityid)
humanresources.jobcandidate (businessentityid) -> humanresources.employee (businessentityid)
person.password (businessentityid) -> person.person (businessentityid)
person.person (businessentityid) -> person.businessentity (businessentityid)
sales.personcreditcard (businessentityid) -> person.person (businessentityid)
sales.personcreditcard (creditcardid) -> sales.creditcard (creditcardid)
person.personphone (businessentityid) -> person.person (businessentityid)
person.personphone (phonenumbertypeid) -> person.phonenumbertype (phonenumbertypeid)
production.product (sizeunitmeasurecode) -> production.unitmeasure (unitmeasurecode)
production.product (weightunitmeasurecode) -> production.unitmeasure (unitmeasurecode)
production.product (productmodelid) -> production.productmodel (productmodelid)
production.product (productsubcategoryid) -> production.productsubcategory (productsubcategoryid)
production.productcosthistory (productid) -> production.product (productid)
production.productdocument (productid) -> production.product (productid)
production.productdocument (documentnode) -> production.document (documentnode)
production.productinventory (locationid) -> production.location (locationid)
production.productinventory (productid) -> production.product (productid)
production.productlistpricehistory (productid) -> production.product (productid)
production.productmodelillustration (productmodelid) -> production.productmodel (productmodelid)
production.productmodelillustration (illustrationid) -> production.illustration (illustrationid)
production.productmodelproductdescriptionculture (productdescriptionid) -> production.productdescription (productdescriptionid)
production.productmodelproductdescriptionculture (cultureid) -> production.culture (cultureid)
production.productmodelproductdescriptionculture (productmodelid) -> production.productmodel (productmodelid)
production.productproductphoto (productid) -> production.product (productid)
production.productproductphoto (productphotoid) -> production.productphoto (productphotoid)
production.productreview (productid) -> production.product (productid)
production.productsubcategory (productcategoryid) -> production.productcategory (productcategoryid)
purchasing.productvendor (productid) -> production.product (productid)
purchasing.productvendor (unitmeasurecode) -> production.unitmeasure (unitmeasurecode)
purchasing.productvendor (businessentityid) -> purchasing.vendor (businessentityid)
purchasing.purchaseorderdetail (productid) -> production.product (productid)
purchasing.purchaseorderdetail (purchaseorderid) -> purchasing.purchaseorderheader (purchaseorderid)
purchasing.purchaseorderheader (employeeid) -> humanresources.employee (businessentityid)
purchasing.purchaseorderheader (vendorid) -> purchasing.vendor (businessentityid)
purchasing.purchaseorderheader (shipmethodid) -> purchasing.shipmethod (shipmethodid)
sales.salesorderdetail (salesorderid) -> sales.salesorderheader (salesorderid) *
sales.salesorderdetail (specialofferid, productid) -> sales.specialofferproduct (specialofferid, productid)
sales.salesorderheader (billtoaddressid) -> person.address (addressid)
sales.salesorderheader (shiptoaddressid) -> person.address (addressid)
sales.salesorderheader (creditcardid) -> sales.creditcard (creditcardid)
sales.salesorderheader (currencyrateid) -> sales.currencyrate (currencyrateid)
sales.salesorderheader (customerid) -> sales.customer (customerid)
sales.salesorderheader (salespersonid) -> sales.salesperson (businessentityid)
sales.salesorderheader (shipmethodid) -> purchasing.shipmethod (shipmethodid)
sales.salesorderheader (territoryid) -> sales.salesterritory (territoryid)
sales.salesorderheadersalesreason (salesreasonid) -> sales.salesreason (salesreasonid)
sales.salesorderheadersalesreason (salesorderid) -> sales.salesorderheader (salesorderid) *
sales.salesperson (businessentityid) -> humanresources.employee (businessentityid)
sales.salesperson (territoryid) -> sales.salesterritory (territoryid)
sales.salespersonquotahistory (businessentityid) -> sales.salesperson (businessentityid)
sales.salestaxrate (stateprovinceid) -> person.stateprovince (stateprovinceid)
sales.salesterritory (countryregioncode) -> person.countryregion (countryregioncode)
sales.salesterritoryhistory (businessentityid) -> sales.salesperson (businessentityid)
sales.salesterritoryhistory (territoryid) -> sales.salesterritory (territoryid)
sales.shoppingcartitem (productid) -> production.product (productid)
sales.specialofferproduct (productid) -> production.product (productid)
sales.specialofferproduct (specialofferid) -> sales.specialoffer (specialofferid)
person.stateprovince (countryregioncode) -> person.countryregion (countryregioncode)
person.stateprovince (territoryid) -> sales.salesterritory (territoryid)
sales.store (businessentityid) -> person.businessentity (businessentityid)
sales.store (salespersonid) -> sales.salesperson (businessentityid)
production.transactionhistory (productid) -> production.product (productid)
purchasing.vendor (businessentityid) -> person.businessentity (businessentityid)
production.workorder (productid) -> production.product (productid)
production.workorder (scrapreasonid) -> production.scrapreason (scrapreasonid)
production.workorderrouting (locationid) -> production.location (locationid)
production.workorderrouting (workorderid) -> production.workorder (workorderid)
"""

# CHECK rules, table, name and predicate.  NOW() is the run date.
CHECKS = """
person.person | CK_Person_EmailPromotion | EmailPromotion BETWEEN 0 AND 2
person.person | CK_Person_PersonType | PersonType IS NULL OR UPPER(PersonType) IN ('SC', 'VC', 'IN', 'EM', 'SP', 'GC')
humanresources.employee | CK_Employee_BirthDate | BirthDate BETWEEN '1930-01-01' AND NOW() - INTERVAL '18 years'
humanresources.employee | CK_Employee_MaritalStatus | UPPER(MaritalStatus) IN ('M', 'S')
humanresources.employee | CK_Employee_HireDate | HireDate BETWEEN '1996-07-01' AND NOW() + INTERVAL '1 day'
humanresources.employee | CK_Employee_Gender | UPPER(Gender) IN ('M', 'F')
humanresources.employee | CK_Employee_VacationHours | VacationHours BETWEEN -40 AND 240
humanresources.employee | CK_Employee_SickLeaveHours | SickLeaveHours BETWEEN 0 AND 120
humanresources.employeedepartmenthistory | CK_EmployeeDepartmentHistory_EndDate | (EndDate >= StartDate) OR (EndDate IS NULL)
humanresources.employeepayhistory | CK_EmployeePayHistory_PayFrequency | PayFrequency IN (1, 2)
humanresources.employeepayhistory | CK_EmployeePayHistory_Rate | Rate BETWEEN 6.50 AND 200.00
production.billofmaterials | CK_BillOfMaterials_EndDate | (EndDate > StartDate) OR (EndDate IS NULL)
production.billofmaterials | CK_BillOfMaterials_ProductAssemblyID | ProductAssemblyID <> ComponentID
production.billofmaterials | CK_BillOfMaterials_BOMLevel | ((ProductAssemblyID IS NULL) AND (BOMLevel = 0) AND (PerAssemblyQty = 1.00)) OR ((ProductAssemblyID IS NOT NULL) AND (BOMLevel >= 1))
production.billofmaterials | CK_BillOfMaterials_PerAssemblyQty | PerAssemblyQty >= 1.00
production.document | CK_Document_Status | Status BETWEEN 1 AND 3
production.product | CK_Product_SafetyStockLevel | SafetyStockLevel > 0
production.product | CK_Product_ReorderPoint | ReorderPoint > 0
production.product | CK_Product_StandardCost | StandardCost >= 0.00
production.product | CK_Product_ListPrice | ListPrice >= 0.00
production.product | CK_Product_Weight | Weight > 0.00
production.product | CK_Product_DaysToManufacture | DaysToManufacture >= 0
production.product | CK_Product_ProductLine | UPPER(ProductLine) IN ('S', 'T', 'M', 'R') OR ProductLine IS NULL
production.product | CK_Product_Class | UPPER(Class) IN ('L', 'M', 'H') OR Class IS NULL
production.product | CK_Product_Style | UPPER(Style) IN ('W', 'M', 'U') OR Style IS NULL
production.product | CK_Product_SellEndDate | (SellEndDate >= SellStartDate) OR (SellEndDate IS NULL)
production.productcosthistory | CK_ProductCostHistory_EndDate | (EndDate >= StartDate) OR (EndDate IS NULL)
production.productcosthistory | CK_ProductCostHistory_StandardCost | StandardCost >= 0.00
production.location | CK_Location_CostRate | CostRate >= 0.00
production.location | CK_Location_Availability | Availability >= 0.00
production.productinventory | CK_ProductInventory_Bin | Bin BETWEEN 0 AND 100
production.productlistpricehistory | CK_ProductListPriceHistory_EndDate | (EndDate >= StartDate) OR (EndDate IS NULL)
production.productlistpricehistory | CK_ProductListPriceHistory_ListPrice | ListPrice > 0.00
production.productreview | CK_ProductReview_Rating | Rating BETWEEN 1 AND 5
production.transactionhistory | CK_TransactionHistory_TransactionType | UPPER(TransactionType) IN ('W', 'S', 'P')
production.transactionhistoryarchive | CK_TransactionHistoryArchive_TransactionType | UPPER(TransactionType) IN ('W', 'S', 'P')
production.workorder | CK_WorkOrder_OrderQty | OrderQty > 0
production.workorder | CK_WorkOrder_ScrappedQty | ScrappedQty >= 0
production.workorder | CK_WorkOrder_EndDate | (EndDate >= StartDate) OR (EndDate IS NULL)
production.workorderrouting | CK_WorkOrderRouting_ScheduledEndDate | ScheduledEndDate >= ScheduledStartDate
production.workorderrouting | CK_WorkOrderRouting_ActualEndDate | (ActualEndDate >= ActualStartDate) OR (ActualEndDate IS NULL) OR (ActualStartDate IS NULL)
production.workorderrouting | CK_WorkOrderRouting_ActualResourceHrs | ActualResourceHrs >= 0.0000
production.workorderrouting | CK_WorkOrderRouting_PlannedCost | PlannedCost > 0.00
production.workorderrouting | CK_WorkOrderRouting_ActualCost | ActualCost > 0.00
purchasing.productvendor | CK_ProductVendor_AverageLeadTime | AverageLeadTime >= 1
purchasing.productvendor | CK_ProductVendor_StandardPrice | StandardPrice > 0.00
purchasing.productvendor | CK_ProductVendor_LastReceiptCost | LastReceiptCost > 0.00
purchasing.productvendor | CK_ProductVendor_MinOrderQty | MinOrderQty >= 1
purchasing.productvendor | CK_ProductVendor_MaxOrderQty | MaxOrderQty >= 1
purchasing.productvendor | CK_ProductVendor_OnOrderQty | OnOrderQty >= 0
purchasing.purchaseorderdetail | CK_PurchaseOrderDetail_OrderQty | OrderQty > 0
purchasing.purchaseorderdetail | CK_PurchaseOrderDetail_UnitPrice | UnitPrice >= 0.00
purchasing.purchaseorderdetail | CK_PurchaseOrderDetail_ReceivedQty | ReceivedQty >= 0.00
purchasing.purchaseorderdetail | CK_PurchaseOrderDetail_RejectedQty | RejectedQty >= 0.00
purchasing.purchaseorderheader | CK_PurchaseOrderHeader_Status | Status BETWEEN 1 AND 4
purchasing.purchaseorderheader | CK_PurchaseOrderHeader_ShipDate | (ShipDate >= OrderDate) OR (ShipDate IS NULL)
purchasing.purchaseorderheader | CK_PurchaseOrderHeader_SubTotal | SubTotal >= 0.00
purchasing.purchaseorderheader | CK_PurchaseOrderHeader_TaxAmt | TaxAmt >= 0.00
purchasing.purchaseorderheader | CK_PurchaseOrderHeader_Freight | Freight >= 0.00
purchasing.shipmethod | CK_ShipMethod_ShipBase | ShipBase > 0.00
purchasing.shipmethod | CK_ShipMethod_ShipRate | ShipRate > 0.00
purchasing.vendor | CK_Vendor_CreditRating | CreditRating BETWEEN 1 AND 5
sales.salesorderdetail | CK_SalesOrderDetail_OrderQty | OrderQty > 0
sales.salesorderdetail | CK_SalesOrderDetail_UnitPrice | UnitPrice >= 0.00
sales.salesorderdetail | CK_SalesOrderDetail_UnitPriceDiscount | UnitPriceDiscount >= 0.00
sales.salesorderheader | CK_SalesOrderHeader_Status | Status BETWEEN 0 AND 8
sales.salesorderheader | CK_SalesOrderHeader_DueDate | DueDate >= OrderDate
sales.salesorderheader | CK_SalesOrderHeader_ShipDate | (ShipDate >= OrderDate) OR (ShipDate IS NULL)
sales.salesorderheader | CK_SalesOrderHeader_SubTotal | SubTotal >= 0.00
sales.salesorderheader | CK_SalesOrderHeader_TaxAmt | TaxAmt >= 0.00
sales.salesorderheader | CK_SalesOrderHeader_Freight | Freight >= 0.00
sales.salesperson | CK_SalesPerson_SalesQuota | SalesQuota > 0.00
sales.salesperson | CK_SalesPerson_Bonus | Bonus >= 0.00
sales.salesperson | CK_SalesPerson_CommissionPct | CommissionPct >= 0.00
sales.salesperson | CK_SalesPerson_SalesYTD | SalesYTD >= 0.00
sales.salesperson | CK_SalesPerson_SalesLastYear | SalesLastYear >= 0.00
sales.salespersonquotahistory | CK_SalesPersonQuotaHistory_SalesQuota | SalesQuota > 0.00
sales.salestaxrate | CK_SalesTaxRate_TaxType | TaxType BETWEEN 1 AND 3
sales.salesterritory | CK_SalesTerritory_SalesYTD | SalesYTD >= 0.00
sales.salesterritory | CK_SalesTerritory_SalesLastYear | SalesLastYear >= 0.00
sales.salesterritory | CK_SalesTerritory_CostYTD | CostYTD >= 0.00
sales.salesterritory | CK_SalesTerritory_CostLastYear | CostLastYear >= 0.00
sales.salesterritoryhistory | CK_SalesTerritoryHistory_EndDate | (EndDate >= StartDate) OR (EndDate IS NULL)
sales.shoppingcartitem | CK_ShoppingCartItem_Quantity | Quantity >= 1
sales.specialoffer | CK_SpecialOffer_EndDate | EndDate >= StartDate
sales.specialoffer | CK_SpecialOffer_DiscountPct | DiscountPct >= 0.00
sales.specialoffer | CK_SpecialOffer_MinQty | MinQty >= 0
sales.specialoffer | CK_SpecialOffer_MaxQty | MaxQty >= 0
"""


def _lines(text: str) -> list[str]:
    return [line for line in text.strip().splitlines() if line]


def _names(text: str) -> tuple[str, ...]:
    return tuple(n.strip() for n in text.split(","))


def primary_keys() -> dict[str, tuple[str, ...]]:
    return {t: _names(k) for t, k in (line.split(": ") for line in _lines(PRIMARY_KEYS))}


def foreign_keys() -> dict[str, list[ForeignKey]]:
    found: dict[str, list[ForeignKey]] = {}
    for line in _lines(FOREIGN_KEYS):
        cascade = line.endswith(" *")
        child, parent = line.removesuffix(" *").split(" -> ")
        table, columns = child.rstrip(")").split(" (")
        target, target_columns = parent.rstrip(")").split(" (")
        found.setdefault(table, []).append(
            ForeignKey(_names(columns), target, _names(target_columns), cascade))
    return found


def check_rules(as_of: dt.date) -> dict[str, list[Rule]]:
    """CHECK rules per table, with the run date in place of the clock."""
    today = f"date '{as_of.isoformat()}'"
    found: dict[str, list[Rule]] = {}
    for line in _lines(CHECKS):
        table, name, predicate = line.split(" | ")
        found.setdefault(table, []).append(check_rule(name, predicate.replace("NOW()", today)))
    return found


def declared_rules(as_of: dt.date) -> dict[str, TableRules]:
    """Keys, foreign keys and CHECK rules of all source tables."""
    keys, links, checks = primary_keys(), foreign_keys(), check_rules(as_of)
    return {t: TableRules(tuple(checks.get(t, ())), keys[t], tuple(links.get(t, ()))) for t in keys}
