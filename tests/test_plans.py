import datetime as dt
import os
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from treadle.plans import daily, dims, facts, marts, shorthand, staging, views, xml_views
from treadle.retail import jobs, runs
from treadle.sources.catalog import describe

D = dt.date
STAMP = dt.datetime(2010, 1, 1)


def m(x):
    return Decimal(str(x))


@pytest.fixture(scope="module")
def source(spark):
    """A small shop: two people customers, one store, two sellers (one leads the other)."""
    def f(rows, schema):
        return spark.createDataFrame(rows, schema)

    ntz = "timestamp_ntz"
    t = {
        "person.person": f([
            (1, "IN", None, "Ann", "Q.", "Lee", None, 0, STAMP), (2, "IN", "Mr.", "Bob", None, "Ray", "Jr.", 1, STAMP),
            (10, "SP", None, "Cy", None, "Ott", None, 0, STAMP), (11, "SP", None, "Di", None, "Poe", None, 0, STAMP),
            (30, "SC", None, "Ed", None, "Fox", None, 0, STAMP)],
            "businessentityid int, persontype string, title string, firstname string, middlename string, lastname string, "
            f"suffix string, emailpromotion int, modifieddate {ntz}")
        .withColumn("additionalcontactinfo", F.lit(None).cast("string")).withColumn("demographics", F.lit(None).cast("string")),
        "person.emailaddress": f([(1, 7, "z@x", STAMP), (1, 5, "a@x", STAMP), (10, 8, "c@x", STAMP), (30, 9, "e@x", STAMP)],
                                 f"businessentityid int, emailaddressid int, emailaddress string, modifieddate {ntz}"),
        "person.personphone": f([(1, "222", 2, STAMP), (1, "111", 1, STAMP), (30, "333", 3, STAMP)],
                                f"businessentityid int, phonenumber string, phonenumbertypeid int, modifieddate {ntz}"),
        "person.phonenumbertype": f([(1, "Cell", STAMP), (2, "Home", STAMP)], f"phonenumbertypeid int, name string, modifieddate {ntz}"),
        "person.address": f([(100, "1 St", None, "Oslo", 1, "0150", STAMP), (101, "2 St", "Flat", "Bergen", 2, "5003", STAMP)],
                            f"addressid int, addressline1 string, addressline2 string, city string, stateprovinceid int, postalcode string, modifieddate {ntz}"),
        "person.businessentityaddress": f([(1, 101, 3, STAMP), (1, 100, 2, STAMP), (10, 100, 2, STAMP), (11, 100, 2, STAMP), (20, 101, 3, STAMP), (40, 101, 2, STAMP)],
                                          f"businessentityid int, addressid int, addresstypeid int, modifieddate {ntz}"),
        "person.addresstype": f([(2, "Home", STAMP), (3, "Main", STAMP)], f"addresstypeid int, name string, modifieddate {ntz}"),
        "person.contacttype": f([(1, "Owner", STAMP)], f"contacttypeid int, name string, modifieddate {ntz}"),
        "person.businessentitycontact": f([(20, 30, 1, STAMP), (40, 30, 1, STAMP)], f"businessentityid int, personid int, contacttypeid int, modifieddate {ntz}"),
        "person.stateprovince": f([(1, "OS", "NO", False, "Oslo", 1, STAMP), (2, "VL", "NO", False, "Vestland", 1, STAMP)],
                                  f"stateprovinceid int, stateprovincecode string, countryregioncode string, isonlystateprovinceflag boolean, name string, territoryid int, modifieddate {ntz}"),
        "person.countryregion": f([("NO", "Norway", STAMP)], f"countryregioncode string, name string, modifieddate {ntz}"),
        "sales.customer": f([(1001, 1, None, 1, STAMP), (1002, 2, None, 1, STAMP), (1003, 30, 20, 1, STAMP), (1004, None, 20, 1, STAMP)],
                            f"customerid int, personid int, storeid int, territoryid int, modifieddate {ntz}"),
        "sales.store": f([(20, "Bikes", 10, "<StoreSurvey xmlns='u'><SquareFeet>900</SquareFeet><YearOpened>1999</YearOpened></StoreSurvey>", STAMP)],
                         f"businessentityid int, name string, salespersonid int, demographics string, modifieddate {ntz}"),
        "sales.salesperson": f([(10, 1, m(100), m(5), m(6), STAMP), (11, None, None, m(7), m(8), STAMP)],
                               f"businessentityid int, territoryid int, salesquota decimal(19,4), salesytd decimal(19,4), saleslastyear decimal(19,4), modifieddate {ntz}"),
        "sales.salesterritory": f([(1, "North", "NO", "Europe", STAMP)], f"territoryid int, name string, countryregioncode string, `group` string, modifieddate {ntz}"),
        "sales.salespersonquotahistory": f([(10, dt.datetime(2012, 7, 1), m(500), STAMP), (10, dt.datetime(2013, 7, 1), m(900), STAMP)],
                                           f"businessentityid int, quotadate {ntz}, salesquota decimal(19,4), modifieddate {ntz}"),
        "sales.salesorderheader": f([
            (1, dt.datetime(2012, 6, 30), dt.datetime(2012, 7, 12), dt.datetime(2012, 7, 7), 1001, 10, 1, m(100), m(110), STAMP),
            (2, dt.datetime(2012, 7, 1), dt.datetime(2012, 7, 13), dt.datetime(2012, 9, 20), 1003, 10, 1, m(50), m(55), STAMP),
            (3, dt.datetime(2013, 8, 1), dt.datetime(2013, 8, 13), None, 1003, 11, None, m(70), m(77), STAMP),
            (4, dt.datetime(2014, 1, 1), dt.datetime(2014, 1, 13), None, 1001, None, 1, m(20), m(22), STAMP)],
            f"salesorderid int, orderdate {ntz}, duedate {ntz}, shipdate {ntz}, customerid int, salespersonid int, territoryid int, subtotal decimal(19,4), totaldue decimal(19,4), modifieddate {ntz}"),
        "sales.salesorderdetail": f([
            (1, 1, 500, 1, 2, m(25), m(0), dt.datetime(2012, 6, 30)), (1, 2, 501, 2, 1, m(100), m(0.5), dt.datetime(2012, 6, 30)),
            (2, 3, 500, 1, 2, m(25), m(0), dt.datetime(2012, 7, 1)), (3, 4, 501, 1, 1, m(70), m(0), dt.datetime(2013, 8, 1)),
            (4, 5, 500, 1, 1, m(20), m(0), dt.datetime(2014, 1, 1))],
            f"salesorderid int, salesorderdetailid int, productid int, specialofferid int, orderqty smallint, unitprice decimal(19,4), unitpricediscount decimal(19,4), modifieddate {ntz}"),
        "humanresources.employee": f([(10, "Lead", "/1/", dt.date(2008, 1, 1), True, STAMP), (11, "Rep", "/1/1/", dt.date(2009, 1, 1), False, STAMP)],
                                     f"businessentityid int, jobtitle string, organizationnode string, hiredate date, currentflag boolean, modifieddate {ntz}"),
        "humanresources.department": f([(1, "Sales", "Trade", STAMP), (2, "Shop", "Trade", STAMP)], f"departmentid int, name string, groupname string, modifieddate {ntz}"),
        "humanresources.shift": f([(1, "Day", STAMP)], f"shiftid int, name string, modifieddate {ntz}"),
        "humanresources.employeedepartmenthistory": f([
            (10, 2, 1, D(2008, 1, 1), D(2009, 1, 1), STAMP), (10, 1, 1, D(2009, 1, 2), None, STAMP), (11, 1, 1, D(2009, 1, 1), None, STAMP)],
            f"businessentityid int, departmentid int, shiftid int, startdate date, enddate date, modifieddate {ntz}"),
        "production.product": f([
            (500, "Sock", "SO-1", "Red", "M", None, m(10), m(25), 10, 5, 1, 7, dt.datetime(2011, 1, 1), None, None, STAMP),
            (501, "Bike", "BI-1", None, None, m(9), m(60), m(100), 20, 8, None, None, dt.datetime(2011, 1, 1), dt.datetime(2012, 12, 31), None, STAMP)],
            "productid int, name string, productnumber string, color string, size string, weight decimal(8,2), standardcost decimal(19,4), "
            "listprice decimal(19,4), safetystocklevel smallint, reorderpoint smallint, productsubcategoryid int, productmodelid int, "
            f"sellstartdate {ntz}, sellenddate {ntz}, discontinueddate {ntz}, modifieddate {ntz}"),
        "production.productmodel": f([(7, "Racing", STAMP)], f"productmodelid int, name string, modifieddate {ntz}"),
        "production.productsubcategory": f([(1, 1, "Socks", STAMP)], f"productsubcategoryid int, productcategoryid int, name string, modifieddate {ntz}"),
        "production.productcategory": f([(1, "Clothing", STAMP)], f"productcategoryid int, name string, modifieddate {ntz}"),
        "production.productdescription": f([(90, "Warm", STAMP)], f"productdescriptionid int, description string, modifieddate {ntz}"),
        "production.productmodelproductdescriptionculture": f([(7, 90, "en", STAMP)], f"productmodelid int, productdescriptionid int, cultureid string, modifieddate {ntz}"),
        "production.productlistpricehistory": f([(500, dt.datetime(2011, 1, 1), dt.datetime(2012, 6, 30), m(20), STAMP), (500, dt.datetime(2012, 7, 1), None, m(25), STAMP)],
                                                f"productid int, startdate {ntz}, enddate {ntz}, listprice decimal(19,4), modifieddate {ntz}"),
        "production.productcosthistory": f([(500, dt.datetime(2011, 1, 1), None, m(10), STAMP), (500, dt.datetime(2012, 9, 1), None, m(11), STAMP)],
                                           f"productid int, startdate {ntz}, enddate {ntz}, standardcost decimal(19,4), modifieddate {ntz}"),
        "production.productinventory": f([(500, 1, "A", 1, 6, STAMP), (500, 1, "B", 2, 4, STAMP), (501, 2, "A", 1, 3, STAMP)],
                                         f"productid int, locationid smallint, shelf string, bin smallint, quantity smallint, modifieddate {ntz}"),
        "production.location": f([(1, "Crib", m(0), STAMP), (2, "Paint", m(40), STAMP)], f"locationid int, name string, availability decimal(8,2), modifieddate {ntz}"),
        "production.workorder": f([(1, 500, 10, 1, dt.datetime(2013, 1, 1), None, STAMP), (2, 501, 5, 0, dt.datetime(2013, 1, 2), None, STAMP)],
                                  f"workorderid int, productid int, orderqty int, scrappedqty smallint, startdate {ntz}, enddate {ntz}, modifieddate {ntz}"),
        "production.workorderrouting": f([(1, 500, 1, m(2.5), dt.datetime(2013, 1, 1), STAMP), (1, 500, 2, m(1), dt.datetime(2013, 1, 1), STAMP)],
                                         f"workorderid int, productid int, operationsequence smallint, actualresourcehrs decimal(9,4), scheduledstartdate {ntz}, modifieddate {ntz}"),
        "production.productreview": f([(1, 500, "X", dt.datetime(2013, 9, 18), "x@x", 5, STAMP), (2, 500, "Y", dt.datetime(2013, 9, 19), "y@x", 2, STAMP)],
                                      f"productreviewid int, productid int, reviewername string, reviewdate {ntz}, emailaddress string, rating int, modifieddate {ntz}"),
        "purchasing.vendor": f([(40, "Tyres", 1, True, True, STAMP)], f"businessentityid int, name string, creditrating smallint, preferredvendorstatus boolean, activeflag boolean, modifieddate {ntz}"),
        "purchasing.productvendor": f([(500, 40, dt.datetime(2013, 12, 1), STAMP)], f"productid int, businessentityid int, lastreceiptdate {ntz}, modifieddate {ntz}"),
        "purchasing.purchaseorderheader": f([(1, 40, dt.datetime(2013, 2, 1), dt.datetime(2013, 2, 5), STAMP)], f"purchaseorderid int, vendorid int, orderdate {ntz}, shipdate {ntz}, modifieddate {ntz}"),
        "purchasing.purchaseorderdetail": f([(1, 1, dt.datetime(2013, 2, 4), 4, 500, m(2.5), m(4), m(1), STAMP), (1, 2, dt.datetime(2013, 2, 9), 3, 501, m(10), m(4), m(1), STAMP)],
                                            f"purchaseorderid int, purchaseorderdetailid int, duedate {ntz}, orderqty smallint, productid int, unitprice decimal(19,4), receivedqty decimal(8,2), rejectedqty decimal(8,2), modifieddate {ntz}"),
        "sales.specialoffer": f([(1, "None", m(0), "No Discount", "No Discount", dt.datetime(2011, 1, 1), dt.datetime(2014, 11, 30), STAMP),
                                 (2, "Half", m(0.5), "Sale", "Reseller", dt.datetime(2012, 1, 1), dt.datetime(2012, 12, 31), STAMP)],
                                f"specialofferid int, description string, discountpct decimal(19,4), type string, category string, startdate {ntz}, enddate {ntz}, modifieddate {ntz}"),
    }
    return t


AS_OF = D(2014, 6, 1)


def test_customer_staging(source, rows):
    got = staging.customer_staging(source, D(2018, 1, 1))
    assert got.dtypes == staging.CUSTOMER
    assert rows(got, "customerid", "customername", "emailaddress", "phonenumber", "city", "countryregioncode",
                "customersegment", "customertype", "yearssincefirstpurchase") == [
        (1001, "Ann Lee", "a@x", "111", "Oslo", "NO", "Premium", "Individual", 6),
        (1002, "Bob Ray", None, None, None, None, "Standard", "Individual", 0),
        (1003, "Ed Fox", "e@x", "333", None, None, "Premium", "Corporate", 6),
        (1004, "", None, None, None, None, "Standard", "Corporate", 0)]


def test_customer_staging_with_optional_tables_missing(source):
    got = staging.customer_staging({k: source[k] for k in ("person.person", "sales.customer")}, AS_OF)
    assert got.dtypes == staging.CUSTOMER and got.count() == 4
    with pytest.raises(ValueError):
        staging.customer_staging({}, AS_OF)


def test_employee_views(source, rows):
    assert rows(views.v_employee(source), "businessentityid", "jobtitle", "emailaddress", "city", "countryregionname") == [
        (10, "Lead", "c@x", "Oslo", "Norway"), (11, "Rep", None, "Oslo", "Norway")]
    assert rows(views.v_employee_department(source), "businessentityid", "department") == [(10, "Sales"), (11, "Sales")]
    assert rows(views.v_employee_department_history(source), "businessentityid", "department", "shift") == [
        (10, "Sales", "Day"), (10, "Shop", "Day"), (11, "Sales", "Day")]


def test_contact_views(source, rows):
    assert rows(views.v_individual_customer(source), "businessentityid", "addresstype", "emailaddress", "phonenumbertype") == sorted(
        (1, a, e, p) for a in ("Home", "Main") for e in ("a@x", "z@x") for p in ("Cell", "Home"))
    assert rows(views.v_store_with_contacts(source), "businessentityid", "contacttype", "lastname", "phonenumbertype") == [(20, "Owner", "Fox", None)]
    assert rows(views.v_vendor_with_contacts(source), "name", "firstname") == [("Tyres", "Ed")]
    assert rows(views.v_store_with_addresses(source), "name", "addresstype", "city") == [("Bikes", "Main", "Bergen")]
    assert rows(views.v_vendor_with_addresses(source), "name", "addresstype") == [("Tyres", "Home")]


def test_sales_views(source, rows):
    assert rows(views.v_sales_person(source), "businessentityid", "territoryname", "territorygroup") == [(10, "North", "Europe"), (11, None, None)]
    assert rows(views.v_sales_person_sales_by_fiscal_years_data(source), "salespersonid", "fullname", "fiscalyear", "salestotal") == [
        (10, "Cy Ott", 2012, m("100.0000")), (10, "Cy Ott", 2013, m("50.0000"))]
    assert rows(views.v_sales_person_sales_by_fiscal_years(source)) == [(10, "Cy Ott", "Lead", "North", m("100.0000"), m("50.0000"), None)]


def test_other_views(source, rows):
    assert rows(views.v_product_and_description(source)) == [(500, "Sock", "Racing", "en", "Warm")]
    assert rows(views.v_state_province_country_region(source), "stateprovinceid", "countryregionname") == [(1, "Norway"), (2, "Norway")]


def test_materialized_view(spark, source, rows, tmp_path):
    got = views.refresh_view(spark, "person.vstateprovincecountryregion", source, str(tmp_path))
    assert got.count() == 2


def test_store_survey(source, frame, rows):
    got = xml_views.v_store_with_demographics(source)
    assert rows(got, "yearopened", "squarefeet", "bankname") == [(1999, 900, None)]
    empty = {"sales.store": frame([(1, "s", None), (2, "t", "<StoreSurvey xmlns='u'/>")], "businessentityid int, name string, demographics string")}
    assert xml_views.v_store_with_demographics(empty).count() == 0


def test_resume_views(frame, rows):
    doc = ("<ns:Resume xmlns:ns='u'><ns:Name><ns:Name.First>Ann</ns:Name.First></ns:Name><ns:Skills> A &amp; B </ns:Skills>"
           "<ns:Employment><ns:Emp.StartDate>2000-06-01Z</ns:Emp.StartDate><ns:Emp.OrgName>X</ns:Emp.OrgName></ns:Employment>"
           "<ns:Employment><ns:Emp.StartDate>2002-06-01Z</ns:Emp.StartDate><ns:Emp.EndDate>2003-01-01Z</ns:Emp.EndDate></ns:Employment>"
           "<ns:Education><ns:Edu.Level>B</ns:Edu.Level><ns:Edu.GPA>3.123456</ns:Edu.GPA></ns:Education></ns:Resume>")
    t = {"humanresources.jobcandidate": frame([(1, None, doc, STAMP), (2, 5, None, STAMP)],
                                              "jobcandidateid int, businessentityid int, resume string, modifieddate timestamp_ntz")}
    people = xml_views.v_job_candidate(t)
    assert rows(people, "jobcandidateid", "`Name.First`", "Skills", "`Addr.Type`") == [(1, "Ann", " A & B ", None), (2, None, None, None)]
    assert rows(xml_views.v_job_candidate_employment(t), "`Emp.StartDate`", "`Emp.EndDate`", "`Emp.OrgName`") == [
        (D(2000, 6, 1), None, "X"), (D(2002, 6, 1), D(2003, 1, 1), None)]
    assert rows(xml_views.v_job_candidate_education(t), "`Edu.Level`", "`Edu.Minor`", "`Edu.GPA`") == [("B", None, "3.123")]


def test_instructions(frame, rows):
    doc = ("<root xmlns='u'>Read me <Location LaborHours='2.5' LotSize='100' LocationID='10'><step>Insert <m>sheet</m> now</step>"
           "<step>turn</step></Location><Location LocationID='20'><step>pack</step></Location><Location LocationID='30'/></root>")
    t = {"production.productmodel": frame([(1, "n", doc, "g", STAMP), (2, "n", None, "g", STAMP)],
                                          "productmodelid int, name string, instructions string, rowguid string, modifieddate timestamp_ntz")}
    assert rows(xml_views.v_product_model_instructions(t), "instructions", "locationid", "laborhours", "lotsize", "step") == [
        ("Read me ", 10, m("2.5000"), 100, "Insert "), ("Read me ", 10, m("2.5000"), 100, "turn"), ("Read me ", 20, None, None, "pack")]


def test_shorthand(source, spark, rows):
    names = shorthand.shorthand_map()
    assert len(names) == 68 and sum(k is None for _, k in names.values()) == 8
    assert shorthand.shorthand("pe.p", source.__getitem__).columns[0] == "id"
    assert shorthand.shorthand("pe.cr", source.__getitem__).columns == source["person.countryregion"].columns
    made = shorthand.register(spark, source)
    assert "sa_soh" in made
    assert spark.sql("SELECT p.firstname, e.jobtitle FROM pe_p p JOIN hr_e e ON p.id = e.id").count() == 2


def test_sales_lines_follow_the_formula(source, rows):
    fact = facts.fact_sales(facts.sales_lines_from_source(source))
    assert rows(fact, "SalesOrderID", "ProductKey", "SalesRevenue", "DiscountAmount", "StoreKey") == [
        (1, 500, m("50.00"), m("0.00"), None), (1, 501, m("50.00"), m("50.00"), None), (2, 500, m("50.00"), m("0.00"), 20),
        (3, 501, m("70.00"), m("0.00"), 20), (4, 500, m("20.00"), m("0.00"), None)]


def test_other_facts_from_source(source, rows):
    assert rows(facts.fact_purchases(facts.purchase_lines_from_source(source)), "ProductKey", "PurchaseAmount", "UnitCost") == [
        (500, m("10.00"), m("2.50")), (501, m("30.00"), m("10.00"))]
    assert rows(facts.fact_inventory(facts.stock_from_source(source), D(2014, 1, 1)), "ProductKey", "WarehouseKey", "QuantityOnHand", "StockAgingDays") == [
        (500, 1, 10, 31), (501, 2, 3, None)]
    assert rows(facts.fact_production(*facts.runs_from_source(source)), "ProductKey", "ProductionTimeHours", "UnitsProduced", "ScrapRate") == [
        (500, m("3.50"), 9, 10.0), (501, None, 5, 0.0)]
    got = facts.fact_employee_sales(facts.sales_lines_from_source(source), facts.quotas_from_source(source),
                                    facts.sellers_from_source(source), D(2011, 1, 1), AS_OF)
    assert rows(got, "SalesDateKey", "EmployeeKey", "SalesAmount", "SalesTarget", "CustomerContactsCount") == [
        (D(2012, 6, 30), 10, m("100.00"), None, 1), (D(2012, 7, 1), 10, m("50.00"), m("500.00"), 1), (D(2013, 8, 1), 11, m("70.00"), None, 1)]
    assert rows(facts.fact_customer_feedback(facts.feedback_from_source(source)), "FeedbackScore", "ComplaintCount", "CSATScore") == [
        (2, 1, m("40.00")), (5, 0, m("100.00"))]
    promo = facts.fact_promotion_response(facts.sales_lines_from_source(source))
    # only the line sold under the sale offer: "No Discount" is no promotion
    assert [(r.PromotionKey, r.DiscountUsageCount) for r in promo.collect()] == [(2, 1)]
    assert rows(facts.fact_finance(facts.invoices_from_source(source)), "InvoiceID", "PaymentDelayDays", "InterestCharges", "CreditUsage") == [
        (1, -5, m("0.00"), None), (2, 69, m("1.07"), None), (3, None, m("0.00"), None), (4, None, m("0.00"), None)]


def test_rates_that_do_not_fit_become_null_and_are_found(frame, rows):
    df = frame([(1, 12.345), (2, 1e33), (3, 123456.0)], "k int, GrowthRate double")
    assert rows(facts.stored(df)) == [(1, m("12.345000")), (2, None), (3, m("123456.000000"))]
    assert rows(df.filter(facts.overflows(df)), "k") == [(2,)]


def test_dimension_stages_have_the_declared_columns(source, rows):
    for name, stage in dims.STAGES.items():
        spec = dims.DIMENSIONS[name]
        got = dims.conform(stage(source, AS_OF), spec)
        assert [c for c, _ in got.dtypes] == [c for c, _ in spec.columns], name
        assert got.select(spec.natural).distinct().count() == got.count() > 0, name


def test_dimension_values(source, rows):
    assert rows(dims.stage_product(source, AS_OF), "ProductID", "Category", "Brand", "ProductStatus") == [
        (500, "Clothing", "Racing", "Active"), (501, None, None, "Discontinued")]
    assert rows(dims.stage_employee(source, AS_OF), "EmployeeID", "ManagerID", "Department", "EmployeeStatus") == [
        (10, None, "Sales", "Active"), (11, 10, "Sales", "Terminated")]
    vendor = dims.conform(dims.stage_vendor(source, AS_OF), dims.DIMENSIONS["DimVendor"])
    assert rows(vendor, "VendorRating", "OnTimeDeliveryRate", "QualityScore", "VendorStatus", "ContactPerson", "Phone") == [
        (m("5.00"), m("50.00"), m("75.00"), "Preferred", "Ed Fox", "333")]
    assert rows(dims.stage_store(source, AS_OF), "ManagerName", "Territory", "City", "SquareFootage", "OpeningDate") == [
        ("Cy Ott", "North", "Bergen", 900, D(1999, 1, 1))]
    assert rows(dims.stage_promotion(source, AS_OF), "PromotionID", "PromotionStatus", "IsActive") == [(1, "Running", True), (2, "Ended", False)]
    assert rows(dims.stage_sales_territory(source, AS_OF), "TerritoryName", "Country", "SalesTarget") == [("North", "Norway", m("100.0000"))]
    assert rows(dims.product_history(source), "ProductID", "ValidFromDate", "ValidToDate", "ListPrice", "Cost") == [
        (500, D(2011, 1, 1), D(2012, 7, 1), m("20.0000"), m("10.0000")), (500, D(2012, 7, 1), D(2012, 9, 1), m("25.0000"), m("10.0000")),
        (500, D(2012, 9, 1), None, m("25.0000"), m("11.0000"))]


def test_manager_keys(source, rows):
    staged = dims.stage_employee(source, AS_OF)
    dim = dims.load_dimension(dims.DIMENSIONS["DimEmployee"], None, staged, AS_OF)
    keyed = dims.with_manager_keys(dim, staged.select("EmployeeID", "ManagerID"))
    key = {r.EmployeeID: r.EmployeeKey for r in dim.collect()}
    assert rows(keyed, "EmployeeID", "ReportingManagerKey") == [(10, None), (11, key[10])]


def test_static_dimensions(spark):
    for name in dims.STATIC_ROWS:
        spec = dims.DIMENSIONS[name]
        got = dims.static_dimension(spark, name)
        assert got.columns == [spec.surrogate, *[c for c, _ in spec.columns]]
        assert got.select(spec.surrogate).distinct().count() == len(dims.STATIC_ROWS[name])


def test_dim_date(frame):
    days = {r.FullDate: r for r in dims.dim_date(frame([(D(2011, 12, 31), D(2012, 7, 4))], "low date, high date")).collect()}
    assert len(days) == 187 and len(days[D(2012, 1, 1)].asDict()) == 19
    a, b = days[D(2012, 1, 1)], days[D(2012, 7, 4)]
    assert (a.DateKey, a.DayName, a.IsWeekend, a.HolidayName, a.FiscalYear, a.FiscalQuarter, a.FiscalMonth, a.Season, a.Week) == (
        20120101, "Sunday", True, "New Year's Day", 2012, 3, 7, "Winter", 1)
    assert (b.IsHoliday, b.FiscalYear, b.FiscalMonth, b.Season) == (True, 2013, 1, "Summer")


def test_surrogates_and_unknown_member(frame, rows):
    fact = frame([(D(2012, 1, 1), 1), (D(2010, 1, 1), 1), (D(2012, 1, 1), 9), (D(2012, 1, 1), None)], "day date, CustomerKey int")
    dim = frame([(77, 1, D(2011, 1, 1), None)], "CustomerKey bigint, CustomerID int, ValidFromDate date, ValidToDate date")
    got = facts.with_surrogates(fact, "day", {"CustomerKey": facts.Link(dim, "CustomerID", "CustomerKey")}, D(2010, 1, 1), D(2013, 1, 1))
    assert rows(got, "CustomerKey") == [(-1,), (-1,), (-1,), (77,)]


def test_a_single_key_is_looked_up_in_one_shuffle(frame, rows):
    day, later = D(2012, 1, 1), D(2012, 6, 1)
    fact = frame([(day, 1, "a"), (day, 1, "a"), (later, 1, "b"), (day, None, "c"), (None, 1, "d"), (D(1990, 1, 1), 1, "e"), (day, 9, "f")],
                 "day date, ProductKey int, v string")
    dim = frame([(77, 1, D(2011, 1, 1), D(2012, 3, 1)), (78, 1, D(2012, 3, 1), None)], "sk bigint, ProductID int, ValidFromDate date, ValidToDate date")
    got = facts.with_surrogates(fact, "day", {"ProductKey": facts.Link(dim, "ProductID", "sk")}, D(2010, 1, 1), D(2013, 1, 1))
    assert got.columns == fact.columns and sorted((r.v, r.ProductKey) for r in got.collect()) == [
        ("a", 77), ("a", 77), ("b", 78), ("c", -1), ("d", -1), ("e", -1), ("f", -1)]
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def little(spark, tmp_path_factory):
    """A folder of small benchmark tables."""
    folder = str(tmp_path_factory.mktemp("little"))
    day = lambda k: dt.datetime(1996 + k % 4, 1 + k % 12, 1 + k % 27)
    tables = {
        "customer": ([(k, f"c{k}", k % 3, 1.0 * k, "BUILDING") for k in range(6)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(k, f"s{k}", k % 3, 1.0) for k in range(4)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(k, f"p{k}", f"b{k % 2}", f"t{k % 3}", k % 7, 10.5 + k) for k in range(12)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(k, k % 7 if k % 9 else None, "O", 5.0 * k, day(k), f"{k % 3}-X") for k in range(40)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(k % 40, k % 13, k % 5 if k % 11 else None, k % 4, 1.0 + k % 5, 2.5 * k, k % 4 / 100, k % 3 / 100, "NR"[k % 2], "OF"[k % 2], day(k + 5))
                      for k in range(150)] * 2,
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_a_step_of_a_daily_run_leaves_no_scratch(spark, little, tmp_path, monkeypatch):
    """Rows that were stored for the jobs of a step stayed for ever."""
    monkeypatch.setattr(daily, "run_folder", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    price, versions = F.col("listprice"), []
    for n, as_of in enumerate((D(1998, 1, 1), D(1997, 1, 1))):  # the second day lies in the past
        tables = runs._products(spark, little, price + n, f"2002-01-0{n + 1}")
        run = runs.day(spark, tables, f"{tmp_path}/root", as_of, [], ("DimProduct",))
        versions.append(run.table("DimProduct").read().count())
    assert versions[1] == 2 * versions[0] and os.listdir(tmp_path) == ["root"]


def test_keys_are_looked_up_by_slices(spark, frame, rows):
    """All slices were shuffled at once, four rows for each sale."""
    day, later = D(2012, 1, 1), D(2012, 6, 1)
    sold = [(day, k % 5, k % 3, f"v{k % 20}") for k in range(60)] + [(None, None, None, None)] * 2 + [(later, 1, None, "a")] * 3
    fact = frame(sold, "day date, ProductKey int, StoreKey int, v string")
    product = frame([(70 + k, k, D(2011, 1, 1), D(2012, 3, 1)) for k in range(4)] + [(81, 1, D(2012, 3, 1), None)],
                    "sk bigint, ProductID int, ValidFromDate date, ValidToDate date")
    store = frame([(5, 1), (6, 2)], "sk bigint, id int")
    links = {"ProductKey": facts.Link(product, "ProductID", "sk"), "StoreKey": facts.Link(store, "id", "sk", versioned=False)}
    whole, kept = facts.with_surrogates(fact, "day", links, D(2010, 1, 1), D(2013, 1, 1)), []

    def keep(df):
        kept.append(df.localCheckpoint())
        return kept[-1]

    for slices in (1, 3):
        kept.clear()
        got = facts.with_surrogates_by_slices(fact, "day", links, D(2010, 1, 1), D(2013, 1, 1), slices, keep)
        assert got.columns == fact.columns and rows(got) == rows(whole) and len(kept) == slices
    assert all(k.count() < len(sold) / 2 + 10 for k in kept) and sum(k.count() for k in kept) == len(sold)


def test_a_query_of_many_keys_keeps_one_slice_of_shuffles(spark, little, tmp_path, monkeypatch, rows):
    want = rows(jobs.k1_fact_sales_keyed(spark, little))
    assert len(want) > 100
    monkeypatch.setattr(jobs, "_SLICE_BYTES", 1 << 10)
    monkeypatch.setattr(jobs, "run_folder", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    assert rows(jobs.k1_fact_sales_keyed(spark, little)) == want
    # four slices and three histories are left, the sales are not
    assert len([n for n in os.listdir(tmp_path) if n.startswith("keyed-")]) == 7


def test_stores_are_put_on_orders_before_their_lines(source):
    """Customers meet the orders; the lines, which are many more, are not dealt out for them."""
    plan = facts.sales_lines_from_source(source)._jdf.queryExecution().analyzed().toString()
    joins = [line.strip(" :+-") for line in plan.splitlines() if "Join" in line]
    assert [j.split(",")[0] for j in joins] == ["Join Inner", "Join LeftOuter", "Join LeftOuter"], joins
    assert "order_id" in joins[0]


def test_marts_keep_the_fact_totals(source):
    fact = facts.fact_sales(facts.sales_lines_from_source(source))
    total = fact.agg(F.sum("SalesRevenue")).collect()[0][0]
    categories = source["production.product"].filter("productid = 500").select(
        F.col("productid").alias("ProductKey"), F.lit("c").alias("ProductCategoryKey"))
    places = source["sales.customer"].filter("customerid = 1001").select(
        F.col("customerid").alias("CustomerKey"), F.lit("s").alias("SegmentKey"), F.lit(1).alias("RegionKey"), F.lit(2).alias("SalesTerritoryKey"))
    for mart, column in ((marts.daily_sales(fact, categories), "TotalRevenue"), (marts.weekly_sales(fact, places, categories), "SumRevenue"),
                         (marts.monthly_sales(fact, places), "TotalRevenue"), (marts.regional_sales(fact, places), "TotalRevenue")):
        assert mart.agg(F.sum(column)).collect()[0][0] == total


def test_regional_refresh_equals_a_full_refresh(frame, rows):
    """A month that appears between others changes its own growth and that of the next one."""
    schema = "SalesDateKey date, CustomerKey int, SalesRevenue decimal(18,2)"
    old = frame([(D(2012, 1, 5), 1, m(100)), (D(2012, 3, 5), 1, m(50)), (D(2012, 4, 5), 1, m(60)), (D(2012, 9, 5), 1, m(60))], schema)
    late = frame([(D(2012, 2, 5), 1, m(200))], schema)
    places = frame([(1, 1, 1)], "CustomerKey int, RegionKey int, SalesTerritoryKey int")
    mart = marts.regional_sales(old, places)
    got = marts.regional_refresh(mart, late, places, ["2012-02"])
    assert rows(got) == rows(marts.regional_sales(old.unionByName(late), places))
    assert rows(got, "MonthStartDateKey", "GrowthRate") == [
        (D(2012, 1, 1), None), (D(2012, 2, 1), 100.0), (D(2012, 3, 1), -75.0), (D(2012, 4, 1), 20.0),
        (D(2012, 9, 1), None)]  # nothing was sold in the month before


def test_returns_of_a_month_without_a_sale_stay(frame):
    sales = frame([(D(2012, 1, 5), 1, None, m(100), 4)],
                  "SalesDateKey date, ProductKey int, StoreKey int, SalesRevenue decimal(18,2), QuantitySold int")
    returns = frame([(D(2012, 1, 9), 1, None, 1), (D(2012, 2, 9), 1, None, 2), (D(2012, 2, 9), 2, 7, 3)],
                    "ReturnDateKey date, ProductKey int, StoreKey int, ReturnedQuantity int")
    ratings = frame([(1, 5)], "ProductKey int, FeedbackScore int")
    got = {(r.MonthStartDateKey.month, r.ProductKey): r for r in
           marts.monthly_product_performance(sales, returns, ratings).collect()}
    assert {k: (r.UnitsSold, r.UnitsReturned, r.ReturnRate, r.TotalRevenue) for k, r in got.items()} == {
        (1, 1): (4, 1, 25.0, m("100.00")), (2, 1): (0, 2, None, m("0.00")), (2, 2): (0, 3, None, m("0.00"))}


def test_due_marts():
    assert daily.due_marts(D(2024, 9, 1)) == list(daily.CADENCE)  # a Sunday and a first
    assert daily.due_marts(D(2024, 9, 3)) == ["agg_daily_sales", "agg_daily_inventory"]


def test_daily_run_is_repeatable(spark, source, rows, tmp_path):
    keys = {"person.person": ("businessentityid",), "sales.customer": ("customerid",), "sales.salesorderheader": ("salesorderid",)}
    specs = describe(source, keys)

    returned = spark.createDataFrame(
        [(1, D(2012, 7, 9), 500, 1001, 20, "Defective", 1, m(25))],
        "return_id bigint, return_date date, product_id int, customer_id int, store_id int, reason string, quantity int, refund decimal(18,2)")

    def run(day):
        return daily.DailyRun(spark, specs, source.__getitem__, str(tmp_path), day, batch=f"b-{day}",
                              returns=returned).run(list(daily.CADENCE))

    def state():
        out = {}
        for name in ("FactSales", "FactFinance", "FactInventory", "FactEmployeeSales", "agg_daily_sales", "agg_weekly_sales",
                     "agg_monthly_sales", "agg_regional_sales", "agg_daily_inventory", "agg_monthly_product_performance",
                     "FactReturns", "error_records", "CustomerChanges"):
            out[name] = rows(spark.read.parquet(str(tmp_path / name)))
        for name in ("DimCustomer", "DimProduct", "DimStore", "DimEmployee", "DimVendor", "DimRegion"):
            out[name] = rows(daily.DailyRun(spark, specs, source.__getitem__, str(tmp_path), AS_OF, batch="r").table(name).read())
        return out

    report = run(AS_OF)
    assert not report.skipped
    first = state()
    assert len(first["FactSales"]) == 5 and len(first["agg_daily_sales"]) == 5
    assert {r[-1] for r in first["CustomerChanges"]} == {"new"}
    assert len(first["error_records"]) > 0  # the phone type 3 has no parent
    probe = daily.DailyRun(spark, specs, source.__getitem__, str(tmp_path), AS_OF, batch="r")
    staff = {r.EmployeeID: r for r in probe.table("DimEmployee").read_open().collect()}
    assert staff[11].ReportingManagerKey == staff[10].EmployeeKey and staff[10].ReportingManagerKey is None
    # keys of reference members are the members' keys, so a mart joins its dimensions
    for table, column in (("FactFinance", "FinanceCategoryKey"), ("FactReturns", "ReturnReasonKey"),
                          ("agg_daily_sales", "ProductCategoryKey"), ("agg_weekly_sales", "RegionKey"),
                          ("agg_monthly_sales", "CustomerSegmentKey"), ("agg_regional_sales", "RegionKey")):
        assert dict(spark.read.parquet(str(tmp_path / table)).dtypes)[column] == "bigint", table
    assert {r.FinanceCategoryKey for r in spark.read.parquet(str(tmp_path / "FactFinance")).collect()} == {1}
    assert {r.ReturnReasonKey for r in spark.read.parquet(str(tmp_path / "FactReturns")).collect()} == {1}
    run(AS_OF)
    second = state()
    assert {r[-1] for r in second.pop("CustomerChanges")} == {"unchanged"}
    first.pop("CustomerChanges")
    assert second == first

    # values that do not fit are NULL in the mart and on record
    lost = spark.read.parquet(str(tmp_path / "error_records")).filter("ErrorType = 'overflow'")
    assert lost.count() == 0
    probe = daily.DailyRun(spark, specs, source.__getitem__, str(tmp_path), AS_OF, batch="probe")
    growing = spark.createDataFrame([(D(2014, 1, 1), 1, 5.0), (D(2014, 2, 1), 1, 1e33)],
                                    "MonthStartDateKey date, RegionKey int, GrowthRate double")
    probe.store("probe", growing, "MonthStartDateKey", ["MonthStartDateKey"])
    assert rows(spark.read.parquet(str(tmp_path / "probe")), "GrowthRate") == [(m("5.000000"),), (None,)]
    assert rows(spark.read.parquet(str(tmp_path / "error_records")).filter("ErrorType = 'overflow'"),
                "SourceTable", "RecordNaturalKey", "ErrorSeverity") == [("probe", "2014-02-01", "WARNING")]

    # the next day's snapshot joins the month, it does not replace it
    later = daily.DailyRun(spark, specs, source.__getitem__, str(tmp_path), D(2014, 6, 2), batch="next")
    later.load_facts({n: source[n] for n in ("production.productinventory", "production.product", "purchasing.productvendor")})
    assert "FactInventory" in later.report.done and "FactSales" in later.report.skipped
    days = spark.read.parquet(str(tmp_path / "FactInventory"))
    assert {r[0] for r in days.select("InventoryDateKey").collect()} == {AS_OF, D(2014, 6, 2)}

    # refreshing one month over stored facts gives the marts the full refresh gave
    again = daily.DailyRun(spark, specs, source.__getitem__, str(tmp_path), AS_OF, batch="m", months=["2012-07"])
    again.report.done += ["FactSales", "FactReturns"]
    names = ["agg_daily_sales", "agg_weekly_sales", "agg_monthly_sales", "agg_regional_sales", "agg_monthly_product_performance"]
    again.load_marts(source, names)
    assert not again.report.skipped
    for name in names:
        assert rows(spark.read.parquet(str(tmp_path / name))) == first[name], name


def test_a_day_lands_changes_and_rebuilds_what_they_touch(spark, source, rows, tmp_path):
    tables = {n: source[n] for n in ("production.product", "production.productmodel", "production.productsubcategory", "production.productcategory",
                                     *daily.PRICES, "sales.salesorderheader", "sales.salesorderdetail", "sales.customer", "sales.specialoffer")}
    keys = {"sales.customer": ("customerid",), "sales.salesorderheader": ("salesorderid",), "production.product": ("productid",)}
    reads = []

    def run(batch):
        reads.clear()
        out = daily.DailyRun(spark, describe(tables, keys), lambda n: reads.append(n) or tables[n], str(tmp_path), AS_OF, batch=batch)
        out.run(["agg_daily_sales"], targets=("DimProduct", "DimProductCategory", "FactSales"))
        return out

    def files():
        return {str(p.relative_to(tmp_path / "FactSales")) for p in (tmp_path / "FactSales").rglob("*.parquet")}

    def priced(r):
        sales, versions = spark.read.parquet(str(tmp_path / "FactSales")), r.table("DimProduct").read()
        return rows(sales.join(versions, "ProductKey", "left").select("SalesDateKey", "ProductID", "ListPrice", "Cost"))

    first = run("b1")
    assert sorted(reads) == sorted(tables)
    want = [(D(2012, 6, 30), 500, m("20.00"), m("10.00")), (D(2012, 6, 30), 501, m("100.00"), m("60.00")), (D(2012, 7, 1), 500, m("25.00"), m("10.00")),
            (D(2013, 8, 1), 501, m("100.00"), m("60.00")), (D(2014, 1, 1), 500, m("25.00"), m("11.00"))]
    assert priced(first) == want
    before = files()
    run("b1")
    assert reads == [] and files() == before  # the batch is done

    # a price that began in the past: the version of that day is cut, sales since then are keyed anew
    old = tables[daily.PRICES[0]]
    tables[daily.PRICES[0]] = old.unionByName(spark.createDataFrame([(500, dt.datetime(2013, 12, 1), None, m(30), STAMP)], old.schema))
    third = run("b2")
    assert priced(third) == [*want[:-1], (D(2014, 1, 1), 500, m("30.00"), m("11.00"))]
    assert {f for f in before - files()} == {f for f in before if "2014-01" in f or "2013-12" in f}
    versions = third.table("DimProduct").read().filter("ProductID = 500")
    assert rows(versions, "ValidFromDate", "ListPrice")[-2:] == [(D(2012, 9, 1), m("25.00")), (D(2013, 12, 1), m("30.00"))]
    assert versions.select("ProductKey").distinct().count() == versions.count()


def test_duplicate_keys_block_what_depends_on_them(spark, source, tmp_path):
    wanted = ("person.person", "sales.salesorderheader", "sales.salesorderdetail", "production.product", "production.productmodel",
              "production.productsubcategory", "production.productcategory")
    broken = {n: source[n] for n in wanted}
    broken["sales.customer"] = source["sales.customer"].unionByName(source["sales.customer"])
    specs = describe(broken, {"sales.customer": ("customerid",)})
    report = daily.DailyRun(spark, specs, broken.__getitem__, str(tmp_path), AS_OF, batch="b").run([])
    assert "duplicate" in report.skipped["sales.customer"]
    assert "FactSales" in report.skipped and "DimProduct" in report.done


def test_documents_of_one_file_are_parsed_by_many_tasks(spark, tmp_path):
    from treadle.retail.source import SourceTables
    spark.range(200).selectExpr("id p_partkey", "concat('part ', id) p_name", "'B' p_brand", "'T' p_type", "cast(id % 50 as int) p_size",
                                "1.0D p_retailprice").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = xml_views.v_product_model_catalog_description(SourceTables(spark, str(tmp_path)))
    assert got.select(F.spark_partition_id()).distinct().count() > 1 and got.count() == 200
