"""Source-shaped tables derived from the benchmark tables.

The texts below run on Spark and on any other SQL engine that knows the benchmark tables,
so a check can start from the same input.  Customers and suppliers become people, suppliers
are also employees, sellers, stores and vendors, nations are states and territories, regions
are countries and code lists, parts are products with one model each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from treadle.retail.tables import TABLES, load

#: Ids of supplier-side entities start here.
BASE = "1000000000000"

NS = "urn:retail"

_CUSTOMER_SURVEY = (
    f"'<IndividualSurvey xmlns=\"{NS}:survey\"><TotalPurchaseYTD>' || cast(cast(c_acctbal as decimal(12,2)) as string)"
    " || '</TotalPurchaseYTD><DateFirstPurchase>1998-0' || cast(1 + c_nationkey % 9 as string) ||"
    " '-15Z</DateFirstPurchase><BirthDate>19' || cast(50 + c_nationkey as string) || '-03-02Z</BirthDate>"
    "<MaritalStatus>M</MaritalStatus><Gender>' || case when c_nationkey % 2 = 0 then 'F' else 'M' end ||"
    " '</Gender><Education>Bachelors &lt;' || cast(c_nationkey as string) || '&gt;</Education><Occupation>' ||"
    " '<![CDATA[R&D <' || lower(c_mktsegment) || '>]]></Occupation><NumberChildrenAtHome>' ||"
    " cast(c_nationkey % 3 as string) || '</NumberChildrenAtHome><YearlyIncome>' || c_mktsegment ||"
    " '</YearlyIncome><TotalChildren>' || cast(c_nationkey % 5 as string) ||"
    " '</TotalChildren><HomeOwnerFlag>' || case when c_acctbal > 0 then '1' else '0' end ||"
    " '</HomeOwnerFlag>' || case when c_mktsegment = 'MACHINERY' then '' else '<NumberCarsOwned>' ||"
    " cast(c_nationkey % 4 as string) || '</NumberCarsOwned>' end || '</IndividualSurvey>'"
)

_CONTACT = (
    f"'<ci:AdditionalContactInfo xmlns:ci=\"{NS}:info\" xmlns:act=\"{NS}:types\">"
    "Notes <act:telephoneNumber><act:number>555-' || cast(c_custkey as string) || '</act:number>"
    "<act:SpecialInstructions> call ' || lower(c_mktsegment) || ' </act:SpecialInstructions></act:telephoneNumber>"
    "<act:homePostalAddress><act:Street>Street ' || cast(c_nationkey as string) || '</act:Street>"
    "<act:City>City ' || cast(c_nationkey as string) || '</act:City><act:StateProvince>S' || cast(c_nationkey as string) ||"
    " '</act:StateProvince><act:PostalCode>' || cast(c_custkey as string) || '</act:PostalCode><act:CountryRegion>C' ||"
    " cast(c_nationkey % 5 as string) || '</act:CountryRegion><act:SpecialInstructions>ring &lt;b&gt;twice&lt;/b&gt;<!-- not' ||"
    " ' thrice --> at ' || lower(c_mktsegment) || '</act:SpecialInstructions></act:homePostalAddress>' ||"
    " case when c_acctbal > 5000 then '<act:eMail><act:eMailAddress>m' || cast(c_custkey as string) ||"
    " '@example.org</act:eMailAddress><act:SpecialInstructions> urgent only <act:telephoneNumber><act:number>999-' ||"
    " cast(c_custkey as string) || '</act:number></act:telephoneNumber></act:SpecialInstructions></act:eMail>'"
    " else '' end || '</ci:AdditionalContactInfo>'"
)

_JOB = (
    "'<ns:Employment><ns:Emp.StartDate>199' || cast({n} as string) || '-06-01Z</ns:Emp.StartDate>' || {end} ||"
    " '<ns:Emp.OrgName>' || c_name || '</ns:Emp.OrgName><ns:Emp.JobTitle>' || c_mktsegment ||"
    " '</ns:Emp.JobTitle><ns:Emp.Responsibility>kept &lt;ledgers&gt; of ' || c_name ||"
    " '<ns:note>and more</ns:note> later</ns:Emp.Responsibility><ns:Emp.FunctionCategory>F' || cast(c_nationkey % 4 as string) ||"
    " '</ns:Emp.FunctionCategory><ns:Emp.IndustryCategory><![CDATA[I&T]]></ns:Emp.IndustryCategory>' ||"
    " '<ns:Emp.Location><ns:Location><ns:Loc.CountryRegion>C' || cast(c_nationkey as string) ||"
    " '</ns:Loc.CountryRegion><ns:Loc.State>S' || cast(c_nationkey as string) || '</ns:Loc.State><ns:Loc.City>City ' ||"
    " cast(c_nationkey as string) || '</ns:Loc.City></ns:Location></ns:Emp.Location></ns:Employment>'"
)
_RESUME = (
    f"'<ns:Resume xmlns:ns=\"{NS}:resume\"><ns:Name><ns:Name.Prefix>Mx.</ns:Name.Prefix><ns:Name.First>' || substr(c_name, 1, 8) ||"
    " '</ns:Name.First><ns:Name.Middle>' || substr(c_mktsegment, 1, 1) || '</ns:Name.Middle><ns:Name.Last>' ||"
    " substr(c_name, 10, 9) || '</ns:Name.Last><ns:Name.Suffix>Jr. &#8211; ' || cast(c_nationkey as string) ||"
    " '</ns:Name.Suffix></ns:Name><ns:Skills>' ||"
    " lower(c_mktsegment) || ' &amp; sales</ns:Skills>' ||"
    f" case when c_acctbal > 0 then {_JOB.format(n=1, end="'<ns:Emp.EndDate>1992-07-31Z</ns:Emp.EndDate>'")} else '' end ||"
    f" case when c_acctbal > 5000 then {_JOB.format(n=3, end="''")} else '' end ||"
    " '<ns:Education><ns:Edu.Level>Bachelor</ns:Edu.Level><ns:Edu.StartDate>1986-09-15Z</ns:Edu.StartDate>"
    "<ns:Edu.EndDate>1990-05-2' || cast(c_nationkey % 10 as string) || 'Z</ns:Edu.EndDate><ns:Edu.Degree>' || c_mktsegment ||"
    " '</ns:Edu.Degree><ns:Edu.Major>Trade &amp; ' || lower(c_mktsegment) || '</ns:Edu.Major>' || case when c_acctbal > 2500 then '<ns:Edu.Minor>M' || cast(c_nationkey as string) ||"
    " '</ns:Edu.Minor>' else '' end || '<ns:Edu.GPA>3.5</ns:Edu.GPA><ns:Edu.GPAScale>4</ns:Edu.GPAScale>"
    "<ns:Edu.School>School ' || cast(c_nationkey as string) || '</ns:Edu.School><ns:Edu.Location><ns:Location>"
    "<ns:Loc.CountryRegion>C' || cast(c_nationkey % 5 as string) || '</ns:Loc.CountryRegion><ns:Loc.State>S' ||"
    " cast(c_nationkey as string) || '</ns:Loc.State><ns:Loc.City>Town ' || cast(c_nationkey as string) ||"
    " '</ns:Loc.City></ns:Location></ns:Edu.Location></ns:Education><ns:Address><ns:Addr.Type>Home</ns:Addr.Type>"
    "<ns:Addr.Location><ns:Location><ns:Loc.CountryRegion>C' || cast(c_nationkey % 5 as string) ||"
    " '</ns:Loc.CountryRegion><ns:Loc.State>S' || cast(c_nationkey as string) || '</ns:Loc.State>"
    "<ns:Loc.City>City ' || cast(c_nationkey as string) ||"
    " '</ns:Loc.City></ns:Location></ns:Addr.Location><ns:Addr.PostalCode>P' || cast(c_custkey as string) ||"
    " '</ns:Addr.PostalCode></ns:Address><ns:EMail>c' || cast(c_custkey as string) ||"
    " '@example.com</ns:EMail><ns:WebSite>https://example.com/?a=1&amp;c=' || cast(c_custkey as string) ||"
    " '</ns:WebSite></ns:Resume>'"
)

_STORE = (
    f"'<StoreSurvey xmlns=\"{NS}:store\"><AnnualSales>' || cast(cast(s_acctbal as decimal(12,2)) as string) ||"
    " '</AnnualSales><AnnualRevenue>' || cast(cast(s_acctbal as decimal(12,2)) as string) ||"
    " '</AnnualRevenue><BankName>Bank ' || cast(s_nationkey as string) || '</BankName><BusinessType>BM</BusinessType>"
    "<YearOpened>' || cast(1970 + s_nationkey as string) || '</YearOpened><Specialty>&lt;Road&gt; ' ||"
    " cast(s_nationkey % 3 as string) || '</Specialty><SquareFeet>' || cast(1000 + s_nationkey as string) || '</SquareFeet><Brands>' ||"
    " case when s_nationkey > 12 then '4+' else 'One' end || '</Brands><Internet>T' || cast(s_nationkey % 4 as string) ||"
    " '</Internet><NumberEmployees>' || cast(s_nationkey + 2 as string) || '</NumberEmployees></StoreSurvey>'"
)

_CATALOG = (
    f"'<p1:ProductDescription xmlns:p1=\"{NS}:model\" xmlns:wm=\"{NS}:warranty\" xmlns:wf=\"{NS}:features\""
    f" xmlns:html=\"{NS}:html\"><p1:Summary><html:p>' || p_name || ' of <html:b>note</html:b> quality</html:p></p1:Summary>"
    "<p1:Manufacturer><p1:Name>' || p_brand || '</p1:Name><p1:Copyright>&#169; ' || p_brand || '</p1:Copyright>"
    "<p1:ProductURL>https://example.com/?p=' || cast(p_partkey as string) || '&amp;l=en</p1:ProductURL></p1:Manufacturer>"
    "<p1:Features>Made of <wm:Warranty><wm:WarrantyPeriod>' || cast(p_size as string) || ' months</wm:WarrantyPeriod>"
    "<wm:Description>parts &lt;and&gt; labour</wm:Description></wm:Warranty><wm:Maintenance><wm:NoOfYears>' ||"
    " cast(p_size % 10 as string) || ' years</wm:NoOfYears><wm:Description>by <html:b>any</html:b> dealer</wm:Description>"
    "</wm:Maintenance><wf:wheel>Strong <html:i>' || p_type || '</html:i></wf:wheel><wf:saddle><html:i>Soft</html:i> seat of ' ||"
    " p_type || '</wf:saddle><wf:pedal><![CDATA[<Top> ]]>grip ' || p_brand || '</wf:pedal><wf:BikeFrame>frame<!-- welded' ||"
    " ' --> of steel</wf:BikeFrame><wf:crankset>' || p_brand || ' &quot;crank&quot;</wf:crankset></p1:Features>"
    "<p1:Picture><p1:Angle>front</p1:Angle><p1:Size>' || case when p_size > 20 then 'large' else 'small' end ||"
    " '</p1:Size><p1:ProductPhotoID>' || cast(p_partkey as string) ||"
    " '</p1:ProductPhotoID></p1:Picture><p1:Picture><p1:Angle>side</p1:Angle></p1:Picture>"
    "<p1:Specifications>' || case when p_size > 25 then '<Material>steel</Material>' else '' end ||"
    " '<Color>' || substr(p_name, 1, 3) || '</Color><ProductLine>' || p_type || '</ProductLine><Style>S' ||"
    " cast(p_size % 4 as string) || '</Style><RiderExperience>novice to ' || p_brand || '</RiderExperience>"
    "</p1:Specifications></p1:ProductDescription>'"
)

_MANUAL = (
    f"'<root xmlns=\"{NS}:manual\">Manual ' || cast(p_partkey as string) ||"
    " '<Location LaborHours=\"2.5\" LotSize=\"' || cast(p_size as string) ||"
    " '\" MachineHours=\"1.75\" LocationID=\"10\"><step>Take <tool>' || p_brand || '</tool> first</step><step>' || p_name ||"
    " '</step></Location><Location SetupHours=\"0.25\" LocationID=\"20\"><step>Pack ' || p_type ||"
    " '</step></Location></root>'"
)

DERIVED = {
    "person.person": f"""
        select c_custkey as businessentityid, 'IN' as persontype,
               case when c_acctbal < 0 then null else 'Mx.' end as title,
               substr(c_name, 1, 8) as firstname,
               case when c_mktsegment = 'MACHINERY' then null else substr(c_mktsegment, 1, 1) end as middlename,
               substr(c_name, 10, 9) as lastname,
               case when c_mktsegment = 'FURNITURE' then 'Jr.' else null end as suffix,
               c_nationkey % 3 as emailpromotion,
               case when c_mktsegment = 'BUILDING' then null else {_CONTACT} end as additionalcontactinfo,
               case when c_mktsegment = 'FURNITURE' then null else {_CUSTOMER_SURVEY} end as demographics,
               'g' || cast(c_custkey as string) as rowguid, timestamp '2001-01-01 00:00:00' as modifieddate
        from {{customer}}
        union all
        select {BASE} + s_suppkey, 'SP', 'Dr.', substr(s_name, 1, 8), null, substr(s_name, 10, 9), null,
               s_nationkey % 3, null, null, 'h' || cast(s_suppkey as string), timestamp '2001-01-01 00:00:00'
        from {{supplier}}""",
    "person.emailaddress": f"""
        select c_custkey as businessentityid, c_custkey * 2 as emailaddressid,
               lower(c_mktsegment) || cast(c_custkey as string) || '@example.com' as emailaddress
        from {{customer}}
        union all
        select c_custkey, c_custkey * 2 + 1, 'second' || cast(c_custkey as string) || '@example.com'
        from {{customer}} where c_acctbal > 8000
        union all
        select {BASE} + s_suppkey, {BASE} + s_suppkey, 's' || cast(s_suppkey as string) || '@example.com'
        from {{supplier}}""",
    "person.personphone": f"""
        select c_custkey as businessentityid, '1-' || cast(c_custkey as string) as phonenumber,
               c_nationkey % 5 as phonenumbertypeid
        from {{customer}} where c_acctbal >= 0
        union all
        select {BASE} + s_suppkey, '2-' || cast(s_suppkey as string), 1 from {{supplier}}""",
    "person.phonenumbertype": "select r_regionkey as phonenumbertypeid, 'Phone ' || r_name as name from {region}",
    "person.addresstype": "select r_regionkey as addresstypeid, 'Address ' || r_name as name from {region}",
    "person.contacttype": "select r_regionkey as contacttypeid, 'Contact ' || r_name as name from {region}",
    "person.countryregion": "select 'C' || cast(r_regionkey as string) as countryregioncode, r_name as name from {region}",
    "person.stateprovince": """
        select n_nationkey as stateprovinceid, 'S' || cast(n_nationkey as string) as stateprovincecode,
               'C' || cast(n_regionkey as string) as countryregioncode, n_nationkey = n_regionkey as isonlystateprovinceflag,
               n_name as name, n_nationkey as territoryid
        from {nation}""",
    "person.address": f"""
        select c_custkey as addressid, 'No. ' || cast(c_custkey as string) as addressline1,
               case when c_acctbal > 9000 then 'Rear' else null end as addressline2,
               'City ' || cast(c_nationkey as string) as city, c_nationkey as stateprovinceid,
               'P' || cast(c_custkey as string) as postalcode
        from {{customer}}
        union all
        select {BASE} + s_suppkey, 'Dock ' || cast(s_suppkey as string), null,
               'Port ' || cast(s_nationkey as string), s_nationkey, 'Q' || cast(s_suppkey as string)
        from {{supplier}}""",
    "person.businessentityaddress": f"""
        select c_custkey as businessentityid, c_custkey as addressid, 1 as addresstypeid from {{customer}}
        union all
        select c_custkey, c_custkey, 3 from {{customer}} where c_acctbal > 8000
        union all
        select {BASE} + s_suppkey, {BASE} + s_suppkey, s_nationkey % 5 from {{supplier}}""",
    "person.businessentitycontact": f"""
        select {BASE} + s_suppkey as businessentityid, s_suppkey as personid, s_nationkey % 5 as contacttypeid
        from {{supplier}}""",
    "sales.customer": f"""
        select c_custkey as customerid, c_custkey as personid,
               case when c_mktsegment = 'MACHINERY' then {BASE} + c_nationkey else null end as storeid,
               c_nationkey as territoryid
        from {{customer}}""",
    "sales.store": f"""
        select {BASE} + s_suppkey as businessentityid, s_name as name, {BASE} + s_suppkey as salespersonid,
               case when s_acctbal < 0 then null else {_STORE} end as demographics
        from {{supplier}}""",
    "sales.salesperson": f"""
        select {BASE} + s_suppkey as businessentityid,
               case when s_acctbal < 0 then null else s_nationkey end as territoryid,
               cast(s_acctbal as decimal(19,4)) as salesquota, cast(s_acctbal as decimal(19,4)) as salesytd,
               cast(0 as decimal(19,4)) as saleslastyear
        from {{supplier}}""",
    "sales.salesterritory": """
        select n_nationkey as territoryid, n_name as name, 'G' || cast(n_regionkey as string) as "group",
               'C' || cast(n_regionkey as string) as countryregioncode
        from {nation}""",
    "sales.salesorderheader": f"""
        select o_orderkey as salesorderid, o_orderdate as orderdate, o_custkey as customerid,
               case when o_orderpriority = '1-URGENT' then null else {BASE} + o_custkey % 10 end as salespersonid,
               cast(o_totalprice as decimal(19,4)) as subtotal
        from {{orders}}""",
    "humanresources.employee": f"""
        select {BASE} + s_suppkey as businessentityid, 'Rep ' || cast(s_nationkey as string) as jobtitle,
               case when s_suppkey < 10 then '/' else '/' || cast(s_suppkey % 10 as string) || '/' end
                 || cast(s_suppkey as string) || '/' as organizationnode,
               date '1990-01-01' as hiredate, s_acctbal >= 0 as currentflag
        from {{supplier}}""",
    "humanresources.department": """
        select r_regionkey as departmentid, 'Dept ' || r_name as name, 'Group ' || r_name as groupname from {region}""",
    "humanresources.shift": "select r_regionkey as shiftid, 'Shift ' || r_name as name from {region}",
    "humanresources.employeedepartmenthistory": f"""
        select {BASE} + s_suppkey as businessentityid, s_nationkey % 5 as departmentid, s_nationkey % 3 as shiftid,
               date '1999-01-01' as startdate, cast(null as date) as enddate
        from {{supplier}}
        union all
        select {BASE} + s_suppkey, (s_nationkey + 1) % 5, 0, date '1997-01-01', date '1998-12-31'
        from {{supplier}} where s_acctbal > 5000""",
    "humanresources.jobcandidate": f"""
        select c_custkey as jobcandidateid, case when c_acctbal < 0 then null else c_custkey end as businessentityid,
               case when c_mktsegment = 'BUILDING' then null else {_RESUME} end as resume,
               timestamp '2001-01-01 00:00:00' as modifieddate
        from {{customer}}""",
    "production.product": """
        select p_partkey as productid, p_name as name, p_brand || '-' || cast(p_partkey as string) as productnumber,
               substr(p_name, 1, 3) as color, cast(p_size as string) as size, cast(p_size as decimal(8,2)) as weight,
               cast(p_size as decimal(19,4)) as standardcost, cast(p_retailprice as decimal(19,4)) as listprice,
               p_size as productsubcategoryid, p_partkey as productmodelid,
               timestamp '1996-01-01 00:00:00' as sellstartdate,
               case when p_size > 40 then timestamp '1999-01-01 00:00:00' else null end as sellenddate,
               cast(null as timestamp) as discontinueddate
        from {part}""",
    "production.productsubcategory": """
        select distinct p_size as productsubcategoryid, p_size % 5 as productcategoryid,
               'Sub ' || cast(p_size as string) as name
        from {part}""",
    "production.productcategory": """
        select distinct p_size % 5 as productcategoryid, 'Category ' || cast(p_size % 5 as string) as name from {part}""",
    "production.location": """
        select n_nationkey as locationid, 'Hall ' || n_name as name, cast(n_regionkey as decimal(8,2)) as availability
        from {nation}""",
    "sales.specialoffer": """
        select distinct cast(cast(l_discount as decimal(3,2)) * 100 as int) as specialofferid,
               'Offer ' || cast(cast(cast(l_discount as decimal(3,2)) * 100 as int) as string) as description,
               cast(cast(l_discount as decimal(3,2)) as decimal(19,4)) as discountpct, 'Discount' as type,
               'Reseller' as category, timestamp '1995-01-01 00:00:00' as startdate,
               case when l_discount < 0.05 then timestamp '1999-12-31 00:00:00' else timestamp '2005-12-31 00:00:00' end as enddate
        from {lineitem}""",
    "purchasing.purchaseorderheader": f"""
        select o_orderkey as purchaseorderid, {BASE} + o_custkey % 10 as vendorid, o_orderdate as orderdate,
               o_orderdate + interval 30 day as shipdate
        from {{orders}}""",
    "purchasing.purchaseorderdetail": """
        select l_orderkey as purchaseorderid, l_shipdate as duedate, l_partkey as productid,
               cast(l_quantity as int) as orderqty, cast(l_extendedprice as decimal(19,4)) as unitprice,
               cast(l_quantity as decimal(8,2)) as receivedqty,
               cast(case when l_returnflag = 'R' then 1 else 0 end as decimal(8,2)) as rejectedqty
        from {lineitem}""",
    "production.productmodel": f"""
        select p_partkey as productmodelid, 'Model ' || p_brand as name,
               case when p_type = 'ECONOMY' then null else {_CATALOG} end as catalogdescription,
               case when p_type = 'SMALL' then null else {_MANUAL} end as instructions,
               'm' || cast(p_partkey as string) as rowguid, timestamp '2001-01-01 00:00:00' as modifieddate
        from {{part}}""",
    "production.productdescription": """
        select p_partkey as productdescriptionid, p_name || ' by ' || p_brand as description from {part}""",
    "production.productmodelproductdescriptionculture": """
        select p_partkey as productmodelid, p_partkey as productdescriptionid, 'en' as cultureid from {part}
        union all
        select p_partkey, p_partkey, 'fr' from {part} where p_size > 25""",
    "purchasing.vendor": f"""
        select {BASE} + s_suppkey as businessentityid, s_name as name, s_nationkey % 5 + 1 as creditrating,
               s_acctbal > 5000 as preferredvendorstatus, s_acctbal > 0 as activeflag
        from {{supplier}}""",
}


def base_tables(name: str) -> list[str]:
    """The benchmark tables a derived table reads."""
    return [b for b in TABLES if "{" + b + "}" in DERIVED[name]]


def portable(name: str) -> str:
    """The derivation as plain SQL over the benchmark tables."""
    return DERIVED[name].format(**{b: b for b in base_tables(name)})


#: Tables whose documents cost far more to build and parse than their rows to read: a file of one row
#: group would have all of them in one task.
DEALT = ("production.productmodel",)


class SourceTables(dict):
    """Derived tables by ``schema.table``, built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        text = DERIVED[name].replace('"group"', "`group`")
        used = {b: load(self.spark, self.folder, b) for b in base_tables(name)}
        if name in DEALT:  # before the documents are built, while the rows are small
            tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            used = {b: df.repartition(tasks, *df.columns[:2]) for b, df in used.items()}
        self[name] = self.spark.sql(text, **used)
        return self[name]

    def __contains__(self, name) -> bool:
        return name in DERIVED

    def get(self, name, default=None):
        return self[name] if name in DERIVED else default
