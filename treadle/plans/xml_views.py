"""Views that shred XML columns.  Each document is parsed once per view into strings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from treadle.functions.scalars import money
from treadle.functions.xml import day, limited, shred, truth, whole

Tables = Mapping[str, DataFrame]

# Fixed values in all schemas of this module: element and attribute names of the documents.
CONTACT = (
    "telephoneNumber array<struct<number:string, SpecialInstructions:string>>, "
    "homePostalAddress array<struct<Street:string, City:string, StateProvince:string, "
    "PostalCode:string, CountryRegion:string, SpecialInstructions:string>>, "
    "eMail array<struct<eMailAddress:string, SpecialInstructions:string>>"
)
EMAIL_PHONE = "eMail array<struct<SpecialInstructions:struct<telephoneNumber:array<struct<number:string>>>>>"


def v_additional_contact_info(t: Tables) -> DataFrame:
    """People without a document keep their row."""
    doc = F.col("additionalcontactinfo")
    parsed = t["person.person"].select(
        "businessentityid", "firstname", "middlename", "lastname", "rowguid", "modifieddate",
        shred(doc, CONTACT).alias("c"), shred(doc, EMAIL_PHONE).alias("e"))
    flat = parsed.select(
        "*", F.get("c.telephoneNumber", F.lit(0)).alias("tel"),
        F.get("c.homePostalAddress", F.lit(0)).alias("home"),
        F.get("c.eMail", F.lit(0)).alias("mail"),
        F.get(F.get("e.eMail", F.lit(0))["SpecialInstructions"]["telephoneNumber"], F.lit(0)).alias("mtel"))
    return flat.select(
        "businessentityid", "firstname", "middlename", "lastname",
        F.col("tel.number").alias("telephonenumber"),
        F.trim(F.col("tel.SpecialInstructions")).alias("telephonespecialinstructions"),
        F.col("home.Street").alias("street"), F.col("home.City").alias("city"),
        F.col("home.StateProvince").alias("stateprovince"), F.col("home.PostalCode").alias("postalcode"),
        F.col("home.CountryRegion").alias("countryregion"),
        F.col("home.SpecialInstructions").alias("homeaddressspecialinstructions"),
        F.col("mail.eMailAddress").alias("emailaddress"),
        F.trim(F.col("mail.SpecialInstructions")).alias("emailspecialinstructions"),
        F.col("mtel.number").alias("emailtelephonenumber"),
        "rowguid", "modifieddate")


SURVEY = ("TotalPurchaseYTD string, DateFirstPurchase string, BirthDate string, MaritalStatus string, "
          "YearlyIncome string, Gender string, TotalChildren string, NumberChildrenAtHome string, "
          "Education string, Occupation string, HomeOwnerFlag string, NumberCarsOwned string")


def v_person_demographics(t: Tables) -> DataFrame:
    d = (
        t["person.person"].filter("demographics IS NOT NULL")
        .select("businessentityid", shred(F.col("demographics"), SURVEY).alias("d"))
    )

    def at(name):
        return F.col(f"d.{name}")

    return d.select(
        "businessentityid",
        money(at("TotalPurchaseYTD")).alias("totalpurchaseytd"),
        day(at("DateFirstPurchase")).alias("datefirstpurchase"),
        day(at("BirthDate")).alias("birthdate"),
        limited(at("MaritalStatus"), 1).alias("maritalstatus"),
        limited(at("YearlyIncome"), 30).alias("yearlyincome"),
        limited(at("Gender"), 1).alias("gender"),
        whole(at("TotalChildren")).alias("totalchildren"),
        whole(at("NumberChildrenAtHome")).alias("numberchildrenathome"),
        limited(at("Education"), 30).alias("education"),
        limited(at("Occupation"), 30).alias("occupation"),
        truth(at("HomeOwnerFlag")).alias("homeownerflag"),
        whole(at("NumberCarsOwned")).alias("numbercarsowned"))


LOCATION = "Location:struct<`Loc.CountryRegion`:string, `Loc.State`:string, `Loc.City`:string>"
RESUME = (
    "Name struct<`Name.Prefix`:string, `Name.First`:string, `Name.Middle`:string, `Name.Last`:string, "
    "`Name.Suffix`:string>, Skills string, "
    f"Address array<struct<`Addr.Type`:string, `Addr.Location`:struct<{LOCATION}>, `Addr.PostalCode`:string>>, "
    "EMail string, WebSite string"
)
JOBS = (
    "Employment array<struct<`Emp.StartDate`:string, `Emp.EndDate`:string, `Emp.OrgName`:string, "
    "`Emp.JobTitle`:string, `Emp.Responsibility`:string, `Emp.FunctionCategory`:string, "
    f"`Emp.IndustryCategory`:string, `Emp.Location`:struct<{LOCATION}>>>"
)
SCHOOLS = (
    "Education array<struct<`Edu.Level`:string, `Edu.StartDate`:string, `Edu.EndDate`:string, "
    "`Edu.Degree`:string, `Edu.Major`:string, `Edu.Minor`:string, `Edu.GPA`:string, `Edu.GPAScale`:string, "
    f"`Edu.School`:string, `Edu.Location`:struct<{LOCATION}>>>"
)


def v_job_candidate(t: Tables) -> DataFrame:
    r = t["humanresources.jobcandidate"].select(
        "jobcandidateid", "businessentityid", "modifieddate", shred(F.col("resume"), RESUME).alias("r"))
    r = r.withColumn("a", F.get("r.Address", F.lit(0)))

    def name(part):
        return limited(F.col(f"r.Name.`Name.{part}`"), 30).alias(f"Name.{part}")

    def place(part):
        return limited(F.col(f"a.`Addr.Location`.Location.`Loc.{part}`"), 100).alias(f"Addr.Loc.{part}")

    return r.select(
        "jobcandidateid", "businessentityid",
        name("Prefix"), name("First"), name("Middle"), name("Last"), name("Suffix"),
        F.col("r.Skills").alias("Skills"),
        limited(F.col("a.`Addr.Type`"), 30).alias("Addr.Type"),
        place("CountryRegion"), place("State"), place("City"),
        limited(F.col("a.`Addr.PostalCode`"), 20).alias("Addr.PostalCode"),
        F.col("r.EMail").alias("EMail"), F.col("r.WebSite").alias("WebSite"), "modifieddate")


def v_job_candidate_employment(t: Tables) -> DataFrame:
    """One row per employment, each from its own element, so a missing field is NULL."""
    e = t["humanresources.jobcandidate"].select(
        "jobcandidateid", F.explode(shred(F.col("resume"), JOBS)["Employment"]).alias("e"))

    def at(part):
        return F.col(f"e.`Emp.{part}`")

    def place(part):
        return F.col(f"e.`Emp.Location`.Location.`Loc.{part}`").alias(f"Emp.Loc.{part}")

    return e.select(
        "jobcandidateid", day(at("StartDate")).alias("Emp.StartDate"), day(at("EndDate")).alias("Emp.EndDate"),
        limited(at("OrgName"), 100).alias("Emp.OrgName"), limited(at("JobTitle"), 100).alias("Emp.JobTitle"),
        at("Responsibility").alias("Emp.Responsibility"), at("FunctionCategory").alias("Emp.FunctionCategory"),
        at("IndustryCategory").alias("Emp.IndustryCategory"),
        place("CountryRegion"), place("State"), place("City"))


def v_job_candidate_education(t: Tables) -> DataFrame:
    e = t["humanresources.jobcandidate"].select(
        "jobcandidateid", F.explode(shred(F.col("resume"), SCHOOLS)["Education"]).alias("e"))

    def text(part, width):
        return limited(F.col(f"e.`Edu.{part}`"), width).alias(f"Edu.{part}")

    def place(part):
        return limited(F.col(f"e.`Edu.Location`.Location.`Loc.{part}`"), 100).alias(f"Edu.Loc.{part}")

    return e.select(
        "jobcandidateid", text("Level", 50), day(F.col("e.`Edu.StartDate`")).alias("Edu.StartDate"),
        day(F.col("e.`Edu.EndDate`")).alias("Edu.EndDate"), text("Degree", 50), text("Major", 50),
        text("Minor", 50), text("GPA", 5), text("GPAScale", 5), text("School", 100),
        place("CountryRegion"), place("State"), place("City"))


CATALOG = (
    "Summary struct<p:array<string>>, "
    "Manufacturer struct<Name:string, Copyright:string, ProductURL:string>, "
    "Features struct<Warranty:struct<WarrantyPeriod:string, Description:string>, "
    "Maintenance:struct<NoOfYears:string, Description:string>, wheel:string, saddle:string, pedal:string, "
    "BikeFrame:string, crankset:string>, "
    "Picture array<struct<Angle:string, Size:string, ProductPhotoID:string>>, "
    "Specifications struct<Material:string, Color:string, ProductLine:string, Style:string, "
    "RiderExperience:string>"
)


def v_product_model_catalog_description(t: Tables) -> DataFrame:
    m = (
        t["production.productmodel"].filter("catalogdescription IS NOT NULL")
        .select("productmodelid", "name", "rowguid", "modifieddate",
                shred(F.col("catalogdescription"), CATALOG).alias("d"))
    )

    def plain(path, name, width=256):
        return limited(F.col(f"d.{path}"), width).alias(name)

    def picture(part, name):
        found = F.filter(F.transform("d.Picture", lambda p: p[part]), lambda v: v.isNotNull())
        return limited(F.get(found, F.lit(0)), 256).alias(name)

    return m.select(
        "productmodelid", "name",
        F.get("d.Summary.p", F.lit(0)).alias("summary"),
        F.col("d.Manufacturer.Name").alias("manufacturer"),
        plain("Manufacturer.Copyright", "copyright", 30), plain("Manufacturer.ProductURL", "producturl"),
        plain("Features.Warranty.WarrantyPeriod", "warrantyperiod"),
        plain("Features.Warranty.Description", "warrantydescription"),
        plain("Features.Maintenance.NoOfYears", "noofyears"),
        plain("Features.Maintenance.Description", "maintenancedescription"),
        plain("Features.wheel", "wheel"), plain("Features.saddle", "saddle"), plain("Features.pedal", "pedal"),
        F.col("d.Features.BikeFrame").alias("bikeframe"), plain("Features.crankset", "crankset"),
        picture("Angle", "pictureangle"), picture("Size", "picturesize"),
        picture("ProductPhotoID", "productphotoid"),
        plain("Specifications.Material", "material"), plain("Specifications.Color", "color"),
        plain("Specifications.ProductLine", "productline"), plain("Specifications.Style", "style"),
        plain("Specifications.RiderExperience", "riderexperience", 1024),
        "rowguid", "modifieddate")


MANUAL = ("Location array<struct<_LocationID:string, _SetupHours:string, _MachineHours:string, "
          "_LaborHours:string, _LotSize:string, step:array<string>>>")


def v_product_model_instructions(t: Tables) -> DataFrame:
    """Locations of a manual, then the steps of each location."""
    doc = F.col("instructions")
    parsed = t["production.productmodel"].filter(doc.isNotNull()).select(
        "productmodelid", "name", "rowguid", "modifieddate", doc, shred(doc, MANUAL).alias("m"))
    located = parsed.select(
        "productmodelid", "name", "rowguid", "modifieddate",
        F.get(F.xpath(doc, F.lit("/*/text()")), F.lit(0)).alias("instructions"),
        # the steps of all locations, each with its location, so that there is one explode
        F.flatten(F.transform(
            F.filter("m.Location", lambda l: l["step"].isNotNull()),
            lambda l: F.transform(l["step"], lambda s: F.struct(l.alias("l"), s.alias("s"))))).alias("steps"))
    steps = located.select("*", F.inline("steps")).drop("steps")

    def hours(name):
        return F.col(f"l._{name}").try_cast("decimal(9,4)").alias(name.lower())

    return steps.select(
        "productmodelid", "name", "instructions",
        whole(F.col("l._LocationID")).alias("locationid"), hours("SetupHours"), hours("MachineHours"),
        hours("LaborHours"), whole(F.col("l._LotSize")).alias("lotsize"),
        limited(F.col("s"), 1024).alias("step"), "rowguid", "modifieddate")


STORE = ("AnnualSales string, AnnualRevenue string, BankName string, BusinessType string, YearOpened string, "
         "Specialty string, SquareFeet string, Brands string, Internet string, NumberEmployees string")


def v_store_with_demographics(t: Tables) -> DataFrame:
    """Stores without a survey have no row."""
    s = (
        t["sales.store"].filter("demographics IS NOT NULL")
        .select("businessentityid", "name", shred(F.col("demographics"), STORE).alias("d"))
    )
    names = [part.strip().split(" ")[0] for part in STORE.split(",")]
    answered = F.coalesce(*[F.col(f"d.{n}") for n in names]).isNotNull()

    def at(name):
        return F.col(f"d.{name}")

    return s.filter(answered).select(
        "businessentityid", "name", money(at("AnnualSales")).alias("annualsales"),
        money(at("AnnualRevenue")).alias("annualrevenue"), limited(at("BankName"), 50).alias("bankname"),
        limited(at("BusinessType"), 5).alias("businesstype"), whole(at("YearOpened")).alias("yearopened"),
        limited(at("Specialty"), 50).alias("specialty"), whole(at("SquareFeet")).alias("squarefeet"),
        limited(at("Brands"), 30).alias("brands"), limited(at("Internet"), 30).alias("internet"),
        whole(at("NumberEmployees")).alias("numberemployees"))
