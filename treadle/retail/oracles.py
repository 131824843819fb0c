"""Plain SQL counterparts of the registered jobs, for another SQL engine to check against."""

from __future__ import annotations

from treadle.retail.source import BASE, portable

_GROSS = "cast(l_extendedprice as decimal(14,2))"
_RATE = "cast(l_discount as decimal(3,2))"
_NET = f"cast({_GROSS} * (1 - {_RATE}) as decimal(18,2))"

_LINES = f"""lines as (
  select l_orderkey as order_id, l_linenumber as line_no, l_partkey as product_id, l_suppkey as store_id,
         cast(l_quantity as int) as quantity, {_NET} as revenue,
         cast({_GROSS} * {_RATE} as decimal(18,2)) as discount_amount,
         cast({_RATE} * 100 as int) as offer_id, l_returnflag as return_flag,
         cast(l_shipdate as date) as ship_date, o_custkey as customer_id, cast(o_orderdate as date) as order_date
  from lineitem join orders on l_orderkey = o_orderkey)"""

_PLACES = """places as (
  select c_custkey, c_mktsegment, n_regionkey, c_nationkey from customer join nation on c_nationkey = n_nationkey)"""

_STATES = """days as (
  select o_custkey, cast(o_orderdate as date) as d, arg_max(o_orderpriority, o_orderkey) as p
  from orders group by 1, 2),
marked as (
  select *, row_number() over w as rn, lag(p) over w as before from days
  window w as (partition by o_custkey order by d)),
starts as (select o_custkey, d, p from marked where rn = 1 or p <> before),
versions as (
  select o_custkey, d as vf, p, lead(d) over (partition by o_custkey order by d) as vt from starts)"""

_STOCK = """stock as (
  select l_partkey, l_suppkey, sum(cast(l_quantity as int)) as q, max(cast(l_shipdate as date)) as last_day
  from lineitem group by 1, 2)"""


def _snapshot(day: str) -> str:
    return (f"select o_custkey as customerid, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) as priority "
            f"from orders where o_orderdate < timestamp '{day}' group by 1")


def _growth(inner: str) -> str:
    return f"""select *, case when lag("MonthStartDateKey") over w + interval 1 month = "MonthStartDateKey"
        then cast("TotalRevenue" - lag("TotalRevenue") over w as double)
        / nullif(cast(lag("TotalRevenue") over w as double), 0) * 100 end as "GrowthRate" from ({inner})
        window w as (partition by "RegionKey", "SalesTerritoryKey" order by "MonthStartDateKey")"""


ORACLES: dict[str, str] = {}

# --- sources -------------------------------------------------------------------------------

ORACLES["s_dim_extract"] = """
select c.* from customer c
where (select max(o_orderdate) from orders where o_custkey = c_custkey) > timestamp '2001-06-01'"""

ORACLES["s_fact_extract"] = """
select o_orderkey, o_custkey, cast(o_orderdate as date) as o_orderdate, o_totalprice from orders
where o_orderdate >= timestamp '1996-01-01' and o_orderdate <= timestamp '1998-12-31'"""

ORACLES["s_classify"] = """
with c as (
  select distinct table_name, lower(column_name) as column_name from information_schema.columns
  where table_name in ('region','nation','customer','supplier','part','orders','lineitem','events',
    'documents','embeddings','pages','benchmark','labels','conversations')),
t as (
  select table_name, count(*) as column_count, bool_or(contains(column_name, 'date')) as dated,
         bool_or(regexp_matches(column_name, 'amount|qty|price|total')) as measured
  from c group by 1),
n as (
  select 'orders' as table_name, count(*) as extracted_rows from orders
  where o_orderdate between timestamp '1996-01-01' and timestamp '1998-12-31'
  union all
  select 'lineitem', count(*) from lineitem
  where l_shipdate between timestamp '1996-01-01' and timestamp '1998-12-31')
select table_name,
       case when regexp_matches(table_name, 'order|detail|history|transaction|workorder|inventory|purchase|salesorder')
              or (dated and measured) then 'fact' else 'dimension' end as table_type,
       column_count, extracted_rows
from t left join n using (table_name)"""

ORACLES["s_delimited_load"] = """
select o_orderkey as orderid, o_orderstatus as status, o_orderstatus = 'O' as openflag,
       md5(cast(o_orderkey as varchar)) as guid, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.587' as placed,
       case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as clerk,
       cast((o_custkey % 100) * 0.01 as decimal(8,2)) as share, '07:30:00' as at,
       '/' || (o_custkey % 1104) || '/' || (o_orderkey % 80) || '/' as node
from orders"""

ORACLES["s_record_load"] = """
with d as (select doc_id, lang, translate(text, chr(9) || chr(13), '  ') as t from documents)
select doc_id, lang, length(t) as n_chars, md5(t) as digest, 'end' as mark from d"""

# --- projections and joins -----------------------------------------------------------------

ORACLES["p_order_totals"] = f"""
with s as (select l_orderkey, cast(sum({_NET}) as decimal(18,2)) as t from lineitem group by 1)
select o_orderkey as order_id, 'SO' || o_orderkey as order_number, coalesce(t, 0) as sub_total,
       cast(o_totalprice as decimal(18,2)) as total_due,
       cast(o_totalprice as decimal(18,2)) = coalesce(t, 0) as reconciled
from orders left join s on l_orderkey = o_orderkey"""

ORACLES["j_orphans_anti"] = """
select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)"""

ORACLES["j_children_semi"] = """
select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'O' and o_orderpriority = '1-URGENT')"""

ORACLES["j_asof_lookup"] = f"""
with {_STATES}, {_LINES}
select order_id, line_no, customer_id, ship_date, p as priority, vf as valid_from
from lines left join versions on o_custkey = customer_id and ship_date >= vf and (vt is null or ship_date < vt)"""

ORACLES["j_price_in_force"] = """
select l_orderkey, l_linenumber, l_partkey, cast(l_shipdate as date) as ship_date,
       max(cast(l_extendedprice as decimal(14,2))) over (partition by l_partkey, year(l_shipdate)) as price,
       cast(date_trunc('year', l_shipdate) as date) as since
from lineitem"""

ORACLES["j_band_tier"] = f"""
with {_STOCK}, aged as (select q, date_diff('day', last_day, date '2001-11-30') as a from stock)
select cast(case when a <= 30 then 1 when a <= 90 then 2 else 3 end as bigint) as "AgingTierKey",
       case when a <= 30 then 'Fresh (0-30 days)' when a <= 90 then 'Aged (31-90 days)'
            else 'Very Aged (90+ days)' end as "AgingTierName",
       count(*) as stock_rows, cast(sum(q) as bigint) as units
from aged group by 1, 2"""

ORACLES["j_self_manager"] = """
with lead_of as (select s_nationkey, min(s_suppkey) as m from supplier group by 1)
select e.s_suppkey as "EmployeeID", e.s_name as "EmployeeName", e.s_nationkey, m as "ManagerID",
       b.s_name as "ManagerName"
from supplier e join lead_of using (s_nationkey) left join supplier b on b.s_suppkey = m"""

# --- aggregates and windows ----------------------------------------------------------------

_FY = "year(cast(o_orderdate as date) + interval 6 month)"
ORACLES["a_pivot_fiscal"] = "select o_orderpriority, " + ", ".join(
    f"cast(sum(case when {_FY} = {y} then cast(o_totalprice as decimal(14,2)) end) as decimal(24,2)) as fy{y}"
    for y in (1997, 1998, 1999)) + " from orders group by 1"

ORACLES["a_ratio_metrics"] = """
select l_partkey, cast(date_trunc('month', l_shipdate) as date) as month,
       cast(sum(cast(l_quantity as bigint)) as bigint) as units,
       cast(sum(case when l_returnflag = 'R' then cast(l_quantity as bigint) else 0 end) as double)
         / nullif(cast(sum(cast(l_quantity as bigint)) as double), 0) as return_rate
from lineitem group by 1, 2"""

ORACLES["s_load_rejects"] = """
with f as (select o_orderkey as k, case when (o_orderkey % 13 = 4) <> (o_orderkey % 17 = 5) then 'number of fields'
      when o_orderkey % 13 = 4 then 'number of fields' else '' end as odd,
    array_to_string(list_filter([case when o_orderkey % 5 = 1 then 'customer' end, case when o_orderkey % 7 = 2 then 'flag' end,
      case when o_orderkey % 11 = 3 then 'share' end], lambda x: x is not null), ',') as bad from orders)
select case when odd <> '' then odd else bad end as reasons, count(*) as n_rows, cast(sum(k) as bigint) as order_sum,
  case when reasons = '' then cast(count(*) * 25 as bigint) end as cents
from f group by 1"""

ORACLES["j_band_fraction"] = """
with p as (select cast(p_retailprice as decimal(14,2)) as price from part),
b as (select distinct cast(floor(price / 100) * 100 as decimal(14,2)) as low from p)
select low as band, count(*) as parts, cast(sum(price) as decimal(18,2)) as worth
from p left join b on price between low and low + 74.5 group by 1"""

ORACLES["q_fk_window"] = """
with l as (select l_orderkey from lineitem where l_shipdate between timestamp '1997-01-01' and timestamp '1997-12-31')
select 'whole' as parents, 'lineitem' as table_name, count(*) as violations from l
where l_orderkey not in (select o_orderkey from orders)
union all
select 'window', 'lineitem', count(*) from l where l_orderkey not in (
  select o_orderkey from orders where o_orderdate between timestamp '1997-01-01' and timestamp '1997-12-31')"""

ORACLES["q_retry"] = """
with r as (select bool_or(l_returnflag = 'R') over (partition by l_orderkey, l_linenumber) as passed
           from lineitem where l_discount > 0.08)
select passed as "IsResolved", 1 as "RetryCount", case when passed then 'passed on retry' end as "ResolutionComment",
  count(*) as records from r group by 1, 3"""

_PRICED = """priced as (
  with o as (
    select l_partkey as p, cast(l_shipdate as date) as d,
           max(cast(l_discount as decimal(3,2))) filter (where l_linestatus = 'O') as a,
           max(cast(l_tax as decimal(3,2))) filter (where l_linestatus = 'F') as b
    from lineitem group by 1, 2),
  f as (
    select p, d, last_value(a ignore nulls) over w as a, last_value(b ignore nulls) over w as b from o
    window w as (partition by p order by d rows unbounded preceding)),
  m as (select *, row_number() over w as rn, lag(a) over w as a0, lag(b) over w as b0 from f window w as (partition by p order by d)),
  s as (select * from m where rn = 1 or a is distinct from a0 or b is distinct from b0)
  select p, d as vf, lead(d) over (partition by p order by d) as vt, a, b from s)"""

ORACLES["k1_fact_sales_keyed"] = f"""
with {_STATES}, {_LINES}, {_PRICED},
quota as (select l_suppkey, year(l_shipdate) + 1 as y from lineitem group by 1, 2),
found as (
  select 'CustomerKey' as dimension, customer_id as member, o_custkey as found, vf as valid_from, revenue
  from lines left join versions on o_custkey = customer_id and order_date >= vf and (vt is null or order_date < vt)
  union all
  select 'ProductKey', product_id, p, vf, revenue
  from lines left join priced on p = product_id and order_date >= vf and (vt is null or order_date < vt)
  union all
  select 'StoreKey', store_id, s_suppkey, null, revenue from lines left join supplier on s_suppkey = store_id
  union all
  select 'EmployeeKey', store_id, l_suppkey, make_date(y, 1, 1), revenue
  from lines left join quota on l_suppkey = store_id and y = year(order_date))
select dimension, member, found, cast(valid_from as date) as valid_from, count(*) as sales,
       cast(sum(revenue) as decimal(18,2)) as revenue
from found group by 1, 2, 3, 4"""

ORACLES["w_growth"] = _growth("""
select cast(date_trunc('month', o_orderdate) as date) as "MonthStartDateKey", n_regionkey as "RegionKey",
       c_nationkey as "SalesTerritoryKey",
       cast(sum(cast(o_totalprice as decimal(14,2))) as decimal(18,2)) as "TotalRevenue"
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2, 3""")

ORACLES["w_keep_last"] = """
select user_id, event_id, event_type, value from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""

# --- quality -------------------------------------------------------------------------------

_COLUMN_RULES = [
    ("customer", "Nulls in c_custkey", "ERROR", "c_custkey is null"),
    ("customer", "Nulls in c_name", "ERROR", "c_name is null"),
    ("customer", "Longer than 9: c_mktsegment", "ERROR", "length(c_mktsegment) > 9"),
    ("supplier", "Nulls in s_suppkey", "ERROR", "s_suppkey is null"),
    ("part", "Nulls in p_partkey", "ERROR", "p_partkey is null"),
    ("part", "Longer than 10: p_name", "ERROR", "length(p_name) > 10"),
    ("part", "Negative values in p_retailprice", "ERROR", "p_retailprice < 0"),
    ("orders", "Nulls in o_orderkey", "ERROR", "o_orderkey is null"),
    ("orders", "Nulls in o_custkey", "ERROR", "o_custkey is null"),
    ("orders", "Negative values in o_totalprice", "ERROR", "o_totalprice < 0"),
    ("orders", "Nulls in o_orderdate", "ERROR", "o_orderdate is null"),
    ("orders", "Future dates in o_orderdate", "WARNING", "o_orderdate > timestamp '2001-06-01'"),
    ("orders", "Longer than 10: o_orderpriority", "ERROR", "length(o_orderpriority) > 10"),
    ("lineitem", "Nulls in l_orderkey", "ERROR", "l_orderkey is null"),
    ("lineitem", "Negative values in l_extendedprice", "ERROR", "l_extendedprice < 0"),
    ("lineitem", "Nulls in l_shipdate", "ERROR", "l_shipdate is null"),
    ("lineitem", "Future dates in l_shipdate", "WARNING", "l_shipdate > timestamp '2001-06-01'"),
]
_CHECK_RULES = [
    ("customer", "CK_customer_balance", "c_acctbal >= 0"),
    ("lineitem", "CK_lineitem_quantity", "l_quantity between 1 and 48"),
    ("lineitem", "CK_lineitem_discount", "l_discount < 0.10 or l_discount is null"),
    ("lineitem", "CK_lineitem_flag", "l_returnflag in ('A', 'N')"),
    ("orders", "CK_orders_status", "o_orderstatus in ('F', 'O')"),
    ("orders", "CK_orders_total", "o_totalprice >= 2000"),
]
_KEYS = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
         "lineitem": "l_orderkey, l_linenumber"}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_FOUND = " union all ".join(
    f"select '{t}' as table_name, {_text(m)} as message, '{s}' as severity, count(*) filter (where {p}) as violations from {t}"
    for t, m, s, p in _COLUMN_RULES)
_CHECKED = " union all ".join(
    f"select '{t}' as table_name, '{n}' as rule, count(*) filter (where not coalesce(({p}), true)) as violations from {t}"
    for t, n, p in _CHECK_RULES)

ORACLES["q_column_rules"] = _FOUND
ORACLES["q_check_rules"] = _CHECKED
ORACLES["q_pk_duplicates"] = """
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1"""
ORACLES["q_key_records"] = """
select l_orderkey || '|' || l_linenumber as "RecordNaturalKey", 'primary_key' as "ErrorType", 'ERROR' as "ErrorSeverity",
       count(*) as records
from lineitem group by l_orderkey, l_linenumber having count(*) > 1"""
ORACLES["q_fk_orphans"] = """
select user_id, count(*) as n_rows from events
where not exists (select 1 from supplier where s_suppkey = user_id) group by 1"""

_DUPLICATES = " union all ".join(
    f"select '{t}' as table_name, 'Duplicate primary keys' as message, 'ERROR' as severity, "
    f"(select count(*) from (select 1 from {t} group by {k} having count(*) > 1)) as violations"
    for t, k in _KEYS.items())
_ORPHANS = """
select 'lineitem' as table_name, 'No row in orders for l_orderkey' as message, 'ERROR' as severity,
       count(*) as violations from lineitem where l_orderkey not in (select o_orderkey from orders)
union all
select 'lineitem', 'No row in part for l_partkey', 'ERROR', count(*) from lineitem
where l_partkey not in (select p_partkey from part)
union all
select 'orders', 'No row in customer for o_custkey', 'ERROR', count(*) from orders
where o_custkey not in (select c_custkey from customer)"""

ORACLES["q_summary"] = f"""
with found as ({_FOUND} union all {_DUPLICATES} union all {_ORPHANS} union all
  select table_name, 'Check failed: ' || rule, 'ERROR', violations from ({_CHECKED})),
lists as (
  select table_name,
         coalesce(string_agg(message, '; ' order by message) filter (where violations > 0 and severity = 'ERROR'), '') as errors,
         coalesce(string_agg(message, '; ' order by message) filter (where violations > 0 and severity = 'WARNING'), '') as warnings
  from found group by 1)
select table_name, case when errors = '' then 'PASS' else 'FAIL' end as status, errors, warnings from lists"""

_SUNK = ("customer", "supplier", "part", "orders", "lineitem")
_SUNK_KEYS = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
              "lineitem": "l_orderkey, l_linenumber"}
_SUNK_LINKS = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
               ("orders", "o_custkey", "customer", "c_custkey")]
_KINDS = {"Nulls": "required", "Longer": "length", "Negative": "negative", "Future": "future"}


def _record_counts() -> str:
    parts = []
    for t, m, s, p in _COLUMN_RULES:
        if t in _SUNK:
            parts.append((t, _KINDS[m.split()[0]], s, m, p))
    for t, n, p in _CHECK_RULES:
        parts.append((t, "check", "ERROR", f"Check failed: {n}", f"not coalesce(({p}), true)"))
    rows = " union all ".join(
        f"select '{t}' as \"SourceTable\", '{k}' as \"ErrorType\", '{s}' as \"ErrorSeverity\", {_text(m)} as \"ErrorMessage\", "
        f"count(*) filter (where {p}) as records, count(*) filter (where {p}) as payloads from {t}"
        for t, k, s, m, p in parts)
    for t, k in _SUNK_KEYS.items():
        rows += (f" union all select '{t}', 'primary_key', 'ERROR', 'Duplicate primary keys', coalesce(sum(n), 0), coalesce(sum(n), 0) "
                 f"from (select count(*) as n from {t} group by {k} having count(*) > 1)")
    for t, c, parent, k in _SUNK_LINKS:
        rows += (f" union all select '{t}', 'foreign_key', 'ERROR', 'No row in {parent}', count(*), count(*) "
                 f"from {t} where {c} is not null and {c} not in (select {k} from {parent} where {k} is not null)")
    return f"""select "SourceTable", "ErrorType", "ErrorSeverity", "ErrorMessage", cast(sum(records) as bigint) as records,
      cast(sum(payloads) as bigint) as payloads from ({rows}) where records > 0 group by all"""


def _balance() -> str:
    parts = []
    for t in _SUNK:
        broken = [p for n, _, s, p in _COLUMN_RULES if n == t and s == "ERROR"]
        broken += [f"not coalesce(({p}), true)" for n, _, p in _CHECK_RULES if n == t]
        bad = " or ".join(f"coalesce(({p}), false)" for p in broken)
        for part, test in (("input", "true"), ("accepted", f"not ({bad})"), ("rejected", bad)):
            parts.append(f"select '{t}', 'rows', 'INFO', '{part}', count(*) filter (where {test}), 0 from {t}")
    return " union all ".join(parts)


ORACLES["q_error_records"] = f"{_record_counts()} union all {_balance()}"

# --- staging and dimensions ----------------------------------------------------------------

ORACLES["d_customer_staging"] = """
with first_order as (select o_custkey, min(o_orderdate) as f from orders group by 1)
select cast(c_custkey as bigint) as customerid, 'Customer ' || substr(c_name, 10, 9) as customername,
       lower(c_mktsegment) || c_custkey || '@example.com' as emailaddress,
       case when c_acctbal >= 0 then '1-' || c_custkey end as phonenumber, 'City ' || c_nationkey as city,
       cast(c_nationkey as bigint) as stateprovinceid, 'C' || n_regionkey as countryregioncode,
       'P' || c_custkey as postalcode,
       case when coalesce(2001 - year(f), 0) >= 5 then 'Premium' else 'Standard' end as customersegment,
       case when c_mktsegment = 'MACHINERY' then 'Corporate' else 'Individual' end as customertype,
       'Active' as accountstatus, cast(0 as bigint) as creditlimit, cast(0 as bigint) as annualincome,
       cast(coalesce(2001 - year(f), 0) as bigint) as yearssincefirstpurchase
from customer join nation on c_nationkey = n_nationkey left join first_order on o_custkey = c_custkey"""

ORACLES["d_dim_customer"] = f"""
with s as ({ORACLES["d_customer_staging"]})
select customerid as "CustomerID", customername as "CustomerName", emailaddress as "Email", phonenumber as "Phone",
       city as "City", cast(stateprovinceid as varchar) as "StateProvince", countryregioncode as "Country",
       postalcode as "PostalCode", customersegment as "CustomerSegment", customertype as "CustomerType",
       accountstatus as "AccountStatus", cast(creditlimit as decimal(18,2)) as "CreditLimit",
       cast(annualincome as decimal(18,2)) as "AnnualIncome", cast(yearssincefirstpurchase as int) as "YearsSinceFirstPurchase",
       date '2001-12-31' as "SourceUpdateDate", date '1995-01-01' as "ValidFromDate", cast(null as date) as "ValidToDate",
       true as "IsCurrent", date '2001-12-31' as "EffectiveStartDate", cast(null as date) as "EffectiveEndDate"
from s"""

_FIRST = """date '1995-01-01' as "ValidFromDate", cast(null as date) as "ValidToDate", true as "IsCurrent\""""
_LOADED = """date '2001-12-31' as "EffectiveStartDate", cast(null as date) as "EffectiveEndDate\""""

ORACLES["d_dim_product"] = f"""
select p_partkey as "ProductID", p_name as "ProductName", p_brand || '-' || p_partkey as "SKU",
       'Category ' || p_size % 5 as "Category", 'Sub ' || p_size as "SubCategory", 'Model ' || p_brand as "Brand",
       cast(p_retailprice as decimal(18,2)) as "ListPrice", cast(p_size as decimal(18,2)) as "Cost",
       case when p_size > 40 then 'Discontinued' else 'Active' end as "ProductStatus", substr(p_name, 1, 3) as "Color",
       cast(p_size as varchar) as "Size", cast(p_size as decimal(10,3)) as "Weight",
       cast(null as date) as "SourceUpdateDate", {_FIRST}, {_LOADED}
from part"""

ORACLES["d_dim_store"] = f"""
select {BASE} + s_suppkey as "StoreID", s_name as "StoreName", {BASE} + s_suppkey as "StoreNumber",
       'Dock ' || s_suppkey as "Address", 'Port ' || s_nationkey as "City", n_name as "StateProvince", r_name as "Country",
       'Q' || s_suppkey as "PostalCode", case when s_acctbal >= 0 then 'G' || n_regionkey end as "Region",
       case when s_acctbal >= 0 then n_name end as "Territory", 'Retail' as "StoreType", 'Open' as "StoreStatus",
       substr(s_name, 1, 8) || ' ' || substr(s_name, 10, 9) as "ManagerName",
       case when s_acctbal >= 0 then make_date(1970 + s_nationkey, 1, 1) end as "OpeningDate",
       cast(case when s_acctbal >= 0 then 1000 + s_nationkey end as int) as "SquareFootage", cast(null as date) as "SourceUpdateDate", {_FIRST}
from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey"""

ORACLES["d_dim_employee"] = f"""
select {BASE} + s_suppkey as "EmployeeID", substr(s_name, 1, 8) || ' ' || substr(s_name, 10, 9) as "EmployeeName",
       'Rep ' || s_nationkey as "JobTitle", 'Dept ' || d.r_name as "Department", cast(null as bigint) as "ReportingManagerKey",
       date '1990-01-01' as "HireDate", case when s_acctbal >= 0 then 'Active' else 'Terminated' end as "EmployeeStatus",
       case when s_acctbal >= 0 then 'G' || n_regionkey end as "Region", case when s_acctbal >= 0 then n_name end as "Territory",
       cast(s_acctbal as decimal(18,2)) as "SalesQuota", cast(null as date) as "SourceUpdateDate", {_FIRST}
from supplier join nation on n_nationkey = s_nationkey join region d on d.r_regionkey = s_nationkey % 5"""

ORACLES["d_manager_keys"] = f"""
select {BASE} + s_suppkey as "EmployeeID", substr(s_name, 1, 8) || ' ' || substr(s_name, 10, 9) as "EmployeeName",
       case when s_suppkey >= 10 then {BASE} + s_suppkey % 10 end as "ManagerID"
from supplier"""

ORACLES["d_dim_vendor"] = f"""
select {BASE} + s_suppkey as "VendorID", s_name as "VendorName",
       substr(c_name, 1, 8) || ' ' || substr(c_name, 10, 9) as "ContactPerson",
       lower(c_mktsegment) || c_custkey || '@example.com' as "Email", case when c_acctbal >= 0 then '1-' || c_custkey end as "Phone",
       'Dock ' || s_suppkey as "Address", 'Port ' || s_nationkey as "City", r_name as "Country",
       cast(5 - s_nationkey % 5 as decimal(3,2)) as "VendorRating", cast(null as varchar) as "PaymentTerms",
       case when s_acctbal <= 0 then 'Inactive' when s_acctbal > 5000 then 'Preferred' else 'Active' end as "VendorStatus",
       cast(null as date) as "SourceUpdateDate", {_FIRST}
from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
left join customer on c_custkey = s_suppkey"""

ORACLES["d_vendor_scores"] = f"""
with l as (
  select {BASE} + o_custkey % 10 as v, o_orderdate + interval 30 day <= l_shipdate as met,
         cast(l_quantity as decimal(8,2)) as got, case when l_returnflag = 'R' then 1 else 0 end as bad
  from lineitem join orders on o_orderkey = l_orderkey)
select v as "VendorID", cast(count(*) filter (where met) as double) / count(*) * 100 as "OnTimeDeliveryRate",
       cast(sum(got - bad) as double) / cast(sum(got) as double) * 100 as "QualityScore"
from l group by 1"""

ORACLES["d_dim_warehouse"] = f"""
select cast(n_nationkey as bigint) as "WarehouseID", 'Hall ' || n_name as "WarehouseName", 'Hall ' || n_name as "Location",
       case when n_regionkey > 0 then 'Production' else 'Storage' end as "WarehouseType", cast(null as bigint) as "ManagerKey",
       {_FIRST}
from nation"""

ORACLES["d_dim_promotion"] = """
with o as (select distinct cast(l_discount as decimal(3,2)) as d, cast(cast(l_discount as decimal(3,2)) * 100 as bigint) as i from lineitem)
select i as "PromotionKey", i as "PromotionID", 'Offer ' || i as "PromotionName",
       'Reseller / Offer ' || i as "PromotionDescription", 'Discount' as "PromotionType",
       cast(i as decimal(5,2)) as "DiscountPercentage", cast(null as decimal(18,2)) as "DiscountAmount",
       date '1995-01-01' as "StartDate", case when d < 0.05 then date '1999-12-31' else date '2005-12-31' end as "EndDate",
       d >= 0.05 as "IsActive", case when d < 0.05 then 'Ended' else 'Running' end as "PromotionStatus",
       cast(null as int) as "CampaignID", cast(null as bigint) as "TargetProductKey",
       cast(null as varchar) as "TargetCustomerSegment"
from o"""

ORACLES["d_dim_sales_territory"] = """
with q as (select s_nationkey, sum(cast(s_acctbal as decimal(18,2))) as t from supplier where s_acctbal >= 0 group by 1)
select cast(n_nationkey as bigint) as "TerritoryKey", cast(n_nationkey as bigint) as "TerritoryID", n_name as "TerritoryName",
       'G' || n_regionkey as "SalesRegion", r_name as "Country", cast(null as varchar) as "Manager",
       cast(t as decimal(18,2)) as "SalesTarget"
from nation join region on r_regionkey = n_regionkey left join q on s_nationkey = n_nationkey"""

ORACLES["d_dim_region"] = """
select cast(n_nationkey as bigint) as "RegionKey", cast(n_nationkey as bigint) as "RegionID", n_name as "RegionName",
       r_name as "Country", 'G' || n_regionkey as "Continent", cast(null as varchar) as "TimeZone"
from nation join region on r_regionkey = n_regionkey"""

ORACLES["d_dim_product_category"] = """
select distinct cast(p_size % 5 as bigint) as "ProductCategoryKey", cast(p_size % 5 as bigint) as "ProductCategoryID",
       'Category ' || p_size % 5 as "CategoryName", cast(null as varchar) as "CategoryDescription"
from part"""

ORACLES["d_product_history"] = """
with o as (
  select l_partkey as p, cast(l_shipdate as date) as d,
         max(cast(l_discount as decimal(3,2))) filter (where l_linestatus = 'O') as a,
         max(cast(l_tax as decimal(3,2))) filter (where l_linestatus = 'F') as b
  from lineitem group by 1, 2),
f as (
  select p, d, last_value(a ignore nulls) over w as a, last_value(b ignore nulls) over w as b from o
  window w as (partition by p order by d rows unbounded preceding)),
m as (select *, row_number() over w as rn, lag(a) over w as a0, lag(b) over w as b0 from f window w as (partition by p order by d)),
s as (select * from m where rn = 1 or a is distinct from a0 or b is distinct from b0)
select p as "ProductID", d as "ValidFromDate", cast(a as decimal(19,4)) as "ListPrice", cast(b as decimal(19,4)) as "Cost",
       lead(d) over (partition by p order by d) as "ValidToDate",
       lead(d) over (partition by p order by d) is null as "IsCurrent"
from s"""

ORACLES["d_change_set"] = f"""
with s as ({_snapshot('1999-01-01')}), c as ({_snapshot('1998-01-01')})
select s.customerid, s.priority,
       case when c.customerid is null then 'new' when s.priority is distinct from c.priority then 'changed'
            else 'unchanged' end as change_type
from s left join c using (customerid)"""

ORACLES["d_scd2_history"] = f"""
with {_STATES}
select o_custkey, vf as "ValidFromDate", p as o_orderpriority, vt as "ValidToDate", vt is null as "IsCurrent"
from versions"""

ORACLES["d_scd2_merge"] = f"""
with snaps as (
  select *, date '1997-01-01' as d from ({_snapshot('1997-01-01')})
  union all select *, date '1998-01-01' from ({_snapshot('1998-01-01')})
  union all select *, date '1999-01-01' from ({_snapshot('1999-01-01')})),
marked as (select *, lag(priority) over (partition by customerid order by d) as before from snaps),
starts as (select * from marked where before is null or before <> priority)
select customerid as "CustomerID", priority as "Priority", d as "ValidFromDate",
       lead(d) over (partition by customerid order by d) as "ValidToDate",
       lead(d) over (partition by customerid order by d) is null as "IsCurrent"
from starts"""

ORACLES["d_scd1_upsert"] = """
with c as (select c_nationkey, count(*) as n from customer where c_acctbal > 0 group by 1)
select n_nationkey as "TerritoryID", case when n is null then n_name else 'renamed' end as "TerritoryName",
       coalesce(n, 0) as "Customers"
from nation left join c on c_nationkey = n_nationkey"""

ORACLES["d_date"] = """
with b as (select min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders),
d as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d from b)
select cast(strftime(d, '%Y%m%d') as int) as "DateKey", d as "FullDate", cast(year(d) as smallint) as "Year",
       cast(quarter(d) as tinyint) as "Quarter", cast(month(d) as tinyint) as "Month", monthname(d) as "MonthName",
       cast((dayofyear(d) + dayofweek(cast(date_trunc('year', d) as date)) - 1) // 7 + 1 as smallint) as "Week",
       cast(dayofweek(d) + 1 as tinyint) as "DayOfWeek", dayname(d) as "DayName",
       cast(day(d) as tinyint) as "DayOfMonth", cast(dayofyear(d) as smallint) as "DayOfYear",
       cast(weekofyear(d) as smallint) as "WeekOfYear", dayofweek(d) in (0, 6) as "IsWeekend",
       strftime(d, '%m-%d') in ('01-01', '07-04', '12-25') as "IsHoliday",
       case strftime(d, '%m-%d') when '01-01' then 'New Year''s Day' when '07-04' then 'Independence Day'
            when '12-25' then 'Christmas Day' end as "HolidayName",
       cast(year(d + interval 6 month) as smallint) as "FiscalYear",
       cast(quarter(d + interval 6 month) as tinyint) as "FiscalQuarter",
       cast(month(d + interval 6 month) as tinyint) as "FiscalMonth",
       case when month(d) in (12, 1, 2) then 'Winter' when month(d) <= 5 then 'Spring'
            when month(d) <= 8 then 'Summer' else 'Autumn' end as "Season"
from d"""

# --- facts ---------------------------------------------------------------------------------

ORACLES["k1_fact_sales"] = f"""
with {_LINES}
select order_date as "SalesDateKey", customer_id as "CustomerKey", product_id as "ProductKey", store_id as "StoreKey",
       store_id as "EmployeeKey", revenue as "SalesRevenue", quantity as "QuantitySold",
       discount_amount as "DiscountAmount", order_id as "SalesOrderID"
from lines"""

ORACLES["k2_fact_purchases"] = f"""
with p as (select *, {_GROSS} as amount, cast(l_quantity as bigint) as q,
                  cast({_GROSS} * 100 as bigint) as cents from lineitem)
select cast(l_shipdate as date) as "PurchaseDateKey", l_partkey as "ProductKey", l_suppkey as "VendorKey",
       cast(amount as decimal(18,2)) as "PurchaseAmount", cast(q as int) as "PurchaseQuantity",
       cast(0 as decimal(18,2)) as "DiscountAmount",
       cast(cast((2 * cents + q) // (2 * q) as decimal(16,0)) * 0.01 as decimal(18,2)) as "UnitCost"
from p"""

ORACLES["k3_fact_inventory"] = f"""
with {_STOCK}
select date '2001-11-30' as "InventoryDateKey", l_partkey as "ProductKey", l_suppkey as "StoreKey",
       l_suppkey as "WarehouseKey", cast(q as bigint) as "QuantityOnHand",
       cast(date_diff('day', last_day, date '2001-11-30') as int) as "StockAgingDays", p_size as "ReorderLevel",
       cast(p_size * 2 as int) as "SafetyStock"
from stock join part on p_partkey = l_partkey"""

ORACLES["k4_fact_production"] = """
with run as (
  select l_orderkey, l_partkey, sum(cast(l_quantity as bigint)) as o,
         sum(case when l_returnflag = 'R' then cast(l_quantity as bigint) else 0 end) as s,
         min(cast(l_shipdate as date)) as d, min(l_suppkey) as e, sum(cast(l_quantity as decimal(9,4)) * 0.25) as h
  from lineitem group by 1, 2)
select d as "ProductionDateKey", l_partkey as "ProductKey", e as "EmployeeKey",
       cast(h as decimal(18,2)) as "ProductionTimeHours", cast(o - s as bigint) as "UnitsProduced",
       cast(s as double) / nullif(cast(o as double), 0) * 100 as "ScrapRate", cast(s as bigint) as "DefectCount"
from run"""

ORACLES["k5_fact_employee_sales"] = f"""
with {_LINES},
quota as (select l_suppkey, year(l_shipdate) + 1 as y, cast(sum({_NET}) as decimal(18,2)) as t from lineitem group by 1, 2),
daily as (
  select order_date, store_id, cast(sum(revenue) as decimal(18,2)) as r, count(distinct customer_id) as c
  from lines group by 1, 2)
select order_date as "SalesDateKey", d.store_id as "EmployeeKey", d.store_id as "StoreKey",
       s_nationkey as "SalesTerritoryKey", r as "SalesAmount", t as "SalesTarget", c as "CustomerContactsCount"
from daily d join supplier on s_suppkey = d.store_id left join quota q on l_suppkey = d.store_id and q.y = year(order_date)"""

ORACLES["k6_fact_customer_feedback"] = """
with e as (select *, cast(least(5, floor(value / 50) + 1) as int) as score from events)
select event_id as "FeedbackID", cast(ts as date) as "FeedbackDateKey", user_id as "CustomerKey",
       cast(-1 as bigint) as "EmployeeKey", event_type as "FeedbackCategoryKey", score as "FeedbackScore",
       cast(event_type = 'error' as int) as "ComplaintCount", cast(null as decimal(10,2)) as "ResolutionTimeHours",
       cast(score * 20 as decimal(5,2)) as "CSATScore"
from e"""

ORACLES["k7_fact_promotion_response"] = f"""
with {_LINES},
cell as (select order_date, product_id, store_id, count(*) as everyone from lines group by 1, 2, 3),
offer as (
  select order_date, product_id, store_id, offer_id, sum(revenue) as r, sum(discount_amount) as d, count(*) as n
  from lines where offer_id <> 0 group by 1, 2, 3, 4)
select order_date as "PromotionDateKey", product_id as "ProductKey", store_id as "StoreKey",
       offer_id as "PromotionKey", cast(r as decimal(18,2)) as "SalesDuringCampaign", n as "DiscountUsageCount",
       cast(n as double) / everyone * 100 as "CustomerUptakeRate",
       cast(r - d as double) / nullif(cast(d as double), 0) as "PromotionROI"
from offer join cell using (order_date, product_id, store_id)"""

ORACLES["k8_fact_finance"] = """
with shipped as (select l_orderkey, max(cast(l_shipdate as date)) as paid, min(l_suppkey) as store from lineitem group by 1),
i as (
  select o_orderkey, cast(o_orderdate as date) as d, o_custkey, store, cast(o_totalprice as decimal(14,2)) as a,
         cast(date_diff('day', cast(o_orderdate as date), paid) as int) as late,
         cast(c_acctbal as decimal(14,2)) as credit
  from orders left join shipped on l_orderkey = o_orderkey left join customer on c_custkey = o_custkey)
select o_orderkey as "InvoiceID", d as "InvoiceDateKey", o_custkey as "CustomerKey", store as "StoreKey",
       'Invoice' as "FinanceCategoryKey", cast(a as decimal(18,2)) as "InvoiceAmount", late as "PaymentDelayDays",
       cast(a as double) / nullif(cast(credit as double), 0) * 100 as "CreditUsage",
       cast(a * cast(0.0005 as decimal(4,4)) * cast(greatest(coalesce(late, 0) - 30, 0) as decimal(6,0)) as decimal(18,2)) as "InterestCharges"
from i"""

ORACLES["k9_fact_returns"] = f"""
with {_LINES}
select order_id * 10 + line_no as "ReturnID", ship_date as "ReturnDateKey", product_id as "ProductKey",
       customer_id as "CustomerKey", store_id as "StoreKey", 'Unspecified' as "ReturnReasonKey",
       quantity as "ReturnedQuantity", revenue as "RefundAmount",
       cast(revenue * cast(0.10 as decimal(2,2)) as decimal(18,2)) as "RestockingFee"
from lines where return_flag = 'R'"""

# --- marts ---------------------------------------------------------------------------------

ORACLES["g1_daily_sales"] = f"""
with {_LINES}
select order_date as "SalesDateKey", store_id as "StoreKey", p_type as "ProductCategoryKey",
       cast(sum(revenue) as decimal(18,2)) as "TotalRevenue", cast(sum(quantity) as bigint) as "TotalQuantity",
       cast(sum(discount_amount) as decimal(18,2)) as "TotalDiscount",
       count(distinct order_id) as "TransactionCount"
from lines join part on p_partkey = product_id group by 1, 2, 3"""

ORACLES["g2_weekly_sales"] = f"""
with {_LINES}, {_PLACES}
select cast(order_date - cast(dayofweek(order_date) as int) as date) as "WeekStartDateKey",
       n_regionkey as "RegionKey", p_type as "ProductCategoryKey",
       cast(sum(revenue) as decimal(18,2)) as "SumRevenue",
       cast(sum(revenue) as double) / count(*) as "AvgRevenue", min(revenue) as "MinRevenue", max(revenue) as "MaxRevenue"
from lines join part on p_partkey = product_id join places on c_custkey = customer_id group by 1, 2, 3"""

ORACLES["g3_monthly_sales"] = f"""
with {_LINES}, {_PLACES}
select cast(date_trunc('month', order_date) as date) as "MonthStartDateKey", c_mktsegment as "CustomerSegmentKey",
       n_regionkey as "RegionKey", cast(sum(revenue) as decimal(18,2)) as "TotalRevenue",
       cast(sum(revenue) as double) / count(distinct order_id) as "AvgOrderValue",
       count(distinct customer_id) as "DistinctCustomerCount"
from lines join places on c_custkey = customer_id group by 1, 2, 3"""

ORACLES["g4_daily_inventory"] = f"""
with {_STOCK},
aged as (select *, date_diff('day', last_day, date '2001-11-30') as a from stock join part on p_partkey = l_partkey)
select date '2001-11-30' as "InventoryDateKey", l_suppkey as "WarehouseKey", p_type as "ProductCategoryKey",
       cast(case when a <= 30 then 1 when a <= 90 then 2 else 3 end as bigint) as "AgingTierKey",
       cast(sum(q * cast(p_retailprice as decimal(12,2))) as double) / count(*) as "AvgInventoryValue"
from aged group by 1, 2, 3, 4"""

ORACLES["g5_monthly_product_performance"] = f"""
with {_LINES},
sold as (
  select cast(date_trunc('month', order_date) as date) as m, product_id, store_id,
         cast(sum(revenue) as decimal(18,2)) as r, cast(sum(quantity) as bigint) as u
  from lines group by 1, 2, 3),
back as (
  select cast(date_trunc('month', ship_date) as date) as m, product_id, store_id, sum(quantity) as b
  from lines where return_flag = 'R' group by 1, 2, 3),
rated as (
  select user_id, cast(sum(cast(least(5, floor(value / 50) + 1) as int)) as double) / count(*) as g
  from events group by 1)
select m as "MonthStartDateKey", product_id as "ProductKey", store_id as "StoreKey",
       cast(coalesce(r, 0) as decimal(18,2)) as "TotalRevenue", coalesce(u, 0) as "UnitsSold",
       cast(coalesce(b, 0) as bigint) as "UnitsReturned",
       cast(coalesce(b, 0) as double) / nullif(cast(u as double), 0) * 100 as "ReturnRate", g as "AvgRating"
from sold full join back using (m, product_id, store_id) left join rated on user_id = product_id"""

ORACLES["g6_regional_sales"] = f"with {_LINES}, {_PLACES} " + _growth("""
select cast(date_trunc('month', order_date) as date) as "MonthStartDateKey", n_regionkey as "RegionKey",
       c_nationkey as "SalesTerritoryKey", cast(sum(revenue) as decimal(18,2)) as "TotalRevenue"
from lines join places on c_custkey = customer_id group by 1, 2, 3""")

ORACLES["g_partition_refresh"] = f"""
with {_LINES}, {_PLACES}
select cast(date_trunc('month', order_date) as date) as "MonthStartDateKey", n_regionkey as "RegionKey",
       cast(sum(revenue) as decimal(18,2)) as "TotalRevenue", strftime(order_date, '%Y-%m') as month
from lines join places on c_custkey = customer_id
where date_trunc('month', order_date) <> date '1997-07-01'
  and (return_flag <> 'R' or date_trunc('month', order_date) = date '1997-06-01')
group by 1, 2, 4"""

# --- views ---------------------------------------------------------------------------------


def _over(text: str, *names: str) -> str:
    """A query over derived source tables, each under its bare name."""
    ctes = ", ".join(f"{n.split('.')[1]} as ({portable(n)})" for n in names)
    return f"with {ctes} {text}"


_WHERE = ("person.businessentityaddress", "person.address", "person.stateprovince", "person.countryregion")
_REACH = ("person.personphone", "person.phonenumbertype", "person.emailaddress")
_PERSON = "q.title, q.firstname, q.middlename, q.lastname, q.suffix"
_CONTACT = "f.phonenumber, k.name as phonenumbertype, m.emailaddress, q.emailpromotion"
_PLACE = "a.addressline1, a.addressline2, a.city, z.name as stateprovincename, a.postalcode, y.name as countryregionname"
_AT = """join businessentityaddress b on b.businessentityid = {id} join address a using (addressid)
  join stateprovince z on z.stateprovinceid = a.stateprovinceid
  join countryregion y on y.countryregioncode = z.countryregioncode"""
_VIA = """left join personphone f on f.businessentityid = {id}
  left join phonenumbertype k on k.phonenumbertypeid = f.phonenumbertypeid
  left join emailaddress m on m.businessentityid = {id}"""

ORACLES["v_employee"] = _over(
    f"""select e.businessentityid, {_PERSON}, e.jobtitle, {_CONTACT}, {_PLACE}
    from employee e join person q using (businessentityid)
    {_AT.format(id='e.businessentityid')} {_VIA.format(id='e.businessentityid')}""",
    "humanresources.employee", "person.person", *_WHERE, *_REACH)

_POSTS = ("humanresources.employee", "person.person", "humanresources.employeedepartmenthistory",
          "humanresources.department")
ORACLES["v_employee_department"] = _over(
    f"""select e.businessentityid, {_PERSON}, e.jobtitle, d.name as department, d.groupname, h.startdate
    from employeedepartmenthistory h join employee e using (businessentityid) join person q using (businessentityid)
    join department d using (departmentid) where h.enddate is null""", *_POSTS)
ORACLES["v_employee_department_history"] = _over(
    f"""select e.businessentityid, {_PERSON}, s.name as shift, d.name as department, d.groupname, h.startdate, h.enddate
    from employeedepartmenthistory h join employee e using (businessentityid) join person q using (businessentityid)
    join department d using (departmentid) join shift s using (shiftid)""", *_POSTS, "humanresources.shift")

ORACLES["v_individual_customer"] = _over(
    f"""select q.businessentityid, {_PERSON}, {_CONTACT}, t.name as addresstype, {_PLACE}
    from customer_ c join person q on q.businessentityid = c.personid
    {_AT.format(id='c.personid')} join addresstype t on t.addresstypeid = b.addresstypeid
    {_VIA.format(id='c.personid')} where c.storeid is null""".replace("customer_", f"({portable('sales.customer')})"),
    "person.person", "person.addresstype", *_WHERE, *_REACH)

_DESCRIBED = """select p_partkey as productid, p_name as name, 'Model ' || p_brand as productmodel, c.cultureid,
    p_name || ' by ' || p_brand as description
    from part join (select 'en' as cultureid union all select 'fr') c on c.cultureid = 'en' or p_size > 25"""
ORACLES["v_product_and_description"] = _DESCRIBED
ORACLES["v_materialized_refresh"] = _DESCRIBED

ORACLES["v_sales_person"] = _over(
    f"""select s.businessentityid, {_PERSON}, e.jobtitle, {_CONTACT}, {_PLACE}, g.name as territoryname,
      g."group" as territorygroup, s.salesquota, s.salesytd, s.saleslastyear
    from salesperson s join employee e using (businessentityid) join person q using (businessentityid)
    {_AT.format(id='s.businessentityid')} left join salesterritory g on g.territoryid = s.territoryid
    {_VIA.format(id='s.businessentityid')}""",
    "sales.salesperson", "humanresources.employee", "person.person", "sales.salesterritory", *_WHERE, *_REACH)

_FISCAL = f"""
  select {BASE} + s_suppkey as salespersonid, substr(s_name, 1, 8) || ' ' || substr(s_name, 10, 9) as fullname,
         'Rep ' || s_nationkey as jobtitle, n_name as salesterritory,
         sum(cast(o_totalprice as decimal(19,4))) as salestotal, {_FY} as fiscalyear
  from orders join supplier on s_suppkey = o_custkey % 10 join nation on n_nationkey = s_nationkey
  where o_orderpriority <> '1-URGENT' and s_acctbal >= 0 group by 1, 2, 3, 4, 6"""
ORACLES["v_fiscal_data"] = f"""select salespersonid, fullname, jobtitle, salesterritory,
    cast(salestotal as decimal(29,4)) as salestotal, cast(fiscalyear as int) as fiscalyear from ({_FISCAL})"""
ORACLES["v_fiscal_pivot"] = "select salespersonid, fullname, jobtitle, salesterritory, " + ", ".join(
    f"cast(sum(salestotal) filter (where fiscalyear = {y}) as decimal(24,4)) as fy{y}" for y in (1997, 1998, 1999)
) + f" from ({_FISCAL}) group by 1, 2, 3, 4"

ORACLES["v_state_province_country_region"] = """
select n_nationkey as stateprovinceid, 'S' || n_nationkey as stateprovincecode,
       n_nationkey = n_regionkey as isonlystateprovinceflag, n_name as stateprovincename, n_nationkey as territoryid,
       'C' || n_regionkey as countryregioncode, r_name as countryregionname
from nation join region on r_regionkey = n_regionkey"""

for _name, _table in (("store", "sales.store"), ("vendor", "purchasing.vendor")):
    ORACLES[f"v_{_name}_with_contacts"] = _over(
        f"""select o.businessentityid, o.name, t.name as contacttype, {_PERSON}, {_CONTACT}
        from {_name} o join businessentitycontact c using (businessentityid) join contacttype t using (contacttypeid)
        join person q on q.businessentityid = c.personid {_VIA.format(id='c.personid')}""",
        _table, "person.businessentitycontact", "person.contacttype", "person.person", *_REACH)
    ORACLES[f"v_{_name}_with_addresses"] = _over(
        f"""select o.businessentityid, o.name, t.name as addresstype, {_PLACE}
        from {_name} o {_AT.format(id='o.businessentityid')} join addresstype t using (addresstypeid)""",
        _table, "person.addresstype", *_WHERE)

ORACLES["v_additional_contact_info"] = f"""
with c as (select *, c_mktsegment <> 'BUILDING' as has, c_mktsegment <> 'BUILDING' and c_acctbal > 5000 as mail from customer)
select c_custkey as businessentityid, substr(c_name, 1, 8) as firstname,
       case when c_mktsegment <> 'MACHINERY' then substr(c_mktsegment, 1, 1) end as middlename,
       substr(c_name, 10, 9) as lastname, case when has then '555-' || c_custkey end as telephonenumber,
       case when has then 'call ' || lower(c_mktsegment) end as telephonespecialinstructions,
       case when has then 'Street ' || c_nationkey end as street, case when has then 'City ' || c_nationkey end as city,
       case when has then 'S' || c_nationkey end as stateprovince, case when has then cast(c_custkey as varchar) end as postalcode,
       case when has then 'C' || c_nationkey % 5 end as countryregion,
       case when has then 'ring <b>twice</b>' end as homeaddressspecialinstructions,
       case when mail then 'm' || c_custkey || '@example.org' end as emailaddress,
       case when mail then 'urgent only' end as emailspecialinstructions,
       case when mail then '999-' || c_custkey end as emailtelephonenumber,
       'g' || c_custkey as rowguid, date '2001-01-01' as modifieddate
from c
union all
select {BASE} + s_suppkey, substr(s_name, 1, 8), null, substr(s_name, 10, 9), null, null, null, null, null, null, null,
       null, null, null, null, 'h' || s_suppkey, date '2001-01-01'
from supplier"""

ORACLES["v_person_demographics"] = """
select c_custkey as businessentityid, cast(cast(c_acctbal as decimal(12,2)) as decimal(19,4)) as totalpurchaseytd,
       make_date(1998, 1 + c_nationkey % 9, 15) as datefirstpurchase, make_date(1950 + c_nationkey, 3, 2) as birthdate,
       'M' as maritalstatus, c_mktsegment as yearlyincome, case when c_nationkey % 2 = 0 then 'F' else 'M' end as gender,
       c_nationkey % 5 as totalchildren, c_nationkey % 3 as numberchildrenathome,
       'Bachelors <' || c_nationkey || '>' as education, 'R&D <' || lower(c_mktsegment) || '>' as occupation, c_acctbal > 0 as homeownerflag,
       case when c_mktsegment <> 'MACHINERY' then c_nationkey % 4 end as numbercarsowned
from customer where c_mktsegment <> 'FURNITURE'"""

ORACLES["v_job_candidate"] = """
with c as (select *, c_mktsegment <> 'BUILDING' as has from customer)
select c_custkey as jobcandidateid, case when c_acctbal >= 0 then c_custkey end as businessentityid,
       case when has then 'Mx.' end as name_prefix, case when has then substr(c_name, 1, 8) end as name_first,
       case when has then substr(c_mktsegment, 1, 1) end as name_middle, case when has then substr(c_name, 10, 9) end as name_last,
       case when has then 'Jr. – ' || c_nationkey end as name_suffix, case when has then lower(c_mktsegment) || ' & sales' end as skills,
       case when has then 'Home' end as addr_type, case when has then 'C' || c_nationkey % 5 end as addr_loc_countryregion,
       case when has then 'S' || c_nationkey end as addr_loc_state, case when has then 'City ' || c_nationkey end as addr_loc_city,
       case when has then 'P' || c_custkey end as addr_postalcode, case when has then 'c' || c_custkey || '@example.com' end as email,
       case when has then 'https://example.com/?a=1&c=' || c_custkey end as website, date '2001-01-01' as modifieddate
from c"""

ORACLES["v_job_candidate_employment"] = """
with j as (
  select *, date '1991-06-01' as d, date '1992-07-31' as e from customer where c_acctbal > 0
  union all select *, date '1993-06-01', null from customer where c_acctbal > 5000)
select c_custkey as jobcandidateid, d as emp_startdate, e as emp_enddate, c_name as emp_orgname,
       c_mktsegment as emp_jobtitle, 'kept <ledgers> of ' || c_name as emp_responsibility,
       'F' || c_nationkey % 4 as emp_functioncategory, 'I&T' as emp_industrycategory,
       'C' || c_nationkey as emp_loc_countryregion, 'S' || c_nationkey as emp_loc_state,
       'City ' || c_nationkey as emp_loc_city
from j where c_mktsegment <> 'BUILDING'"""

ORACLES["v_job_candidate_education"] = """
select c_custkey as jobcandidateid, 'Bachelor' as edu_level, date '1986-09-15' as edu_startdate,
       make_date(1990, 5, 20 + c_nationkey % 10) as edu_enddate, c_mktsegment as edu_degree, 'Trade & ' || lower(c_mktsegment) as edu_major,
       case when c_acctbal > 2500 then 'M' || c_nationkey end as edu_minor, '3.5' as edu_gpa,
       '4' as edu_gpascale, 'School ' || c_nationkey as edu_school,
       'C' || c_nationkey % 5 as edu_loc_countryregion, 'S' || c_nationkey as edu_loc_state,
       'Town ' || c_nationkey as edu_loc_city
from customer where c_mktsegment <> 'BUILDING'"""

ORACLES["v_product_model_catalog"] = "select p_partkey as productmodelid, 'Model ' || p_brand as name, " + ", ".join(
    f"{value} as {name}" for name, value in {
        "summary": "p_name || ' of '", "manufacturer": "p_brand", "copyright": "'© ' || p_brand",
        "producturl": "'https://example.com/?p=' || p_partkey || '&l=en'",
        "warrantyperiod": "p_size || ' months'", "warrantydescription": "'parts <and> labour'",
        "noofyears": "p_size % 10 || ' years'", "maintenancedescription": "'by '", "wheel": "'Strong '",
        "saddle": "' seat of ' || p_type", "pedal": "'<Top> grip ' || p_brand", "bikeframe": "'frame'",
        "crankset": "p_brand || ' \"crank\"'", "pictureangle": "'front'",
        "picturesize": "case when p_size > 20 then 'large' else 'small' end",
        "productphotoid": "cast(p_partkey as varchar)", "material": "case when p_size > 25 then 'steel' end",
        "color": "substr(p_name, 1, 3)", "productline": "p_type", "style": "'S' || p_size % 4",
        "riderexperience": "'novice to ' || p_brand",
    }.items()) + (
    ", 'm' || p_partkey as rowguid, date '2001-01-01' as modifieddate from part where p_type <> 'ECONOMY'")

ORACLES["v_product_model_instructions"] = """
with s as (
  select *, 10 as l, cast(null as decimal(9,4)) as setup, cast(2.5 as decimal(9,4)) as labor,
         cast(1.75 as decimal(9,4)) as machine, p_size as lot, 'Take ' as t from part
  union all select *, 10, null, 2.5, 1.75, p_size, p_name from part
  union all select *, 20, 0.25, null, null, null, 'Pack ' || p_type from part)
select p_partkey as productmodelid, 'Model ' || p_brand as name, 'Manual ' || p_partkey as instructions,
       l as locationid, setup as setuphours, machine as machinehours, labor as laborhours,
       lot as lotsize, t as step, 'm' || p_partkey as rowguid, date '2001-01-01' as modifieddate
from s where p_type <> 'SMALL'"""

ORACLES["v_store_with_demographics"] = f"""
select {BASE} + s_suppkey as businessentityid, s_name as name,
       cast(cast(s_acctbal as decimal(12,2)) as decimal(19,4)) as annualsales,
       cast(cast(s_acctbal as decimal(12,2)) as decimal(19,4)) as annualrevenue, 'Bank ' || s_nationkey as bankname, 'BM' as businesstype,
       cast(1970 + s_nationkey as int) as yearopened, '<Road> ' || s_nationkey % 3 as specialty,
       cast(1000 + s_nationkey as int) as squarefeet,
       case when s_nationkey > 12 then '4+' else 'One' end as brands, 'T' || s_nationkey % 4 as internet,
       cast(s_nationkey + 2 as int) as numberemployees
from supplier where s_acctbal >= 0"""

ORACLES["v_hierarchy"] = """
with c as (
  select 'C' || c_custkey as name, '/' || n_regionkey || '/' || n_nationkey || '/' as up,
         '/' || (c_custkey // 1104 // 1104) % 1104 || '/' || (c_custkey // 1104) % 1104 || '/' || c_custkey % 1104 || '/' as rest
  from customer join nation on c_nationkey = n_nationkey),
n as (select n_nationkey, n_regionkey, n_name, count(c_custkey) as k
      from nation left join customer on c_nationkey = n_nationkey group by 1, 2, 3)
select 'company' as name, '/' as path, null as parent_path, 0 as depth,
       (select count(*) from region) + (select count(*) from n) + (select count(*) from c) as descendants
union all
select r_name as name, '/' || r_regionkey || '/' as path, '/' as parent_path, 1 as depth,
       cast(count(n_nationkey) + coalesce(sum(k), 0) as bigint) as descendants
from region left join n on n_regionkey = r_regionkey group by r_name, r_regionkey
union all
select n_name, '/' || n_regionkey || '/' || n_nationkey || '/', '/' || n_regionkey || '/', 2, k from n
union all
select name, up || substr(rest, 2), regexp_replace(up || substr(rest, 2), '[^/]+/$', ''), 5, 0 from c"""

ORACLES["v_shorthand"] = " union all ".join(
    f"select '{t}' as table_name, count(*) as n_rows, cast(sum({k}) as bigint) as id_sum, count(*) as same from {t}"
    for t, k in {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
                 "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id",
                 "documents": "doc_id", "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id",
                 "labels": "doc_id", "conversations": "conv_id"}.items())

# --- daily runs ----------------------------------------------------------------------------

_MOVED = """moved as (
  select o_orderkey, strftime(o_orderdate, '%Y-%m') = '1997-06' as late,
         case when strftime(o_orderdate, '%Y-%m') = '1997-06' then date '1997-07-15' else cast(o_orderdate as date) end as d
  from orders),
sold as (
  select d, strftime(d, '%Y-%m') as month, p_size % 5 as category,
         cast(cast(l_extendedprice as decimal(19,4)) * cast(cast(l_quantity as int) as decimal(9,0)) as decimal(18,2)) as revenue
  from lineitem join moved on l_orderkey = o_orderkey left join part on l_partkey = p_partkey)"""

ORACLES["g_incremental_day"] = f"""
with {_MOVED},
fact as (select month, count(*) as n, sum(revenue) as revenue from sold group by 1),
mart as (select month, count(*) as n, sum(revenue) as revenue
         from (select month, d, category, sum(revenue) as revenue from sold group by all) group by 1),
both_ as (select 'FactSales' as name, * from fact union all select 'agg_daily_sales', * from mart)
select name, month, n as n_rows, cast(revenue as decimal(18,2)) as revenue, month = '1997-07' as rebuilt,
       (select count(*) from moved where late) as landed
from both_"""

ORACLES["d_late_versions"] = """
with part3 as (select p_partkey, p_partkey % 3 as m, p_partkey % 5 = 0 as late, cast(p_retailprice as decimal(19,4)) as price from part),
v as (
  select p_partkey, price + m as price, date '1995-01-01' as vf,
         case when late then date '1997-07-01' when m > 0 then date '1998-01-01' end as vt from part3
  union all
  select p_partkey, price + 7, date '1997-07-01', case when m > 0 then date '1998-01-01' end from part3 where late
  union all
  select p_partkey, price + 2 * m, date '1998-01-01', date '1999-01-01' from part3 where m > 0
  union all
  select p_partkey, price + 3 * m, date '1999-01-01', null from part3 where m > 0)
select p_partkey as "ProductID", cast(price as decimal(18,2)) as "ListPrice", vf as "ValidFromDate", vt as "ValidToDate",
       vt is null as "IsCurrent"
from v"""

ORACLES["d_dense_keys"] = """
with n as (select count(*) as parts, count(*) filter (where p_partkey % 3 > 0) as moved from part),
c as (select 1 as run, parts as k from n union all select 2, parts + moved from n union all select 3, parts + moved from n)
select cast(run as int) as run, k as versions, k as keys, cast(1 as bigint) as least, k as largest, k as starts from c"""

ORACLES["k1_sales_by_price"] = """
with o as (
  select l_partkey as p, cast(l_shipdate as date) as d,
         max(cast(l_discount as decimal(3,2)) + 1) filter (where l_linestatus = 'O') as a,
         max(cast(l_tax as decimal(3,2)) + 1) filter (where l_linestatus = 'F') as b
  from lineitem group by 1, 2),
f as (
  select p, d, last_value(a ignore nulls) over w as a, last_value(b ignore nulls) over w as b from o
  window w as (partition by p order by d rows unbounded preceding)),
own as (select p_partkey, cast(cast(p_retailprice as decimal(19,4)) as decimal(18,2)) as price, cast(p_size as decimal(18,2)) as cost from part),
e as (
  select p, d, coalesce(cast(a as decimal(18,2)), price) as a, coalesce(cast(b as decimal(18,2)), cost) as b
  from f join own on p_partkey = p
  union all
  select p_partkey, date '1995-01-01', price, cost from own),
m as (select *, row_number() over w as rn, lag(a) over w as a0, lag(b) over w as b0 from e window w as (partition by p order by d)),
s as (select * from m where rn = 1 or a <> a0 or b <> b0),
v as (select p, a, b, d as vf, lead(d) over (partition by p order by d) as vt from s),
sold as (
  select l_partkey, cast(o_orderdate as date) as d,
         cast(cast(l_extendedprice as decimal(19,4)) * cast(cast(l_quantity as int) as decimal(9,0)) as decimal(18,2)) as revenue
  from lineitem join orders on l_orderkey = o_orderkey)
select p as "ProductID", a as "ListPrice", b as "Cost", vf as "ValidFromDate", count(*) as sales,
       cast(sum(revenue) as decimal(18,2)) as revenue
from sold left join v on p = l_partkey and d >= vf and (vt is null or d < vt)
group by 1, 2, 3, 4"""

ORACLES["q_retry_run"] = """
with bad as (select p_partkey % 2 = 0 as mended from part where p_partkey % 7 = 0 and p_retailprice > 0),
kinds as (select 'negative' as k, 'Negative values in listprice' as m union all select 'check', 'Check failed: CK_Product_ListPrice')
select 'production.product' as "SourceTable", k as "ErrorType", m as "ErrorMessage", mended as "IsResolved",
       cast(case when mended then 1 else 2 end as int) as "RetryCount",
       case when mended then 'passed on retry' end as "ResolutionComment", count(*) as records,
       case when mended then date '2002-01-02' else date '2002-01-03' end as last_attempt
from bad cross join kinds group by all"""

ORACLES["j_band_index"] = """
with b as (select distinct cast(cast(o_totalprice as decimal(14,2)) * 100 as bigint) as low from orders),
l as (select cast(cast(l_extendedprice as decimal(14,2)) * 100 as bigint) as price,
             cast(cast(l_quantity as decimal(14,2)) * 100 as bigint) as quantity from lineitem)
select low as band, count(*) as n_lines, cast(sum(quantity) as bigint) as quantity
from l left join b on price between low and low + 1999 group by 1"""

ORACLES["p_computed"] = """
with l as (
  select 'SO' || l_orderkey as salesordernumber,
         'AW' || case when length(cast(l_suppkey as varchar)) >= 8 then cast(l_suppkey as varchar) else lpad(cast(l_suppkey as varchar), 8, '0') end as accountnumber,
         coalesce(cast(l_extendedprice as decimal(19,4)) + case when l_linestatus = 'O' then cast(l_tax as decimal(19,4)) end
                  + cast(l_discount as decimal(19,4)), 0) as due,
         coalesce(cast(l_quantity as decimal(8,2)) - case when l_returnflag <> 'N' then cast(1 as decimal(8,2)) end, 0) as stocked,
         case when l_returnflag <> 'R' then l_tax end as share
  from lineitem)
select salesordernumber, accountnumber, count(*) as n_lines, cast(sum(due) as decimal(19,4)) as totaldue,
       cast(sum(stocked) as decimal(18,2)) as stockedqty, count(share) as shares
from l group by 1, 2"""

ORACLES["q_numeric_type"] = """
select 'orders' as table_name, 'numeric_' || c as rule, 'Bad numeric type: ' || c as message, n as violations
from (select 'o_orderkey' as c, cast(0 as bigint) as n
      union all select 'o_rank', count(*) from orders where try_cast(substr(o_orderpriority, 1, 1) as smallint) is null and o_orderpriority is not null
      union all select 'o_amount', count(*) from orders where o_custkey % 10 = 0
      union all select 'o_code', count(*) from orders where o_orderstatus is not null and try_cast(o_orderstatus as int) is null)"""
