"""The test tables brought into the shape of the raw retail files.

Errors are planted by arithmetic on keys, so that plain SQL can plant the same
ones. All columns are text, as in a file.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.text import missing_to_null
from ledgerloom.rules import Rules
from ledgerloom.schemas import raw_columns
from ledgerloom.session import input_bytes

RULES = Rules(
    as_of=date(2001, 6, 30),
    leakage_cutoff=date(2001, 7, 1),
    join_date_limit=date(2001, 6, 30),
    join_date_default=date(2001, 1, 1),
    period_before=(1996, 1997),
    period_after=(1999, 2000),
)

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_QUARTER = "(year(d) - 1995) * 4 + quarter(d)"

# Sales lines in whole cents, one row per line item, errors planted.
_LINES = f"""
with lines as (
  select l_orderkey as k, l_partkey, l_suppkey, o_custkey, o_orderpriority as priority,
    cast(o_orderdate as date) as d,
    cast(round(p_retailprice * 100) as bigint) as price_c,
    cast(l_quantity as bigint) * case when l_returnflag = 'R' and l_orderkey % 7 = 0 then -1
      when l_orderkey % 401 = 7 then 100 else 1 end as qty,
    case when l_orderkey % 419 = 9 then 150 when l_orderkey % 421 = 10 then -5
      else cast(round(l_discount * 100) as bigint) end as disc
  from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
    join {{part}} on l_partkey = p_partkey
), priced as (
  select *, case when k % 409 = 8 then price_c div 100 else price_c end as sale_c,
    {_QUARTER} as qn
  from lines
)
select *, sale_c * qty as gross_c,
  cast(rint(sale_c * qty * (100 - disc) / 100D) as bigint) as net_c
from priced
"""


def _cents(expression: str) -> str:
    return f"cast(cast(({expression}) * 0.01BD as decimal(18,2)) as string)"


_SALES = f"""
select concat('T', k) as transaction_id, concat('INV', k) as invoice_number,
  case when k % 499 = 1 then 'not-a-date' else cast(d as string) end as date_id,
  case when k % 311 = 2 then '99' else cast(o_custkey % 5 + 1 as string) end as store_id,
  case when k % 53 = 3 then null when k % 307 = 4 then '999999' when k % 911 = 4 then 'E-77'
    when k % 929 = 5 then '12.001' when k % 3 = 0 then concat(l_suppkey, '.0') else cast(l_suppkey as string) end as employee_id,
  case when k % 313 = 5 then '9999999' when k % 907 = 3 then 'XYZ-9' when l_partkey % 2 = 0 then concat(l_partkey, '.0')
    else cast(l_partkey as string) end as product_id,
  cast(o_custkey as string) as customer_id,
  case when k % 35 = 6 then cast(qn + 1 as string) when k % 5 = 1 then cast(qn as string) end
    as promotion_id,
  case when k % 919 = 6 then '3000000000' else cast(qty as string) end as quantity,
  concat({_cents("sale_c")}, case when k % 937 = 7 then '5' else '' end) as unit_price,
  case when k % 941 = 8 then '123456' else cast(disc as string) end as discount_pct,
  {_cents("gross_c + case when k % 431 = 11 then 1000 else 0 end")} as gross_amount,
  {_cents("net_c + case when k % 433 = 12 then 1000 else 0 end")} as net_amount,
  case substr(priority, 1, 1) when '1' then 'Cash' when '2' then 'Card' when '3' then 'UPI'
    when '4' then case k % 3 when 0 then ' cash ' when 1 then 'CARD' else 'upi ' end
    else case when k % 6 = 0 then 'NA' when k % 3 = 0 then null else 'Cash' end end as payment_mode
from {{sale_lines}}
  lateral view explode(case when k % 211 = 0 then array(1, 2) else array(1) end) as c
"""

_STOCK = """
with events as (
  select l_partkey, cast(o_orderdate as date) as d, l_orderkey as k,
    l_orderkey * 1000000 + l_partkey as id, cast(sum(l_quantity) as bigint) as sold
  from {lineitem} join {orders} on l_orderkey = o_orderkey
  group by l_partkey, cast(o_orderdate as date), l_orderkey
)
select cast(id as string) as stock_event_id, cast(d as string) as date_id,
  case when l_partkey % 2 = 0 then concat(l_partkey, '.0') else cast(l_partkey as string) end
    as product_id,
  case when id % 29 = 0 then 'Stockout' else 'Sale' end as event_type,
  cast(-sold as string) as quantity_change,
  cast(5000 - sum(sold) over (partition by l_partkey order by d, id)
    + case when id % 17 = 0 then 40 else 0 end as string) as stock_on_hand
from events
"""

_PURCHASES = """
with orders_in as (
  select o_orderkey as k, o_custkey as c, o_orderkey % (select count(*) from {part}) as p,
    cast(o_orderdate as date) as d,
    date_add(cast(o_orderdate as date), cast(
      case when o_orderkey % 61 = 0 then -(o_custkey % 60) else o_custkey % 60 end as int)) as a
  from {orders}
)
select cast(k as string) as po_id, cast(p as string) as product_id,
  cast(d as string) as order_date,
  cast(date_add(least(d, a), p_size) as string) as expected_delivery_date,
  cast(a as string) as actual_delivery_date,
  case when k % 71 = 1 then 'abc' else cast(50 + c % 100 as string) end as quantity_ordered,
  cast(50 + c % 100 + case when k % 67 = 0 then 5 else 0 end as string) as quantity_received,
  'Delivered' as po_status
from orders_in join {part} on p = p_partkey
"""

_SETTLEMENTS = """
with modes as (
  select d, case substr(priority, 1, 1) when '1' then 'CASH' when '2' then 'CARD'
      when '3' then 'UPI'
      when '4' then case k % 3 when 0 then 'CASH' when 1 then 'CARD' else 'UPI' end
      else case when k % 3 = 0 then 'UNKNOWN' else 'CASH' end end as mode,
    net_c
  from {sale_lines}
), days as (
  select d, mode, sum(net_c) as net_c from modes
  where not (mode = 'UPI' and day(d) % 13 = 0) group by d, mode
)
select cast(datediff(d, date'1990-01-01') * 10 + case mode when 'CASH' then 1 when 'CARD' then 2
    when 'UPI' then 3 else 4 end as string) as settlement_id,
  cast(d as string) as date_id, concat(' ', mode) as payment_mode,
  cast(cast((net_c + case when day(d) % 9 = 0 then 700 else 0 end) * 0.01BD as decimal(18,2))
    as string) as gross_amount_settled,
  'Settled' as settlement_status
from days
"""

_OPEX = """
with months as (select distinct trunc(cast(o_orderdate as date), 'MM') as m from {orders}),
numbered as (select m, year(m) as y, month(m) as mo, kind from months
  lateral view explode(array(1, 2, 3)) as kind)
select cast((y * 100 + mo) * 10 + kind as string) as opex_id,
  date_format(m, 'MMM-yy') as month,
  case kind when 1 then 'Salary-Permanent' when 2 then 'Salary-Seasonal' else 'Rent' end
    as expense_type,
  case when kind = 3 and y * 100 + mo = 199501 then '20000000000.00'
    else cast(20000 + 1000 * mo + 10 * kind as string) end as amount,
  case kind when 1 then cast((y - 1994) * 12 + mo as string)
    when 2 then case when mo in (10, 11) then '14' else '2' end end as headcount,
  cast(mo % 5 + 1 as string) as store_id
from numbered
"""

_PROMOTIONS = f"""
with quarters as (
  select {_QUARTER} as qn, min(d) as first_day, max(d) as last_day
  from (select cast(o_orderdate as date) as d from {{orders}}) group by {_QUARTER}
)
select cast(qn as string) as promotion_id, concat('Promo ', qn) as promotion_name,
  cast(case when qn % 5 = 0 then last_day else first_day end as string) as start_date,
  cast(case when qn % 5 = 0 then first_day else last_day end as string) as end_date,
  'ALL' as target_category,
  case when qn % 7 = 3 then '150' when qn % 7 = 5 then '-5' else cast(qn as string) end
    as discount_pct
from quarters
"""

_PRODUCTS = f"""
select cast(p_partkey as string) as product_id, p_type as category, 'General' as subcategory,
  case when p_partkey % 45 = 7 then concat(p_name, chr(10), '"in two", lines') else p_name end
    as item_name,
  case when p_partkey % 40 = 1 then ' rcm' else p_brand end as brand_name,
  'Mid' as price_tier, concat('HUB', p_size % 5) as manufacturing_hub,
  'Central' as distribution_hub, cast(p_size as string) as lead_time_days,
  {_cents('''cast(round(p_retailprice * 100) as bigint)
    * case when p_partkey % 50 = 0 then 12 else 6 end div 10''')} as unit_cost,
  {_cents("cast(round(p_retailprice * 100) as bigint)")} as unit_price,
  '5208' as hsn_code,
  case p_partkey % 6 when 0 then '0' when 1 then '5' when 2 then '12' when 3 then '18'
    when 4 then '28' else '7.5' end as gst_rate
from {{part}}
"""

_CUSTOMERS = """
select cast(c_custkey as string) as customer_id, c_mktsegment as customer_type,
  n_name as home_area,
  cast(date_add(date'1995-01-01', cast(c_custkey % 700 as int)) as string) as first_purchase_date,
  'General' as preferred_category
from {customer} join {nation} on c_nationkey = n_nationkey
"""

_EMPLOYEES = """
select cast(s_suppkey as string) as employee_id,
  case s_suppkey % 4 when 0 then 'Sales Staff' when 1 then 'Cashier'
    when 2 then 'Stock/Godown Staff' else 'Manager' end as role,
  case when s_suppkey % 10 = 9 then 'Seasonal' else 'Permanent' end as employment_type,
  cast(case when s_suppkey % 37 = 5 then 90000 else 10000 + (s_suppkey * 131) % 9000 end as string)
    as monthly_salary,
  cast(date_add(date'1994-01-01', cast(s_suppkey % 100 as int) * 30) as string) as join_date,
  cast(s_suppkey % 5 + 1 as string) as store_id
from {supplier}
"""

_STORES = """
select cast(r_regionkey + 1 as string) as store_id, r_name as store_name,
  'Shop' as store_type,
  case when r_regionkey = 4 then repeat('Main Street ', 5)
    when r_regionkey = 2 then concat('Gate 2,', chr(10), chr(10), 'near "The Arch"')
    else 'Main Street' end as location
from {region}
"""

# The months of the Tamil calendar by the civil month they begin in.
TAMIL_MONTHS = (
    "Thai", "Maasi", "Panguni", "Chithirai", "Vaikasi", "Aani",
    "Aadi", "Aavani", "Purattasi", "Aippasi", "Karthigai", "Margazhi",
)

_CALENDAR = f"""
select d as date_id, year(d) as year, month(d) as month, day(d) as day,
  date_format(d, 'EEEE') as day_of_week, dayofweek(d) = 1 as is_weekend_sunday,
  element_at(array({", ".join(f"'{m}'" for m in TAMIL_MONTHS)}), month(d)) as tamil_month,
  case month(d) when 1 then 'Pongal' when 4 then 'Tamil New Year' when 11 then 'Deepavali' end
    as festival_name,
  case when month(d) in (10, 11) then 'Festival' when month(d) = 7 then 'Discount'
    else 'Regular' end as season_tag
from (select distinct cast(o_orderdate as date) as d from {{orders}})
"""

_RAW = {
    "fact_sales": _SALES,
    "dim_product": _PRODUCTS,
    "dim_employee": _EMPLOYEES,
    "dim_promotion": _PROMOTIONS,
    "fact_purchase_order": _PURCHASES,
    "fact_stock": _STOCK,
    "dim_customer": _CUSTOMERS,
    "fact_payment_settlement": _SETTLEMENTS,
    "dim_store": _STORES,
    "fact_opex": _OPEX,
}


def packed_bytes(spark: SparkSession, sf_dir: str) -> int:
    return sum(input_bytes(spark, f"{sf_dir}/{t}.parquet") for t in _TABLES)


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores when a table is fewer files than there are cores. The number of partitions is
    left to the optimizer, so that it grows with the table and not with the cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(key) if len(df.inputFiles()) < cores else df


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    found = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES}
    for table, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        found[table] = _spread(found[table], key)
    found["sale_lines"] = spark.sql(_LINES, **found)
    return found


def file_text(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The ten raw tables exactly as they would stand in a file."""
    found = _sources(spark, sf_dir)
    return {t: spark.sql(text, **found).select(*raw_columns(t)) for t, text in _RAW.items()}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The ten raw tables as a scan gives them: missing tokens are NULL."""
    return {t: missing_to_null(df) for t, df in file_text(spark, sf_dir).items()}


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar table, which arrives typed and clean."""
    return spark.sql(_CALENDAR, **_sources(spark, sf_dir))
