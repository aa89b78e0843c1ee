"""DuckDB twins of the registered queries."""

from __future__ import annotations

from ..operators import seasonal_css
from ..operators.quality import NO_SOURCE_ID, STALE_SOURCE
from .oracle_base import CUSTOMERS, exact_sum, half_even, half_up, half_up_double, rank, with_customers, with_raw, with_sales

ORACLE: dict[str, str] = {}

CUSTOMER = """first_name as "First_Name", last_name as "Last_Name", full_name as "Full_Name", gender as "Gender",
  education as "Education", marital_status as "Marital_Status", income as "Income",
  months_as_member as "Months_As_Member", loyaltystatus as "LoyaltyStatus", """
PLACE = """country as "Country", province_state as "Province_State", city as "City", postal_code as "Postal_Code",
  latitude as "Latitude", longitude as "Longitude", location_type as "Location_Type" """

ORACLE["clean_sales"] = with_sales(f"""
select customer_id as "Customer_ID", {CUSTOMER} clv as "CLV", {PLACE}, year as "Year", quarter as "Quarter",
  product_line as "Product_Line", coupon_response as "Coupon_Response", order_count as "Order_Count",
  quantity_sold as "Quantity_Sold", unit_sale_price as "Unit_Sale_Price", unit_cost as "Unit_Cost", revenue as "Revenue",
  income_flag as "Income_Flag", is_full_year as "Is_Full_Year"
from s""")

ORACLE["enrich_sales"] = with_sales(f"""
select customer_id as "Customer_ID", {CUSTOMER} clv as "CLV", {PLACE}, year as "Year", quarter as "Quarter",
  product_line as "Product_Line", coupon_response as "Coupon_Response", order_count as "Order_Count",
  quantity_sold as "Quantity_Sold", unit_sale_price as "Unit_Sale_Price", unit_cost as "Unit_Cost",
  revenue as "Revenue", income_flag as "Income_Flag", is_full_year as "Is_Full_Year",
  total_cost as "Total_Cost", profit as "Profit", profit_margin_pct as "Profit_Margin_Pct", atv as "ATV",
  revenue_per_unit as "Revenue_Per_Unit", gross_contribution as "Gross_Contribution",
  year_quarter as "Year_Quarter", quarter_num as "Quarter_Num", date_key as "Date_Key", loyalty_rank as "Loyalty_Rank",
  education_rank as "Education_Rank", income_bucket as "Income_Bucket", tenure_bucket as "Tenure_Bucket",
  region_key as "Region_Key", geo_key as "Geo_Key", clv_segment as "CLV_Segment", coupon_num as "Coupon_Num",
  coupon_popularity_rank as "Coupon_Popularity_Rank"
from s""")

ORACLE["sales_metrics"] = with_sales("""
select customer_id as "Customer_ID", revenue as "Revenue", total_cost as "Total_Cost", profit as "Profit",
  profit_margin_pct as "Profit_Margin_Pct", atv as "ATV", revenue_per_unit as "Revenue_Per_Unit",
  gross_contribution as "Gross_Contribution" from s""")
ORACLE["income_bucket"] = with_sales("""
select income as "Income", income_flag as "Income_Flag", income_bucket as "Income_Bucket", count(*) as rows_
from s group by all""")
ORACLE["tenure_bucket"] = with_sales("""
select months_as_member as "Months_As_Member", tenure_bucket as "Tenure_Bucket", count(*) as rows_ from s group by all""")
ORACLE["clv_segment"] = with_sales("""
select customer_id as "Customer_ID", clv as "CLV", clv_segment as "CLV_Segment", count(*) as rows_ from s group by all""")
ORACLE["coupon_rank"] = with_sales("""
select cr as "Coupon_Response", coupon_popularity_rank as "Coupon_Popularity_Rank" from coupons""")
ORACLE["geo_keys"] = with_sales("""
select region_key as "Region_Key", geo_key as "Geo_Key", count(*) as rows_ from s group by all""")
ORACLE["accepted_quarter_except"] = with_raw("""
select quarter as "Quarter" from raw except select unnest(['Q1', 'Q2', 'Q3'])""")

# -- star schema ---------------------------------------------------------------------------------
DATES = """
select distinct date_key as "Date_Key", last_day(make_date(year, quarter_num * 3, 1)) as "Date", year as "Year",
  quarter as "Quarter", quarter_num as "Quarter_Num", year_quarter as "Year_Quarter", is_full_year as "Is_Full_Year"
from s"""
ORACLE["dim_date"] = with_sales(DATES)
ORACLE["dim_product"] = with_sales(f"""
select row_number() over (order by product_line) as "Product_ID", product_line as "Product_Line",
  round(sum(revenue), 4) as "Total_Revenue", round(sum(profit), 4) as "Total_Profit",
  {half_even("avg(unit_sale_price)")} as "Avg_Unit_Price", {half_even("avg(unit_cost)")} as "Avg_Unit_Cost",
  cast(sum(order_count) as bigint) as "Total_Orders", sum(quantity_sold) as "Total_Qty",
  {half_even("sum(profit) / sum(revenue) * 100", 4)} as "Avg_Profit_Margin_Pct"
from s group by product_line""")
ORACLE["dim_geography"] = with_sales("""
select row_number() over (order by geo_key) as "Geo_ID", geo_key as "Geo_Key", region_key as "Region_Key",
  country as "Country", province_state as "Province_State", city as "City", postal_code as "Postal_Code",
  latitude as "Latitude", longitude as "Longitude", location_type as "Location_Type"
from (select *, row_number() over (partition by geo_key order by region_key, country, province_state, city, postal_code,
  latitude, longitude, location_type) as rn from s) where rn = 1""")
ORACLE["dim_customer"] = with_sales(f"""
select customer_id as "Customer_ID", {CUSTOMER} clv as "CLV", education_rank as "Education_Rank",
  income_flag as "Income_Flag", income_bucket as "Income_Bucket", tenure_bucket as "Tenure_Bucket",
  loyalty_rank as "Loyalty_Rank", clv_segment as "CLV_Segment"
from (select *, row_number() over (partition by customer_id order by clv desc nulls last) as rn from s) where rn = 1""")
ORACLE["fact_sales"] = with_sales("""
select row_number() over (order by customer_id, date_key, product_line, geo_key, coupon_response, order_count,
    quantity_sold, unit_sale_price, unit_cost, revenue, loyaltystatus, income_bucket, tenure_bucket, clv_segment) as "Fact_ID",
  customer_id as "Customer_ID", date_key as "Date_Key", product_line as "Product_Line", region_key as "Region_Key",
  geo_key as "Geo_Key", coupon_response as "Coupon_Response", coupon_num as "Coupon_Num",
  coupon_popularity_rank as "Coupon_Popularity_Rank", order_count as "Order_Count", quantity_sold as "Quantity_Sold",
  unit_sale_price as "Unit_Sale_Price", unit_cost as "Unit_Cost", revenue as "Revenue", total_cost as "Total_Cost",
  profit as "Profit", profit_margin_pct as "Profit_Margin_Pct", atv as "ATV", revenue_per_unit as "Revenue_Per_Unit",
  gross_contribution as "Gross_Contribution", loyaltystatus as "LoyaltyStatus", loyalty_rank as "Loyalty_Rank",
  income_bucket as "Income_Bucket", tenure_bucket as "Tenure_Bucket", clv_segment as "CLV_Segment", year as "Year",
  quarter as "Quarter", quarter_num as "Quarter_Num", year_quarter as "Year_Quarter", is_full_year as "Is_Full_Year",
  product_id as "Product_ID"
from s""")
ORACLE["partition_columns"] = with_sales("""
select 'fact_sales' as table_name, cast(year as varchar) as partition_value, count(*) as row_count from s group by all
union all select 'dim_customer', loyaltystatus, count(distinct customer_id) from s group by all
union all select 'dim_geography', country, count(distinct geo_key) from s group by all""")

# -- aggregates ----------------------------------------------------------------------------------
BASE = """round(sum(revenue), 4) as "Total_Revenue", round(sum(profit), 4) as "Total_Profit",
  cast(sum(order_count) as bigint) as "Total_Orders", sum(quantity_sold) as "Total_Qty",
  round(avg(clv), 4) as "Avg_CLV", count(distinct customer_id) as "Unique_Customers" """
MARGIN = half_even("sum(profit) / nullif(sum(revenue), 0) * 100")
LOYALTY_ORDER = "loyalty_rank"

ORACLE["agg_year_product"] = with_sales(f"""
select year as "Year", product_line as "Product_Line", {BASE}, {MARGIN} as "Profit_Margin_Pct" from s group by 1, 2""")
ORACLE["agg_country_year"] = with_sales(f"""
select country as "Country", year as "Year", {BASE}, {MARGIN} as "Profit_Margin_Pct" from s group by 1, 2""")
ORACLE["agg_edu_product"] = with_sales(f"""
select education as "Education", product_line as "Product_Line", {BASE}, any_value(education_rank) as "Education_Rank"
from s group by 1, 2""")
ORACLE["agg_gender_product"] = with_sales(f"""
select gender as "Gender", product_line as "Product_Line", {BASE} from s group by 1, 2""")
ORACLE["agg_loyalty"] = with_sales(f"""
select loyaltystatus as "LoyaltyStatus", count(distinct customer_id) as "Customer_Count",
  round(sum(revenue), 4) as "Total_Revenue", round(sum(profit), 4) as "Total_Profit",
  {half_even("avg(revenue)")} as "Avg_Revenue", {half_even("avg(clv)")} as "Avg_CLV",
  {half_even("avg(income) filter (where income > 0)")} as "Avg_Income", {half_even("avg(months_as_member)", 1)} as "Avg_Months",
  any_value(loyalty_rank) as "Loyalty_Rank",
  {half_even("sum(revenue) / (select sum(revenue) from s) * 100")} as "Pct_Revenue"
from s group by 1""")
ORACLE["agg_coupon"] = with_sales(f"""
select coupon_response as "Coupon_Response", cast(sum(order_count) as bigint) as "Usage_Count",
  round(sum(revenue), 4) as "Total_Revenue", round(avg(revenue), 4) as "Avg_Revenue",
  round(sum(profit), 4) as "Total_Profit", {MARGIN} as "Profit_Margin_Pct",
  {half_even("sum(revenue) / sum(order_count)")} as "Revenue_Per_Use",
  {half_even("sum(order_count) / (select sum(order_count) from s) * 100")} as "Pct_Usage"
from s group by 1""")
ORACLE["agg_kpi"] = with_sales("""
select * from (
  select unnest([1,2,3,4,5,6,7,8]) as "Position",
    unnest(['Total Revenue ($)', 'Total Profit ($)', 'Overall Profit Margin (%)', 'Total Transactions', 'Unique Customers',
      'Avg CLV ($)', 'Avg Revenue per Transaction ($)', 'Avg Revenue per Customer ($)']) as "Metric",
    unnest([format('{:,.0f}', r), format('{:,.0f}', p), format('{:.2f}', m), format('{:,}', o), format('{:,}', c),
      format('{:,.2f}', clv), format('{:,.2f}', atv), format('{:,.2f}', rc)]) as "Value",
    unnest([round(r,2), round(p,2), round(m,2), o, c, round(clv,2), round(atv,2), round(rc,2)]) as "Numeric_Value"
  from (select sum(revenue) as r, sum(profit) as p, sum(profit) / sum(revenue) * 100 as m, cast(sum(order_count) as bigint) as o,
      count(distinct customer_id) as c, avg(clv) as clv, avg(atv) as atv, sum(revenue) / count(distinct customer_id) as rc from s))
union all select 9, 'Top Product Line (Revenue)', (select product_line from s group by 1 order by sum(revenue) desc, 1 limit 1), null
union all select 10, 'Top Country (Revenue)', (select country from s group by 1 order by sum(revenue) desc, 1 limit 1), null
union all select 11, 'Top LoyaltyStatus (Revenue)', (select loyaltystatus from s group by 1 order by sum(revenue) desc, 1 limit 1), null""")

# -- marts ---------------------------------------------------------------------------------------
PCT = "round(sum(profit) / nullif(sum(revenue), 0) * 100, 2)"
MARTS = f"""{CUSTOMERS},
sales_by_product as (
  select product_line, count(*) as transaction_rows, cast(sum(order_count) as bigint) as total_orders,
    sum(quantity_sold) as total_quantity, {half_up(exact_sum("revenue"))} as total_revenue, {half_up(exact_sum("profit"))} as total_profit,
    {PCT} as profit_margin_pct from s group by 1),
sales_by_quarter as (
  select year, quarter, quarter_num, year_quarter, count(*) as transaction_rows, cast(sum(order_count) as bigint) as total_orders,
    {half_up(exact_sum("revenue"))} as total_revenue, {half_up(exact_sum("profit"))} as total_profit, {PCT} as profit_margin_pct
  from s group by 1, 2, 3, 4),
sales_by_loyalty as (
  select s.loyaltystatus, s.loyalty_rank, count(distinct s.customer_id) as unique_customers, count(*) as transaction_rows,
    {half_up(exact_sum("revenue"))} as total_revenue, {half_up(exact_sum("profit"))} as total_profit, {half_up_double(f"cast({exact_sum('c.clv')} as double) / nullif(count(c.clv), 0)")} as avg_clv,
    {half_up_double(f"cast({exact_sum('revenue')} as double) / nullif(count(distinct s.customer_id), 0)")} as revenue_per_customer
  from s left join dim_customer c on s.customer_id = c.customer_id group by 1, 2),
customer_value as (
  select c.customer_id, c.full_name, c.loyaltystatus, c.loyalty_rank, c.clv, c.clv_segment, c.months_as_member,
    count(s.customer_id) as transaction_rows, cast(coalesce(sum(order_count), 0) as bigint) as total_orders,
    {half_up("coalesce(" + exact_sum("revenue") + ", 0)")} as total_revenue, {half_up("coalesce(" + exact_sum("profit") + ", 0)")} as total_profit,
    max(year_quarter) as last_observed_quarter, max(year * 4 + quarter_num) as last_quarter_idx
  from dim_customer c left join s on c.customer_id = s.customer_id group by 1, 2, 3, 4, 5, 6, 7),
retention_priority as (
  select * exclude (idle, transaction_rows, last_quarter_idx), idle as quarters_since_last_purchase,
    case when idle >= 8 or (clv_segment = 'Top CLV' and total_revenue >= 5000) then 'Critical'
      when idle >= 4 or clv_segment in ('Top CLV', 'High CLV') then 'High Risk'
      when idle >= 2 or total_revenue >= 3000 then 'Medium Risk'
      when total_revenue > 0 then 'Low Risk' else 'Monitor' end as retention_priority
  from (select *, (select max(year * 4 + quarter_num) from s) - last_quarter_idx as idle from customer_value))"""


def with_marts(body: str) -> str:
    return with_sales(body, MARTS)


for name in ("sales_by_product", "sales_by_quarter", "sales_by_loyalty", "customer_value", "retention_priority"):
    ORACLE[name] = with_marts(f"select * from {name}")
ORACLE["churn_priority_customers"] = ORACLE["retention_priority"]

ORACLE["val_row_counts"] = with_marts("""
select 'fact_sales' as table_name, count(*) as row_count from s
union all select 'dim_customer', count(distinct customer_id) from s
union all select 'dim_product', count(distinct product_line) from s
union all select 'dim_date', count(distinct date_key) from s
union all select 'dim_geography', count(distinct geo_key) from s""")
ORACLE["val_freshness"] = with_sales("""
select min(year_quarter) as min_quarter, max(year_quarter) as max_quarter, count(distinct year_quarter) as quarter_count from s""")
ORACLE["val_negative_rows"] = with_sales("select count(*) as invalid_rows from s where revenue < 0 or profit < 0")
ORACLE["val_partition_counts"] = with_sales("""
select cast(year as varchar) as partition_year, count(*) as row_count from s group by 1""")
ORACLE["val_top_products"] = with_marts("""
select product_line, total_revenue from sales_by_product order by total_revenue desc, product_line limit 3""")
ORACLE["val_product_order"] = with_marts("select product_line, total_revenue, total_profit from sales_by_product")
ORACLE["val_recent_quarters"] = with_marts("""
select year_quarter, total_revenue from sales_by_quarter order by year_quarter desc limit 3""")
ORACLE["val_loyalty_order"] = with_marts("""
select loyaltystatus, loyalty_rank, total_revenue, unique_customers from sales_by_loyalty""")
ORACLE["val_top_customers"] = with_marts("""
select customer_id, total_revenue from customer_value order by total_revenue desc, customer_id limit 3""")
ORACLE["val_priority_counts"] = with_marts("""
select retention_priority, count(*) as customers from retention_priority group by 1""")
ORACLE["val_churn_priority_counts"] = ORACLE["val_priority_counts"]

# -- quality -------------------------------------------------------------------------------------
_GRAIN = "customer_id, product_id, date_key, geo_key, revenue, quantity_sold, unit_sale_price"


def _dq(name, level, ok, value, expected, details=""):
    return (f"select '{name}' as check_name, '{level}' as level, case when {ok} then 'PASS' else 'FAIL' end as status, "
            f"cast({value} as varchar) as value, '{expected}' as expected, '{details}' as details from m")


_DQ = [
    *[_dq(f"{t}_required_columns", "ERROR", "true", "'none'", "no missing required columns")
      for t in ("FACT_Sales", "DIM_Customer", "DIM_Product", "DIM_Date")],
    _dq("fact_sales_row_count", "ERROR", "n > 0", "n", "> 0"),
    _dq("fact_sales_unique_fact_id", "ERROR", "dup_id = 0", "dup_id", "0 duplicates"),
    _dq("fact_sales_possible_duplicate_transactions", "WARNING", "dup = 0", "dup", "0 duplicate natural-grain rows",
        NO_SOURCE_ID),
    *[_dq(f"fact_sales_{c}_not_null", "ERROR", f"null_{c} = 0", f"null_{c}", "0 nulls")
      for c in ("Customer_ID", "Product_ID", "Date_Key")],
    _dq("dim_customer_unique_customer_id", "ERROR", "dup_c = 0", "dup_c", "0 duplicates"),
    *[_dq(f"fact_{k}_fk_integrity", "ERROR", f"orphan_{k} = 0", f"orphan_{k}", "0 orphan rows")
      for k in ("customer", "product", "date", "geography")],
    _dq("fact_sales_no_negative_revenue", "ERROR", "neg_r = 0", "neg_r", "0 rows"),
    _dq("fact_sales_no_negative_profit", "ERROR", "neg_p = 0", "neg_p", "0 rows"),
    _dq("fact_sales_accepted_quarter_values", "ERROR", "bad_q = 0", "case when bad_q = 0 then 'none' else cast(bad_q as varchar) end", "Q1, Q2, Q3, Q4 only"),
    _dq("fact_sales_2001_partial_year_flag", "ERROR", "n2001 > 0 and n2001 = flagged",
        "case when n2001 > 0 and n2001 = flagged then 'present' else 'missing_or_invalid' end",
        "2001 rows exist and Is_Full_Year=false"),
    _dq("fact_sales_recent_year_warning", "WARNING", "max_year >= 2001", "max_year", ">= 2001",
        STALE_SOURCE),
]
ORACLE["dq_report"] = with_sales("\nunion all ".join(_DQ), f""",
known_customers as (select distinct customer_id from s), known_products as (select distinct product_id from s),
known_dates as (select distinct date_key from s), known_places as (select distinct geo_key from s),
m as (
  select count(*) as n, count(*) - (select count(*) from (select distinct {_GRAIN} from s)) as dup,
    count(*) filter (customer_id is null) as null_Customer_ID, count(*) filter (product_id is null) as null_Product_ID,
    count(*) filter (date_key is null) as null_Date_Key, count(*) filter (revenue < 0) as neg_r,
    count(*) filter (profit < 0) as neg_p, count(distinct quarter) filter (quarter not in ('Q1', 'Q2', 'Q3', 'Q4')) as bad_q,
    count(*) filter (year = 2001) as n2001, count(*) filter (year = 2001 and not is_full_year) as flagged,
    max(year) as max_year, count(*) - count(distinct fact_id) as dup_id,
    (select count(*) - count(distinct customer_id) from known_customers) as dup_c,
    (select count(*) from s anti join known_customers c on s.customer_id is not distinct from c.customer_id) as orphan_customer,
    (select count(*) from s anti join known_products p on s.product_id is not distinct from p.product_id) as orphan_product,
    (select count(*) from s anti join known_dates d on s.date_key is not distinct from d.date_key) as orphan_date,
    (select count(*) from s anti join known_places g on s.geo_key is not distinct from g.geo_key) as orphan_geography
  from (select *, row_number() over () as fact_id from s) s)""")
_DEFECTS = """,
named as (select *, cast(customer_id as bigint) as num from s),
bad as (
  select num, num * 10000 + year as fact_id, if(num % 97 = 0, null, customer_id) as customer_id,
    if(num % 89 = 1, null, product_id) as product_id, if(num % 83 = 2, null, date_key) as date_key, geo_key, year, quantity_sold,
    unit_sale_price, if(num % 71 = 6, -revenue, revenue) as revenue, if(num % 67 = 7, -1.5, abs(profit)) as profit,
    if(num % 73 = 5, 'Q9', quarter) as quarter, is_full_year or num % 61 = 8 as is_full_year from named),
people as (select distinct customer_id, num from named),
dim_c as (select customer_id from people where num % 7 <> 3 union all select customer_id from people where num % 11 = 4),
marked as (
  select *, customer_id is null or num % 7 = 3 and num % 11 <> 4 as lost_c, product_id is null or product_id % 5 = 0 as lost_p,
    date_key is null or right(date_key, 2) = '02' as lost_d, length(geo_key) % 4 = 0 as lost_g, quarter = 'Q9' as bad_q from bad)"""
ORACLE["dq_violation_masks"] = with_sales("""
select cast(4 * cast(customer_id is null as int) + 8 * cast(product_id is null as int) + 16 * cast(date_key is null as int)
  + 32 * cast(lost_c as int) + 64 * cast(lost_p as int) + 128 * cast(lost_d as int) + 256 * cast(lost_g as int)
  + 512 * cast(revenue < 0 as int) + 1024 * cast(profit < 0 as int) + 2048 * cast(bad_q as int) as bigint) as violations,
  count(*) as row_count from marked group by 1""", _DEFECTS)
_DEFECT_CHECKS = [sql.replace(">= 2001", ">= 2002") for sql in _DQ]
ORACLE["dq_report_defects"] = with_sales("\nunion all ".join(_DEFECT_CHECKS), _DEFECTS + f""",
m as (
  select count(*) as n, count(*) - (select count(*) from (select distinct {_GRAIN} from marked)) as dup,
    count(*) - count(distinct fact_id) as dup_id, count(*) filter (customer_id is null) as null_Customer_ID,
    count(*) filter (product_id is null) as null_Product_ID, count(*) filter (date_key is null) as null_Date_Key,
    count(*) filter (revenue < 0) as neg_r, count(*) filter (profit < 0) as neg_p,
    count(distinct quarter) filter (bad_q) as bad_q, count(*) filter (year = 2001) as n2001,
    count(*) filter (year = 2001 and not is_full_year) as flagged, max(year) as max_year,
    (select count(*) - count(distinct customer_id) from dim_c) as dup_c, count(*) filter (lost_c) as orphan_customer,
    count(*) filter (lost_p) as orphan_product, count(*) filter (lost_d) as orphan_date, count(*) filter (lost_g) as orphan_geography
  from marked)""")
_MODEL_ROWS = [
    ("INFO", "FACT_ROWS", "(select count(*) from s)"), ("INFO", "CUSTOMER_ROWS", "(select count(*) from dim_customer)"),
    ("INFO", "UNIQUE_FACT_CUSTOMERS", "(select count(distinct customer_id) from s)"),
    ("INFO", "UNIQUE_DIM_CUSTOMERS", "(select count(distinct customer_id) from dim_customer)"),
    ("WARN", "FACT_NULL_CELLS", "(select count(*) filter (product_line is null) from s)"),
    ("WARN", "CUSTOMER_NULL_CELLS", "(select count(*) filter (full_name is null) from dim_customer)"),
    ("WARN", "DUPLICATE_CUSTOMER_IDS", "(select count(*) - count(distinct customer_id) from dim_customer)"),
    ("WARN", "NEGATIVE_REVENUE_ROWS", "(select count(*) from s where revenue < 0)"),
    ("WARN", "NEGATIVE_PROFIT_ROWS", "(select count(*) from s where profit < 0)"),
    ("WARN", "ORPHAN_CUSTOMER_ROWS", "(select count(*) from s where customer_id not in (select customer_id from dim_customer))"),
]
ORACLE["model_input_report"] = with_customers("\nunion all ".join(
    f"select '{level}' as \"Level\", '{check}' as \"Check\", cast({value} as bigint) as \"Value\""
    for level, check, value in _MODEL_ROWS))

_DEFECT_ROWS = {
    "CUSTOMER_ROWS": "(select count(*) from known)", "UNIQUE_DIM_CUSTOMERS": "(select count(distinct num) from known)",
    "FACT_NULL_CELLS": "(select count(*) filter (num % 13 = 1) + count(*) filter (num % 17 = 2) from named)",
    "CUSTOMER_NULL_CELLS": "(select count(*) filter (num % 19 = 4) + count(*) filter (num % 23 = 5) from known)",
    "DUPLICATE_CUSTOMER_IDS": "(select count(*) - count(distinct num) from known)",
    "NEGATIVE_REVENUE_ROWS": "(select count(*) from named where num % 71 = 6)",
    "NEGATIVE_PROFIT_ROWS": "(select count(*) from named where num % 67 = 7)",
    "ORPHAN_CUSTOMER_ROWS": "(select count(*) from named where num not in (select num from known))",
}
ORACLE["model_input_defects"] = with_customers("\nunion all ".join(
    f"select '{level}' as \"Level\", '{check}' as \"Check\", cast({_DEFECT_ROWS.get(check, value)} as bigint) as \"Value\""
    for level, check, value in _MODEL_ROWS), """,
named as (select *, cast(customer_id as bigint) as num from s),
people as (select customer_id, cast(customer_id as bigint) as num from dim_customer),
known as (select num from people where num % 7 <> 3 union all select num from people where num % 11 = 4)""")

# -- series --------------------------------------------------------------------------------------
SERIES = """,
qs as (
  select year_quarter, cast(row_number() over (order by year, quarter_num) as int) as quarter_idx, quarter_num, year,
    round(sum(revenue), 4) as revenue, round(sum(profit), 4) as profit
  from s group by year_quarter, year, quarter_num),
ls as (
  select 'Revenue' as target, year_quarter, quarter_idx, quarter_num, revenue as v from qs
  union all select 'Profit', year_quarter, quarter_idx, quarter_num, profit from qs),
lg as (
  select *, lag(v, 1) over w as l1, lag(v, 4) over w as l4, lag(v, 5) over w as l5 from ls
  window w as (partition by target order by quarter_idx))"""
SEASON = """quarter_idx as trend, quarter_idx * quarter_idx as trend_sq, round(sin(2 * pi() * quarter_num / 4), 8) as q_sin,
  round(cos(2 * pi() * quarter_num / 4), 8) as q_cos, cast(quarter_num = 4 as int) as is_q4, cast(quarter_num = 1 as int) as is_q1"""
ID = 'year_quarter as "Year_Quarter", quarter_idx as "Quarter_Idx", quarter_num as "Quarter_Num"'


def with_series(body: str, extra: str = "") -> str:
    return with_sales(body, SERIES + extra)


ORACLE["quarter_index"] = with_series('select year as "Year", ' + ID + " from qs")
ORACLE["quarterly_series"] = with_series(f'select {ID}, revenue as "Revenue", profit as "Profit" from qs')
ORACLE["product_quarterly_series"] = with_series(f"""
select product_line as "Product_Line", year_quarter as "Year_Quarter", quarter_idx as "Quarter_Idx",
  qs.quarter_num as "Quarter_Num", round(sum(s.revenue), 4) as "Revenue", round(sum(s.profit), 4) as "Profit"
from s join qs using (year_quarter) group by 1, 2, 3, 4""")
ORACLE["forecast_features"] = with_series(f"""
select target as "Target", {ID}, round(v, 2) as "Value", round(l1, 2) as lag1, round(l4, 2) as lag4, round(l5, 2) as lag5,
  round(case when count(l1) over f = 4 then avg(l1) over f end, 2) as roll4_mean,
  round(coalesce(case when count(l1) over f = 4 then stddev_samp(l1) over f end, 0), 2) as roll4_std,
  round(l1 / nullif(l5, 0), 8) as yoy_growth, {SEASON}
from lg window f as (partition by target order by quarter_idx rows between 3 preceding and current row)""")
ORACLE["next_forecast_row"] = with_series(f"""
select target as "Target", {ID}, round(lag1, 2) as lag1, round(lag4, 2) as lag4, round(lag5, 2) as lag5, roll4_mean, roll4_std, round(lag1 / lag5, 8) as yoy_growth, {SEASON}
from (
  select target, cast(max(quarter_idx) + 1 as int) as quarter_idx,
    cast(((max(n) + 1) // 4) as varchar) || '-Q' || ((max(n) + 1) % 4 + 1) as year_quarter, cast((max(n) + 1) % 4 + 1 as int) as quarter_num,
    max(v) filter (rn = 1) as lag1, max(v) filter (rn = 4) as lag4, max(v) filter (rn = 5) as lag5,
    round(avg(v) filter (rn <= 4), 2) as roll4_mean, round(stddev_samp(v) filter (rn <= 4), 2) as roll4_std
  from (select *, cast(year_quarter[1:4] as int) * 4 + quarter_num - 1 as n,
      row_number() over (partition by target order by quarter_idx desc) as rn from ls) group by target)""")
TRANSFORMS = """,
tr as (
  select target, year_quarter, quarter_idx, 'level' as transform, v as x from lg
  union all select target, year_quarter, quarter_idx, 'log_level', ln(1 + v) from lg
  union all select target, year_quarter, quarter_idx, 'diff_1', v - l1 from lg
  union all select target, year_quarter, quarter_idx, 'seasonal_diff_4', v - l4 from lg
  union all select target, year_quarter, quarter_idx, 'diff_1_and_seasonal_diff_4', (v - l1) - (l4 - l5) from lg)"""
ORACLE["series_transforms"] = with_series("""
select target as "Target", year_quarter as "Year_Quarter", quarter_idx as "Quarter_Idx", transform as "Transform",
  round(x, 6) as "Transformed" from tr""", TRANSFORMS)
ORACLE["unit_root_stat"] = with_series("""
select target as "Target", transform as "Transform", round(stat, 6) as "DF_Statistic",
  coalesce(stat < -2.86, false) as "Stationary", n_obs as "N_Obs"
from (
  select target, transform, count(x) as n_obs,
    case when count(x) >= 8 and min(x) <> max(x) then regr_slope(x - p, p) / sqrt(
      (regr_syy(x - p, p) - regr_slope(x - p, p) * regr_sxy(x - p, p)) / (regr_count(x - p, p) - 2) / regr_sxx(x - p, p)) end as stat
  from (select *, lag(x) over (partition by target, transform order by quarter_idx) as p from tr where x is not null)
  group by 1, 2)""", TRANSFORMS)
def _solved(lag: int, sample: int) -> str:
    """Slope of x, its standard error and the squared residuals by Cramer's rule on centred cross products."""
    names = [f"d{i}" for i in range(1, lag + 1)]
    used = f"d{sample} is not null" if sample else "x is not null"
    cov = lambda a, b: f"covar_pop({a}, {b}) filter ({used})"

    def det(m: list[list[str]]) -> str:
        if len(m) == 1:
            return m[0][0]
        minors = [f"{'-' if j % 2 else '+'} ({v}) * ({det([r[:j] + r[j + 1:] for r in m[1:]])})" for j, v in enumerate(m[0])]
        return " ".join(minors)

    xs = ["x", *names]
    gram = [[cov(a, b) for b in xs] for a in xs]
    whole = [[*r, cov(a, "y")] for r, a in zip(gram, xs)] + [[*[cov("y", b) for b in xs], cov("y", "y")]]
    top = [[cov("y", b) for b in xs], *gram[1:]]
    rest = det([r[1:] for r in gram[1:]]) if names else "1"
    return (f"select target, transform, {lag} as lag, count(v) as n_obs, min(v) = max(v) as flat, count(*) filter ({used}) as n,"
            f" ({det(top)}) / nullif({det(gram)}, 0) as slope, ({rest}) / nullif({det(gram)}, 0) as inv,"
            f" ({det(whole)}) / nullif({det(gram)}, 0) as sse from lagged group by 1, 2")


# Lag regressions: covariances in place of sums, so residuals and inverses carry a factor n.
ORACLE["unit_root_lags"] = with_series("""
select target as "Target", transform as "Transform", n_obs as "N_Obs", cast(lag as int) as "Lag", round(stat, 5) as "DF_Statistic",
  round(aic, 5) as "AIC", n as "N_Used",
  row_number() over (partition by target, transform order by aic nulls last, lag) = 1 as "Selected",
  coalesce(stat < -2.86, false) as "Stationary"
from (
  select o.*, case when o.n_obs >= 8 and not o.flat then o.slope / sqrt(o.sse / (o.n - o.lag - 2) * o.inv) end as stat,
    case when o.n_obs >= 8 and not o.flat then c.n * ln(c.sse) + 2 * (o.lag + 2) end as aic
  from own o join common c using (target, transform, lag))""", TRANSFORMS + f""",
first_lag as (select target, transform, quarter_idx, x as v, lag(x) over w as x, x - lag(x) over w as y from tr where x is not null
  window w as (partition by target, transform order by quarter_idx)),
lagged as (select *, lag(y, 1) over w as d1, lag(y, 2) over w as d2 from first_lag
  window w as (partition by target, transform order by quarter_idx)),
own as ({" union all ".join(_solved(k, k) for k in range(3))}),
common as ({" union all ".join(_solved(k, 2) for k in range(3))})""")
ORACLE["seasonal_profile"] = with_series("""
select target as "Target", quarter_num as "Quarter_Num", round(avg(v), 4) as "Quarter_Average",
  round(avg(v) / any_value(m), 8) as "Seasonal_Index"
from ls join (select target, avg(v) as m from ls group by 1) using (target) group by 1, 2""")
ORACLE["last_and_trailing_mean"] = with_series("""
select target as "Target", max(v) filter (rn = 1) as last_value, round(avg(v), 4) as trailing_mean
from (select *, row_number() over (partition by target order by quarter_idx desc) as rn from ls) where rn <= 4 group by 1""")

# -- forecasting: every fold is a join of its validation quarter with the quarters before it ---------
def _css_models() -> str:
    """Candidates as rows: orders, differences, which coefficients are free, and the step of their grid in hundredths."""
    rows = []
    for order, seasonal in seasonal_css.ORDERS:
        free = [order[0] >= 1, order[0] >= 2, seasonal[0] >= 1, order[2] >= 1, order[2] >= 2, seasonal[2] >= 1]
        steps = ", ".join(str(seasonal_css.STEPS[sum(free)] * f) for f in free)
        rows.append(f"('{order}', '{seasonal}', {order[1]}, {steps})")
    return ", ".join(rows)


_CO = seasonal_css.COEFFICIENTS
_LAGS = seasonal_css.LAGS


def _css_next(w: tuple[str, ...], e: tuple[str, ...]) -> str:
    """Next difference from the values 1, 2, 4 and 5 quarters back and their errors."""
    return (f"(a1 * {w[0]} + a2 * {w[1]} + as4 * {w[2]} - a1 * as4 * {w[3]} + m1 * {e[0]} + m2 * {e[1]} + ms4 * {e[2]}"
            f" + m1 * ms4 * {e[3]})")


_NOW = _css_next(("w1", "w2", "w4", "w5"), ("e1", "e2", "e4", "e5"))
_AFTER = _css_next(("w", "w1", "w3", "w4"), ("err", "e1", "e3", "e4"))
_GRID = ", ".join(f"{c}.v as {c}" for c in _CO)
_GRID_JOINS = " ".join(f"join css_values {c} on {c}.step = m.s_{c}" for c in _CO)
_MOVED = "w as w1, w1 as w2, w2 as w3, w3 as w4, w4 as w5, err as e1, e1 as e2, e2 as e3, e3 as e4, e4 as e5"
CSS = f""",
css_m(ord, sord, d, {", ".join(f"s_{c}" for c in _CO)}) as (values {_css_models()}),
css_values as (
  select 0 as step, 0.0::double as v
  union all select step, unnest(range(step - 100, 100, step)) / 100.0::double from (values (5), (10), (20)) t(step)),
css_grid as (
  select ord, sord, d, {_GRID} from css_m m {_GRID_JOINS} where a2.v + abs(a1.v) < 1 and abs(m1.v) - m2.v < 1),
css_w as (
  select *, row_number() over (partition by target, d order by qi) as t from (
    select target, quarter_idx as qi, 0 as d, sd as w from d3 where sd is not null
    union all select target, quarter_idx, 1, cd from d3 where cd is not null)),
css as (
  with recursive c as (
    select target, ord, sord, g.d, {", ".join(_CO)}, 0 as t, 0 as qi, 0.0::double as sse, 0.0::double as nxt,
      {", ".join(f"0.0::double as {c}" for c in _LAGS)}
    from (select distinct target, d from css_w) join css_grid g using (d)
    union all
    select target, ord, sord, d, {", ".join(_CO)}, t, qi, sse + err * err, {_AFTER}, {_MOVED} from (
      select c.* exclude (t, qi), x.t, x.qi, x.w, x.w - {_NOW} as err
      from c join css_w x on x.target = c.target and x.d = c.d and x.t = c.t + 1))
  select * from c where t > 0),
css_best as (
  select * from css qualify row_number() over (partition by target, ord, sord, qi order by sse, {", ".join(_CO)}) = 1)"""
PREDICTIONS = f""",
d as (select *, v / nullif(l4, 0) as g, v - l4 as sd from lg),
d2 as (select *, lag(sd) over (partition by target order by quarter_idx) as sd1 from d),
d3 as (select *, sd - sd1 as cd, lag(sd - sd1) over (partition by target order by quarter_idx) as cd1 from d2),
train as (
  select o.target, o.quarter_idx as fold, any_value(o.quarter_num) as qn,
    avg(t.v) filter (t.quarter_num = o.quarter_num) as same_q, avg(t.v) as all_q,
    coalesce(quantile_cont(t.g, 0.5), 1.0) as g,
    coalesce(sum(t.sd * t.sd1) / nullif(sum(t.sd1 * t.sd1) filter (t.sd is not null), 0), 0) as phi_sd,
    coalesce(sum(t.cd * t.cd1) / nullif(sum(t.cd1 * t.cd1) filter (t.cd is not null), 0), 0) as phi_cd,
    max(t.v) filter (t.quarter_idx = o.quarter_idx - 1) as y1, max(t.v) filter (t.quarter_idx = o.quarter_idx - 4) as y4,
    max(t.v) filter (t.quarter_idx = o.quarter_idx - 5) as y5, max(t.sd) filter (t.quarter_idx = o.quarter_idx - 1) as sd,
    max(t.cd) filter (t.quarter_idx = o.quarter_idx - 1) as cd
  from d3 o join d3 t on o.target = t.target and t.quarter_idx < o.quarter_idx
  where o.quarter_idx > 12 group by 1, 2){CSS},
pred as (
  select target, fold, 'SeasonalNaive' as model, '' as ord, '' as sord, coalesce(same_q, all_q) as p from train
  union all select target, fold, 'SeasonalGrowth', '', '', y4 * g from train
  union all select target, fold, 'SeasonalRandomWalk', '(0, 1, 0)', '(0, 1, 0, 4)', y1 + y4 - y5 from train
  union all select target, fold, 'SeasonalAR1_CLS', '(1, 0, 0)', '(0, 1, 0, 4)', y4 + phi_sd * sd from train
  union all select target, fold, 'SeasonalAR1_CLS', '(1, 1, 0)', '(0, 1, 0, 4)', y1 + y4 - y5 + phi_cd * cd from train
  union all select target, fold, 'SeasonalCSS', ord, sord, if(d = 0, y4, y1 + y4 - y5) + nxt
    from train join (select *, qi + 1 as fold from css_best) using (target, fold)),
err as (select target, model, ord, sord, year_quarter, v, greatest(p, 0) as p
  from pred join ls using (target) where fold = quarter_idx),
bt as (
  select target as "Target", model as "Model", ord as "Order", sord as "Seasonal_Order", year_quarter as "Validation_Quarter",
    {half_even("v")} as "Actual", {half_even("p")} as "Predicted", {half_even("p - v")} as "Error",
    {half_even("abs(p - v)")} as "MAE", {half_even("abs(p - v)")} as "RMSE",
    {half_even("abs(p - v) / greatest(abs(v), 1e-12)", 4)} as "MAPE",
    {half_even("abs(p - v) / greatest((abs(v) + abs(p)) / 2, 1e-12)", 4)} as "sMAPE",
    {half_even("p - v")} as "Bias", cast(null as double) as "AIC", cast(null as double) as "BIC", true as "Converged",
    cast(null as varchar) as error_message
  from err),
summ as (
  select "Target", "Model", "Order", "Seasonal_Order", avg("MAE") as "Backtest_MAE", sqrt(avg("Error" * "Error")) as "Backtest_RMSE",
    avg("MAPE") as "Backtest_MAPE", avg("sMAPE") as "Backtest_sMAPE", avg("Bias") as "Backtest_Bias",
    quantile_cont("MAPE", 0.5) as "Median_MAPE", avg("AIC") as "AIC", avg("BIC") as "BIC",
    count("MAPE") as "N_Backtests", avg(cast("Converged" as int)) as "Converged_Rate"
  from bt group by 1, 2, 3, 4),
sel as (
  select * from (select *, row_number() over (partition by "Target" order by "Backtest_MAPE" nulls last, "Backtest_MAE" nulls last,
    "AIC" nulls last, "Model", "Order", "Seasonal_Order") as rn from summ) where rn = 1)"""
for key, model in (("seasonal_naive_backtest", "SeasonalNaive"), ("seasonal_growth_backtest", "SeasonalGrowth"),
                   ("seasonal_rw_backtest", "SeasonalRandomWalk"), ("seasonal_ar1_backtest", "SeasonalAR1_CLS"),
                   ("seasonal_css_backtest", "SeasonalCSS")):
    ORACLE[key] = with_series(f"""select * from bt where "Model" = '{model}'""", PREDICTIONS)
ORACLE["backtest_summary"] = with_series("""
select "Target", "Model", "Order", "Seasonal_Order", round("Backtest_MAE", 4) as "Backtest_MAE",
  round("Backtest_RMSE", 4) as "Backtest_RMSE", round("Backtest_MAPE", 8) as "Backtest_MAPE",
  round("Backtest_sMAPE", 8) as "Backtest_sMAPE", round("Backtest_Bias", 4) as "Backtest_Bias",
  round("Median_MAPE", 8) as "Median_MAPE", "AIC", "BIC", "N_Backtests", "Converged_Rate" from summ""", PREDICTIONS)
ORACLE["selected_model"] = with_series('select "Target", "Model", "Order", "Seasonal_Order" from sel', PREDICTIONS)
ORACLE["selected_backtest"] = with_series(
    'select bt.* from bt join sel using ("Target", "Model", "Order", "Seasonal_Order")'.replace("bt.*", 'bt.*'), PREDICTIONS)
# Step-by-step recursion, one row per step, for all models at once.
RECURSION = PREDICTIONS + f""",
last as (
  select target, max(quarter_idx) as n, coalesce(quantile_cont(g, 0.5), 1.0) as g,
    coalesce(sum(sd * sd1) / nullif(sum(sd1 * sd1) filter (sd is not null), 0), 0) as phi_sd,
    coalesce(sum(cd * cd1) / nullif(sum(cd1 * cd1) filter (cd is not null), 0), 0) as phi_cd,
    arg_max(cd, quarter_idx) as cd, arg_max(sd, quarter_idx) as sdv, max(cast(year_quarter[1:4] as int) * 4 + quarter_num - 1) as lab
  from d3 group by 1),
naive as (select target, quarter_num, avg(v) as m from ls group by 1, 2),
recursive_base as (
  select l.target, m.model, m.ord, m.sord, n, g, phi_sd, phi_cd, cd, lab, sdv, b.d, {", ".join(f"b.{c}" for c in (*_CO, *_LAGS))},
    (select list(v order by quarter_idx) from ls where ls.target = l.target) as ys
  from last l cross join (select distinct model, ord, sord from pred) m
    left join css_best b on m.model = 'SeasonalCSS' and b.target = l.target and b.ord = m.ord and b.sord = m.sord and b.qi = l.n),
rec as (
  with recursive r as (
    select *, 0 as step from recursive_base
    union all
    select target, model, ord, sord, n, g, phi_sd, phi_cd, cd * phi_cd as cd, lab, if(d = 0, w, sdv + w) as sdv, d,
      {", ".join(_CO)}, {_MOVED}, list_append(ys, case
        when model = 'SeasonalCSS' then ys[len(ys) - 3] + if(d = 0, w, sdv + w)
        when model = 'SeasonalNaive' then (select m from naive where naive.target = r.target and naive.quarter_num = (lab + step + 1) % 4 + 1)
        when model = 'SeasonalGrowth' then greatest(ys[len(ys) - 3] * g, 0)
        when model = 'SeasonalRandomWalk' then ys[len(ys)] + ys[len(ys) - 3] - ys[len(ys) - 4]
        when ord = '(1, 0, 0)' then ys[len(ys) - 3] + phi_sd * (ys[len(ys)] - ys[len(ys) - 4])
        else ys[len(ys)] + ys[len(ys) - 3] - ys[len(ys) - 4] + phi_cd * cd end) as ys, step + 1
    from (select *, {_NOW} as w, 0.0::double as err from r where step < 7) r)
  select *, greatest(ys[len(ys)], 0) as y from r where step > 0),
fc as (
  select rec.target, rec.model, rec.ord, ((lab + step) // 4) || '-Q' || ((lab + step) % 4 + 1) as quarter, cast(n + step as int) as quarter_idx,
    cast((lab + step) % 4 + 1 as int) as quarter_num, y, b."Backtest_MAPE" as band,
    case when rec.ord = '' then rec.model else rec.model || rec.ord || 'x' || rec.sord end as label,
    s2."Model" is not null as chosen
  from rec join summ b on b."Target" = rec.target and b."Model" = rec.model and b."Order" = rec.ord and b."Seasonal_Order" = rec.sord
    left join sel s2 on s2."Target" = rec.target and s2."Model" = rec.model and s2."Order" = rec.ord and s2."Seasonal_Order" = rec.sord)"""
FC = {"Predicted": half_even("y"), "CI_Lower": half_even("greatest(y * (1 - band), 0)"), "CI_Upper": half_even("y * (1 + band)"),
      "Band_Pct": half_even("band", 4)}
ORACLE["forecast_all_models"] = with_series(f"""
select target as "Target", quarter as "Quarter", quarter_idx as "Quarter_Idx", quarter_num as "Quarter_Num",
  label as "Model", {", ".join(f'{e} as "{n}"' for n, e in FC.items())} from fc""", RECURSION)


def _wide(target: str) -> str:
    names = {"Predicted": f"Predicted_{target}", "CI_Lower": f"{target}_CI_Lower", "CI_Upper": f"{target}_CI_Upper",
             "Band_Pct": f"{target}_Band_Pct"}
    cells = [f"""max({FC[k]}) filter (target = '{target}') as "{n}\"""" for k, n in names.items()]
    return ", ".join([*cells, f"""max(label) filter (target = '{target}') as "{target}_Model\""""])


ORACLE["forecast_horizon"] = with_series(f"""
select quarter as "Quarter", quarter_idx as "Quarter_Idx", {_wide("Revenue")}, {_wide("Profit")}
from fc where chosen group by 1, 2""", RECURSION)

# -- churn ---------------------------------------------------------------------------------------
from ..functions.fixed import ACTION_OWNERS, ACTION_TEXTS, CHURN_FEATURES, REASON_TEXTS  # noqa: E402


def features(snapshots: str, reach: int = 2) -> str:
    return CUSTOMERS + SERIES + f""",
f as (select s.*, qs.quarter_idx as q from s join qs using (year_quarter)),
snap as (select unnest({snapshots}) as s),
gaps as (
  select customer_id, s, coalesce(avg(q - p), 0) as avg_gap
  from (select customer_id, s, q, lag(q) over (partition by customer_id, s order by q) as p
    from (select distinct customer_id, s, q from f join snap on q <= s)) group by 1, 2),
h as (
  select customer_id, s, s - max(q) as recency, s - min(q) + 1 as tenure, count(distinct q) as active_quarters,
    sum(order_count) as total_orders, round(sum(revenue), 6) as total_revenue, round(sum(profit), 6) as total_profit,
    round(sum(revenue), 6) / count(revenue) as avg_revenue,
    coalesce(sum(order_count) filter (q >= s), 0) as freq_l1q, coalesce(sum(order_count) filter (q >= s - 1), 0) as freq_l2q,
    coalesce(sum(order_count) filter (q >= s - 3), 0) as freq_l4q, round(coalesce(sum(revenue) filter (q >= s), 0), 6) as rev_l1q,
    round(coalesce(sum(revenue) filter (q >= s - 1), 0), 6) as rev_l2q, round(coalesce(sum(revenue) filter (q >= s - 3), 0), 6) as rev_l4q,
    round(coalesce(sum(profit) filter (q >= s - 3), 0), 6) as profit_l4q,
    round(coalesce(sum(revenue) filter (q >= s - 1), 0), 6) - round(coalesce(sum(revenue) filter (q in (s - 3, s - 2)), 0), 6) as revenue_trend_2q,
    count(distinct product_line) as num_products, count(distinct coupon_num) as coupon_diversity,
    round(sum(unit_sale_price), 6) / count(unit_sale_price) as avg_unit_price,
    round(sum(quantity_sold), 6) / count(quantity_sold) as avg_quantity
  from f join snap on q <= s group by 1, 2),
buyers as (select distinct customer_id, s from f join snap on q between s + 1 and s + {reach}),
x as (
  select h.*, g.avg_gap, active_quarters / tenure as active_rate, total_profit / nullif(total_revenue, 0) as profit_margin,
    c.full_name, c.gender, c.education, c.education_rank, c.income, c.income_bucket, c.months_as_member, c.tenure_bucket,
    c.loyaltystatus, c.loyalty_rank, c.clv, c.clv_segment,
    case when coalesce(c.income, 0) <= 0 then (select median(income) from dim_customer where income > 0) else c.income end as income_imputed,
    cast(lower(c.gender) = 'male' as int) as gender_male, cast(b.customer_id is null as int) as y
  from h join gaps g using (customer_id, s) left join dim_customer c using (customer_id)
    left join buyers b using (customer_id, s))"""


TRAIN_SNAPSHOTS = "range(8, (select max(quarter_idx) - 1 from qs))"
LAST_SNAPSHOT = "[(select max(quarter_idx) from qs)]"
FEATURE_SELECT = ", ".join(f'coalesce(cast({c.lower()} as double), 0) as "{c}"' for c in CHURN_FEATURES)
CARRIED = """customer_id as "Customer_ID", cast(s as int) as "Snapshot_Idx", (s + 1) || '-' || (s + 2) as "Target_Window",
  full_name as "Full_Name", gender as "Gender", education as "Education", income as "Income", income_bucket as "Income_Bucket",
  tenure_bucket as "Tenure_Bucket", loyaltystatus as "LoyaltyStatus", clv_segment as "CLV_Segment" """
Y = 'y as "Y_Churn_Next_2Q"'
ORACLE["churn_snapshot"] = with_sales(f"select {CARRIED}, {FEATURE_SELECT}, {Y} from x", features("[20]"))
ORACLE["churn_training_windows"] = with_sales(f"select {CARRIED}, {FEATURE_SELECT}, {Y} from x", features(TRAIN_SNAPSHOTS))
ORACLE["churn_scoring_snapshot"] = with_sales(f"select {CARRIED}, {FEATURE_SELECT} from x", features(LAST_SNAPSHOT))
ORACLE["standardizer_stats"] = with_sales("\nunion all ".join(
    f"""select '{c}' as "Feature", round(avg({e}), 4) as "Mean",
    round(case when stddev_pop({e}) = 0 then 1 else stddev_pop({e}) end, 4) as "Std" from x"""
    for c in CHURN_FEATURES for e in [f"coalesce(cast({c.lower()} as double), 0)"]), features("[20]"))
ORACLE["fixed_segment"] = with_sales("""
select customer_id as "Customer_ID", cast(recency as int) as "Recency",
  case when p >= 0.8 or recency >= 8 then 'Critical' when p >= 0.65 then 'High Risk' when p >= 0.45 then 'Medium Risk'
    when p >= 0.25 then 'Low Risk' else 'Healthy' end as "Churn_Risk_Segment"
from (select *, cast(customer_id as bigint) * 37 % 1000 / 1000.0::double as p from x)""", features("[20]"))

# -- trained models --------------------------------------------------------------------------------
_VALUES = ", ".join(f"coalesce(cast({c.lower()} as double), 0)" for c in CHURN_FEATURES)
_NAMES = ", ".join(f"'{c}'" for c in CHURN_FEATURES)
_TRAINING = f""",
t as (select y, [{_VALUES}] as v from x where s < (select max(s) from x)),
size as (select count(*) as n, greatest(sum(y), 1) as pos, greatest(count(*) - sum(y), 1) as neg from t)"""
_EDGES = ", ".join(f"{i}/64.0::double" for i in range(1, 64))
_UNIT = "1048576.0::double"
# Gradients at the root are those of probability one half, in whole units of 2^-20.
ORACLE["churn_root_split"] = with_sales("""
select m.model as "Model", f.feature as "Feature", round(b.e, 6) as "Threshold", round(b.gain, 6) as "Gain",
  round(-(b.gl / b.u) / (b.hl / b.u + m.l2), 6) as "Left_Weight", round(-(b.gr / b.u) / (b.hr / b.u + m.l2), 6) as "Right_Weight"
from m cross join (select distinct feature from flat) f left join (
  select *, row_number() over (partition by model, feature order by gain desc, e) as k from gains) b
  on b.model = m.model and b.feature = f.feature and b.k = 1 and b.gain > 1e-6""", features(TRAIN_SNAPSHOTS) + _TRAINING + f""",
m(model, l2, least) as (values ('GBT_Balanced', 3.0::double, 8), ('GBT_Regularized', 6.0::double, 12)),
flat as (select y, unnest(v) as v, unnest([{_NAMES}]) as feature from t),
edge as (select feature, unnest(list_distinct(quantile_cont(v, [{_EDGES}]))) as e from flat group by feature),
sides as (
  select feature, e, sum(y) as p, count(*) - sum(y) as q from edge join flat using (feature) where v <= e group by 1, 2),
unit as (
  select {_UNIT} as u, round_even(-0.5 * neg / pos * {_UNIT}, 0) as gp, 0.5 * {_UNIT} as gn,
    round_even(0.25 * neg / pos * {_UNIT}, 0) as hp, 0.25 * {_UNIT} as hn, pos, neg from size),
sums as (
  select feature, e, u, p * gp + q * gn as gl, p * hp + q * hn as hl, (pos - p) * gp + (neg - q) * gn as gr,
    (pos - p) * hp + (neg - q) * hn as hr from sides cross join unit),
gains as (
  select model, feature, e, u, gl, hl, gr, hr, (gl / u) * (gl / u) / (hl / u + l2) + (gr / u) * (gr / u) / (hr / u + l2)
    - ((gl + gr) / u) * ((gl + gr) / u) / ((hl + hr) / u + l2) as gain
  from sums cross join m where hl >= least * u and hr >= least * u)""")
_WIDE = len(CHURN_FEATURES) + 1
_MOMENTS = lambda f: ", ".join(f"{f}(v[{i}])" for i in range(1, _WIDE))
_GRADIENT = ", ".join(f"sum(err * z[{i}])" for i in range(1, _WIDE + 1))
# Steps with the inverse of the largest possible curvature, a quarter of the Gram matrix; the start and speed differ from
# Newton's, the solution does not.
ORACLE["churn_logistic_solution"] = with_sales(f"""
select model as "Model", unnest(['intercept', {_NAMES}]) as "Feature", unnest(list_transform(beta, lambda b: round(b, 5))) as "Coefficient",
  unnest(list_transform(gradient, lambda g: round(abs(g), 5))) as "Gradient"
from walk where step = 400""", features(TRAIN_SNAPSHOTS) + _TRAINING + f""",
moments as (select [{_MOMENTS('avg')}] as mean, [{_MOMENTS('stddev_pop')}] as sd from t),
z as (
  select y, list_prepend(1.0::double, list_transform(range(1, {_WIDE}), lambda i: (v[i] - mean[i]) / if(sd[i] = 0, 1, sd[i]))) as z
  from t cross join moments),
cross_sums as (
  select y, i, j, sum(z[i] * z[j]) as g from z cross join range(1, {_WIDE + 1}) a(i) cross join range(1, {_WIDE + 1}) b(j)
  where i <= j group by 1, 2, 3),
m as (
  select model, l2, n, if(balanced, n / (2.0 * pos), 1) as w1, if(balanced, n / (2.0 * neg), 1) as w0 from size cross join
    (values ('Logistic_Balanced', 0.05::double, true), ('Logistic_StrongL2', 0.30::double, true),
      ('Logistic_Unweighted', 0.05::double, false)) c(model, l2, balanced)),
entry as (
  select model, i, j, sum(g * if(y = 1, w1, w0)) / any_value(n) / 4 + if(i = j and i > 1, any_value(l2 / n), 0) as g
  from cross_sums cross join m group by 1, 2, 3),
full_rows as (
  select model, i, list_concat(list(g order by j), list_transform(range(1, {_WIDE + 1}), lambda k: if(k = i, 1.0::double, 0.0::double))) as r
  from (select model, i, j, g from entry union all select model, j, i, g from entry where i < j) group by model, i),
pivot_ as (
  select model, 1 as k, list(r order by i) as a from full_rows group by model
  union all
  select model, k + 1, list_transform(a, lambda r, i: if(i = k, list_transform(r, lambda x: x / a[k][k]),
    list_transform(r, lambda x, j: x - r[k] * a[k][j] / a[k][k]))) from pivot_ where k <= {_WIDE}),
inverse as (select model, list_transform(a, lambda r: r[{_WIDE + 1}:{2 * _WIDE}]) as inv from pivot_ where k = {_WIDE + 1}),
walk as (
  select model, 0 as step, list_transform(range({_WIDE}), lambda i: 0.0::double) as beta,
    list_transform(range({_WIDE}), lambda i: 1.0::double) as gradient from m
  union all
  select model, step + 1, list_transform(beta, lambda b, i: b - list_dot_product(inv[i], gradient)), gradient from (
    select model, step, beta, inv, list_transform(g, lambda x, i: x / n + if(i = 1, 0, l2 / n * beta[i])) as gradient from (
      select model, step, any_value(beta) as beta, any_value(inv) as inv, any_value(n) as n, any_value(l2) as l2, [{_GRADIENT}] as g
      from (select model, step, beta, inv, n, l2, z, if(y = 1, w1, w0) * (1 / (1 + exp(-list_dot_product(z, beta))) - y) as err
        from walk join m using (model) join inverse using (model) cross join z where step < 400)
      group by model, step)))""", recursive=True)

# -- labels and metrics ----------------------------------------------------------------------------
LABELS = SERIES + f""",
f as (select customer_id, quarter_idx as q from s join qs using (year_quarter)),
snap as (select unnest({TRAIN_SNAPSHOTS}) as s),
lab as (
  select customer_id, s, cast(max(cast(q > s as int)) = 0 as int) as y,
    cast(customer_id as bigint) * 37 % 1000 / 1000.0::double as p37, cast(customer_id as bigint) * 91 % 1000 / 1000.0::double as p91
  from f join snap on q <= s + 2 group by 1, 2 having min(q) <= s)"""


def with_labels(body: str, extra: str = "") -> str:
    return with_sales(body, LABELS + extra)


def rates(source: str, keys: str) -> str:
    """Rates from a relation with columns tp, tn, fp, fn and the keys."""
    return f"""
    select *, 2 * precision * recall / greatest(precision + recall, 1e-12) as f1,
      2 * npv * specificity / greatest(npv + specificity, 1e-12) as f1_no_churn, (recall + specificity) / 2 as balanced_accuracy,
      (2 * precision * recall / greatest(precision + recall, 1e-12) + 2 * npv * specificity / greatest(npv + specificity, 1e-12)) / 2 as macro_f1
    from (select *, (tp + tn) / greatest(tp + tn + fp + fn, 1) as accuracy, tp / greatest(tp + fp, 1) as precision,
      tp / greatest(tp + fn, 1) as recall, tn / greatest(tn + fp, 1) as specificity, tn / greatest(tn + fn, 1) as npv
      from {source})"""


def counts(score: str, threshold: str, keys: str, source: str = "lab") -> str:
    group = f"group by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""(select {lead}count(*) filter (y = 1 and {score} >= {threshold}) as tp,
      count(*) filter (y = 0 and {score} < {threshold}) as tn, count(*) filter (y = 0 and {score} >= {threshold}) as fp,
      count(*) filter (y = 1 and {score} < {threshold}) as fn, avg(power({score} - y, 2)) as brier from {source} {group})"""


RATE_NAMES = ("accuracy", "precision", "recall", "specificity", "npv", "f1", "f1_no_churn", "balanced_accuracy", "macro_f1")
RATE_SELECT = ", ".join(f"round({c}, 10) as {c}" for c in RATE_NAMES)
ORACLE["churn_label_rate"] = with_labels("""
select cast(s as int) as "Snapshot_Idx", count(*) as rows_, round(avg(y), 10) as churn_rate from lab group by 1""")
ORACLE["validation_folds"] = with_labels("""
select distinct cast(s as int) as "Snapshot_Idx" from lab order by 1 desc limit 4""")
ORACLE["binary_metrics"] = with_labels(f"""
select cast(s as int) as "Snapshot_Idx", {RATE_SELECT}, round(brier, 10) as brier, 0.5::double as threshold, tp, tn, fp, fn
from ({rates(counts("p37", "0.5", "s"), "s")})""")
ORACLE["confusion_matrix"] = with_labels(f"""
select 'Actual 0' as "Actual", tn as "Predicted 0", fp as "Predicted 1" from {counts("p37", "0.5", "")}
union all select 'Actual 1', fn, tp from {counts("p37", "0.5", "")}""")


def auc_sql(score: str, keys: str) -> str:
    """Midrank form of the rank-sum statistic."""
    return f"""
    select {keys}, (sum(r) filter (y = 1) - count(*) filter (y = 1) * (count(*) filter (y = 1) + 1) / 2.0)
      / (cast(count(*) filter (y = 1) as double) * count(*) filter (y = 0)) as auc_roc
    from (select *, rank() over (partition by {keys} order by {score})
      + (count(*) over (partition by {keys}, {score}) - 1) / 2.0 as r from lab) group by {keys}"""


def lift_sql(score: str, keys: str) -> str:
    """Ties at the cut share their positives evenly."""
    return f"""
    select {keys}, sum(y * least(1, greatest(0, (k - before) / ties))) / any_value(k) / greatest(avg(y), 1e-12) as lift_top_10pct
    from (select *, greatest(ceil(count(*) over (partition by {keys}) * 0.1::double), 1) as k,
      rank() over (partition by {keys} order by {score} desc) - 1 as before,
      count(*) over (partition by {keys}, {score}) as ties from lab) group by {keys}"""


ORACLE["auc"] = with_labels(f"""
select cast(s as int) as "Snapshot_Idx", round(auc_roc, 10) as auc_roc from ({auc_sql("p37", "s")})""")
ORACLE["lift_at_10"] = with_labels(f"""
select cast(s as int) as "Snapshot_Idx", round(lift_top_10pct, 10) as lift_top_10pct from ({lift_sql("p37", "s")})""")
GRID = [0.05 + 0.05 * i for i in range(19)]
ORACLE["best_threshold"] = with_labels(f"""
select round(threshold, 10) as threshold, round(least(0.95, threshold + 0.003), 10) as operating_threshold,
  round(balanced_accuracy + 3.0 * macro_f1 + least(recall, specificity), 10) as objective,
  round(least(recall, specificity), 10) as class_balance_floor, round(balanced_accuracy, 10) as balanced_accuracy,
  round(macro_f1, 10) as macro_f1, round(brier, 10) as brier
from ({rates(counts("p37", "threshold", "threshold", "lab cross join grid"), "threshold")})
order by balanced_accuracy + 3.0 * macro_f1 + least(recall, specificity) desc, least(recall, specificity) desc,
  balanced_accuracy desc, macro_f1 desc, threshold desc limit 1""", f""",
grid as (
  select unnest([{", ".join(f"{g!r}::double" for g in GRID)}]) as threshold
  union select unnest((select quantile_cont(p37, [{", ".join(repr(g) for g in GRID)}]) from lab)))""")
_RANKED = ("accuracy", "balanced_accuracy", "macro_f1", "f1", "f1_no_churn", "precision", "recall", "specificity", "npv",
           "auc_roc", "lift_top_10pct", "brier")


def _model(name: str, score: str) -> str:
    return f"""select '{name}' as model, m.*, a.auc_roc, l.lift_top_10pct from ({rates(counts(score, "0.25", "s"), "s")}) m
      join ({auc_sql(score, "s")}) a using (s) join ({lift_sql(score, "s")}) l using (s)
      where s in (select distinct s from lab order by s desc limit 4)"""


ORACLE["model_ranking"] = with_labels(f"""
select model as "Model", {", ".join(f"round(avg({c}), 10) as {c}" for c in _RANKED)}, 0.25::double as threshold,
  count(*) as "N_Backtests", round(least(avg(recall), avg(specificity)), 10) as class_balance_floor,
  avg(recall) >= 0.6 and avg(specificity) >= 0.2 as eligible_for_champion
from ({_model("score_37", "p37")} union all by name {_model("score_91", "p91")}) group by 1""")

# -- scored customers ------------------------------------------------------------------------------
_OWNER = " ".join(f"when '{k}' then '{v}'" for k, v in ACTION_OWNERS.items())
_TEXT = " ".join(f"when '{k}' then '{v}'" for k, v in ACTION_TEXTS.items())
SCORED = features(LAST_SNAPSHOT) + f""",
scored as (
  select *, cast(p >= 0.5 as int) as predicted,
    case when p >= 0.7 then 'Critical' when p >= 0.5 then 'High Risk' when p >= 0.375 then 'Medium Risk'
      when p >= 0.25 then 'Low Risk' else 'Healthy' end as segment,
    p * total_revenue as at_risk, p * ln(1 + greatest(clv, 0)) as priority,
    concat_ws(', ', r1, r2, r3, case when r1 is null or r2 is null or r3 is null then r4 end) as reason
  from (select *, cast(customer_id as bigint) * 37 % 1000 / 1000.0::double as p,
      case when recency >= 4 then '{REASON_TEXTS["inactive"]}' end as r1,
      case when rev_l4q <= 0 then '{REASON_TEXTS["no_recent_revenue"]}' end as r2,
      case when clv >= (select median(clv) from x) then '{REASON_TEXTS["high_value"]}' end as r3,
      case when active_quarters <= 1 then '{REASON_TEXTS["thin_history"]}' end as r4 from x))"""
_NUM = ("Loyalty_Rank", "Recency", "Tenure", "Active_Quarters", "Total_Orders", "Total_Revenue", "Total_Profit", "Rev_L4Q", "Freq_L4Q")
ORACLE["scored_customers"] = with_sales(f"""
select customer_id as "Customer_ID", full_name as "Full_Name", cast(s as int) as "Snapshot_Idx", loyaltystatus as "LoyaltyStatus",
  round(clv, 4) as "CLV", clv_segment as "CLV_Segment", income_bucket as "Income_Bucket", tenure_bucket as "Tenure_Bucket",
  {", ".join(f'round(cast({c.lower()} as double), 4) as "{c}"' for c in _NUM)}, p as "Churn_Probability_Next_2Q",
  predicted as "Predicted_Churn", segment as "Churn_Risk_Segment", round(at_risk, 4) as "Expected_Revenue_At_Risk",
  round(priority, 8) as "Retention_Priority_Score", case segment {_OWNER} end as "Action_Owner",
  case segment {_TEXT} end as "Recommended_Action",
  case when reason = '' then '{REASON_TEXTS["default"]}' else reason end as "Action_Reason"
from scored""", SCORED)
ORACLE["high_risk_list"] = with_sales(f"""
select customer_id as "Customer_ID", segment as "Churn_Risk_Segment", case segment {_OWNER} end as "Action_Owner"
from scored where segment in ('Critical', 'High Risk')""", SCORED)
ORACLE["head_5000"] = with_sales("""
select customer_id as "Customer_ID", predicted as "Predicted_Churn" from scored
order by predicted desc, priority desc, p desc, customer_id limit 5000""", SCORED)
ORACLE["top_n_at_risk"] = with_sales("""
select cast(row_number() over w as int) as "Rank", customer_id as "Customer_ID", segment as "Churn_Risk_Segment",
  round(at_risk, 2) as "Expected_Revenue_At_Risk",
  round(sum(at_risk) over (order by at_risk desc, customer_id rows unbounded preceding), 2) as "Cumulative_Revenue_At_Risk"
from scored window w as (order by at_risk desc, customer_id) order by at_risk desc, customer_id limit 1000""", SCORED)

# -- insights --------------------------------------------------------------------------------------
_TOTALS = """sum(revenue) as revenue, sum(profit) as profit, cast(sum(order_count) as bigint) as orders,
  sum(quantity_sold) as quantity, count(distinct customer_id) as customers"""


def totals(dim: str = "") -> str:
    lead = f"{dim}, " if dim else ""
    return f""",
t as (select year_quarter, year * 4 + quarter_num as q, {lead}{_TOTALS} from s group by all),
j as (select t.*, p.revenue as p_revenue, p.orders as p_orders, p.customers as p_customers, p.quantity as p_quantity
  from t left join t p on t.q = p.q + 4 {f"and t.{dim} = p.{dim}" if dim else ""})"""


def yoy(a: str, b: str, digits: int = 4) -> str:
    return f"round(({a} - {b}) / nullif({b}, 0) * 100, {digits})"


_DRIVER = ", ".join(f'{yoy(c, "p_" + c)} as "{c.title()}_YoY_Pct"' for c in ("revenue", "orders", "customers"))
ORACLE["yoy_drivers"] = with_sales(f"""
select year_quarter as "Year_Quarter", round(revenue, 4) as "Revenue", orders as "Orders", customers as "Customers",
  round(revenue / orders, 6) as "AOV", round(p_revenue, 4) as "Prior_Revenue", p_orders as "Prior_Orders",
  p_customers as "Prior_Customers", round(p_revenue / p_orders, 6) as "Prior_AOV", {_DRIVER},
  {yoy("revenue / orders", "(p_revenue / p_orders)")} as "AOV_YoY_Pct" from j""", totals())
for key, dim, name in (("yoy_by_country", "country", "Country"), ("yoy_by_product", "product_line", "Product_Line")):
    ORACLE[key] = with_sales(f"""
select year_quarter as "Year_Quarter", {dim} as "{name}", round(revenue, 4) as "Revenue", orders as "Orders",
  customers as "Customers", {_DRIVER} from j""", totals(dim))
ORACLE["price_quantity_split"] = with_sales(f"""
select year_quarter as "Year_Quarter", product_line as "Product_Line", round(revenue / quantity, 6) as "Weighted_Unit_Price",
  round(quantity / orders, 6) as "Quantity_Per_Order",
  {yoy("revenue / quantity", "(p_revenue / p_quantity)", 6)} as "Weighted_Unit_Price_YoY_Pct",
  {yoy("quantity / orders", "(p_quantity / p_orders)", 6)} as "Quantity_Per_Order_YoY_Pct" from j""", totals("product_line"))
ORACLE["mix_shift"] = with_sales("""
select a.year_quarter as "Year_Quarter", a.product_line as "Product_Line", round(a.revenue, 4) as "Revenue",
  round(a.share, 8) as "Revenue_Share_Pct", round(a.share - b.share, 8) as "Share_Shift_Points"
from sh a left join sh b on a.q = b.q + 4 and a.product_line = b.product_line""", totals("product_line") + """,
sh as (select *, revenue / sum(revenue) over (partition by q) * 100 as share from t)""")
ORACLE["revenue_share"] = with_sales("""
select loyaltystatus as "LoyaltyStatus", round(sum(revenue), 4) as "Revenue", round(sum(profit), 4) as "Profit",
  cast(sum(order_count) as bigint) as "Orders", count(distinct customer_id) as "Customers",
  round(sum(revenue) / (select sum(revenue) from s) * 100, 4) as "Revenue_Share_Pct",
  round(sum(revenue) / sum(order_count), 4) as "AOV", round(sum(revenue) / count(distinct customer_id), 4) as "Revenue_Per_Customer"
from s group by 1""")
ORACLE["new_vs_returning"] = with_sales("""
select year_quarter as "Year_Quarter", case when q = first_q then 'New' else 'Returning' end as "Customer_Type",
  round(sum(revenue), 4) as "Revenue", cast(sum(order_count) as bigint) as "Orders", count(distinct customer_id) as "Customers"
from (select *, year * 4 + quarter_num as q, min(year * 4 + quarter_num) over (partition by customer_id) as first_q from s)
group by 1, 2""")
ORACLE["top_n_concentration"] = with_sales("""
select year_quarter as "Year_Quarter", round(sum(revenue), 4) as "Revenue", count(*) as "Transactions",
  round(sum(revenue) filter (rn <= 500), 4) as "Top_Revenue", round(sum(revenue) filter (rn <= 500) / sum(revenue) * 100, 8) as "Top_Share_Pct"
from (select *, row_number() over (partition by year_quarter order by revenue desc) as rn from s) group by 1""")
_EXTRACT = """round(sum(revenue), 4) as "Revenue", round(sum(profit), 4) as "Profit", cast(sum(order_count) as bigint) as "Orders",
  sum(quantity_sold) as "Quantity", round(avg(unit_sale_price), 6) as "Avg_Unit_Price",
  round(sum(profit) / nullif(sum(revenue), 0) * 100, 4) as "Profit_Margin_Pct", round(sum(revenue) / sum(order_count), 6) as "AOV" """
ORACLE["product_by_quarter"] = with_sales(
    f'select product_line as "Product_Line", year_quarter as "Year_Quarter", {_EXTRACT} from s group by 1, 2')
ORACLE["loyalty_by_quarter"] = with_sales(
    f'select loyaltystatus as "LoyaltyStatus", year_quarter as "Year_Quarter", {_EXTRACT} from s group by 1, 2'.replace(", 6)", ", 4)"))
ORACLE["sales_by_year"] = with_sales(f'select year as "Year", {_EXTRACT} from s group by 1')
ORACLE["product_quarter_pivot"] = with_sales("""
select product_line as "Product_Line", round(sum(revenue) filter (quarter = 'Q1'), 4) as "Q1",
  round(sum(revenue) filter (quarter = 'Q2'), 4) as "Q2", round(sum(revenue) filter (quarter = 'Q3'), 4) as "Q3",
  round(sum(revenue) filter (quarter = 'Q4'), 4) as "Q4" from s group by 1""")
