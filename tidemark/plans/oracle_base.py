"""DuckDB text of the sales mapping, shared by all check queries."""

from __future__ import annotations

from ..functions import fixed


def exact_sum(expr: str) -> str:
    return f"sum(cast({expr} as decimal(38,10)))"


def half_up(expr: str, digits: int = 2) -> str:
    """Ties away from zero: an exact decimal, rounded once."""
    return f"cast(round({expr}, {digits}) as double)"


def half_up_double(expr: str, digits: int = 2) -> str:
    """The same on the shortest decimal form of a double."""
    return half_up(f"cast(cast({expr} as varchar) as decimal(38,12))", digits)


def half_even(expr: str, digits: int = 2) -> str:
    """Ties to even on the scaled double."""
    return f"round_even(({expr}) * {10 ** digits}.0::double, 0) / {10 ** digits}.0::double"


def pick(values, index: str) -> str:
    inner = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{inner}], cast({index} as int) + 1)"


def rank(column: str, values) -> str:
    arms = " ".join(f"when {column} = '{v}' then {i}" for i, v in enumerate(values, 1))
    return f"cast(case {arms} end as int)"


def bins(column: str, edges, labels) -> str:
    arms = " ".join(f"when {column} <= {e} then '{l}'" for e, l in zip(edges[1:], labels))
    return f"case when {column} is null or {column} <= {edges[0]} then 'nan' {arms} else 'nan' end"


RAW = f"""
raw as (
  select cast(c_custkey as varchar) as customer_id,
    split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name, c_name as full_name,
    {pick(("Male", "Female"), "c_custkey % 2")} as gender,
    {pick(fixed.EDUCATION_LEVELS, "(c_custkey // 6) % 5")} as education,
    {pick(("Single", "Married", "Divorced"), "c_custkey % 3")} as marital_status,
    case when c_acctbal < 0 then 0.0::double else cast(floor(c_acctbal * 10) as double) end as income,
    cast(c_custkey % 75 as int) as months_as_member,
    {pick(fixed.LOYALTY_TIERS, "c_custkey % 6")} as loyaltystatus,
    c_acctbal + 1000 as clv,
    n_name as country, r_name as province_state, 'C' || (c_custkey % 10) as city, 'P' || (c_custkey % 10) as postal_code,
    c_nationkey * 1.5::double as latitude, c_nationkey * -2.5::double as longitude, 'Urban' as location_type,
    cast(year(o_orderdate) as int) as year, 'Q' || quarter(o_orderdate) as quarter,
    p_type as product_line, 'Coupon ' || left(o_orderpriority, 1) as coupon_response,
    1 as order_count, l_quantity as quantity_sold, l_extendedprice / nullif(l_quantity, 0) as unit_sale_price,
    p_retailprice as unit_cost, l_extendedprice * (1 - l_discount) as revenue
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    join part on l_partkey = p_partkey)"""

SALES = RAW + f""",
edges as (select quantile_cont(clv, 0.25) as e1, quantile_cont(clv, 0.5) as e2, quantile_cont(clv, 0.75) as e3 from raw),
coupons as (
  select coupon_response as cr, cast(floor(rank() over (order by n desc)
      + (count(*) over (partition by n) - 1) / 2.0) as int) as coupon_popularity_rank
  from (select coupon_response, count(*) as n from raw group by 1)),
products as (
  select product_line as pl, row_number() over (order by product_line) as product_id
  from (select distinct product_line from raw)),
s as (
  select *,
    case when income = 0 then 'No Income Reported' else 'Has Income' end as income_flag,
    year <> 2001 as is_full_year,
    unit_cost * quantity_sold as total_cost,
    revenue - unit_cost * quantity_sold as profit,
    {half_even("(revenue - unit_cost * quantity_sold) / nullif(revenue, 0) * 100", 4)} as profit_margin_pct,
    {half_even("revenue / order_count", 2)} as atv,
    {half_even("revenue / nullif(quantity_sold, 0)", 2)} as revenue_per_unit,
    revenue - unit_cost * quantity_sold as gross_contribution,
    year || '-' || quarter as year_quarter,
    cast(quarter[2] as int) as quarter_num,
    year || '0' || quarter[2] as date_key,
    {rank("loyaltystatus", fixed.LOYALTY_TIERS)} as loyalty_rank,
    {rank("education", fixed.EDUCATION_LEVELS)} as education_rank,
    {bins("income", fixed.INCOME_EDGES, fixed.INCOME_LABELS)} as income_bucket,
    {bins("months_as_member", fixed.TENURE_EDGES, fixed.TENURE_LABELS)} as tenure_bucket,
    case when clv <= e1 then 'Low CLV' when clv <= e2 then 'Mid CLV' when clv <= e3 then 'High CLV' else 'Top CLV' end as clv_segment,
    cast(coupon_response[8] as int) as coupon_num,
    upper(country[1:2]) || '_' || replace(upper(province_state[1:5]), ' ', '') as region_key,
    upper(country[1:2]) || '_' || replace(upper(province_state[1:5]), ' ', '') || '_' || city || '_' || postal_code as geo_key
  from raw cross join edges join coupons on cr = coupon_response join products on pl = product_line)"""

CUSTOMERS = """,
dim_customer as (
  select distinct customer_id, first_name, last_name, full_name, gender, education, education_rank, marital_status,
    income, income_flag, income_bucket, months_as_member, tenure_bucket, loyaltystatus, loyalty_rank, clv, clv_segment
  from s)"""


def with_raw(body: str, extra: str = "") -> str:
    return f"with {RAW.strip()}{extra}\n{body}"


def with_sales(body: str, extra: str = "", recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{SALES.strip()}{extra}\n{body}"


def with_customers(body: str, extra: str = "") -> str:
    return f"with {SALES.strip()}{CUSTOMERS}{extra}\n{body}"
