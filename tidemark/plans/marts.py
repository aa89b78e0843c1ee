"""SQL marts over the curated tables.

Each mart is one text over ``{fact_sales}``, ``{dim_customer}`` ... placeholders. The placeholders
take DataFrames (``mart``) or catalog names (``sources/catalog.py`` creates the views from the
same texts). Facts are aggregated before they meet a dimension.

Amounts are summed as exact decimals of ten places, so totals do not depend on the order of rows and are rounded once.
Infinite and not-a-number amounts count as missing there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PERIOD = "year * 4 + quarter_num"
_SUMS = "sum(try_cast(revenue AS decimal(28, 10))) AS revenue, sum(try_cast(profit AS decimal(28, 10))) AS profit"

SALES_BY_PRODUCT = f"""
WITH per_id AS (
  SELECT product_id, count(*) AS n, sum(order_count) AS orders, sum(quantity_sold) AS quantity,
         {_SUMS}
  FROM {{fact_sales}} GROUP BY product_id)
SELECT p.product_line, sum(n) AS transaction_rows, sum(orders) AS total_orders, sum(quantity) AS total_quantity,
       cast(round(sum(revenue), 2) AS double) AS total_revenue,
       cast(round(sum(profit), 2) AS double) AS total_profit,
       round(try_divide(cast(sum(profit) AS double), cast(sum(revenue) AS double)) * 100, 2) AS profit_margin_pct
FROM per_id LEFT JOIN {{dim_product}} p ON per_id.product_id = p.product_id
GROUP BY p.product_line
"""

SALES_BY_QUARTER = f"""
SELECT year, quarter, quarter_num, year_quarter, transaction_rows, total_orders,
       cast(round(revenue, 2) AS double) AS total_revenue,
       cast(round(profit, 2) AS double) AS total_profit,
       round(try_divide(cast(profit AS double), cast(revenue AS double)) * 100, 2) AS profit_margin_pct
FROM (
  SELECT year, quarter, quarter_num, year_quarter, count(*) AS transaction_rows,
         sum(order_count) AS total_orders, {_SUMS}
  FROM {{fact_sales}} GROUP BY year, quarter, quarter_num, year_quarter)
"""

# avg_clv stays weighted by transactions: customer CLV times the customer's row count.
SALES_BY_LOYALTY = f"""
WITH per_customer AS (
  SELECT loyaltystatus, loyalty_rank, customer_id, count(*) AS n, {_SUMS}
  FROM {{fact_sales}} GROUP BY loyaltystatus, loyalty_rank, customer_id)
SELECT f.loyaltystatus, f.loyalty_rank, count(f.customer_id) AS unique_customers, sum(n) AS transaction_rows,
       cast(round(sum(revenue), 2) AS double) AS total_revenue,
       cast(round(sum(profit), 2) AS double) AS total_profit,
       round(try_divide(cast(sum(try_cast(c.clv AS decimal(20, 10)) * cast(n AS decimal(17, 0))) AS double),
             sum(CASE WHEN try_cast(c.clv AS decimal(20, 10)) IS NOT NULL THEN n END)), 2) AS avg_clv,
       round(try_divide(cast(sum(revenue) AS double), count(f.customer_id)), 2) AS revenue_per_customer
FROM per_customer f LEFT JOIN {{dim_customer}} c ON f.customer_id = c.customer_id
GROUP BY f.loyaltystatus, f.loyalty_rank
"""

CUSTOMER_VALUE = f"""
WITH bought AS (
  SELECT customer_id, count(*) AS n, sum(order_count) AS orders, {_SUMS},
         max(year_quarter) AS last_label, max({_PERIOD}) AS last_idx
  FROM {{fact_sales}} GROUP BY customer_id)
SELECT c.customer_id, c.full_name, c.loyaltystatus, c.loyalty_rank, c.clv, c.clv_segment, c.months_as_member,
       coalesce(n, 0) AS transaction_rows, coalesce(orders, 0) AS total_orders,
       cast(round(coalesce(revenue, 0), 2) AS double) AS total_revenue,
       cast(round(coalesce(profit, 0), 2) AS double) AS total_profit,
       last_label AS last_observed_quarter, last_idx AS last_quarter_idx
FROM {{dim_customer}} c LEFT JOIN bought b ON c.customer_id = b.customer_id
"""

RETENTION_PRIORITY = f"""
WITH aged AS (
  SELECT cv.*, m.newest - cv.last_quarter_idx AS idle
  FROM {{customer_value}} cv CROSS JOIN (SELECT max({_PERIOD}) AS newest FROM {{fact_sales}}) m)
SELECT customer_id, full_name, loyaltystatus, loyalty_rank, clv, clv_segment, months_as_member, total_orders,
       total_revenue, total_profit, last_observed_quarter, idle AS quarters_since_last_purchase,
       CASE WHEN idle >= 8 OR (clv_segment = 'Top CLV' AND total_revenue >= 5000) THEN 'Critical'
            WHEN idle >= 4 OR clv_segment IN ('Top CLV', 'High CLV') THEN 'High Risk'
            WHEN idle >= 2 OR total_revenue >= 3000 THEN 'Medium Risk'
            WHEN total_revenue > 0 THEN 'Low Risk'
            ELSE 'Monitor' END AS retention_priority
FROM aged
"""

CHURN_PRIORITY_CUSTOMERS = "SELECT * FROM {retention_priority}"

# In dependency order: every mart only reads tables and marts listed before it.
MARTS: dict[str, str] = {
    "sales_by_product": SALES_BY_PRODUCT,
    "sales_by_quarter": SALES_BY_QUARTER,
    "sales_by_loyalty": SALES_BY_LOYALTY,
    "customer_value": CUSTOMER_VALUE,
    "retention_priority": RETENTION_PRIORITY,
    "churn_priority_customers": CHURN_PRIORITY_CUSTOMERS,
}

# Checks to run after the marts are in place, as name -> text.
VALIDATIONS: dict[str, str] = {
    "val_row_counts": """
SELECT 'fact_sales' AS table_name, count(*) AS row_count FROM {fact_sales}
UNION ALL SELECT 'dim_customer', count(*) FROM {dim_customer}
UNION ALL SELECT 'dim_product', count(*) FROM {dim_product}
UNION ALL SELECT 'dim_date', count(*) FROM {dim_date}
UNION ALL SELECT 'dim_geography', count(*) FROM {dim_geography}
""",
    "val_freshness": """
SELECT min(year_quarter) AS min_quarter, max(year_quarter) AS max_quarter,
       count(DISTINCT year_quarter) AS quarter_count FROM {fact_sales}
""",
    "val_negative_rows": "SELECT count(*) AS invalid_rows FROM {fact_sales} WHERE revenue < 0 OR profit < 0",
    "val_partition_counts": """
SELECT partition_year, count(*) AS row_count FROM {fact_sales} GROUP BY partition_year ORDER BY partition_year
""",
    "val_top_products": """
SELECT product_line, total_revenue FROM {sales_by_product} ORDER BY total_revenue DESC, product_line LIMIT 3
""",
    "val_product_order": """
SELECT product_line, total_revenue, total_profit FROM {sales_by_product} ORDER BY total_revenue DESC, product_line
""",
    "val_recent_quarters": """
SELECT year_quarter, total_revenue FROM {sales_by_quarter} ORDER BY year_quarter DESC LIMIT 3
""",
    "val_loyalty_order": """
SELECT loyaltystatus, loyalty_rank, total_revenue, unique_customers FROM {sales_by_loyalty}
ORDER BY loyalty_rank NULLS LAST
""",
    "val_top_customers": """
SELECT customer_id, total_revenue FROM {customer_value} ORDER BY total_revenue DESC, customer_id LIMIT 3
""",
    "val_priority_counts": """
SELECT retention_priority, count(*) AS customers FROM {retention_priority}
GROUP BY retention_priority ORDER BY customers DESC, retention_priority
""",
    "val_churn_priority_counts": """
SELECT retention_priority, count(*) AS customers FROM {churn_priority_customers}
GROUP BY retention_priority ORDER BY customers DESC, retention_priority
""",
}


def names_in(text: str) -> list[str]:
    known = ("fact_sales", "dim_customer", "dim_product", "dim_date", "dim_geography", *MARTS)
    return [n for n in known if "{" + n + "}" in text]


def run_text(spark: SparkSession, text: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run a mart or validation text; marts it builds on are planned into the same query."""
    inputs = {n: tables[n] if n in tables else run_text(spark, MARTS[n], tables) for n in names_in(text)}
    return spark.sql(text, **inputs)


def mart(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    return run_text(spark, MARTS[name], tables)


def validation(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    return run_text(spark, VALIDATIONS[name], tables)
