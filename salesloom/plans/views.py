"""The six metric views as texts that the catalog keeps, over the saved tables of a database.

Each gives the rows of the function of its name in ``metrics``; whoever has only SQL reads
these.  "Today" is the date of the run that published them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from salesloom.functions import columns as C
from salesloom.plans import catalog, metrics


def _ratio(num: str, den: str, scale: int, digits: int) -> str:
    times = "" if scale == 1 else f" * {scale}BD"
    return (f"CAST(round(CAST({num} AS decimal(24,4)) / nullif(CAST({den} AS decimal(24,4)), 0BD){times}, "
            f"{digits}) AS double)")


def _orders(by: str) -> str:
    """Sums by ``by`` over order grain, returns left out."""
    return f"""
        SELECT {by}, count(*) AS orders, count(DISTINCT customer_id) AS customers, sum(lines) AS lines,
               sum(revenue) AS revenue, sum(margin) AS margin
        FROM (SELECT {by}, order_id, customer_id, count(*) AS lines, sum(revenue) AS revenue,
                     sum(margin) AS margin
              FROM {{db}}.sales_fact WHERE NOT is_return GROUP BY {by}, order_id, customer_id)
        GROUP BY {by}"""


MONTHLY_REVENUE = f"""
    SELECT year, month, year_month, orders, customers, revenue, margin,
           {_ratio('revenue_sum', 'lines', 1, 2)} AS avg_item_value,
           {_ratio('revenue_sum', 'orders', 1, 2)} AS avg_ticket,
           {_ratio('margin', 'revenue', 100, 1)} AS margin_pct,
           CASE WHEN revenue = max(revenue) OVER () THEN '{metrics.PEAK_LABEL}' ELSE '' END AS peak_label
    FROM (SELECT year, month, concat(lpad(year, 4, '0'), '-', lpad(month, 2, '0')) AS year_month, orders,
                 customers, lines, revenue AS revenue_sum, round(revenue, 2) AS revenue,
                 round(margin, 2) AS margin
          FROM ({_orders('year, month')}))
    ORDER BY year DESC, month DESC"""

BRAND_RANKING = f"""
    SELECT brand, orders, customers, revenue, margin, {_ratio('margin', 'revenue', 100, 1)} AS margin_pct,
           {_ratio('revenue', 'total', 100, 2)} AS share_pct
    FROM (SELECT brand, orders, customers, round(revenue, 2) AS revenue, round(margin, 2) AS margin,
                 sum(revenue) OVER () AS total FROM ({_orders('brand')}))
    ORDER BY revenue DESC, brand"""

CATEGORY_MARGIN = f"""
    SELECT category, orders, skus, revenue, margin, {_ratio('margin', 'revenue', 100, 1)} AS margin_pct
    FROM (SELECT o.category, orders, skus, round(revenue, 2) AS revenue, round(margin, 2) AS margin
          FROM ({_orders('category')}) o JOIN (
               SELECT category, count(DISTINCT sku) AS skus FROM {{db}}.sales_fact WHERE NOT is_return
               GROUP BY category) s ON o.category <=> s.category)
    ORDER BY margin DESC, category"""

CUSTOMERS_AT_RISK = f"""
    SELECT customer_id, name, coalesce(city, '{C.MISSING_CITY}') AS city,
           coalesce(state, '{C.MISSING_STATE}') AS state, coalesce(segment, '{C.MISSING_SEGMENT}') AS segment,
           last_purchase, days_quiet, orders, round(revenue_sum, 2) AS revenue,
           {_ratio('revenue_sum', 'orders', 1, 2)} AS avg_ticket,
           {_ratio('revenue_sum', 'datediff({today}, first_purchase)', 30, 2)} AS est_monthly_avg
    FROM (SELECT *, datediff({{today}}, last_purchase) AS days_quiet
          FROM (SELECT customer_id, max(order_date) AS last_purchase, min(order_date) AS first_purchase,
                       count(DISTINCT order_id) AS orders, sum(revenue) AS revenue_sum
                FROM {{db}}.sales_fact WHERE NOT is_return GROUP BY customer_id))
         JOIN {{db}}.customers USING (customer_id)
    WHERE days_quiet > 90
    ORDER BY days_quiet DESC, customer_id"""

LAUNCH_EFFECT = f"""
    SELECT sku, brand, category, launch_date, days_since_launch, orders, revenue, margin,
           CASE WHEN days_since_launch < 0 THEN '{metrics.PHASE_BEFORE}'
                WHEN days_since_launch <= 120 THEN '{metrics.PHASE_EARLY}'
                ELSE '{metrics.PHASE_LATE}' END AS phase, p.name AS product_name
    FROM (SELECT sku, brand, category, launch_date, datediff(order_date, launch_date) AS days_since_launch,
                 count(DISTINCT order_id) AS orders, round(sum(revenue), 2) AS revenue,
                 round(sum(margin), 2) AS margin
          FROM {{db}}.sales_fact WHERE NOT is_return AND launch_date IS NOT NULL
          GROUP BY sku, brand, category, launch_date, datediff(order_date, launch_date))
         JOIN (SELECT sku, name FROM {{db}}.products) p USING (sku)
    ORDER BY sku, days_since_launch"""

STOCKOUT_BY_BRAND = f"""
    SELECT brand, sku_count, stocked_out, {_ratio('stocked_out', 'sku_count', 100, 1)} AS stockout_pct
    FROM (SELECT coalesce(brand, '{C.MISSING_BRAND}') AS brand, count(*) AS sku_count,
                 count_if(stock_out) AS stocked_out
          FROM {{db}}.stock LEFT JOIN (SELECT sku, brand FROM {{db}}.products) USING (sku)
          WHERE snapshot_on = (SELECT max(snapshot_on) FROM {{db}}.stock)
          GROUP BY coalesce(brand, '{C.MISSING_BRAND}'))
    ORDER BY stockout_pct DESC, brand"""

TEXTS = {
    "monthly_revenue": MONTHLY_REVENUE, "brand_ranking": BRAND_RANKING, "category_margin": CATEGORY_MARGIN,
    "customers_at_risk": CUSTOMERS_AT_RISK, "launch_effect": LAUNCH_EFFECT,
    "stockout_by_brand": STOCKOUT_BY_BRAND,
}


def publish(spark: SparkSession, db: str, name: str, as_of: dt.date, comment: str) -> None:
    """Create or replace a view in the catalog, with comments on it and its columns."""
    text = TEXTS[name].format(db=db, today=f"DATE'{as_of}'")
    names = spark.sql(text).columns
    if spark.catalog.tableExists(f"{db}.{name}") and spark.catalog.getTable(f"{db}.{name}").tableType != "VIEW":
        spark.sql(f"DROP TABLE {db}.{name}")  # of an earlier release, which kept results
    catalog.create_view(spark, f"{db}.{name}", text, comment, {c: c.replace("_", " ") for c in names})
