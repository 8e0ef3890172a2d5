"""The five business reports as SQL table functions over the registered tables.

``register`` makes them known to a session; after that SQL callers write ``SELECT * FROM stockout_report(7)``. The
functions read the views ``products``, ``sales``, ``inventory`` and ``forecasts`` (``tables.register_catalog``), give
the same rows as the functions of ``reports`` and, as any query in SQL, come in no fixed order unless it is asked for.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from demandspark import schemas

FUNCTIONS = {
    "monthly_category_report": (
        "",
        "sales_month STRING, category STRING, total_units_sold BIGINT, total_revenue DOUBLE, avg_discount_pct DOUBLE",
        """
        SELECT sales_month, category, sum(units), CAST(round(sum(revenue), 2) AS DOUBLE),
          round(CAST(sum(discount) AS DOUBLE) / sum(discounts), 2)
        FROM (SELECT date_format(date, 'yyyy-MM') AS sales_month, product_id, sum(units_sold) AS units, sum(revenue) AS revenue,
                sum(discount) AS discount, count(discount) AS discounts
              FROM sales GROUP BY 1, 2) s
          JOIN products p USING (product_id)
        GROUP BY sales_month, category""",
    ),
    "top_products_report": (
        "n INT COMMENT 'ranks per store'",
        "store_id STRING, rank_in_store INT, product_id STRING, product_name STRING, category STRING, total_revenue DOUBLE",
        """
        SELECT store_id, place, product_id, product_name, category, CAST(round(revenue, 2) AS DOUBLE)
        FROM (SELECT store_id, product_id, revenue, dense_rank() OVER (PARTITION BY store_id ORDER BY revenue DESC NULLS FIRST) AS place
              FROM (SELECT store_id, product_id, sum(revenue) AS revenue FROM sales GROUP BY 1, 2) s
                LEFT SEMI JOIN products USING (product_id)) r
          JOIN products USING (product_id)
        WHERE place <= top_products_report.n""",
    ),
    "stockout_report": (
        "days INT COMMENT 'days before the newest one that count'",
        "store_id STRING, product_id STRING, product_name STRING, current_inventory BIGINT, daily_run_rate DOUBLE, "
        "estimated_days_of_stock DOUBLE, inventory_health_status STRING",
        f"""
        SELECT i.store_id, i.product_id, p.product_name, i.inventory_level, coalesce(v.velocity, 0D),
          round(i.inventory_level / nullif(v.velocity, 0D), 1),
          CASE WHEN i.inventory_level < coalesce(v.velocity, 0D) * 3 THEN '{schemas.HEALTH_URGENT}'
               WHEN i.inventory_level > coalesce(v.velocity, 0D) * 14 THEN '{schemas.HEALTH_OVERSTOCK}'
               ELSE '{schemas.HEALTH_OPTIMAL}' END
        FROM inventory i JOIN products p ON p.product_id = i.product_id
          LEFT JOIN (SELECT store_id, product_id, round(avg(units_sold), 2) AS velocity FROM sales
                     WHERE date >= date_sub((SELECT max(date) FROM sales), stockout_report.days)
                     GROUP BY store_id, product_id) v
            ON v.product_id = i.product_id AND v.store_id = i.store_id""",
    ),
    "promo_elasticity_report": (
        "",
        "category STRING, avg_units_on_promo DOUBLE, avg_units_no_promo DOUBLE, promotion_sales_lift_pct DOUBLE",
        """
        SELECT category, round(up, 2), round(down, 2), round((up - down) / nullif(down, 0D) * 100, 2)
        FROM (SELECT category, sum(units_1) / nullif(CAST(sum(rows_1) AS DOUBLE), 0D) AS up,
                sum(units_0) / nullif(CAST(sum(rows_0) AS DOUBLE), 0D) AS down
              FROM (SELECT product_id, sum(units_sold) FILTER (WHERE promotion = 1) AS units_1,
                      count(units_sold) FILTER (WHERE promotion = 1) AS rows_1,
                      sum(units_sold) FILTER (WHERE promotion = 0) AS units_0,
                      count(units_sold) FILTER (WHERE promotion = 0) AS rows_0
                    FROM sales GROUP BY product_id) s
                JOIN products USING (product_id)
              GROUP BY category) c""",
    ),
    "forecast_accuracy_report": (
        "n INT COMMENT 'newest forecasts'",
        "product_id STRING, store_id STRING, forecast_date DATE, model_name STRING, predicted_demand DOUBLE, "
        "actual_units_sold BIGINT, absolute_error DOUBLE, error_percentage DOUBLE",
        """
        SELECT product_id, store_id, forecast_date, model_name, predicted, units_sold, round(abs(predicted - units_sold), 2),
          round(abs(predicted - units_sold) * 100 / nullif(CAST(units_sold AS DOUBLE), 0D), 2)
        FROM (SELECT f.product_id, f.store_id, f.forecast_date, f.model_name, CAST(f.predicted_demand AS DOUBLE) AS predicted, s.units_sold,
                row_number() OVER (ORDER BY f.forecast_date DESC NULLS FIRST, f.store_id, f.product_id, f.model_name) AS place
              FROM forecasts f JOIN sales s ON s.product_id = f.product_id AND s.store_id = f.store_id AND s.date = f.forecast_date) r
        WHERE place <= forecast_accuracy_report.n""",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Make the five functions known to the session; returns their names."""
    for name, (parameters, columns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")
    return list(FUNCTIONS)
