"""Ad-hoc SQL over the registered datasets (SQL-1).

Users query the catalogued tables with ``spark.sql``; results can be written
to a results folder. The two statements below are examples over ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DAILY_REVENUE = """
SELECT order_date, ROUND(SUM(total_amount), 2) AS revenue, COUNT(order_id) AS orders
FROM {orders}
GROUP BY order_date
"""

# Top market of each year: a ranked report, the one place a rank limit is the point.
TOP_MARKET_PER_YEAR = """
SELECT year, country, revenue FROM (
  SELECT year, country, ROUND(SUM(total_amount), 2) AS revenue,
         RANK() OVER (PARTITION BY year ORDER BY ROUND(SUM(total_amount), 2) DESC) AS rnk
  FROM {orders}
  GROUP BY year, country
) WHERE rnk = 1
"""


def run_sql(spark: SparkSession, statement: str, results_path: str | None = None,
            **tables: str) -> DataFrame:
    df = spark.sql(statement.format(**tables))
    if results_path:
        df.write.mode("overwrite").parquet(results_path)
    return df
