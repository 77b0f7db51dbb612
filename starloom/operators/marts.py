"""Reporting aggregates over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookups import current_filter

TOTAL = "decimal(28,4)"


def monthly_summary(fact: DataFrame, dates: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Quantity and net amount by month, product and customer segment.

    Each fact counts for the dimension version it was loaded with. The fact is cut to five columns; they meet the customers, then the
    products, and are summed once. Sums by both keys before that would be nearly as many rows, wider, and shuffled once more. A hot
    customer's rows are split by adaptive execution, or meet a customer that is broadcast.
    """
    months = dates.select("date_key", "year_number", "month_number", "month_name")
    lines = fact.select("date_key", "product_key", "customer_key", "quantity", "net_amount")
    joined = lines.join(customers.select("customer_key", "customer_segment"), "customer_key").drop("customer_key")
    joined = joined.join(products.select("product_key", "category", "product_name"), "product_key").join(months, "date_key")
    return joined.groupBy("year_number", "month_number", "month_name", "category", "product_name", "customer_segment").agg(
        F.sum("quantity").cast(TOTAL).alias("total_quantity"),
        F.sum("net_amount").cast(TOTAL).alias("total_net_amount"),
    )


def sales_by_segment(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Net amount and row count by segment of the current customers.

    Facts are summed per customer first: that is the only shuffle of the fact,
    a hot customer is one row per task in it, and the join reuses it.
    """
    per_customer = fact.groupBy("customer_key").agg(F.sum("net_amount").alias("net"), F.count("*").alias("n"))
    current = current_filter(customers).select("customer_key", "customer_segment")
    return (
        per_customer.join(current, "customer_key")
        .groupBy("customer_segment")
        .agg(F.sum("net").cast(TOTAL).alias("total_net_amount"), F.sum("n").alias("transaction_count"))
    )
