"""Daily metrics as partial states that merge, exact distinct buyers included.

A state is a row per day, category and buyer: the buyer's presence and sums of
the buyer's sales. Sums add up and rows of the same buyer become one, so a
delivery is folded into the days it touches without looking at the sales that are
there already, and counting a buyer of two deliveries once. States are never more
than the sales, whatever the number of buyers that there are; bitmaps over all
buyers would grow with days times buyers, and on most days few of them buy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("sale_date", "product_category")
SUMS = ("total_sales", "total_quantity", "transaction_count", "amount_count")


def partial_states(fact: DataFrame, member: str = "customer_id") -> DataFrame:
    """One row per day, category and buyer with the sums of the sales.

    Sales without ``member`` are summed up in a row of their own, which counts as
    no buyer. Rows merge inside each task first.
    """
    return fact.groupBy(*KEYS, F.col(member).alias("buyer")).agg(
        F.sum("total_amount").alias("total_sales"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        F.count("transaction_id").alias("transaction_count"),
        F.count("total_amount").alias("amount_count"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """States of the same day, category and buyer as one."""
    return states.groupBy(*KEYS, "buyer").agg(*[F.sum(c).alias(c) for c in SUMS])


def metrics_of(states: DataFrame) -> DataFrame:
    """Metrics per day and category from states, merged or not."""
    return (
        merge_states(states)
        .groupBy(*KEYS)
        .agg(
            F.sum("total_sales").alias("total_sales"),
            F.sum("total_quantity").alias("total_quantity"),
            F.sum("transaction_count").alias("transaction_count"),
            _mean(F.sum("total_sales"), F.sum("amount_count")).alias("avg_transaction_value"),
            F.count("buyer").alias("unique_customers"),
        )
    )


def _mean(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n.cast("double"))
