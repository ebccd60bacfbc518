"""The ratio features and the order of the model vector."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order of the 18 model inputs.
FEATURES = [
    "up_orders",
    "user_mean_days_since_prior",
    "user_period",
    "user_distinct_products",
    "user_reorder_ratio",
    "user_total_products",
    "up_average_cart_position",
    "up_last_order",
    "user_orders",
    "up_first_order",
    "prod_orders",
    "prod_reorder_probability",
    "prod_reorder_times",
    "prod_reorder_ratio",
    "user_average_basket",
    "up_order_rate",
    "up_orders_since_last_order",
    "up_order_rate_since_first_order",
]

# Counts that only feed the ratios and leave the row afterwards.
CONSUMED = ["prod_reorders", "prod_first_orders", "prod_second_orders"]


def ratio_columns() -> dict[str, Column]:
    """Seven derived features; a zero denominator gives NULL, never an error."""
    since_first = F.col("user_orders") - F.col("up_first_order") + F.lit(1)
    return {
        "prod_reorder_probability": F.try_divide("prod_second_orders", "prod_first_orders"),
        "prod_reorder_times": F.lit(1.0) + F.try_divide("prod_reorders", "prod_first_orders"),
        "prod_reorder_ratio": F.try_divide("prod_reorders", "prod_orders"),
        "user_average_basket": F.try_divide("user_total_products", "user_orders"),
        "up_order_rate": F.try_divide("up_orders", "user_orders"),
        "up_orders_since_last_order": F.col("user_orders") - F.col("up_last_order"),
        "up_order_rate_since_first_order": F.try_divide(F.col("up_orders"), since_first),
    }
