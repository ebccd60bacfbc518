"""Orders and their product lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINE_COLUMNS = ["product_id", "add_to_cart_order", "reordered"]


def orders_with_lines(orders: DataFrame, order_products: DataFrame, eval_set: str | None = "prior") -> DataFrame:
    """LEFT join of orders and lines; an order without lines keeps one row.

    Written as inner join plus the unmatched orders: adaptive execution can
    split a hot order on the line side of an inner join, but not on the right
    side of a left join. The unmatched part needs only the distinct order ids.
    """
    if eval_set is not None:
        orders = orders.where(F.col("eval_set") == eval_set)
    lines = order_products.select("order_id", *LINE_COLUMNS)
    matched = orders.join(lines, "order_id").select(*orders.columns, *LINE_COLUMNS)
    unmatched = orders.join(lines.select("order_id").distinct(), "order_id", "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def preview(rows: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in key order; the order is total, so the result is fixed."""
    return rows.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


def order_products_prior(orders: DataFrame, order_products: DataFrame) -> DataFrame:
    """INNER join of the 'prior' orders and their lines."""
    prior = orders.where(F.col("eval_set") == "prior")
    lines = order_products.select("order_id", *LINE_COLUMNS)
    return prior.join(lines, "order_id").select(*orders.columns, *LINE_COLUMNS)
