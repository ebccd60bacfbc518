"""Decisions and the per-order recommendation list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebasket.functions.decisions import PAGE_THRESHOLD, SUBMISSION_THRESHOLD, above, rounded, verdict


def decide(scored: DataFrame, score: str = "prob", threshold: float = SUBMISSION_THRESHOLD,
           page_threshold: float = PAGE_THRESHOLD) -> DataFrame:
    """Add the 0/1 decision, the half-to-even rounding and the page's text."""
    return scored.withColumns({
        "decision": above(score, threshold),
        "rounded": rounded(score),
        "verdict": verdict(score, page_threshold),
    })


def submission(decided: DataFrame) -> DataFrame:
    """Per order its chosen products in number order, or 'None'; sorted by order.

    The set of an order is never larger than the catalogue, and repeated rows
    collapse in the partial aggregate before the shuffle.
    """
    chosen = F.when(F.col("decision") == 1, F.col("product_id"))
    listed = F.array_join(F.sort_array(F.collect_set(chosen)), " ")
    orders = decided.groupBy("order_id").agg(listed.alias("products"))
    products = F.when(F.col("products") == "", "None").otherwise(F.col("products"))
    return orders.withColumn("products", products).orderBy("order_id")
