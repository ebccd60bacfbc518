"""User, product and user-by-product features, and the joined matrix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebasket.functions.keys import PAIR
from rebasket.functions.ratios import CONSUMED, ratio_columns
from rebasket.operators.running import running_totals

# Order numbers per block when the lines of a pair are ranked.
ORDERS_PER_BLOCK = 65_536


def user_features_1(orders: DataFrame) -> DataFrame:
    """Per user over all orders: last order number, days in total and on average."""
    return orders.groupBy("user_id").agg(
        F.max("order_number").alias("user_orders"),
        F.sum("days_since_prior_order").alias("user_period"),
        F.avg("days_since_prior_order").alias("user_mean_days_since_prior"),
    )


def user_features_2(prior: DataFrame) -> DataFrame:
    """Per user over the prior lines: products, distinct products, reorder ratio."""
    again = F.count_if(F.col("reordered") == 1)
    after_first = F.count_if(F.col("order_number") > 1)
    return prior.groupBy("user_id").agg(
        F.count("product_id").alias("user_total_products"),
        F.count_distinct("product_id").alias("user_distinct_products"),
        F.try_divide(again, after_first).alias("user_reorder_ratio"),
    )


def up_features(prior: DataFrame) -> DataFrame:
    """Per user and product: orders, first and last order, mean cart position."""
    return prior.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("up_orders"),
        F.min("order_number").alias("up_first_order"),
        F.max("order_number").alias("up_last_order"),
        F.avg("add_to_cart_order").alias("up_average_cart_position"),
    )


def product_seq_time(prior: DataFrame, orders_per_block: int = ORDERS_PER_BLOCK) -> DataFrame:
    """Every prior line with its purchase number for this user and product.

    The number is a rank: lines of one order number tie and the next one skips.
    Lines are counted per order number, which removes the ties, ranked in blocks
    of order numbers, and the rank is joined back to the lines; so no task holds
    all lines, or all orders, of a pair.
    """
    # a missing order number sorts first, in a block of its own
    known = F.col("order_number").isNotNull()
    lines = prior.withColumns({"_known": known, "_order": F.coalesce("order_number", F.lit(0))})
    step = ["_known", "_order"]
    steps = lines.groupBy(*PAIR, *step).agg(F.count(F.lit(1)).alias("n"))
    block = F.when(F.col("_known"), F.floor(F.col("_order") / F.lit(orders_per_block))).otherwise(F.lit(-(1 << 63)))
    steps = running_totals(steps, PAIR, block, step, ["n"]).select(
        *[F.col(c).alias(f"_of_{c}") for c in [*PAIR, *step]], (F.col("n_before") + 1).alias("product_seq_time"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*PAIR, *step]])
    return lines.join(steps, same).select(*prior.columns, F.col("product_seq_time").cast("bigint"))


def prd_features(prior: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Per product: lines, reorders, and lines that are a first or second purchase.

    A line is a first purchase when no line of the pair has a lower order
    number, and a second one when exactly one line has. So the two lowest order
    numbers of a pair and their line counts decide, and counting per order
    number before the window keeps both shuffles free of hot groups: the window
    passes on at most two rows per pair from every task. With ``user_id`` in
    ``within``, or columns that follow from it, the counts are kept apart by them.
    """
    group = [*(within or []), "product_id"]
    pair = [*(c for c in within or [] if c not in PAIR), *PAIR]
    per_order = prior.groupBy(*pair, "order_number").agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy(*pair).orderBy("order_number"))
    lowest = per_order.withColumn("nth", nth).where(F.col("nth") <= 2)
    pairs = lowest.groupBy(*pair).agg(
        F.sum(F.when(F.col("nth") == 1, F.col("n"))).alias("first"),
        F.sum(F.when(F.col("nth") == 2, F.col("n"))).alias("second"),
    )
    sequence = pairs.select(
        *group,
        F.col("first").alias("prod_first_orders"),
        F.when(F.col("first") == 1, F.col("second")).alias("prod_second_orders"),
    )
    lines = prior.select(*group, F.lit(1).alias("prod_orders"), F.col("reordered").alias("prod_reorders"))
    # Both kinds of rows meet in one partial aggregate, so one small shuffle serves them.
    every = lines.unionByName(sequence, allowMissingColumns=True)
    return every.groupBy(*group).agg(
        F.count("prod_orders").alias("prod_orders"),
        F.sum("prod_reorders").alias("prod_reorders"),
        F.sum("prod_first_orders").alias("prod_first_orders"),
        F.coalesce(F.sum("prod_second_orders"), F.lit(0)).alias("prod_second_orders"),
    )


def purchases(prior: DataFrame) -> DataFrame:
    """The prior lines summed per user, product and order number: all that the
    three line features need, from one pass over the lines."""
    return prior.groupBy(*PAIR, "order_number").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("reordered") == 1).alias("again"),
        F.sum("reordered").alias("reorders"),
        F.sum("add_to_cart_order").alias("carts"),
        F.count("add_to_cart_order").alias("carted"),
    )


def pair_summary(bought: DataFrame) -> DataFrame:
    """One row per user and product from ``purchases``.

    The two lowest order numbers pass a limited window; the sums are plain
    aggregates, so neither gathers the orders of a pair in one task.
    """
    nth = F.row_number().over(Window.partitionBy(*PAIR).orderBy("order_number"))
    lowest = bought.select(*PAIR, "order_number", "n").withColumn("nth", nth).where(F.col("nth") <= 2)
    ends = lowest.select(
        *PAIR, F.when(F.col("nth") == 1, F.col("n")).alias("first"), F.when(F.col("nth") == 2, F.col("n")).alias("second"))
    both = bought.unionByName(ends, allowMissingColumns=True)
    return both.groupBy(*PAIR).agg(
        *[F.sum(c).alias(c) for c in ("n", "again", "reorders", "carts", "carted", "first", "second")],
        F.sum(F.when(F.col("order_number") > 1, F.col("n"))).alias("later"),
        F.min("order_number").alias("up_first_order"),
        F.max("order_number").alias("up_last_order"),
    )


def line_features(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``user_features_2``, ``up_features`` and ``prd_features`` from ``pair_summary``."""
    users = pairs.groupBy("user_id").agg(
        F.coalesce(F.sum(F.when(F.col("product_id").isNotNull(), F.col("n"))), F.lit(0)).alias("user_total_products"),
        F.count("product_id").alias("user_distinct_products"),
        F.try_divide(F.sum("again"), F.sum("later")).alias("user_reorder_ratio"),
    )
    up = pairs.select(
        *PAIR, F.col("n").alias("up_orders"), "up_first_order", "up_last_order",
        F.try_divide("carts", "carted").alias("up_average_cart_position"))
    products = pairs.groupBy("product_id").agg(
        F.sum("n").alias("prod_orders"),
        F.sum("reorders").alias("prod_reorders"),
        F.sum("first").alias("prod_first_orders"),
        F.coalesce(F.sum(F.when(F.col("first") == 1, F.col("second"))), F.lit(0)).alias("prod_second_orders"),
    )
    return users, up, products


def features_join(up: DataFrame, prd: DataFrame, uf1: DataFrame, uf2: DataFrame) -> DataFrame:
    """Inner joins of the pair rows with their product and user features.

    The two user tables hold one row per user, so they are joined first; each
    join of the large pair table then stands alone in its stage and adaptive
    execution may split a hot user or product.
    """
    users = uf1.join(uf2, "user_id")
    return up.join(users, "user_id").join(prd, "product_id")


def derive_features(joined: DataFrame) -> DataFrame:
    """Add the seven ratios and drop the counts only they use."""
    return joined.withColumns(ratio_columns()).drop(*CONSUMED)
