"""The shop tables, derived from a star schema of orders, lineitem and part.

A product is a part name. A user's last order is the one to predict ('train'
for three of four users, else 'test'); all earlier ones are 'prior'.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rebasket.operators.prior import order_products_prior
from rebasket.operators.running import range_blocks, running_totals
from rebasket.session import shared_dir, size_shuffles, stored
from rebasket.sources.files import write_prior
from rebasket.sources.schemas import ORDER_LINES, ORDER_PRODUCTS, ORDERS, PRODUCTS


def derive_products(part: DataFrame) -> DataFrame:
    """Part names numbered in name order; aisle and department are their words."""
    names = part.select(F.col("p_name").alias("product_name")).distinct().withColumn("one", F.lit(1))
    names = range_blocks(stored(names, "product-names"), ["product_name"], "product-blocks")
    numbered = running_totals(names, [], F.col("block"), ["product_name"], ["one"])
    return numbered.select(
        (F.col("one_before") + 1).cast("bigint").alias("product_id"),
        "product_name",
        F.split_part("product_name", F.lit(" "), F.lit(1)).alias("aisle"),
        F.split_part("product_name", F.lit(" "), F.lit(2)).alias("department"),
    )


def derive_orders(raw: DataFrame) -> DataFrame:
    """Order numbers, days since the previous order and the eval set per user.

    Numbered in ranges of (user, date, order), so a user with very many orders,
    or with very many on one day, is spread over tasks; only one row per user and
    day meets in the window over a user.
    """
    rows = raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        "o_orderdate",
        F.to_date("o_orderdate").alias("day"),
        F.lit(1).alias("one"),
    )
    first = F.min(F.struct("o_orderdate", "order_id")).getField("order_id")
    days = rows.groupBy("user_id", "day").agg(first.alias("first_id"))
    previous = F.lag("day").over(Window.partitionBy("user_id").orderBy("day"))
    days = days.withColumn("gap", F.datediff("day", previous))

    ranged = range_blocks(rows, ["user_id", "o_orderdate", "order_id"], "order-ranges")
    numbered = running_totals(ranged, ["user_id"], F.col("block"), ["o_orderdate", "order_id"], ["one"])
    number = F.col("one_before") + 1
    open_set = F.when(F.col("user_id") % 4 < 3, "train").otherwise("test")
    gap = F.when(F.col("order_id") == F.col("first_id"), F.col("gap")).otherwise(0)
    return numbered.join(days, ["user_id", "day"]).select(
        "order_id",
        "user_id",
        F.when(number < F.col("one_total"), "prior").otherwise(open_set).alias("eval_set"),
        number.cast("bigint").alias("order_number"),
        gap.cast("double").alias("days_since_prior_order"),
    )


def derive_order_products(lineitem: DataFrame, part: DataFrame, products: DataFrame,
                          orders: DataFrame) -> DataFrame:
    """One line per order and product with its cart position and reorder flag.

    The window over an order holds at most one row per product.
    """
    # Two numbers per part, stored, so that they are broadcast when their size allows and the lines are not shuffled.
    names = stored(part.join(products, F.col("p_name") == F.col("product_name")).select("p_partkey", "product_id"), "part-names")
    lines = (
        lineitem.join(names, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("order_id"), "product_id")
        .agg(F.min("l_linenumber").alias("pos"))
    )
    position = F.row_number().over(Window.partitionBy("order_id").orderBy("pos", "product_id"))
    lines = lines.withColumn("add_to_cart_order", position.cast("bigint"))
    # Stored, since two passes read the lines.
    lines = stored(lines.join(orders.select("order_id", "user_id", "order_number"), "order_id"), "placed-lines")
    firsts = lines.groupBy("user_id", "product_id").agg(F.min("order_number").alias("first_number"))
    again = F.when(F.col("order_number") > F.col("first_number"), 1).otherwise(0)
    return lines.join(firsts, ["user_id", "product_id"]).select(
        "order_id", "product_id", "add_to_cart_order", again.alias("reordered"))


def prior_with_repeats(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Prior lines with the supplier as product and repeats kept: a pair may
    have several lines in one order, so purchase ranks tie."""
    lines = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("product_id"),
        F.col("l_linenumber").cast("bigint").alias("add_to_cart_order"),
        F.when(F.col("l_linenumber") > 1, 1).otherwise(0).alias("reordered"),
    )
    return order_products_prior(orders, lines)


STORED = {
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_products": ORDER_PRODUCTS,
    "order_products_prior": ORDER_LINES,
}
_written: set[str] = set()
_writing = threading.RLock()  # a table may need another one


class Shop:
    """The shop tables of one data folder. Each is derived when a job first asks for it
    and written once per application.

    They are stored in the shared folder, so every later job scans Parquet with
    statistics and no lineage reaches back to the derivation.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        digest = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
        self.spark = spark
        self.sf_dir = sf_dir
        self.where = f"{shared_dir(spark)}/shop-{spark.sparkContext.applicationId}-{digest}"

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _table(self, name: str, write: Callable[[str], None]) -> DataFrame:
        path = f"{self.where}/{name}"
        with _writing:
            if path not in _written:
                write(path)
                _written.add(path)
        return self.spark.read.schema(STORED[name]).parquet(path)

    @property
    def products(self) -> DataFrame:
        return self._table("products", lambda path: derive_products(
            self._raw("part")).write.mode("overwrite").parquet(path))

    @property
    def orders(self) -> DataFrame:
        # The hint sizes the files: one per few tasks, not one per task and eval set.
        return self._table("orders", lambda path: derive_orders(self._raw("orders")).hint(
            "rebalance", "eval_set").write.mode("overwrite").partitionBy("eval_set").parquet(path)).select(
            "order_id", "user_id", "eval_set", "order_number", "days_since_prior_order")

    @property
    def order_products(self) -> DataFrame:
        return self._table("order_products", lambda path: derive_order_products(
            self._raw("lineitem"), self._raw("part"), self.products, self.orders).write.mode("overwrite").parquet(path))

    @property
    def order_products_prior(self) -> DataFrame:
        return self._table("order_products_prior", lambda path: write_prior(
            order_products_prior(self.orders, self.order_products), path))

    @property
    def order_products_train(self) -> DataFrame:
        train = self.orders.where(F.col("eval_set") == "train").select("order_id")
        return self.order_products.join(train, "order_id", "left_semi").select(
            "order_id", "product_id", "reordered")


def shop(spark: SparkSession, sf_dir: str) -> Shop:
    """The shop tables of one data folder; shuffles of the session follow its lines."""
    size_shuffles(spark, spark.read.parquet(f"{sf_dir}/lineitem.parquet").count())
    return Shop(spark, sf_dir)
