"""Small helpers for comparing frames."""

from pyspark.sql import functions as F

ORDER_SCHEMA = "order_id long, user_id long, eval_set string, order_number long, days_since_prior_order double"
LINE_SCHEMA = "order_id long, product_id long, add_to_cart_order long, reordered int"
PRIOR_SCHEMA = "order_id long, user_id long, product_id long, order_number long, add_to_cart_order long, reordered int"


def rows(frame, *columns):
    """Rows as plain tuples in a fixed order."""
    if columns:
        frame = frame.select(*columns)
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert rows(left, *columns) == rows(right, *columns)


def prior_of(spark, lines):
    """Prior lines from (user, product, order_number) or with a reordered flag."""
    full = [(i, r[0], r[1], r[2], 1, r[3] if len(r) > 3 else 0) for i, r in enumerate(lines)]
    return spark.createDataFrame(full, PRIOR_SCHEMA).withColumn("eval_set", F.lit("prior"))
