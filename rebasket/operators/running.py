"""Running totals that hold when one group is very large.

A plain window sends a whole group to one task. Here the rows of a group are
cut into ordered blocks: totals inside a block come from a window over the
block, totals of the blocks before it from a window over one row per block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebasket.session import stored

# Rows of a block of ``range_blocks``: what a window sorts in one task.
ROWS_PER_BLOCK = 500_000

# What stands for a missing key, as text; other types take "0".
_SOME = {"date": "1970-01-01", "timestamp": "1970-01-01 00:00:00", "timestamp_ntz": "1970-01-01 00:00:00"}


def running_totals(
    rows: DataFrame,
    keys: list[str],
    block: Column,
    order: list[str],
    weights: list[str],
) -> DataFrame:
    """Add ``<w>_before`` and ``<w>_total`` for every weight column.

    ``<w>_before`` sums the weight over the rows of the same key that come
    earlier in ``order``; ``<w>_total`` sums it over the key. ``block`` must not
    decrease along ``order``; NULL is a key like any other, ``block`` and ``order``
    hold no NULL.
    """
    # A NULL key becomes a value and a bit in ``_none``. Plain equality then holds, so the window inside
    # the blocks and the join with their totals share one shuffle of the rows.
    columns, types = rows.columns, dict(rows.dtypes)
    bits = [F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, k in enumerate(keys)]
    filled = {k: F.coalesce(F.col(k), F.lit(_SOME.get(types[k], "0")).cast(types[k])) for k in keys}
    rows = rows.withColumns(
        {**filled, "_block": F.coalesce(block, F.lit(0)), "_none": reduce(Column.__add__, bits, F.lit(0))})
    key = [*keys, "_none"]
    part = [*key, "_block"]
    all_blocks = Window.partitionBy(*key)
    earlier = all_blocks.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    blocks = rows.groupBy(*part).agg(*[F.sum(w).alias(f"_{w}") for w in weights])
    blocks = blocks.select(
        *part,
        *[F.coalesce(F.sum(f"_{w}").over(earlier), F.lit(0)).alias(f"_{w}_earlier") for w in weights],
        *[F.sum(f"_{w}").over(all_blocks).alias(f"{w}_total") for w in weights],
    )
    within = rows.withColumns(
        {f"_{w}_inside": F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights}
    )
    known = {k: F.when(F.col("_none").bitwiseAND(F.lit(1 << i)) == 0, F.col(k)) for i, k in enumerate(keys)}
    return within.join(blocks, part).select(
        *[known[c].alias(c) if c in known else c for c in columns],
        *[f"{w}_total" for w in weights],
        *[(F.col(f"_{w}_earlier") + F.col(f"_{w}_inside")).alias(f"{w}_before") for w in weights],
    )


def range_blocks(rows: DataFrame, order: list[str], name: str, per_block: int | None = None) -> DataFrame:
    """The rows, stored by the caller, with ``block``: numbers that ascend along ``order``.

    Blocks are ranges of about ``per_block`` rows that Spark cuts at sampled
    quantiles of the order columns, so their number follows the rows. Ranges
    are stored, so that a row keeps its block; a single block is a constant.
    """
    blocks = max(1, -(-rows.count() // (per_block or ROWS_PER_BLOCK)))
    if blocks == 1:
        return rows.withColumn("block", F.lit(0))
    return stored(rows.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id()), name)
