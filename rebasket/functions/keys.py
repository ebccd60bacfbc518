"""Repeatable row buckets. They depend on key values only, so a retried task,
another partitioning or another engine gives the same bucket."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIR = ["user_id", "product_id"]


def hash_bucket(keys: list[str], buckets: int = 100, seed: int | None = None) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of the md5 of the keys."""
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts = [F.lit(str(seed)), *parts]
    digest = F.substring(F.md5(F.concat_ws("-", *parts)), 1, 8)
    return F.conv(digest, 16, 10).cast("bigint") % F.lit(buckets)


def user_bucket(buckets: int) -> Column:
    """Bucket of a user for tables stored by user; the same for every integer type."""
    return F.pmod(F.xxhash64(F.col("user_id").cast("bigint")), F.lit(buckets)).cast("int")


def hash_number(keys: list[str], seed: int | None = None) -> Column:
    """A number below 2**60 from the md5 of the keys, for an order that looks random and repeats."""
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts = [F.lit(str(seed)), *parts]
    return F.conv(F.substring(F.md5(F.concat_ws("-", *parts)), 1, 15), 16, 10).cast("bigint")
