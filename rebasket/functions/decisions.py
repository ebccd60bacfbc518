"""From a probability to a yes or no."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The thresholds and the two texts.
SUBMISSION_THRESHOLD = 0.21
PAGE_THRESHOLD = 0.2
LIKELY = "Customer is likely to buy this product!"
UNLIKELY = "Customer is unlikely to buy this product!"


def above(score: str, threshold: float) -> Column:
    """1 when strictly above; NaN (which Spark sorts above all numbers) and NULL are 0."""
    s = F.col(score)
    return F.when(~F.isnan(s) & (s > F.lit(threshold)), 1).otherwise(0)


def rounded(score: str) -> Column:
    """Nearest whole number, halves to even; NULL for NaN and NULL."""
    s = F.col(score)
    return F.when(~F.isnan(s), F.bround(s)).cast("int")


def verdict(score: str, threshold: float = PAGE_THRESHOLD) -> Column:
    return F.when(above(score, threshold) == 1, LIKELY).otherwise(UNLIKELY)
