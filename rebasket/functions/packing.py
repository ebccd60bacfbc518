"""The packed feature text and the request text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pack(features: list[str]) -> Column:
    """Comma-joined values; a missing value is an empty field, so positions hold."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in features])


def unpack(packed: str, features: list[str]) -> dict[str, Column]:
    """One double per position; an empty or unreadable field is NULL."""
    fields = F.split(F.col(packed), ",")
    return {c: F.get(fields, F.lit(i)).try_cast("double") for i, c in enumerate(features)}


def request_key(body: str, position: int) -> Column:
    """Key number ``position`` of a 'user_id,product_id' text, NULL if unreadable."""
    return F.trim(F.get(F.split(F.col(body), ","), F.lit(position))).try_cast("bigint")
