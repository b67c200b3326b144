"""Stable buckets that do not depend on partitioning or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(key: Column, buckets: int) -> Column:
    """The first 32 bits of ``md5(key)`` as an integer, modulo ``buckets``."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets).cast("bigint"))
