"""Key expressions that do not depend on partitioning or row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int) -> Column:
    """A bucket in ``[0, buckets)`` from the MD5 of the key's text form."""
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("bigint"), F.lit(buckets).cast("bigint"))


def key_bucket(key: Column, buckets: int, hashed: bool = True) -> Column:
    """``hash_bucket``, or the plain remainder of an integer key when ``hashed`` is false."""
    if hashed:
        return hash_bucket(key, buckets)
    return F.pmod(key.cast("bigint"), F.lit(buckets).cast("bigint"))
