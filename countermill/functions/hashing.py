"""Key hashes that slice a table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from countermill.functions.columns import ColumnLike, as_column

# The signed 32-bit range the hash covers, and the number of slices of a scan.
HASH_LOWER = -(2**31)
HASH_UPPER = 2**31 - 1
HASH_SLICES = 200


def key_hash(key: ColumnLike) -> Column:
    """First 32 bits of the key's MD5 as a signed INT."""
    unsigned = F.conv(F.substring(F.md5(as_column(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.when(unsigned > HASH_UPPER, unsigned - 2**32).otherwise(unsigned).cast("int")


def hash_slice(key: ColumnLike, slices: int = HASH_SLICES) -> Column:
    """Slice number 0..slices-1: equal-width ranges of :func:`key_hash`."""
    offset = key_hash(key).cast("bigint") - F.lit(HASH_LOWER)
    return F.floor(offset * F.lit(slices) / F.lit(2.0**32)).cast("int")
