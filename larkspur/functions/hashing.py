"""Repeatable sampling: the bucket depends on the key only, so a re-run, a lost
executor or another partitioning gives the same split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(key: Column, buckets: int = 100, salt: str = "") -> Column:
    text = F.concat(key.cast("string"), F.lit(salt)) if salt else key.cast("string")
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def split_label(key: Column, shares: Sequence[tuple[str, int]], salt: str = "") -> Column:
    """Label by whole-percent shares, which must add up to 100."""
    if sum(share for _, share in shares) != 100:
        raise ValueError("shares must add up to 100")
    b = bucket(key, 100, salt)
    out = F.lit(shares[-1][0])
    upper = 100
    for name, share in reversed(list(shares)):
        out = F.when(b < upper, F.lit(name)).otherwise(out)
        upper -= share
    return out
