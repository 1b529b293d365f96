"""Row hashing that gives the same buckets in any engine with md5."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10_000


def hash_bucket(keys: Sequence[str], seed: int | str, buckets: int = BUCKETS) -> Column:
    """Bucket ``0 .. buckets-1`` from the md5 of ``seed:key[:key..]``.

    Depends on the key values only, so membership does not move when the input
    is repartitioned, extended or read by another engine.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(buckets)
