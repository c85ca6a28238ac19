"""Row-stable pseudo-random numbers.

The draw depends on the key and the seed alone, never on partitioning or row order, so a lost
executor, a retry or another cluster size gives the same rows. MD5 is used because every SQL engine
has it: the same sample can be reproduced outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RESOLUTION = 1 << 32


def digest(keys: list[Column], seed: int) -> Column:
    """MD5 text of the keys and the seed."""
    parts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def draw(keys: list[Column], seed: int) -> Column:
    """Uniform integer in ``[0, 2**32)``."""
    return F.conv(F.substring(digest(keys, seed), 1, 8), 16, 10).cast("long")
