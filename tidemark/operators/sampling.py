"""Bounded samples for training, drawn by hash: the same rows whenever they are drawn, and none through a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SLOTS = 1 << 40


def hash_sample(rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    """All rows if they are ``limit`` at most, else those whose keys hash below the share that gives about that many.

    Adds the column ``draw`` to sort by. The expected number is a little under ``limit``, so that the final limit, which
    holds the bound in any case, hardly ever drops a row. The keys should tell rows apart.
    """
    n = rows.count()
    drawn = rows.withColumn("draw", F.pmod(F.xxhash64(*keys), F.lit(_SLOTS)))
    if n <= limit:
        return drawn
    return drawn.filter(F.col("draw") < int(_SLOTS * max(limit - 4 * limit**0.5, 1) / n)).limit(limit)
