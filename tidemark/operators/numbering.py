"""Dense numbers over a total order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import checkpointed, shuffle_width


def numbered(rows: DataFrame, column: str, *order: str) -> DataFrame:
    """Adds 1..n in the order of ``order`` (nulls first). Rows are ranged over partitions, numbered inside, and shifted
    by the counts of the partitions before: only those counts, one per partition, come to the driver."""
    ranged = rows.repartitionByRange(shuffle_width(rows.sparkSession), *order).withColumn("__part", F.spark_partition_id())
    ranged = checkpointed(ranged)  # the ranges are sampled anew whenever they are computed
    counts = sorted((r["__part"], r["count"]) for r in ranged.groupBy("__part").count().collect())
    known, before, offsets = dict(counts), 0, []
    for part in range(max(known, default=-1) + 1):
        offsets.append(before)
        before += known.get(part, 0)
    offset = F.array(*[F.lit(x).cast("bigint") for x in offsets])[F.col("__part")] if offsets else F.lit(0)
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.withColumn(column, (place + offset).cast("bigint")).drop("__part")


def first_seen_ids(rows: DataFrame, keys: list[str], order: str, column: str, count: str | None = None) -> DataFrame:
    """(keys, column): each distinct key once, null as a value like others, numbered by its smallest ``order``; with the
    number of its rows as ``count`` if that is named."""
    counted = [F.count("*").alias(count)] if count else []
    first = rows.groupBy(*keys).agg(F.min(order).alias("__first"), *counted)
    return numbered(first, column, "__first", *keys).drop("__first")
