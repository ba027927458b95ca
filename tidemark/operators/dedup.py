"""Exact duplicates and majority values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import filled
from tidemark.operators.skew import attach_group

#: A fact is the same measurement as another if they agree in these columns, nulls included.
FACT_KEY = ("paper_id", "extraction_model_id", "entity_id", "event_id", "attribute", "quantity_raw", "units_raw", "quantity_canonical", "units_canonical", "qualifier_id", "page_number", "confidence")


def duplicate_flags(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``kept``: whether a row has the greatest ``order`` among the rows that agree in ``keys`` (null is a value).

    The groups' maxima are combined before the shuffle and joined back with hot groups broadcast, so a group that holds
    most of the rows isn't sorted by one task.
    """
    groups = rows.groupBy(*keys).agg(F.max(order).alias("__last"), F.count("*").alias("__n"))
    return attach_group(rows, groups, keys, "__n").withColumn("kept", F.col(order) == F.col("__last")).drop("__last")


def majority(value: Column) -> Column:
    """The most frequent non-empty text of a group, the smallest on a tie."""
    return F.mode(filled(value), True)
