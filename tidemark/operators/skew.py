"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 1000
#: Below this count a key never is hot, whatever its share.
HOT_FLOOR = 20_000


def attach_group(
    rows: DataFrame, groups: DataFrame, keys: list[str], count: str, how: str = "inner", total: int | None = None
) -> DataFrame:
    """Joins each row with its group's single summary row, without sending a hot group to one task.

    ``groups`` has one row per ``keys`` and the group's row count in ``count``; it must itself come from an
    aggregation, so hot keys were combined on the map side. Groups with more than HOT_SHARE of ``total`` rows (and
    HOT_FLOOR at least) number at most 1 / HOT_SHARE: those are broadcast, the rest meets in a shuffle join in which
    no key is hot. Keys compare as equal when both are null. ``how`` is ``inner`` or ``left``. The count column is
    not in the result.
    """
    payload = [c for c in groups.columns if c not in keys and c != count]
    if total is None:
        total = groups.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    limit = max(HOT_FLOOR, int(total * HOT_SHARE))
    if total <= limit:
        return _joined(rows, groups.drop(count), keys, payload, how)
    hot = groups.filter(F.col(count) > limit)
    warm = _joined(rows, F.broadcast(hot.drop(count)), keys, payload, "inner")
    other, equal = _renamed(hot.select(*keys), keys, [])
    rest = rows.join(F.broadcast(other), equal, "left_anti")
    return warm.unionByName(_joined(rest, groups.filter(F.col(count) <= limit).drop(count), keys, payload, how))


def _renamed(groups: DataFrame, keys: list[str], payload: list[str]) -> tuple[DataFrame, Column]:
    """``groups`` under names that no caller has, and the condition under which a row meets its group."""
    other = groups.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *[F.col(c).alias(f"__of_{c}") for c in payload])
    return other, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str], payload: list[str], how: str) -> DataFrame:
    other, equal = _renamed(groups, keys, payload)
    return rows.join(other, equal, how).select(*rows.columns, *[F.col(f"__of_{c}").alias(c) for c in payload])


def bounded_broadcast(frame: DataFrame, limit: int, size: int | None = None) -> DataFrame:
    """A broadcast hint for ``frame`` if it has at most ``limit`` rows, else the frame itself for a shuffle join."""
    size = frame.limit(limit + 1).count() if size is None else size
    return F.broadcast(frame) if size <= limit else frame
