"""Set-based writes on snapshots: insert if absent, last write wins, compare and set, claims and high-water marks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import filled
from tidemark.session import checkpointed


IDENTIFIERS = ("doi", "openalex_id", "semantic_scholar_id")


def insert_if_absent(target: DataFrame, batch: DataFrame, order: str) -> DataFrame:
    """The rows of ``batch`` that an insert with three unique identifiers would add to ``target``.

    A row with a doi is dropped if any of its identifiers is taken; a row without one goes by its openalex_id, else by
    its semantic_scholar_id; a row without any is dropped. Rows with a doi come first, then those with an openalex_id,
    each in ``order`` (unique); a row loses only to rows that are added themselves. Identifiers are compared as
    written, empty ones are none.
    """
    clean = batch.select("*", *[filled(F.col(c)).alias(f"__{c}") for c in IDENTIFIERS])
    bucket = F.when(F.col("__doi").isNotNull(), 1).when(F.col("__openalex_id").isNotNull(), 2).when(F.col("__semantic_scholar_id").isNotNull(), 3)
    rows = clean.withColumn("__rank", F.struct(bucket.alias("b"), order)).filter("__rank.b is not null")
    for c in IDENTIFIERS:
        known = target.select(filled(F.col(c)).alias(f"__{c}")).filter(f"__{c} is not null").distinct().withColumn(f"__taken_{c}", F.lit(True))
        without = rows.filter(F.col(f"__{c}").isNull()).withColumn(f"__taken_{c}", F.lit(None).cast("boolean"))  # nulls don't shuffle to one task
        rows = rows.filter(F.col(f"__{c}").isNotNull()).join(known, f"__{c}", "left").unionByName(without)
    taken = lambda c: F.coalesce(F.col(f"__taken_{c}"), F.lit(False))
    lost = F.when(F.col("__rank.b") == 1, any_of([taken(c) for c in IDENTIFIERS])).when(F.col("__rank.b") == 2, taken("openalex_id")).otherwise(taken("semantic_scholar_id"))
    open_rows = checkpointed(rows.filter(~lost).select(*batch.columns, *[f"__{c}" for c in IDENTIFIERS], "__rank"))
    added = open_rows.limit(0)
    while True:  # the first open row always wins
        # a row is added if it is the first open one under all of its identifiers; then all that share one with it lose
        wins = open_rows.withColumn("__wins", F.lit(True))
        for c in IDENTIFIERS:
            first = open_rows.filter(F.col(f"__{c}").isNotNull()).groupBy(f"__{c}").agg(F.min("__rank").alias("__first"))
            wins = wins.join(first, f"__{c}", "left").withColumn("__wins", F.col("__wins") & (F.col("__first").isNull() | (F.col("__first") == F.col("__rank")))).drop("__first")
        new = checkpointed(wins.filter("__wins").select(open_rows.columns))
        added = added.unionByName(new)
        rest = open_rows.join(new.select("__rank").withColumn("__done", F.lit(True)), "__rank", "left").filter("__done is null").drop("__done")
        for c in IDENTIFIERS:
            rest = rest.join(new.select(f"__{c}").filter(f"__{c} is not null").distinct(), f"__{c}", "left_anti")
        open_rows = checkpointed(rest.select(open_rows.columns))
        if not open_rows.limit(1).count():
            return added.select(batch.columns)


def last_write_wins(target: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """``target`` with the rows of ``batch`` put in, one row per key: the batch's latest (by ``order``), else the old one."""
    every = target.withColumn("__new", F.lit(0)).unionByName(batch.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    row = F.struct("__new", order, *[c for c in every.columns if c not in ("__new", order, key)])
    return every.groupBy(key).agg(F.max(row).alias("r")).select(*[F.col(c) if c == key else F.col(f"r.{c}") for c in target.columns])


def keyed_update(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """``target`` with the columns of ``updates`` replaced where the key occurs there, null values included."""
    columns = [c for c in updates.columns if c != key]
    put = updates.select(key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = target.join(put, key, "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def compare_and_set(target: DataFrame, keys: DataFrame, key: str, column: str, expected: str, value: str) -> DataFrame:
    """``target`` with ``column`` set to ``value`` for the given keys where it still is ``expected``."""
    asked = keys.select(key).distinct().withColumn("__asked", F.lit(True))
    joined = target.join(asked, key, "left")
    put = F.when(F.col("__asked") & (F.col(column) == expected), F.lit(value)).otherwise(F.col(column))
    return joined.select(*[put.alias(c) if c == column else F.col(c) for c in target.columns])


def claim(target: DataFrame, column: str, value: str, key: str, size: int) -> DataFrame:
    """The keys of the next ``size`` rows in a queue, smallest first, so that a repeated claim takes the same ones."""
    return target.filter(F.col(column) == value).select(key).orderBy(key).limit(size)


def claim_and_set(target: DataFrame, column: str, value: str, claimed: str, key: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(the claimed rows, ``target`` with them set to ``claimed``): a claim and its transition in one. The claim is
    checkpointed, so both sides agree if a task is repeated; rows that another claim took before aren't there any more."""
    taken = checkpointed(claim(target, column, value, key, size))
    return target.join(taken, key, "left_semi"), compare_and_set(target, taken, key, column, value, claimed)


def share_of(key: Column, worker: int, workers: int) -> Column:
    """Whether a row belongs to one of several workers: disjoint shares without locks."""
    return F.pmod(F.xxhash64(key), F.lit(workers)) == worker


def advance_marks(state: DataFrame, seen: DataFrame) -> DataFrame:
    """(source, watermark): per source the later of the stored and the newly seen date; a mark never goes back."""
    return state.select("source", "watermark").unionByName(seen.select("source", "watermark")).groupBy("source").agg(F.max("watermark").alias("watermark"))


def on_or_after(rows: DataFrame, date: str, marks: DataFrame, source: str) -> DataFrame:
    """Rows dated on or after their source's mark; all rows of a source without one. The boundary day comes again."""
    known = marks.select(F.col("source").alias(source), "watermark")
    return rows.join(known, source, "left").filter(F.col("watermark").isNull() | (F.col(date) >= F.col("watermark"))).drop("watermark")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``; maxima combine before the shuffle, so no key is hot."""
    others = [c for c in rows.columns if c not in (key, order)]
    best = rows.groupBy(key).agg(F.max(F.struct(order, *others)).alias("__best"))
    return best.select(*[F.col(c) if c == key else F.col(f"__best.{c}") for c in rows.columns])
