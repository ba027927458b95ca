"""Attribute-value rows into one wide row per entity, by column-block pivoting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalogue import ALIAS_BROADCAST_ROWS, alias_lookup, attribute_key
from tidemark.functions.numbers import stated_number
from tidemark.operators.skew import bounded_broadcast
from tidemark.session import shuffle_width

#: Texts that stand for a missing value.
MISSING = ("", "—", "-", "–", "na", "n/a", "nd", "n.d.", "bdl", "below detection", "not reported", "not stated", "null", "none")
TRUE_WORDS = ("yes", "y", "true", "t", "1")
FALSE_WORDS = ("no", "n", "false", "f", "0")
SQL_TYPES = {"number": "double", "integer": "bigint", "boolean": "boolean", "date": "date", "text": "string"}


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def present(text: Column) -> Column:
    """The trimmed text, or null where it stands for a missing value."""
    clean = trimmed(text)
    return F.when(~F.lower(clean).isin(*MISSING), clean)


def stated_date(text: Column) -> Column:
    """A date written year first, day first, as month and year, or as a year; the first day where a part is missing."""
    whole = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})$", 1)
    day = F.regexp_extract(text, r"^(\d{1,2})[-./](\d{1,2})[-./](\d{4})$", 0)
    parts = F.split(F.regexp_replace(day, "[./]", "-"), "-")
    month = F.regexp_extract(text, r"^(\d{1,2})[-./](\d{4})$", 0)
    halves = F.split(F.regexp_replace(month, "[./]", "-"), "-")
    year = F.regexp_extract(text, r"^(\d{4})$", 1)
    pad = lambda c: F.lpad(c, 2, "0")
    iso = (
        F.when(whole != "", whole)
        .when(day != "", F.concat_ws("-", F.get(parts, F.lit(2)), pad(F.get(parts, F.lit(1))), pad(F.get(parts, F.lit(0)))))
        .when(month != "", F.concat(F.get(halves, F.lit(1)), F.lit("-"), pad(F.get(halves, F.lit(0))), F.lit("-01")))
        .when(year != "", F.concat(year, F.lit("-01-01")))
    )
    return iso.try_cast("date")


def cells(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per entity and catalogue attribute, with the typed content of that cell.

    Partial aggregation shrinks a hot entity or a repeated row before the shuffle, and the state of a cell is of fixed
    size. The typed value is the latest one stated (by recorded_at, then item_id, then value); ``least`` and ``most``
    are the extreme numbers that the cell's rows state, so the cell is contradictory if they differ.
    """
    lookup = bounded_broadcast(alias_lookup(catalogue), ALIAS_BROADCAST_ROWS)
    stated = (
        rows.filter("entity_id is not null")
        .select("entity_id", "item_id", "recorded_at", attribute_key(F.col("attribute")).alias("attribute_key"), present(F.col("value")).alias("value"))
        .join(lookup, "attribute_key")
        .withColumn("number", F.when(F.col("value_kind").isin("number", "integer"), stated_number(F.col("value"))))
    )
    usable = F.when(F.col("value_kind").isin("number", "integer"), F.col("number").isNotNull()).otherwise(F.col("value").isNotNull())
    latest = F.struct(F.coalesce("recorded_at", F.lit("0001-01-01").cast("timestamp")), F.coalesce("item_id", F.lit(-1)), "value", "number")
    return stated.groupBy("entity_id", "attribute").agg(
        F.max(F.when(usable, latest)).alias("latest"),
        F.min("number").alias("least"),
        F.max("number").alias("most"),
        F.first("value_kind").alias("value_kind"),
    ).select("entity_id", "attribute", "value_kind", "latest.value", "latest.number", "least", "most")


def typed(kind: str, chosen: Column) -> Column:
    value, number = chosen["value"], chosen["number"]
    if kind == "number":
        return number
    if kind == "integer":
        return number.try_cast("bigint")
    word = F.lower(value)
    if kind == "boolean":
        return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))
    if kind == "date":
        return stated_date(value)
    return F.regexp_replace(word, r"(?U)\s+", " ")


def entity_names(rows: DataFrame) -> DataFrame:
    """(entity_id, name): the spelling an entity's rows use most, the smaller one on a tie; null if none is given."""
    spelled = rows.filter("entity_id is not null").select("entity_id", F.expr("nullif(regexp_replace(regexp_replace(name, '(?U)\\\\s+', ' '), '^ | $', ''), '')").alias("name"))
    counted = spelled.groupBy("entity_id", "name").agg(F.count("*").alias("n"))
    best = F.min(F.when(F.col("name").isNotNull(), F.struct((-F.col("n")).alias("n"), "name")))
    return counted.groupBy("entity_id").agg(best.alias("best")).select("entity_id", F.col("best.name").alias("name"))


def conflict_column(attribute: str) -> str:
    return f"{attribute}__conflict"


def pivot_wide(rows: DataFrame, catalogue: DataFrame, block: int = 64) -> DataFrame:
    """One row per entity: entity_id, name, a typed column per catalogue attribute, and a conflict flag per number.

    rows: entity_id, item_id, name, attribute, value, recorded_at; other columns are ignored.
    catalogue: attribute, value_kind, canonical_units, aliases.

    Method: the attributes are divided into blocks of ``block`` columns. The cells are shuffled once by entity; each
    block pivots them inside that partitioning with plain conditional aggregates, and the blocks join on it without a
    further exchange, however many thousands of attributes there are.

    Rows without an entity make none; an entity whose rows all are of unknown attributes or without values keeps a row
    of nulls; misspelt attributes belong to no column; repeated rows change nothing; empty input gives no rows.
    """
    attributes = [(r.attribute, r.value_kind) for r in catalogue.filter("attribute is not null").groupBy("attribute").agg(F.min("value_kind").alias("value_kind")).orderBy("attribute").collect()]
    width = shuffle_width(rows.sparkSession)
    placed = cells(rows, catalogue).repartition(width, "entity_id")
    chosen = F.struct("value", "number")
    blocks = []
    for start in range(0, len(attributes), block):
        columns = []
        for attribute, kind in attributes[start : start + block]:
            mine = F.col("attribute") == attribute
            columns.append(typed(kind, F.max(F.when(mine, chosen))).alias(attribute))
            if kind == "number":
                columns.append(F.max(F.when(mine, F.col("most") > F.col("least"))).alias(conflict_column(attribute)))
        blocks.append(placed.groupBy("entity_id").agg(*columns))
    names = entity_names(rows).repartition(width, "entity_id")
    return reduce(lambda left, right: left.join(right, "entity_id", "left"), blocks, names)


def contradictions(wide: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(entity_id, attribute) of the wide table's cells for which two or more different numbers are stated."""
    numbers = [r.attribute for r in catalogue.filter("value_kind = 'number'").select("attribute").distinct().orderBy("attribute").collect()]
    flagged = [F.when(F.col(conflict_column(a)), F.lit(a)) for a in numbers]
    listed = F.filter(F.array(*flagged) if flagged else F.array().cast("array<string>"), lambda a: a.isNotNull())
    return wide.select(F.col("entity_id").cast("bigint").alias("entity_id"), F.explode(listed).alias("attribute"))
