"""Quantities in mixed units to canonical units, with a calibrated tree ensemble for units that nobody stated."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalogue import ALIAS_BROADCAST_ROWS, alias_lookup, attribute_key
from tidemark.functions.boosting import BoostedTrees
from tidemark.functions.unit_algebra import conversion, parse_unit, read_value, unit_in_text
from tidemark.operators.sampling import hash_sample
from tidemark.operators.skew import attach_group, bounded_broadcast
from tidemark.session import checkpointed

#: At most this many rows with a stated unit train the classifier; all rows are converted and all counts cover all rows.
TRAINING_ROWS = 12_000
#: A predicted unit of at least this calibrated probability is applied; others go to review.
CONFIDENT = 0.9
#: The class of all units that have no fixed factor to an attribute's canonical one.
OTHER = "other"
#: Sources and categories are counted in this many groups of hashes.
_GROUPS = 64

READING = T.StructType(
    [
        T.StructField("shape", T.StringType()),
        T.StructField("point", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("unit_text", T.StringType()),
        T.StructField("unit_from", T.StringType()),
        T.StructField("unit_key", T.StringType()),
        T.StructField("factor", T.DoubleType()),
    ]
)


def unit_key(text: str | None) -> str | None:
    """One name for all spellings of a unit."""
    unit = parse_unit(text)
    return None if unit is None else f"{unit[0]:.6g} {' '.join(f'{k}{v}' for k, v in unit[1])} {unit[2]}".strip()


def _read(canonical: str | None, value: str | None, units: str | None, remark: str | None) -> tuple:
    read = read_value(value)
    if read is None:
        return (None,) * 8
    shape, point, low, high, rest = read
    for text, source in ((units, "units"), (rest, "value"), (unit_in_text(remark), "text")):
        if text and (key := unit_key(text)):
            return (shape, point, low, high, text, source, key, conversion(text, canonical))
    return (shape, point, low, high, None, None, None, None)


@F.arrow_udf(READING)
def _readings(canonical: pa.Array, value: pa.Array, units: pa.Array, remark: pa.Array) -> pa.Array:
    columns = [c.to_pylist() for c in (canonical, value, units, remark)]
    rows = [_read(*x) for x in zip(*columns)]
    kinds = [pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.string(), pa.float64()]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], READING.names)


def readings(extractions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Every extraction with its catalogue attribute, the numbers its value states and the unit stated with them.

    ``unit_class`` names what a unit does to a number: its factor to the canonical unit, or OTHER for a unit of another
    kind; null if no unit is stated.
    """
    lookup = bounded_broadcast(alias_lookup(catalogue), ALIAS_BROADCAST_ROWS)
    flat = extractions.select(
        F.col("id").alias("extraction_id"), "paper_id",
        attribute_key(F.col("data.attribute")).alias("attribute_key"),
        F.col("data.value").alias("value"), F.col("data.units").alias("units"), F.col("data.additional_details").alias("remark"),
        F.pmod(F.xxhash64("model_version"), F.lit(_GROUPS)).alias("source_group"),
        F.pmod(F.xxhash64(F.col("data.ecosystem_type")), F.lit(_GROUPS)).alias("category_group"),
    )
    return (
        flat.join(lookup, "attribute_key", "left")
        .withColumn("reading", _readings("canonical_units", "value", "units", "remark"))
        .select("extraction_id", "paper_id", "attribute", "canonical_units", "source_group", "category_group", "reading.*")
        .withColumn("unit_class", F.when(F.col("unit_key").isNotNull(), F.coalesce(F.col("factor").cast("string"), F.lit(OTHER))))
        .drop("unit_key")
    )


def _magnitude(point: pd.Series, low: pd.Series, high: pd.Series) -> np.ndarray:
    middle = np.nanmean(np.abs(np.stack([point.fillna(np.nan), low.fillna(np.nan), high.fillna(np.nan)]).astype(float)), axis=0)
    return np.log10(np.maximum(middle, 1e-12))


class UnitModel:
    """Which unit a quantity without one is in: candidates are all unit classes stated for its attribute."""

    def __init__(self, candidates: dict, trees: BoostedTrees):
        self.candidates, self.trees = candidates, trees

    def features(self, attribute, magnitude, source, category, neighbour) -> tuple[np.ndarray, np.ndarray, list]:
        x, owner, chosen = [], [], []
        for i, (a, m, s, c, n) in enumerate(zip(attribute, magnitude, source, category, neighbour)):
            for unit in self.candidates.get(a, ()):
                z = (m - unit["mean"]) / unit["spread"]
                x.append((z, abs(z), unit["share"], unit["by_source"].get(s, unit["share"]), unit["by_category"].get(c, unit["share"]),
                          np.nan if n is None else float(n == unit["key"]), len(self.candidates[a])))
                owner.append(i)
                chosen.append(unit)
        return np.array(x, dtype=float).reshape(-1, 7), np.array(owner, dtype=int), chosen

    def predict(self, *columns) -> list[tuple[dict | None, float]]:
        x, owner, chosen = self.features(*columns)
        p = self.trees.probability(x)
        total = np.bincount(owner, p, len(columns[0])) if len(owner) else np.zeros(len(columns[0]))
        best: list[tuple[dict | None, float]] = [(None, 0.0)] * len(columns[0])
        for i, unit, q in zip(owner, chosen, p):
            share = q / max(total[i], 1e-9)  # a unit is one of its attribute's classes
            if share > best[i][1]:
                best[i] = (unit, float(share))
        return best


def class_statistics(stated: DataFrame) -> dict[str, list[dict]]:
    """The units stated for each attribute with their magnitudes and shares, over all rows with a stated unit.

    One pass counts (attribute, unit class, source, category); what comes to the driver is one row per attribute, class
    and group. An attribute's classes are the factors that the unit grammar can build for its dimension and one for all
    other units, and there are _GROUPS groups of either kind, so this depends on the catalogue and not on the rows.
    """
    size = F.log10(F.greatest(F.abs(F.coalesce("point", (F.col("low") + F.col("high")) / 2, "low", "high")), F.lit(1e-12)))
    cells = stated.groupBy("attribute", "unit_class", "source_group", "category_group").agg(
        F.count("*").alias("n"), F.sum(size).alias("s"), F.sum(size * size).alias("q"), F.max("factor").alias("factor"), F.min("unit_text").alias("text")
    )
    group = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("bigint").alias("group"))
    told = cells.withColumn("g", F.explode(F.array(group("all", F.lit(0)), group("source", F.col("source_group")), group("category", F.col("category_group")))))
    rows = told.groupBy("attribute", "unit_class", "g").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.max("factor").alias("factor"), F.min("text").alias("text")).collect()
    total: Counter = Counter()
    shares: dict = defaultdict(dict)
    for r in rows:
        total[r.attribute] += r.n if r.g.kind == "all" else 0
        if r.g.kind != "all":
            shares[r.attribute, r.g.kind, r.g.group][r.unit_class] = r.n
    candidates: dict = defaultdict(list)
    for r in sorted((r for r in rows if r.g.kind == "all"), key=lambda r: (-r.n, r.unit_class)):
        share = r.n / total[r.attribute]

        def within(kind: str) -> dict:
            known = ((g, shares.get((r.attribute, kind, g))) for g in range(_GROUPS))
            return {g: (d.get(r.unit_class, 0) + share) / (sum(d.values()) + 1) for g, d in known if d}

        spread = math.sqrt(max(r.q / r.n - (r.s / r.n) ** 2, 0.0))
        candidates[r.attribute].append(
            {"key": r.unit_class, "text": None if r.unit_class == OTHER else r.text, "factor": r.factor, "mean": r.s / r.n, "spread": max(spread, 0.15), "share": share, "by_source": within("source"), "by_category": within("category")}
        )
    return dict(candidates)


def fit_units(read: DataFrame, neighbours: DataFrame) -> UnitModel:
    """Class statistics over all rows with a stated unit; the trees over a sample bounded by TRAINING_ROWS."""
    stated = read.filter("unit_class is not null and attribute is not null")
    sample = hash_sample(stated.select("extraction_id", "paper_id", "attribute", "unit_class", "point", "low", "high", "source_group", "category_group"), TRAINING_ROWS, "extraction_id")
    model = UnitModel(class_statistics(stated), BoostedTrees(trees=50, depth=3))
    rows = attach_group(sample, neighbours, ["paper_id", "attribute"], "n", "left").toPandas().sort_values(["draw", "extraction_id"])
    x, owner, chosen = model.features(rows["attribute"], _magnitude(rows["point"], rows["low"], rows["high"]), rows["source_group"], rows["category_group"], others_unit(rows))
    keys = list(rows["unit_class"])
    y = np.array([float(unit["key"] == keys[i]) for i, unit in zip(owner, chosen)])
    if len(y) < 10 or y.min() == y.max():
        model.candidates = {}
        return model
    model.trees.fit(x, y)
    return model


def others_unit(rows: pd.DataFrame) -> list[str | None]:
    """The unit of a row's neighbours. A row with a unit must not be its own neighbour: the unit counts only if other
    rows state it too."""
    near = rows["near_class"].where(rows["near_class"].notna(), None)
    return [None if n is None or n <= 1 and u == k else u for u, n, k in zip(near, rows["near_n"].fillna(0), rows["unit_class"])]


def neighbour_units(read: DataFrame) -> DataFrame:
    """(paper_id, attribute, near_class, near_n, n): the unit that a paper's other rows of an attribute state most."""
    counted = read.filter("attribute is not null").groupBy("paper_id", "attribute", "unit_class").agg(F.count("*").alias("c"))
    best = F.max(F.when(F.col("unit_class").isNotNull(), F.struct("c", "unit_class")))
    return counted.groupBy("paper_id", "attribute").agg(best.alias("best"), F.sum("c").alias("n")).select(
        "paper_id", "attribute", F.col("best.unit_class").alias("near_class"), F.col("best.c").alias("near_n"), "n"
    )


def _predictor(model):
    schema = T.StructType([T.StructField("unit_class", T.StringType()), T.StructField("unit_text", T.StringType()), T.StructField("factor", T.DoubleType()), T.StructField("probability", T.DoubleType())])

    @F.pandas_udf(schema)
    def predicted(attribute: pd.Series, point: pd.Series, low: pd.Series, high: pd.Series, source: pd.Series, category: pd.Series, near: pd.Series) -> pd.DataFrame:
        found = model.value.predict(attribute, _magnitude(point, low, high), source, category, near.astype(object).where(near.notna(), None))
        return pd.DataFrame([(u["key"], u["text"], u["factor"], p) if u else (None, None, None, p) for u, p in found], columns=schema.names)

    return predicted("attribute", "point", "low", "high", "source_group", "category_group", "near_class")


def convert_quantities(extractions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per extraction: its quantity in canonical units, how the unit is known, and what became of it.

    extractions: id, paper_id, model_version, data<attribute, value, units, additional_details, ecosystem_type>.
    Result: extraction_id, attribute, canonical_units, shape, point, low, high (converted), unit_text, unit_from
    (``units``, ``value``, ``text``, ``predicted`` or null), factor, probability, route.

    route is ``converted``; ``review`` for a missing unit without a confident prediction; ``inconvertible`` for a unit
    of another kind; ``unreadable`` for a value without a number; ``unknown_attribute``. Null or empty values are
    unreadable, a null unit is a missing one, repeated rows each keep their row, and an empty table gives no rows.
    """
    read = checkpointed(readings(extractions, catalogue))  # the texts are parsed once; what follows reads the numbers
    stated_to = F.when(F.col("factor").isNotNull(), "converted").otherwise("inconvertible")
    known = read.filter("attribute is null or shape is null or unit_class is not null").select(
        "*", F.when(F.col("unit_class").isNotNull() & F.col("attribute").isNotNull(), F.lit(1.0)).alias("probability"),
        F.when(F.col("attribute").isNull(), "unknown_attribute").when(F.col("shape").isNull(), "unreadable").otherwise(stated_to).alias("route"),
    )
    missing = read.filter("attribute is not null and shape is not null and unit_class is null")
    neighbours = checkpointed(neighbour_units(read))
    model = read.sparkSession.sparkContext.broadcast(fit_units(read, neighbours))

    guessed = (
        attach_group(missing, neighbours, ["paper_id", "attribute"], "n", "left")
        .withColumn("guess", _predictor(model))
        .select(
            *[c for c in missing.columns if c not in ("unit_text", "unit_from", "factor")],
            F.col("guess.unit_text").alias("unit_text"), F.lit("predicted").alias("unit_from"), F.col("guess.factor").alias("factor"), F.col("guess.probability").alias("probability"),
            F.when((F.col("guess.probability") >= CONFIDENT) & F.col("guess.factor").isNotNull(), "converted").otherwise("review").alias("route"),
        )
    )
    scale = F.when(F.col("route") == "converted", F.col("factor"))
    return known.unionByName(guessed).select(
        "extraction_id", "attribute", "canonical_units", "shape",
        *[(F.col(c) * scale).alias(c) for c in ("point", "low", "high")],
        "unit_text", "unit_from", "factor", "probability", "route",
    )


def masked_accuracy(extractions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(attribute, n, n_right, n_confident, n_confident_right, mean_probability): how well stated units are told when
    they are hidden, over all rows with a stated unit that the classifier wasn't trained on.

    A confident prediction is one that ``convert_quantities`` would apply. The difference of n_right / n and
    mean_probability is the calibration error. A table whose rows all serve for training gives no rows.
    """
    read = checkpointed(readings(extractions, catalogue))
    neighbours = checkpointed(neighbour_units(read))
    model = read.sparkSession.sparkContext.broadcast(fit_units(read, neighbours))
    stated = read.filter("unit_class is not null and attribute is not null")
    hidden = stated.join(hash_sample(stated, TRAINING_ROWS, "extraction_id").select("extraction_id").distinct(), "extraction_id", "left_anti")
    met = attach_group(hidden, neighbours, ["paper_id", "attribute"], "n", "left")
    alone = (F.col("near_n") <= 1) & (F.col("near_class") == F.col("unit_class"))
    told = met.withColumn("near_class", F.when(~F.coalesce(alone, F.lit(False)), F.col("near_class"))).withColumn("guess", _predictor(model))
    right = F.coalesce(F.col("guess.unit_class") == F.col("unit_class"), F.lit(False)).cast("bigint")
    sure = F.coalesce((F.col("guess.probability") >= CONFIDENT) & F.col("guess.factor").isNotNull(), F.lit(False)).cast("bigint")
    return told.groupBy("attribute").agg(
        F.count("*").alias("n"), F.sum(right).alias("n_right"), F.sum(sure).alias("n_confident"), F.sum(right * sure).alias("n_confident_right"), F.avg("guess.probability").alias("mean_probability")
    )


def changed_by_conversion(quantities: DataFrame) -> DataFrame:
    """(extraction_id) of quantities whose stated unit makes the number change on conversion."""
    nonzero = (F.coalesce("point", F.lit(0.0)) != 0) | (F.coalesce("low", F.lit(0.0)) != 0) | (F.coalesce("high", F.lit(0.0)) != 0)
    stated = F.col("unit_from").isin("units", "value", "text")
    return quantities.filter(stated & (F.col("route") == "converted") & (F.col("factor") != 1.0) & nonzero).select("extraction_id")
