"""Column-block pivoting and conversion of quantities."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import quantities
from tidemark.operators.quantities import changed_by_conversion, convert_quantities
from tidemark.operators.wide import contradictions, pivot_wide

CATALOGUE = [("salinity", "number", "psu", ["Sal"]), ("nitrate", "number", "µmol/L", ["NO3-"]), ("sampling_date", "date", None, ["sampled on"]), ("station_count", "integer", None, None), ("tidal_flag", "boolean", None, []), ("substrate", "text", None, None)]
CATALOGUE_DDL = "attribute string, value_kind string, canonical_units string, aliases array<string>"
ITEMS_DDL = "item_id bigint, entity_id int, name string, attribute string, value string, recorded_at timestamp, number string, latest string"


def items(spark, rows):
    day = lambda d: datetime(2024, 1, d)
    return spark.createDataFrame([(i, e, n, a, v, day(d), "x", "y") for i, (e, n, a, v, d) in enumerate(rows)], ITEMS_DDL)


def test_wide(spark):
    catalogue = spark.createDataFrame(CATALOGUE, CATALOGUE_DDL)
    rows = [
        (1, "A  B", "salinity", "3.5", 1), (1, "A B", " SAL ", "3.50*", 2), (1, "a b", "no3 ", "1.2E+01", 1), (1, None, "NO3-", "12", 3), (1, "A B", "sampled_on", "07-2015", 1),
        (2, None, "salinity", "1", 1), (2, None, "salinity", "2", 2), (2, None, "Salinity", "2", 2), (2, None, "station-count", "n=7", 1), (2, None, "tidal flag", "Y", 1), (2, None, "substrate", "Sandy  MUD", 1),
        (3, "C", "salinty", "9", 1), (3, "C", "salinity", "ND", 1), (3, "C", "salinity", None, 2), (None, "D", "salinity", "4", 1), (3, "C", None, "5", 1),
    ]
    for block in (2, 100):
        wide = pivot_wide(items(spark, rows), catalogue, block)
        got = {r.entity_id: r for r in wide.collect()}
        assert sorted(got) == [1, 2, 3]
        assert (got[1].name, got[1].salinity, got[1].nitrate, str(got[1].sampling_date)) == ("A B", 3.5, 12.0, "2015-07-01")
        assert (got[2].name, got[2].salinity, got[2].station_count, got[2].tidal_flag, got[2].substrate) == (None, 2.0, 7, True, "sandy mud")
        assert got[3].salinity is None and got[3].name == "C"
        assert [tuple(r) for r in contradictions(wide, catalogue).collect()] == [(2, "salinity")]
    plan = pivot_wide(items(spark, rows), catalogue, 2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_wide_of_nothing(spark):
    catalogue = spark.createDataFrame(CATALOGUE, CATALOGUE_DDL)
    assert pivot_wide(items(spark, []), catalogue).count() == 0
    empty = spark.createDataFrame([], CATALOGUE_DDL)
    assert pivot_wide(items(spark, [(1, "A", "salinity", "1", 1)]), empty).columns == ["entity_id", "name"]


EXTRACTION_DDL = "id bigint, paper_id bigint, model_version string, data struct<attribute: string, value: string, units: string, additional_details: string, ecosystem_type: string>, attribute string, factor double"


def test_quantities(spark):
    catalogue = spark.createDataFrame(CATALOGUE, CATALOGUE_DDL)
    rows = [
        ("nitrate", "2", "mmol/L", None), ("nitrate", "3 nM", "see value", None), ("NO3-", "4", None, "units: µM"), ("nitrate", "5", "mg/L", None), ("nitrate", "ND", "mmol/L", None), ("nitrate", None, None, None),
        ("other", "5", "m", None), (None, "1", "psu", None), ("salinity", "10±2", "", "post-storm; values given as mg/kg"), ("salinity", "0", "mg/kg", None), ("salinity", "1–2", "psu", ""), ("salinity", "7", None, None),
    ]
    frame = spark.createDataFrame([(i, 1, "m", (a, v, u, d, None), "clash", 0.0) for i, (a, v, u, d) in enumerate(rows)], EXTRACTION_DDL)
    got = {r.extraction_id: r for r in convert_quantities(frame, catalogue).collect()}
    assert len(got) == len(rows)
    assert (got[0].point, got[1].point, got[2].point) == (2000.0, 0.003, 4.0)
    assert [got[i].route for i in (3, 4, 5, 6, 7)] == ["inconvertible", "unreadable", "unreadable", "unknown_attribute", "unknown_attribute"]
    assert (round(got[8].low, 6), round(got[8].high, 6), got[8].unit_from) == (0.008, 0.012, "text") and got[10].high == 2.0
    assert got[11].unit_from == "predicted" and got[11].route in ("converted", "review")
    assert sorted(r.extraction_id for r in changed_by_conversion(convert_quantities(frame, catalogue)).collect()) == [0, 1, 8]
    assert convert_quantities(frame.limit(0), catalogue).count() == 0


def test_missing_units_are_learned(spark):
    """Two units a thousandfold apart: the magnitude tells which one is missing, on rows that were held out."""
    catalogue = spark.createDataFrame([("nitrate", "number", "µmol/L", None)], CATALOGUE_DDL)
    rows = [(i, i % 50, "m", ("nitrate", str(round(10 + i % 17 if i % 2 else (10 + i % 17) / 1000, 5)), (None if i % 9 == 0 else "µM" if i % 2 else "mM"), None, None), "c", 0.0) for i in range(900)]
    got = convert_quantities(spark.createDataFrame(rows, EXTRACTION_DDL), catalogue).filter("unit_from = 'predicted'")
    result = got.select("extraction_id", "route", "factor").collect()
    right = [r for r in result if r.factor == (1.0 if r.extraction_id % 2 else 1000.0)]
    assert len(result) == 100 and len(right) >= 95 and sum(r.route == "converted" for r in result) >= 60
    assert got.filter(F.col("probability") > 1).count() == 0


def test_hidden_units_are_told(spark, monkeypatch):
    """Units of rows that weren't trained on: most are told right, and those that would be applied nearly all."""
    monkeypatch.setattr(quantities, "TRAINING_ROWS", 300)
    catalogue = spark.createDataFrame([("nitrate", "number", "µmol/L", None)], CATALOGUE_DDL)
    rows = [(i, i % 50, "m", ("nitrate", str(round(10 + i % 17 if i % 2 else (10 + i % 17) / 1000, 5)), "µM" if i % 2 else "mM", None, None), "c", 0.0) for i in range(900)]
    frame = spark.createDataFrame(rows, EXTRACTION_DDL)
    told = quantities.masked_accuracy(frame, catalogue).collect()
    assert len(told) == 1 and told[0].n >= 500 and told[0].n_right >= 0.95 * told[0].n and told[0].n_confident_right >= 0.97 * told[0].n_confident
    assert quantities.masked_accuracy(frame.limit(0), catalogue).count() == 0


def test_every_stated_unit_is_a_candidate(spark):
    """Units of one factor are one class, those without a factor another, and no number of units is too many."""
    catalogue = spark.createDataFrame([("salinity", "number", "psu", None), ("nitrate", "number", "µmol/L", None)], CATALOGUE_DDL)
    prefixes, volumes = ("p", "n", "µ", "m", "c", "d", "k", ""), ("L", "mL", "m^3", "dL")
    units = [f"{p}mol/{v}" for p in prefixes for v in volumes] + ["mg/L", "g/L", "NTU"]
    rows = [(i, i, "m", ("nitrate", "2", units[i % len(units)], None, None), "c", 0.0) for i in range(4 * len(units))]
    read = quantities.readings(spark.createDataFrame(rows, EXTRACTION_DDL), catalogue)
    classes = quantities.class_statistics(read.filter("unit_class is not null and attribute is not null"))["nitrate"]
    factors = {c["factor"] for c in classes if c["key"] != quantities.OTHER}
    assert len(classes) > 16 and len(factors) == len(classes) - 1 and sum(round(c["share"] * len(rows)) for c in classes) == len(rows)
