"""Vectors of values and units."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions.numbers import stated_number
from tidemark.functions.qualifier import FIELDS, qualifier
from tidemark.functions.unit_algebra import conversion, parse_unit, read_value, unit_in_text
from tidemark.functions.units import canonical_factor, unit_form

EXACT = {"26.52": 26.52, "4.5*": 4.5, "1,801": 1801.0, "2.9%": 2.9, "-0.5": -0.5, "1.79E+09": 1.79e9, "9.7×10⁻⁴": 9.7e-4, "3 x 10^2": 300.0}
RANGES = {"22–27": (22, 27), "0.3-318": (0.3, 318), "10.2 to 20.8": (10.2, 20.8), "(27.9–33.6)": (27.9, 33.6), "33.9–33.6": (33.6, 33.9), "84–110%": (84, 110), "10⁻⁴": (4, 10)}
NOTHING = ["ND", "NA", "—", "–", "", "  ", "~0.11", "nearly 30", "tidal marsh", "5.0(3.2)", "<0.03 to 3.67", "Below detection–0.1", "303 (?)", None, "1e400"]


def parsed(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", qualifier(F.col("t")).alias("q"))
    return [r.q for r in frame.orderBy("i").collect()]


def test_qualifier_shapes(spark):
    for q, (text, value) in zip(parsed(spark, list(EXACT)), EXACT.items()):
        assert q.confidence_region == "exact" and q.quantity == pytest.approx(value), text
    for q, (text, (low, high)) in zip(parsed(spark, list(RANGES)), RANGES.items()):
        assert q.confidence_region == "range" and (q.range_min, q.range_max) == (low, high), text
    a, b, c, d, e = parsed(spark, ["10.8±0.5", "5.5±5.5", "<0.2", "≤0.05", ">33.7"])
    assert (a.quantity, a.confidence_min, a.confidence_max) == (10.8, pytest.approx(10.3), pytest.approx(11.3))
    assert (b.confidence_min, b.confidence_max) == (0, 11)
    assert [c.less_than_or_equal, d.less_than_or_equal, e.greater_than] == [0.2, 0.05, 33.7]
    assert parsed(spark, NOTHING) == [None] * len(NOTHING)
    assert len(FIELDS) == 8


UNITS = [
    ("nitrate", "µmol/L", 1.0), ("nitrate", "nmol L⁻¹", 0.001), ("dissolved_inorganic_carbon", "mmol/kg", 1000.0), ("dissolved_inorganic_carbon", "µmol kg⁻¹", 1.0),
    ("dissolved_inorganic_carbon", "μmol/kg", 1.0), ("dissolved_inorganic_carbon", "umol/kg", 1.0), ("salinity", "ppt", 1.0), ("salinity", "g/kg", 1.0), ("salinity", "‰", 1.0),
    ("light_attenuation", "m⁻¹", 1.0), ("light_attenuation", "per meter", 1.0), ("nitrate", "µM", 1.0), ("chlorophyll", "mg/L", 1000.0),
    ("not_a_real_attribute", "mg/L", None), ("salinity", None, None), ("salinity", " ", None), ("dissolved_organic_carbon", "µmol/L", None), ("dissolved_oxygen", "% saturation", None), ("salinity", "mS cm-1", None),
    ("suspended_particulate_matter", "mg/l", None), ("pco2", "matm", None),
]


def test_warehouse_factors(spark):
    frame = spark.createDataFrame([(i, a, u) for i, (a, u, _) in enumerate(UNITS)], "i int, a string, u string")
    got = [r.f for r in frame.select("i", canonical_factor(F.col("a"), F.col("u")).alias("f")).orderBy("i").collect()]
    for f, (attribute, unit, want) in zip(got, UNITS):
        assert f is None if want is None else f == pytest.approx(want), (attribute, unit)
    forms = spark.createDataFrame([("umol L-1",), ("mg/litre",), ("mmol m^{-2} day^{-1}",), ("nM",), (None,)], "u string").select(unit_form(F.col("u")).alias("f")).collect()
    assert [r.f for r in forms] == ["µmol/L", "mg/L", "mmol /m^2 /d".replace(" /", "/"), "nmol/L", None]


def test_unit_algebra():
    assert conversion("nmol N cm⁻² h⁻¹", "µmol N/m^2/h") == pytest.approx(10)
    assert conversion("mol m⁻² y⁻¹", "mmol/m^2/d") == pytest.approx(1000 / 365)
    assert conversion("mg kg^{-1}", "psu") == pytest.approx(1e-3) and conversion("practical salinity units", "psu") == 1
    assert conversion("kPa", "µatm") == pytest.approx(9869.23266716) and conversion("per centimeter", "/m") == pytest.approx(100)
    assert conversion("mg/m^3", "µg/L") == 1 and conversion("grams C per square meter per year", "g C/m^2/d") == pytest.approx(1 / 365)
    for unit, goal in (("mg/L", "µmol/L"), ("µg N/L", "µmol/L"), ("mmol/m^3", "µmol/kg"), ("FNU", "NTU"), ("ppm", "µatm"), ("mS/cm", "psu"), ("% sat.", "mg/L"), ("see value", "mg/L"), (None, "mg/L"), ("mg/L", None)):
        assert conversion(unit, goal) is None, (unit, goal)
    assert parse_unit("x" * 1000) is None and parse_unit("") is None


def test_values_and_remarks():
    assert read_value("1,211 µmol kg^-1") == ("exact", 1211, 1211, 1211, "µmol kg^-1")
    assert read_value("(2.8–6.3) FTU")[1:] == (None, 2.8, 6.3, "FTU") and read_value("37.2 +/- 11")[0] == "plus_minus"
    assert read_value("≤4.85")[:4] == ("at_most", None, None, 4.85) and read_value(">3")[:4] == ("at_least", None, 3, None)
    assert read_value("ND") is None and read_value(None) is None and read_value("") is None
    assert unit_in_text("pooled cores; values given as µM") == "µM" and unit_in_text("0.5 m depth") is None and unit_in_text(None) is None


def test_stated_numbers(spark):
    texts = {"1,014": 1014.0, "1.014E+03": 1014.0, "1.014×10³": 1014.0, "n=12": 12.0, " .5 mg/L": 0.5, "bdl": None, None: None, "7.638×10⁻³": 0.007638}
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", stated_number(F.col("t")).alias("n"))
    assert [r.n for r in frame.orderBy("i").collect()] == list(texts.values())
