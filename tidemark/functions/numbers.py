"""Reads the number that a printed value states, inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Printed superscripts and minus signs, and the plain characters they stand for.
RAISED, PLAIN = "⁰¹²³⁴⁵⁶⁷⁸⁹⁻−‑", "0123456789---"
#: A number with optional thousands commas, followed by an optional exponent (1.2E-03, 1.2×10^-3).
NUMBER = r"([-+]?(?:\d[\d,]*(?:\.\d+)?|\.\d+))(?:\s*[eE]([-+]?\d+)|\s*[×x]\s*10\^?\{?([-+]?\d+)\}?)?"


def stated_number(text: Column) -> Column:
    """The first number in ``text`` as a double, or null. ``1,014``, ``1.014E+03`` and ``1.014×10³`` are one number."""
    plain = F.translate(text, RAISED, PLAIN)
    mantissa = F.regexp_replace(F.regexp_extract(plain, NUMBER, 1), ",", "")
    exponent = F.concat(F.regexp_extract(plain, NUMBER, 2), F.regexp_extract(plain, NUMBER, 3))
    literal = F.concat(mantissa, F.lit("e"), F.when(exponent == "", "0").otherwise(exponent))
    return F.when(mantissa != "", literal.try_cast("double"))
