"""Unit spellings onto one form, and factors to an attribute's canonical unit, as column expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.catalogue import CANONICAL_UNITS, SALINITY_UNITS
from tidemark.functions.text import filled, let, squeezed, stripped

#: Raised and lowered digits and signs, and the characters they stand for.
SHIFTED, PLAIN = "⁰¹²³⁴⁵⁶⁷⁸⁹⁻−‑₀₁₂₃₄₅₆₇₈₉₋", "0123456789---0123456789-"
#: What a prefix multiplies, and the bases it may stand before.
PREFIXES = {"p": 1e-12, "n": 1e-9, "µ": 1e-6, "m": 1e-3, "c": 1e-2, "d": 1e-1, "": 1.0, "da": 1e1, "h": 1e2, "k": 1e3, "M": 1e6, "G": 1e9}
BASES = ("mol", "g", "atm", "eq")
#: Every numerator that can be scaled: its scale and its base.
NUMERATORS = {prefix + base: (scale, base) for (prefix, scale), base in product(PREFIXES.items(), BASES)}


#: Names of units that stand for a symbol, in any letter case; and prefixes that a molarity may have.
SYMBOLS = {"liter": "L", "liters": "L", "litre": "L", "litres": "L", "day": "d", "hr": "h", "yr": "y"}
MOLAR_PREFIXES = ("", "n", "p", "µ", "u", "m", "c")
#: Units before which a plain u means micro.
MICRO_UNITS = ("mol", "g", "L", "atom")
#: One token of a unit: a name with a negative exponent (``m-2``, ``L^-1``), another word, or a sign.
_TOKEN = r"([A-Za-zµ]+)\^?-([0-9]+)|[A-Za-zµ0-9_]+|[\s\S]"


def _names() -> dict[str, str]:
    micro = {"u" + unit: "µ" + unit for unit in MICRO_UNITS}
    molar = {prefix + "M": prefix.replace("u", "µ") + "mol/L" for prefix in MOLAR_PREFIXES}
    return micro | molar


def unit_form(raw: Column) -> Column:
    """One spelling for a unit's many: ``nmol L⁻¹``, ``nM`` and ``nmol/litre`` are ``nmol/L``. Empty is null.

    The text is cut into tokens; names are looked up one by one, and a name with a negative exponent goes below a slash.
    """
    text = F.translate(F.translate(filled(stripped(raw)), "μ\u202f\u00a0", "µ  "), SHIFTED, PLAIN)
    text = F.replace(F.replace(text, F.lit("^{"), F.lit("^")), F.lit("}"), F.lit(""))
    names = F.create_map(*[F.lit(x) for pair in _names().items() for x in pair])
    symbols = F.create_map(*[F.lit(x) for pair in SYMBOLS.items() for x in pair])
    called = lambda name: F.coalesce(symbols[F.lower(name)], names[name], name)

    def put(token: Column) -> Column:
        below = F.concat(F.lit("/"), called(token["name"]), F.when(token["power"] == "1", "").otherwise(F.concat(F.lit("^"), token["power"])))
        return F.when(token["name"] != "", below).otherwise(called(token["raw"]))

    def printed(s: Column) -> Column:
        part = lambda i: F.regexp_extract_all(s, F.lit(_TOKEN), F.lit(i))
        return F.array_join(F.transform(F.arrays_zip(part(0).alias("raw"), part(1).alias("name"), part(2).alias("power")), put), "")

    tidy = lambda s: F.array_join(F.transform(F.split(s, "/"), squeezed), "/")
    return tidy(F.regexp_replace(let(squeezed(text), printed), r"(?i)\bper meter\b", "/m"))


def canonical_unit(attribute: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in CANONICAL_UNITS.items() for x in pair])[attribute]


def canonical_factor(attribute: Column, raw: Column) -> Column:
    """What a quantity in the unit is multiplied with; null for a null, unknown or inconvertible unit.

    Equal forms and the salinity units have factor 1. Otherwise only the numerator's prefix may differ.
    """
    scale = F.create_map(*[F.lit(x) for token, (s, _) in NUMERATORS.items() for x in (token, s)])
    base = F.create_map(*[F.lit(x) for token, (_, b) in NUMERATORS.items() for x in (token, b)])
    top = lambda u: F.substring_index(u, "/", 1)
    below = lambda u: F.when(F.instr(u, "/") > 0, F.substring(u, F.instr(u, "/") + 1, F.length(u)))

    def factor(pair: Column) -> Column:
        form, goal = pair["form"], pair["goal"]
        fits = (below(form) == below(goal)) & (base[top(form)] == base[top(goal)])
        salt = (attribute == "salinity") & form.isin(*SALINITY_UNITS)
        return F.when(salt | (form == goal), F.lit(1.0)).when(fits, scale[top(form)] / scale[top(goal)])

    return let(F.struct(unit_form(raw).alias("form"), canonical_unit(attribute).alias("goal")), factor)
