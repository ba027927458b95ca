"""Parses printed units into a scale and a dimension, and printed values into numbers and a remaining text.

Plain functions with a per-process memory: the callers apply them in Arrow batches, and the distinct spellings of a
corpus are few against its rows.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

#: Scale prefixes, as symbols and as words.
PREFIXES = {"": 1.0, "p": 1e-12, "n": 1e-9, "u": 1e-6, "m": 1e-3, "c": 1e-2, "d": 1e-1, "k": 1e3}
PREFIX_WORDS = {"pico": 1e-12, "nano": 1e-9, "micro": 1e-6, "milli": 1e-3, "centi": 1e-2, "deci": 1e-1, "kilo": 1e3, "": 1.0}
#: Base units with their scale and dimension. A year has 365 days.
BASES = {
    "mol": (1.0, (("mol", 1),)),
    "g": (1.0, (("g", 1),)),
    "eq": (1.0, (("eq", 1),)),
    "atm": (101325.0, (("Pa", 1),)),
    "Pa": (1.0, (("Pa", 1),)),
    "bar": (1e5, (("Pa", 1),)),
    "S": (1.0, (("S", 1),)),
    "m": (1.0, (("m", 1),)),
    "L": (1e-3, (("m", 3),)),
    "l": (1e-3, (("m", 3),)),
    "M": (1e3, (("mol", 1), ("m", -3))),
}
BASE_WORDS = {
    "mole": "mol", "mol": "mol", "gram": "g", "gramme": "g", "equivalent": "eq", "meter": "m", "metre": "m", "liter": "L", "litre": "L",
    "pascal": "Pa", "atmosphere": "atm", "siemens": "S", "molar": "M",
}
TIMES = {
    "s": 1.0, "sec": 1.0, "second": 1.0, "min": 60.0, "minute": 60.0, "h": 3600.0, "hr": 3600.0, "hour": 3600.0,
    "d": 86400.0, "day": 86400.0, "week": 604800.0, "y": 31536000.0, "yr": 31536000.0, "year": 31536000.0, "a": 31536000.0,
}
#: Units of a kind of their own, which convert to nothing else.
KINDS = {
    "psu": "psu", "ppt": "psu", "‰": "psu", "per mille": "psu", "permille": "psu", "practical salinity units": "psu", "practical salinity unit": "psu",
    "ntu": "ntu", "ftu": "ftu", "fnu": "fnu", "ppm": "ppm", "ppb": "ppb", "%": "percent", "percent": "percent",
    "% sat.": "saturation", "% sat": "saturation", "% saturation": "saturation", "percent saturation": "saturation", "% dry weight": "dry weight",
    "°c": "degree", "deg c": "degree",
}
TAGS = {"C", "N", "P", "Si", "O2", "N2", "CO2", "CaCO3", "chl"}


@lru_cache(maxsize=200_000)
def parse_unit(text: str | None) -> tuple[float, tuple[tuple[str, int], ...], str] | None:
    """(scale, dimension, tag) of a unit, or None if the text isn't one as a whole.

    The tag is the element or substance an amount is given in (``mmol N``), or ``""``. Practical salinity and g/kg are
    one unit: both have the dimension ``psu``.
    """
    if text is None:
        return None
    s = " ".join(text.replace("µ", "u").replace("μ", "u").split()).strip(" ;,()[]")
    if not s or len(s) > 80:
        return None
    kind = KINDS.get(s.lower())
    if kind:
        return (1.0, ((kind, 1),), "")
    s = unicodedata.normalize("NFKC", s).replace("−", "-").replace("‐", "-").replace("–", "-").replace("μ", "u")
    s = s.replace("{", "").replace("}", "").replace("^", "").replace("**", "")
    s = re.sub(r"[·⋅∙*×]", " ", s)
    s = re.sub(r"\b(square|cubic)\s+(\w*?met(?:er|re))s?\b", lambda m: m[2] + ("2" if m[1] == "square" else "3"), s, flags=re.I)
    s = re.sub(r"\bper\b", "/", s, flags=re.I)
    scale, dims, tag = 1.0, {}, ""
    for part, group in enumerate(s.split("/")):
        tokens = group.split()
        if not tokens and part:
            return None
        for token in tokens:
            if token in TAGS:
                if tag and tag != token:
                    return None
                tag = token
                continue
            found = _token(token)
            if found is None:
                return None
            factor, base, power = found
            power = -power if part else power
            scale *= factor**power
            for name, exponent in base:
                name = "per g" if name == "g" and power < 0 else name  # g/kg is no pure number
                dims[name] = dims.get(name, 0) + exponent * power
    dims = {k: v for k, v in dims.items() if v}
    if not dims:
        return None if scale == 1.0 else (scale, (("ratio", 1),), tag)
    if dims == {"g": 1, "per g": -1}:
        return (scale / 1e-3, (("psu", 1),), tag)
    return (scale, tuple(sorted(dims.items())), tag)


@lru_cache(maxsize=50_000)
def _token(token: str) -> tuple[float, tuple[tuple[str, int], ...], int] | None:
    m = re.fullmatch(r"([A-Za-z]+)([-+]?\d+)?", token)
    if not m:
        return None
    word, power = m[1], int(m[2]) if m[2] else 1
    if not -4 <= power <= 4 or not power:
        return None
    if word in TIMES or word.lower().rstrip("s") in TIMES and len(word) > 2:
        return (TIMES[word] if word in TIMES else TIMES[word.lower().rstrip("s")], (("s", 1),), power)
    for prefix, factor in PREFIXES.items():
        if word.startswith(prefix) and word[len(prefix) :] in BASES:
            base = BASES[word[len(prefix) :]]
            return (factor * base[0], base[1], power)
    low = word.lower()
    for prefix, factor in PREFIX_WORDS.items():
        rest = low[len(prefix) :]
        if low.startswith(prefix) and (rest in BASE_WORDS or rest.rstrip("s") in BASE_WORDS):
            base = BASES[BASE_WORDS.get(rest) or BASE_WORDS[rest.rstrip("s")]]
            return (factor * base[0], base[1], power)
    return None


def comparable(unit: tuple | None, canonical: tuple | None) -> bool:
    """Whether the two differ by a fixed factor at most. A unit without an element or substance goes with any."""
    return bool(unit and canonical and unit[1] == canonical[1] and (unit[2] == canonical[2] or not unit[2]))


@lru_cache(maxsize=200_000)
def conversion(unit_text: str | None, canonical_text: str | None) -> float | None:
    """The factor from a unit to the canonical one, or None where no fixed factor exists."""
    unit, canonical = parse_unit(unit_text), parse_unit(canonical_text)
    if not comparable(unit, canonical):
        return None
    factor = unit[0] / canonical[0]
    return 1.0 if abs(factor - 1) < 1e-9 else float(f"{factor:.12g}")


_RAISED = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻−‑", "0123456789---")
_N = r"[-+]?(?:\d[\d,]*(?:\.\d+)?|\.\d+)(?:\s*[eE][-+]?\d+|\s*[×x]\s*10\^?\{?[-+]?\d+\}?)?"
_VALUE = re.compile(
    rf"^\s*(?:(?P<bound><=|>=|<|>|≤|≥|~|≈)\s*)?\(?\s*(?P<a>{_N})\s*(?:(?P<op>±|\+/-|\+-|–|—|-|to\b)\s*(?P<b>{_N})\s*)?\)?\s*\*?"
)


def _float(text: str) -> float | None:
    m = re.fullmatch(r"([^eE×x]+?)\s*(?:[eE]([-+]?\d+)|[×x]\s*10\^?\{?([-+]?\d+)\}?)?", text.strip())
    try:
        return float(f"{m[1].replace(',', '').strip()}e{m[2] or m[3] or 0}")
    except (ValueError, TypeError):
        return None


@lru_cache(maxsize=50_000)
def read_value(text: str | None) -> tuple[str, float | None, float | None, float | None, str] | None:
    """(shape, point, low, high, remaining text) of a printed value, or None if it states no number.

    Shapes: exact, range, plus_minus, at_most, at_least. What follows the number, such as a unit, remains.
    """
    if text is None:
        return None
    m = _VALUE.match(text if "×10" not in text and "x10" not in text else text.translate(_RAISED))
    if not m:
        return None
    a, b = _float(m["a"]), _float(m["b"]) if m["b"] else None
    rest = text[m.end() :] if "×10" not in text and "x10" not in text else text.translate(_RAISED)[m.end() :]
    if a is None or m["b"] and b is None or rest[:1].isdigit():
        return None
    if m["bound"] in ("<", "<=", "≤"):
        return ("at_most", None, None, a, rest.strip())
    if m["bound"] in (">", ">=", "≥"):
        return ("at_least", None, a, None, rest.strip())
    if m["op"] in ("±", "+/-", "+-"):
        return ("plus_minus", a, a - abs(b), a + abs(b), rest.strip())
    if m["op"]:
        return ("range", None, min(a, b), max(a, b), rest.strip())
    return ("exact", a, a, a, rest.strip())


_LEAD = re.compile(r"(?:units?\s*:|values?\s+given\s+as|given\s+as|reported\s+(?:in|as)|table\s+lists|expressed\s+(?:in|as)|measured\s+in|in)\s+", re.I)


@lru_cache(maxsize=200_000)
def unit_in_text(text: str | None) -> str | None:
    """A unit that a remark states (``units: mg/L``, ``pooled cores; values given as µM``), or None."""
    for part in (text or "").split(";"):
        part = part.strip()
        for m in _LEAD.finditer(part):
            if parse_unit(part[m.end() :]):
                return part[m.end() :].strip()
        if parse_unit(part) and not re.match(r"[\d.]+\s", part):
            return part
    return None
