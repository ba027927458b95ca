"""Free-text values into typed quantities: exact, range, plus-minus, and bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import let, stripped

#: Raised digits and signs, and the characters they stand for.
RAISED, PLAIN = "⁰¹²³⁴⁵⁶⁷⁸⁹⁻−‑", "0123456789---"
FIELDS = ("confidence_region", "quantity", "range_min", "range_max", "confidence_min", "confidence_max", "less_than_or_equal", "greater_than")
#: What may stand behind a value of each kind.
TAILS = {"range": ("", ")", "%", ")%"), "words": ("",), "margin": ("", "%"), "bound": ("", "%"), "power": ("",), "alone": ("", "*", "%", "*%")}


def qualifier(raw: Column) -> Column:
    """A struct of FIELDS, or null for a text that no kind of value fits.

    The text is read from left to right: a bracket, a comparison sign, a number, a sign that links it to a second number,
    that number, and a tail of signs. Thousands commas don't count, and raised digits are lowered first, so a bare
    ``10⁻⁴`` is the range 4 to 10. An exponent that no double can hold is no value.
    """
    text = F.translate(F.regexp_replace(stripped(raw), ",", ""), RAISED, PLAIN)
    return let(text, lambda t: let(_framed(t), lambda f: let(_numbers(f), _decided)))


def _framed(text: Column) -> Column:
    """(mark, bracket, body, tail): the text without what stands around its numbers."""
    mark = F.when(F.substring(text, 1, 1).isin("<", "≤"), "<").when(F.substring(text, 1, 1).isin(">", "≥"), ">").otherwise("")
    bracket = F.startswith(text, F.lit("("))
    inner = F.ltrim(F.when(mark != "", F.regexp_replace(F.substring(text, 2, 1_000_000), "^=", "")).when(bracket, F.substring(text, 2, 1_000_000)).otherwise(text))
    body = F.rtrim(inner, F.lit(")*% "))
    return F.struct(mark.alias("mark"), bracket.alias("bracket"), body.alias("body"), F.ltrim(F.substring(inner, F.length(body) + 1, F.length(inner))).alias("tail"))


def _numbers(f: Column) -> Column:
    """(first, rest) besides the frame: the first number as a text, and what follows it."""
    first = F.regexp_extract(f["body"], r"^-?[0-9]+(?:\.[0-9]+)?", 0)
    rest = lambda n: F.ltrim(F.substring(f["body"], F.length(n) + 1, F.length(f["body"])))
    return let(first, lambda n: F.struct(*[f[c].alias(c) for c in ("mark", "bracket", "tail")], n.alias("first"), rest(n).alias("rest")))


def _decided(v: Column) -> Column:
    none = F.lit(None).cast("double")
    number = lambda text: text.try_cast("double")

    def shaped(region: str, **values: Column) -> Column:
        return F.struct(F.lit(region).alias(FIELDS[0]), *[values.get(f, none).alias(f) for f in FIELDS[1:]])

    def after(sign: str) -> Column:
        """The number that follows a link, as a text; null if something else does. A minus directly before is its own."""
        left = F.ltrim(F.substring(v["rest"], len(sign) + 1, 1_000_000))
        return F.when(F.startswith(F.lower(v["rest"]), F.lit(sign)) & left.rlike(r"^-?[0-9]+(?:\.[0-9]+)?$"), left)

    def ends(kind: str) -> Column:
        return v["tail"].isin(*TAILS[kind])

    a = number(v["first"])
    dashed = F.coalesce(*[after(s) for s in ("-", "–", "—")])
    worded, margin = after("to"), F.coalesce(*[after(s) for s in ("±", "+/-", "+-")])
    power = F.when(F.lower(F.substring(v["rest"], 1, 1)) == "e", F.ltrim(F.substring(v["rest"], 2, 1_000_000)))
    ten = F.when(F.substring(v["rest"], 1, 1).isin("×", "x"), F.ltrim(F.substring(v["rest"], 2, 1_000_000)))
    ten = F.when(F.startswith(ten, F.lit("10")), F.regexp_replace(F.substring(ten, 3, 1_000_000), r"^\^", ""))
    exponent = F.coalesce(F.when(power.rlike("^[+-]?[0-9]+$"), power), F.when(ten.rlike("^-?[0-9]+$"), ten))
    value = a * F.pow(F.lit(10.0), number(exponent))
    free = ~v["bracket"] & (v["mark"] == "")

    def ranged(text: Column) -> Column:
        return shaped("range", range_min=F.least(a, number(text)), range_max=F.greatest(a, number(text)))

    return (
        F.when(v["first"].isNull() | (v["first"] == ""), None)
        .when(v["mark"] != "", F.when((v["rest"] == "") & ends("bound"), F.when(v["mark"] == "<", shaped("less_than_or_equal", less_than_or_equal=a)).otherwise(shaped("greater_than", greater_than=a))))
        .when(dashed.isNotNull() & ends("range"), ranged(dashed))
        .when(free & worded.isNotNull() & ends("words"), ranged(worded))
        .when(free & margin.isNotNull() & ends("margin"), shaped("plus_minus", quantity=a, confidence_min=a - number(margin), confidence_max=a + number(margin)))
        .when(free & exponent.isNotNull() & ends("power"), F.when(F.abs(value) < float("inf"), shaped("exact", quantity=value)))
        .when(free & (v["rest"] == "") & ends("alone"), shaped("exact", quantity=a))
    )


def scaled(shape: Column, factor: Column) -> Column:
    """The qualifier with all its numbers multiplied."""
    return F.struct(shape[FIELDS[0]].alias(FIELDS[0]), *[(shape[f] * factor).alias(f) for f in FIELDS[1:]])
