"""Text and identifier functions as column expressions; all of them keep null as null unless they say otherwise."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stay lower case in a title unless they open or close it.
MINOR_WORDS = ("a", "an", "and", "as", "at", "but", "by", "for", "from", "in", "into", "nor", "of", "on", "onto", "or", "over", "per", "so", "the", "to", "up", "via", "vs", "with", "yet")
#: Endings of titles that are formulas and no footnote marks.
FORMULA_ENDINGS = ("CO2", "NO2", "NO3", "SO2", "SO4", "PO4", "NH3", "NH4", "H2S", "N2O", "CH4")
#: Tags a title may keep.
TITLE_TAGS = ("i", "em", "b", "strong", "sup", "sub")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. Catalyst would else write a long expression out wherever it is used,
    until the generated code exceeds what the JVM compiles."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def filled(text: Column) -> Column:
    """Null in place of an empty text."""
    return F.nullif(text, F.lit(""))


def squeezed(text: Column) -> Column:
    return stripped(F.regexp_replace(text, r"(?U)\s+", " "))


def entity_key(name: Column) -> Column:
    """A site name in lower case without punctuation, white space collapsed; null if nothing is left."""
    return filled(squeezed(F.regexp_replace(F.lower(name), r"(?U)[^\w\s]", "")))


def sha_prefix(text: Column, length: int) -> Column:
    return F.substring(F.sha2(text, 256), 1, length)


def prompt_hash(prompt: Column) -> Column:
    return sha_prefix(prompt, 12)


def voter_hash(ip: Column, agent: Column) -> Column:
    """Sixteen hex digits of who votes; a missing address is ``unknown``, a missing agent empty."""
    return sha_prefix(F.concat(F.coalesce(ip, F.lit("unknown")), F.lit("|"), F.coalesce(agent, F.lit(""))), 16)


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def without_footnote_mark(title: Column) -> Column:
    """Drops footnote numbers of one or two digits that are glued to the last word, unless the title ends in a formula."""
    formula = reduce(lambda a, b: a | b, [title.endswith(e) for e in FORMULA_ENDINGS])
    base = F.rtrim(title, F.lit("0123456789,"))
    marks = F.split(F.substring(title, F.length(base) + 1, F.length(title)), ",")
    glued = F.right(base, F.lit(1)).rlike("[A-Za-z>]") & F.forall(marks, lambda m: F.length(m).between(1, 2))
    return F.when(~formula & glued, base).otherwise(title)


def title_case(title: Column) -> Column:
    """Raises the first letter of each word but minor ones inside; tags and inner capitals stay. A ``<`` that opens no tag
    is dropped."""
    word = lambda t: t.rlike("^[A-Za-z0-9]")
    is_tag = lambda s: F.startswith(s, F.lit("<")) & s.endswith(">") & (F.length(s) > 2)

    def cased(s: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            minor = F.lower(t).isin(*MINOR_WORDS) & (i != s["first"]) & (i != s["last"])
            return F.when(~word(t), t).when(minor, F.lower(t)).otherwise(F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1_000_000)))

        return F.array_join(F.transform(s["tokens"], one), "")

    def placed(tokens: Column) -> Column:
        at = F.transform(tokens, lambda t, i: F.when(word(t), i))
        return let(F.struct(tokens.alias("tokens"), F.array_min(at).alias("first"), F.array_max(at).alias("last")), lambda s: F.when(s["first"].isNull(), title).otherwise(cased(s)))

    # cut around tags first, then the text between them where words begin and end
    edges = "(?<=[A-Za-z0-9'])(?![A-Za-z0-9'])|(?<![A-Za-z0-9'])(?=[A-Za-z0-9'])"
    pieces = F.transform(F.split(title, "(?=<)|(?<=>)"), lambda s: F.when(is_tag(s), F.array(s)).otherwise(F.split(F.replace(s, F.lit("<"), F.lit("")), edges)))
    return let(F.filter(F.flatten(pieces), lambda t: t != ""), placed)


def safe_title(title: Column) -> Column:
    """Keeps the tags of TITLE_TAGS without attributes and drops all others; an approximation of a full sanitiser."""
    kept = F.regexp_replace(title, rf"(?i)<(/?)({'|'.join(TITLE_TAGS)})\b[^>]*>", "\u0001$1$2\u0002")
    return F.translate(F.regexp_replace(kept, r"<[^>]*>", ""), "\u0001\u0002", "<>")


def rendered_title(title: Column) -> Column:
    return title_case(without_footnote_mark(safe_title(title)))


def without_markup(text: Column) -> Column:
    """Tags become blanks, white space collapses; null if nothing is left."""
    return filled(squeezed(F.regexp_replace(text, r"<[^>]+>", " ")))


def plain_doi(doi: Column) -> Column:
    """Without the resolver's address; case is kept; empty is null."""
    return filled(F.regexp_replace(doi, r"^https://doi\.org/", ""))


def last_segment(url: Column) -> Column:
    """The last part of an address, such as an identifier; empty is null."""
    return F.element_at(F.split(filled(url), "/"), -1)


def doi_prefix(doi: Column) -> Column:
    return F.when(F.instr(doi, "/") > 0, F.substring_index(doi, "/", 1)).otherwise(F.lit("unknown"))


def issn(text: Column) -> Column:
    """Eight characters become XXXX-XXXX; others stay."""
    return F.when(F.length(text) == 8, F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 4))).otherwise(text)


def iso_date(text: Column) -> Column:
    """A whole ISO date, or null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def date_from_parts(parts: Column) -> Column:
    """[year, month, day] with month and day 1 if missing; null if it is no date."""
    part = lambda i, default: F.coalesce(F.get(parts, F.lit(i)), F.lit(default)).cast("string")
    year = F.get(parts, F.lit(0)).cast("string")
    return F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(part(1, 1), 2, "0"), F.lpad(part(2, 1), 2, "0")).try_cast("date")


def text_from_index(index: Column) -> Column:
    """The text of a word -> positions map; of two words at one place the later one of the map; null if empty."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w")))))

    def joined(ordered: Column) -> Column:
        last = F.filter(ordered, lambda x, i: (i == F.size(ordered) - 1) | (F.get(ordered, i + 1)["p"] != x["p"]))
        return F.array_join(F.transform(last, lambda x: x["w"]), " ")

    return filled(let(F.array_sort(placed), joined))


def names_or_null(names: Column) -> Column:
    """The non-blank names of an array; null if there is none."""
    kept = F.filter(names, lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, kept)


def pdf_url(url: Column) -> Column:
    """The first version's address of the publisher's text-mining service."""
    return F.replace(url, F.lit("/onlinelibrary/tdm/v2/"), F.lit("/onlinelibrary/tdm/v1/"))


def short_error(text: Column, limit: int = 2000) -> Column:
    return F.substring(text, 1, limit)


def escaped_like(text: str) -> str:
    """A literal for LIKE with backslash as escape."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def clipped(text: Column, limit: int) -> Column:
    """The text on one line, cut with an ellipsis beyond ``limit`` characters."""
    line = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.when(F.length(line) > limit, F.concat(F.substring(line, 1, limit), F.lit("…"))).otherwise(line)


def has_key(document: Column, key: str) -> Column:
    """Whether a JSON object in text has the key; null for a null text or one that is no object."""
    return F.array_contains(F.json_object_keys(document), key)


def without_key(document: Column, key: str) -> Column:
    """A flat JSON object in text without the key."""
    fields = F.from_json(document, "map<string, string>")
    return F.when(has_key(document, key), F.to_json(F.map_filter(fields, lambda k, v: k != key), {"ignoreNullFields": "false"})).otherwise(document)
