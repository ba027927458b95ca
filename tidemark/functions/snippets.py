"""Pages of a transcribed document, and the page on which a value stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import let, stripped
from tidemark.operators.skew import HOT_FLOOR, HOT_SHARE

#: How pages are tagged in a transcribed document.
PAGE = r'(?s)<page number="(\d+)">(.*?)</page>'
#: What is shown of a document without pages.
UNPAGED_CHARS = 2000
#: The questions about a document with very many are spread over so many tasks.
SALTS = 16


def page_list(text: Column) -> Column:
    """array<struct<page, text>> of the tagged pages, in order, texts without outer white space."""
    numbers, texts = F.regexp_extract_all(text, F.lit(PAGE), F.lit(1)), F.regexp_extract_all(text, F.lit(PAGE), F.lit(2))
    return F.zip_with(numbers, texts, lambda n, t: F.struct(n.try_cast("bigint").alias("page"), stripped(t).alias("text")))


def page_text(text: Column, page: Column) -> Column:
    """The text of one page; of pages with the same number the last."""
    return F.element_at(F.filter(page_list(text), lambda p: p["page"] == page), -1)["text"]


def number_of(text: Column) -> Column:
    """The number a text is, thousands commas aside, or null."""
    bare = F.regexp_replace(stripped(text), ",", "")
    return F.when(bare.rlike(r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?$"), bare.try_cast("double"))


def _core(run: Column) -> Column:
    """A run of digits, points and commas without the punctuation around it."""
    return F.rtrim(F.regexp_replace(run, "^(-?)[.,]+", "$1"), F.lit(".,"))


def _value(run: Column) -> Column:
    return F.replace(_core(run), F.lit(","), F.lit("")).try_cast("double")


def numbers_in(text: Column) -> Column:
    """The distinct numbers of a text: runs of digits with points and commas inside; a minus begins a run."""
    runs = F.split(text, "(?=-)|[^0-9.,-]+")
    return F.array_distinct(F.filter(F.transform(runs, _value), lambda n: n.isNotNull()))


def _around(text: Column, value: Column) -> Column:
    """(parts, alone) of a text cut at a value: whether each occurrence is a token of its own, without a digit, point or
    comma on either side and without a minus before it."""
    quoted = F.concat(F.lit("\\Q"), F.replace(value, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))

    def told(parts: Column) -> Column:
        n = F.size(parts)
        before = lambda i: F.right(F.when((F.get(parts, i) == "") & (i > 0), value).otherwise(F.get(parts, i)), F.lit(1))
        after = lambda i: F.left(F.when((F.get(parts, i + 1) == "") & (i + 2 < n), value).otherwise(F.get(parts, i + 1)), F.lit(1))
        alone = F.transform(F.slice(parts, 1, n - 1), lambda p, i: ~before(i).rlike("[0-9.,-]") & ~after(i).rlike("[0-9.,]"))
        return F.struct(parts.alias("parts"), alone.alias("alone"))

    return let(F.split(text, quoted, -1), told)


def holds(text: Column, value: Column) -> Column:
    """Whether a text shows the value as a token of its own."""
    return F.contains(text, value) & let(_around(text, value), lambda a: F.exists(a["alone"], lambda x: x))


def marked_literal(text: Column, value: Column) -> Column:
    """The text with each occurrence of the value that is a token of its own between mark tags."""

    def put(a: Column) -> Column:
        shown = lambda i: F.when(F.get(a["alone"], i), F.concat(F.lit("<mark>"), value, F.lit("</mark>"))).otherwise(F.when(i + 1 < F.size(a["parts"]), value).otherwise(""))
        return F.array_join(F.transform(a["parts"], lambda p, i: F.concat(p, shown(i))), "")

    return let(_around(text, value), put)


def marked_number(text: Column, number: Column) -> Column:
    """The text with every number that equals the given one between mark tags."""
    runs = F.split(text, "(?=-)|(?<=[0-9.,])(?![0-9.,])|(?<![0-9.,-])(?=[0-9.,])")

    def put(run: Column) -> Column:
        core = _core(run)
        return F.when(run.rlike("^-?[0-9.,]+$") & (_value(run) == number), F.replace(run, core, F.concat(F.lit("<mark>"), core, F.lit("</mark>")))).otherwise(run)

    return F.array_join(F.transform(runs, put), "")


def _asked(rows: DataFrame, key: str, document: str) -> DataFrame:
    return rows.select(key, document, "value", F.lower("attribute").alias("attribute"), F.lower("units").alias("units"), number_of(F.col("value")).alias("number"))


def _spread(asked: DataFrame, paged: DataFrame, document: str) -> tuple[DataFrame, DataFrame]:
    """Questions and pages with ``salt``: documents with more than a thousandth of all questions, a thousand at most, have
    their questions spread over SALTS copies of their pages, so no task has them all."""
    counts = asked.groupBy(document).agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(counts.filter(F.col("n") > max(HOT_FLOOR, int(total * HOT_SHARE))).select(document, F.lit(True).alias("hot")))
    salted = asked.join(hot, document, "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64(*asked.columns), F.lit(SALTS)).cast("int")).otherwise(0)).drop("hot")
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted, paged.join(hot, document, "left").withColumn("salt", F.explode(copies)).drop("hot")


def _best_pages(rows: DataFrame, contexts: DataFrame, key: str, document: str) -> DataFrame:
    """(key, document, value, tier, pos, page): the place that answers each row; nulls without one."""
    paged = contexts.select(document, F.posexplode(page_list(F.col("context"))).alias("pos", "p")).select(document, "pos", "p.page", "p.text", F.lower("p.text").alias("low"), numbers_in(F.col("p.text")).alias("numbers"))
    asked, pages = _spread(_asked(rows, key, document), paged, document)
    given = (F.col("value") != "") & F.col("value").isNotNull()
    mention = lambda c: F.coalesce((F.col(c) != "") & F.contains("low", c), F.lit(False))
    literal = F.coalesce(given & holds(F.col("text"), F.col("value")), F.lit(False))
    equal = F.coalesce(given & F.array_contains("numbers", F.col("number")), F.lit(False))
    flagged = asked.join(pages, [document, "salt"], "left").select(
        key, document, "value", "pos", "page", given.alias("given"), literal.alias("literal"), equal.alias("equal"), (mention("attribute") | mention("units")).alias("mention")
    )
    tier = F.when(~F.col("given"), 3).when(F.col("literal"), 0).when(F.col("equal"), 1).when(F.col("mention"), 2).otherwise(3)
    # a page without the value must not win over one with it, and mentions only matter within a tier
    order = F.struct(tier.alias("tier"), F.when(F.col("given") & F.col("mention"), 0).otherwise(1).alias("m"), "pos", "page")
    best = flagged.groupBy(key).agg(F.min(order).alias("b"), F.first(document).alias(document), F.first("value").alias("value"))
    return best.select(key, document, "value", F.col("b.tier").alias("tier"), F.col("b.pos").alias("pos"), F.col("b.page").alias("page"))


def find_pages(rows: DataFrame, contexts: DataFrame, key: str, document: str) -> DataFrame:
    """(key, page_number, page_matched) of the page that shows each row's value best, one row per row.

    rows: key (unique), document, value, attribute, units; contexts: document (unique), context. In this order: pages with
    the value as a token, pages with an equal number, pages that mention attribute or units, the first page; among hits
    one that mentions them goes first. Without a context or without pages the number is null and nothing matched; a null
    or empty value goes to the first page unmatched. Pages are cut, and their numbers read, once per document.
    """
    return _best_pages(rows, contexts, key, document).select(key, F.col("page").alias("page_number"), (F.coalesce("tier", F.lit(3)) < 2).alias("page_matched"))


def find_snippets(rows: DataFrame, contexts: DataFrame, key: str, document: str) -> DataFrame:
    """(key, page_number, text, page_matched): ``find_pages`` with the text to show, the value marked where it stands.

    A document without pages shows its first UNPAGED_CHARS characters; a row without a context has no text.
    """
    best = _best_pages(rows, contexts, key, document)
    pages = contexts.select(document, F.posexplode(page_list(F.col("context"))).alias("pos", "p")).select(document, "pos", F.col("p.text").alias("shown"))
    starts = contexts.select(document, F.lit(-1).alias("pos"), F.substring(stripped(F.col("context")), 1, UNPAGED_CHARS).alias("shown"))
    left, right = _spread(best.withColumn("pos", F.coalesce("pos", F.lit(-1))), pages.unionByName(starts), document)
    met = left.join(right, [document, "salt", "pos"], "left")
    text = F.when(F.col("tier") == 0, marked_literal(F.col("shown"), F.col("value"))).when(F.col("tier") == 1, marked_number(F.col("shown"), number_of(F.col("value")))).otherwise(F.col("shown"))
    return met.select(key, F.col("page").alias("page_number"), text.alias("text"), (F.coalesce("tier", F.lit(3)) < 2).alias("page_matched"))
