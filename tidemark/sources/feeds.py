"""Bibliographic feeds: response pages as files, mapped onto one landing schema, with marks per source.

Network access is behind ``PageSource.fetch``; what is built here reads pages that were fetched into files, one JSON
response per file, so that a run can be repeated and tested.
"""

from __future__ import annotations

import json
import time
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators.upsert import advance_marks, insert_if_absent, on_or_after

#: The parts of the feeds' answers that are read.
WORKS_SCHEMA = (
    "meta struct<next_cursor: string>, results array<struct<id: string, doi: string, title: string, abstract_inverted_index: map<string, array<int>>, "
    "open_access: struct<oa_url: string>, publication_date: string, authorships: array<struct<author: struct<display_name: string>>>>>"
)
PAPERS_SCHEMA = (
    "total bigint, token string, data array<struct<paperId: string, externalIds: struct<DOI: string>, title: string, abstract: string, "
    "openAccessPdf: struct<url: string>, publicationDate: string, authors: array<struct<name: string>>>>"
)
ITEMS_SCHEMA = (
    "message struct<`next-cursor`: string, items: array<struct<DOI: string, title: array<string>, abstract: string, published: struct<`date-parts`: array<array<int>>>, "
    "link: array<struct<`intended-application`: string, URL: string>>, author: array<struct<given: string, family: string>>>>>"
)
#: The text-mining service's address and what marks a link to it.
MINING_URL, MINING_HOST = "https://api.wiley.com/onlinelibrary/tdm/v1/articles", "api.wiley.com/onlinelibrary/tdm/"

LANDING = ("doi", "openalex_id", "semantic_scholar_id", "title", "abstract", "oa_pdf_url", "authors", "publication_date", "discovered_from", "metadata")


def landed(rows: DataFrame, **columns: Column) -> DataFrame:
    none = F.lit(None).cast("string")
    kinds = {"authors": "array<string>", "publication_date": "date"}
    put = {c: columns.get(c, F.lit("{}") if c == "metadata" else none.cast(kinds.get(c, "string"))) for c in LANDING}
    return rows.select(*[put[c].alias(c) for c in LANDING])


def map_works(pages: DataFrame) -> DataFrame:
    """Landing rows of works whose abstracts come as word positions."""
    r = F.col("r")
    return landed(
        pages.select(F.explode("results").alias("r")), doi=t.plain_doi(r["doi"]), openalex_id=t.last_segment(r["id"]), title=r["title"], abstract=t.text_from_index(r["abstract_inverted_index"]),
        oa_pdf_url=r["open_access"]["oa_url"], authors=t.names_or_null(F.transform(r["authorships"], lambda a: a["author"]["display_name"])),
        publication_date=t.iso_date(r["publication_date"]), discovered_from=F.lit("openalex"),
    )


def map_search(pages: DataFrame) -> DataFrame:
    """Landing rows of a bulk search's papers."""
    r = F.col("r")
    return landed(
        pages.select(F.explode("data").alias("r")), doi=r["externalIds"]["DOI"], semantic_scholar_id=r["paperId"], title=r["title"], abstract=r["abstract"], oa_pdf_url=r["openAccessPdf"]["url"],
        authors=t.names_or_null(F.transform(r["authors"], lambda a: a["name"])), publication_date=t.iso_date(r["publicationDate"]), discovered_from=F.lit("semantic_scholar"),
    )


def mining_url(links: Column, doi: Column) -> Column:
    """The first text-mining link on the service's own host, else the address made from the doi."""
    fit = F.filter(links, lambda x: (x["intended-application"] == "text-mining") & F.contains(x["URL"], F.lit(MINING_HOST)))
    return F.coalesce(t.pdf_url(F.get(fit, F.lit(0))["URL"]), F.concat(F.lit(MINING_URL + "/"), t.filled(doi)))


def map_items(pages: DataFrame) -> DataFrame:
    """Landing rows of a registry's items, with marked-up abstracts and dates in parts."""
    r = F.col("r")
    name = lambda a: F.concat_ws(" ", t.filled(a["given"]), t.filled(a["family"]))
    return landed(
        pages.select(F.explode("message.items").alias("r")), doi=t.filled(r["DOI"]), title=F.get(r["title"], F.lit(0)), abstract=t.without_markup(r["abstract"]), oa_pdf_url=mining_url(r["link"], r["DOI"]),
        authors=t.names_or_null(F.transform(r["author"], name)), publication_date=t.date_from_parts(F.get(r["published"]["date-parts"], F.lit(0))), discovered_from=F.lit("wiley"),
    )


FEEDS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {"openalex": (WORKS_SCHEMA, map_works), "semantic_scholar": (PAPERS_SCHEMA, map_search), "wiley": (ITEMS_SCHEMA, map_items)}


def works_filter(topics: list[str], since: date | None) -> str:
    parts = ["is_oa:true"] + (["topics.id:" + "|".join(topics)] if topics else []) + ([f"from_publication_date:{since.isoformat()}"] if since else [])
    return ",".join(parts)


def items_filter(issns: list[str], since: date | None) -> str:
    if not issns:
        raise ValueError("a registry feed needs at least one ISSN")
    tidy = [x.strip().replace("-", "") for x in issns]
    parts = ["type:journal-article", "has-full-text:true", *[f"issn:{x[:4]}-{x[4:]}" if len(x) == 8 else f"issn:{x}" for x in tidy]]
    return ",".join(parts + ([f"from-pub-date:{since.isoformat()}"] if since else []))


def search_query(query: str) -> str:
    """A query on one line without wildcards."""
    return " ".join(query.replace("*", "").split())


def read_pages(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """The landing rows of a source's fetched pages, one JSON answer per file; records without a PDF address are kept."""
    schema, mapper = FEEDS[source]
    return mapper(spark.read.schema(schema).option("multiLine", True).json(folder))


def with_pdf(rows: DataFrame) -> DataFrame:
    return rows.filter(F.coalesce("oa_pdf_url", F.lit("")) != "")


def discover(spark: SparkSession, folders: dict[str, str], papers: DataFrame, marks: DataFrame, warn: Callable[[str], None] = print) -> tuple[DataFrame, DataFrame]:
    """(new rows, advanced marks) from the pages of several sources.

    An unknown source is reported and skipped. Rows before their source's mark don't count; the mark's own day comes
    again and is harmless. The marks advance by all results, those without a PDF included.
    """
    known = {s: f for s, f in folders.items() if s in FEEDS}
    for s in sorted(set(folders) - set(known)):
        warn(f"unknown source {s}")
    if not known:
        return papers.limit(0).select(*[c for c in LANDING if c in papers.columns]), marks.select("source", "watermark")
    rows = reduce(DataFrame.unionByName, [read_pages(spark, s, f) for s, f in sorted(known.items())])
    fresh = on_or_after(rows, "publication_date", marks, "discovered_from")
    order = F.struct(F.xxhash64(*LANDING[:6]).alias("h"), "doi", "title")
    new = insert_if_absent(papers, with_pdf(fresh).withColumn("__order", order), "__order").drop("__order")
    seen = rows.groupBy(F.col("discovered_from").alias("source")).agg(F.max("publication_date").alias("watermark"))
    return new, advance_marks(marks, seen)


class PageSource(ABC):
    """Fetches the pages of a feed since a date; implementations with network access live outside of this package."""

    @abstractmethod
    def fetch(self, since: date | None):
        """Yields the JSON text of one page after the other."""


def _works_next(body: dict) -> tuple[str, str] | None:
    mark = (body.get("meta") or {}).get("next_cursor")
    return ("cursor", mark) if mark else None


def _search_next(body: dict) -> tuple[str, str] | None:
    return ("token", body["token"]) if body.get("data") and body.get("token") else None


def _items_next(size: int) -> Callable[[dict], tuple[str, str] | None]:
    def follow(body: dict) -> tuple[str, str] | None:
        message = body.get("message") or {}
        full = len(message.get("items") or []) >= size
        return ("cursor", message["next-cursor"]) if full and message.get("next-cursor") else None

    return follow


class CursorPages(PageSource):
    """The pages of a feed, one after the other: ``get`` answers parameters with JSON text, ``follow`` names the parameter
    that leads to the next page, or None on the last one."""

    def __init__(self, get: Callable[[dict], str], params: Callable[[date | None], dict], follow: Callable[[dict], tuple[str, str] | None], delay: float = 0.0, sleep: Callable[[float], None] = time.sleep):
        self.get, self.params, self.follow, self.delay, self.sleep = get, params, follow, delay, sleep

    def fetch(self, since: date | None) -> Iterator[str]:
        params = self.params(since)
        while True:
            text = self.get(dict(params))
            yield text
            step = self.follow(json.loads(text))
            if step is None:
                return
            params[step[0]] = step[1]
            if self.delay:
                self.sleep(self.delay)


def works_pages(get: Callable[[dict], str], topics: list[str], size: int = 200, **kw) -> CursorPages:
    return CursorPages(get, lambda since: {"filter": works_filter(topics, since), "per-page": size, "cursor": "*"}, _works_next, **kw)


def search_pages(get: Callable[[dict], str], query: str | None, size: int = 1000, **kw) -> CursorPages:
    def params(since: date | None) -> dict:
        out = {"limit": size, "openAccessPdf": ""}
        return out | ({"publicationDateOrYear": f"{since.isoformat()}:"} if since else {}) | ({"query": search_query(query)} if query else {})

    return CursorPages(get, params, _search_next, **kw)


def items_pages(get: Callable[[dict], str], issns: list[str], size: int = 200, **kw) -> CursorPages:
    return CursorPages(get, lambda since: {"filter": items_filter(issns, since), "rows": size, "cursor": "*"}, _items_next(size), **kw)


def save_pages(pages: PageSource, since: date | None, put: Callable[[str, str], None]) -> int:
    """Hands every page to ``put`` under a name that a repeated fetch gives again, and returns their number. What was saved
    before a failure is kept: ``discover`` advances a source's mark by the pages that are there."""
    n = 0
    for n, text in enumerate(pages.fetch(since), 1):
        put(f"{since.isoformat() if since else 'all'}-{n:06d}.json", text)
    return n


def get_with_retry(get: Callable[[], tuple[int, dict, str]], attempts: int = 5, base: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The body of a request; on status 429 it waits as the answer says, else ever longer, and tries again."""
    for attempt in range(attempts):
        status, headers, body = get()
        if status != 429:
            if status >= 400:
                raise OSError(f"status {status}: {body[:500]}")
            return body
        said = headers.get("Retry-After")
        sleep(float(said) if said and said.isdigit() else max(60.0, base * 2**attempt))
    raise OSError(f"still refused after {attempts} attempts")


# --- files


def scan_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(paper_id, text) of a folder of ``<paper_id>.txt`` files."""
    rows = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"(\d+)\.txt$", 1).try_cast("bigint").alias("paper_id"), F.col("value").alias("text"))
    return rows.filter("paper_id is not null")


def with_files(claimed: DataFrame, files: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(claimed rows with their file's columns, keys of those without one): the latter go back to their queue."""
    joined = claimed.join(files.withColumn("__there", F.lit(True)), key, "left")
    return joined.filter("__there").drop("__there"), joined.filter("__there is null").select(key)


def scan_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """(paper_id, length) of a folder's ``<paper_id>.pdf`` files that look like one: 1024 bytes or more, and its mark."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    sound = (F.col("length") >= 1024) & (F.substring("content", 1, 5) == F.lit(b"%PDF-"))
    return rows.filter(sound).select(F.regexp_extract("path", r"(\d+)\.pdf$", 1).try_cast("bigint").alias("paper_id"), "length").filter("paper_id is not null")


def split_setting(value: str | None) -> list[str]:
    """A list given with commas or as JSON; empty for none."""
    if not value or not value.strip():
        return []
    if value.strip().startswith("["):
        return [str(x) for x in json.loads(value)]
    return [x.strip() for x in value.split(",") if x.strip()]
