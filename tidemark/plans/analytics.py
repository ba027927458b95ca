"""The fixed analytical queries over a star schema, as functions of tables and filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.snippets import page_text
from tidemark.functions.text import clipped, escaped_like
from tidemark.operators.numbering import numbered

PAGE_SIZE = 25


def matching(title: str | None = None, attribute: str | None = None, ecosystem_type: str | None = None, entity_id: int | None = None) -> Column:
    """The conjunction of the filters that are given; an empty text is none."""
    tests = [F.lit(True)]
    if attribute:
        tests.append(F.col("attribute") == attribute)
    if ecosystem_type:
        tests.append(F.col("ecosystem_type") == ecosystem_type)
    if entity_id is not None:
        tests.append(F.col("entity_id") == entity_id)
    if title:
        tests.append(F.col("title").ilike(f"%{escaped_like(title)}%"))
    return reduce(lambda a, b: a & b, tests)


def star(fact: DataFrame, entity: DataFrame, paper: DataFrame) -> DataFrame:
    """Facts with their entity and paper. Dimensions are broadcast by their size, not by a hint."""
    return fact.join(entity, "entity_id").join(paper, "paper_id")


def get_by_id(dimension: DataFrame, key: str, value: int, columns: list[str]) -> DataFrame:
    return dimension.filter(F.col(key) == value).select(F.col(key).alias("id"), *columns)


def list_papers(fact: DataFrame, entity: DataFrame, paper: DataFrame, page: int = 1, size: int = PAGE_SIZE, **filters) -> DataFrame:
    """One page of the papers with a matching fact, those with the latest extraction first."""
    found = star(fact, entity, paper).filter(matching(**filters))
    per_paper = found.groupBy("paper_id").agg(F.count("*").alias("extraction_count"), F.max("source_extraction_id").alias("latest"))
    rows = per_paper.orderBy(F.desc("latest")).offset((max(page, 1) - 1) * size).limit(size)
    shown = rows.join(paper, "paper_id").orderBy(F.desc("latest"))
    return shown.select(F.col("paper_id").alias("id"), "title", "authors", "publication_date", "doi", "extraction_count")


def count_papers(fact: DataFrame, entity: DataFrame, paper: DataFrame, size: int = PAGE_SIZE, **filters) -> DataFrame:
    """(total, total_pages) of ``list_papers``."""
    total = F.countDistinct("paper_id")
    pages = F.greatest(F.lit(1), F.ceil(total / F.lit(size)))
    return star(fact, entity, paper).filter(matching(**filters)).agg(total.alias("total"), pages.cast("bigint").alias("total_pages"))


def ecosystem_types(entity: DataFrame) -> DataFrame:
    return entity.filter("ecosystem_type is not null").select("ecosystem_type").distinct().orderBy("ecosystem_type")


def search_titles(paper: DataFrame, fact: DataFrame, query: str, limit: int, least: int = 2) -> DataFrame:
    """Papers with a fact whose title holds the query: prefixes first, then the shortest, then the smallest id.

    A query of fewer than ``least`` characters finds nothing.
    """
    text = query.strip()
    if len(text) < least:
        return paper.limit(0).select(F.col("paper_id").alias("id"), "title", "authors", "publication_date", "doi")
    like = escaped_like(text)
    found = paper.filter(F.col("title").ilike(f"%{like}%")).join(fact.select("paper_id"), "paper_id", "left_semi")
    order = (F.when(F.col("title").ilike(f"{like}%"), 0).otherwise(1), F.length("title"), F.col("paper_id"))
    return found.orderBy(*order).limit(limit).select(F.col("paper_id").alias("id"), "title", "authors", "publication_date", "doi")


def suggestions(found: DataFrame) -> DataFrame:
    """(json) of found titles as a search box takes them: id, title, authors, year."""
    return found.select(F.to_json(F.struct("id", "title", "authors", F.year("publication_date").alias("year"))).alias("json"))


def show_papers(papers: DataFrame, ids: list[int] | None = None, statuses: list[str] | None = None, accessible: bool | None = None, limit: int = 20) -> tuple[DataFrame, int]:
    """(rows, total) of the papers that pass the given filters, the last discovered first."""
    tests = [F.lit(True)]
    if ids:
        tests.append(F.col("id").isin(ids))
    if statuses:
        tests.append(F.col("status").isin(statuses))
    if accessible is not None:
        tests.append((F.coalesce("oa_pdf_url", F.lit("")) != "") == accessible)
    found = papers.filter(reduce(lambda x, y: x & y, tests))
    return found.orderBy(F.desc_nulls_first("discovered_at"), "id").limit(limit), found.count()


def map_entities(fact: DataFrame, entity: DataFrame, paper: DataFrame, **filters) -> DataFrame:
    """Entities with coordinates and the number of papers with a matching fact on them."""
    placed = entity.filter("latitude is not null and longitude is not null")
    found = star(fact, placed, paper).filter(matching(**filters))
    return found.groupBy("entity_id", F.col("name").alias("entity_name"), "latitude", "longitude").agg(F.countDistinct("paper_id").alias("paper_count"))


def pages_of_paper(fact: DataFrame, entity: DataFrame, paper_id: int, **filters) -> DataFrame:
    """(page_number, count) of a paper's matching facts; facts without a page last."""
    found = fact.filter(F.col("paper_id") == paper_id).join(entity, "entity_id").filter(matching(**filters))
    return found.groupBy("page_number").agg(F.count("*").alias("count")).orderBy(F.asc_nulls_last("page_number"))


def page_facts(fact: DataFrame, entity: DataFrame, event: DataFrame, paper: DataFrame, paper_id: int, page_number: int, title: str | None = None, **filters) -> DataFrame:
    """The matching facts of one page of one paper, in order of extraction."""
    rows = fact.filter((F.col("paper_id") == paper_id) & (F.col("page_number") == page_number)).join(entity, "entity_id").join(event, "event_id").filter(matching(**filters))
    if title:
        rows = rows.join(paper.filter(matching(title=title)).select("paper_id"), "paper_id", "left_semi")
    return rows.orderBy("source_extraction_id").select(*fact_columns())


def fact_columns() -> list[Column]:
    return [
        F.col("source_extraction_id").alias("id"), F.col("paper_id"), F.col("attribute"), F.col("quantity_raw").alias("value"), F.col("units_raw").alias("units"), F.col("confidence"),
        F.col("entity_id"), F.col("name").alias("entity_name"), F.col("identifiers"), F.col("location_description").alias("location"), F.col("ecosystem_type"),
        F.col("date_measured").alias("event_date"), F.col("sub_location"), F.col("additional_details"),
    ]


#: The columns of an export in their order, as (heading, source).
EXPORT_COLUMNS = (
    ("entity_id", "entity_id"), ("entity_name", "name"), ("entity_latitude", "latitude"), ("entity_longitude", "longitude"), ("identifiers", "identifiers"),
    ("location_description", "location_description"), ("attribute", "attribute"), ("value", "quantity_raw"), ("units", "units_raw"), ("ecosystem_type", "ecosystem_type"),
    ("date", "date_measured"), ("sub_location", "sub_location"), ("additional_details", "additional_details"), ("judgement", "judgement"), ("confidence", "confidence"),
    ("title", "title"), ("authors", "authors"), ("doi", "doi"), ("publication_date", "publication_date"),
)


def export_rows(fact: DataFrame, entity: DataFrame, event: DataFrame, paper: DataFrame, judgements: DataFrame, **filters) -> DataFrame:
    """All matching facts with every column of an export, the current judgement joined in; authors as one text."""
    live = judgements.select(F.col("id").alias("source_extraction_id"), "judgement")
    rows = star(fact, entity, paper).filter(matching(**filters)).join(event, "event_id").join(live, "source_extraction_id", "left")
    put = lambda name: F.concat_ws(", ", "authors") if name == "authors" else F.col(name)
    return rows.orderBy("source_extraction_id").select(*[F.when(F.col("authors").isNotNull(), put(n)).alias(h) if n == "authors" else put(n).alias(h) for h, n in EXPORT_COLUMNS])


def write_csv(rows: DataFrame, path: str) -> None:
    """One CSV file with a heading, nulls as empty fields; the rows are an export's, of one user's filter."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def judgements_of(extractions: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, judgement) of the given ids that exist."""
    return extractions.select("id", "judgement").join(ids.select("id").distinct(), "id", "left_semi")


def vote_judgements(votes: DataFrame) -> DataFrame:
    """(extraction_id, n_valid, n_invalid, judgement): the majority of all votes, null on a tie."""
    valid = F.sum(F.when(F.col("vote"), 1).otherwise(0))
    invalid = F.sum(F.when(~F.col("vote"), 1).otherwise(0))
    return votes.groupBy("extraction_id").agg(
        valid.alias("n_valid"), invalid.alias("n_invalid"), F.when(valid > invalid, "valid").when(invalid > valid, "invalid").alias("judgement")
    )


def status_counts(papers: DataFrame) -> DataFrame:
    return papers.groupBy("status").agg(F.count("*").alias("n"))


def recent(papers: DataFrame, limit: int) -> DataFrame:
    """The papers discovered last, with shortened title and abstract; unknown times first, smaller ids first on a tie."""
    rows = papers.orderBy(F.desc_nulls_first("discovered_at"), "id").limit(limit)
    return rows.select("id", "status", F.substring("title", 1, 72).alias("title"), clipped(F.col("abstract"), 120).alias("abstract"))


def papers_with_extractions(papers: DataFrame, extractions: DataFrame, ids: DataFrame) -> DataFrame:
    """(pos, id, title, extraction_id, attribute, value, units) in the order asked for, a paper's extractions by id; null
    title and no extraction for an unknown id. One row per extraction: a paper may have more than one row can hold."""
    rows = extractions.select(F.col("paper_id").alias("id"), F.col("id").alias("extraction_id"), "data.attribute", "data.value", "data.units")
    return ids.select("pos", "id").join(papers.select("id", "title"), "id", "left").join(rows, "id", "left").orderBy("pos", "extraction_id").select("pos", "id", "title", "extraction_id", "attribute", "value", "units")


def facts_by_id(fact: DataFrame, entity: DataFrame, event: DataFrame, paper: DataFrame, ids: DataFrame) -> DataFrame:
    """The facts of the given extraction ids with their paper's title and doi."""
    rows = star(fact, entity, paper).join(ids.select(F.col("id").alias("source_extraction_id")).distinct(), "source_extraction_id", "left_semi").join(event, "event_id")
    return rows.select(*fact_columns(), "title", "doi")


def funnel(papers: DataFrame, extractions: DataFrame, contexts: DataFrame) -> DataFrame:
    """(status, papers, extractions, transcribed): how far the papers of each status came."""
    counts = extractions.groupBy(F.col("paper_id").alias("id")).agg(F.count("*").alias("n"))
    texts = contexts.select(F.col("paper_id").alias("id")).distinct().withColumn("text", F.lit(1))
    rows = papers.select("id", "status").join(counts, "id", "left").join(texts, "id", "left")
    return rows.groupBy("status").agg(F.count("*").alias("papers"), F.coalesce(F.sum("n"), F.lit(0)).alias("extractions"), F.count("text").alias("transcribed"))


def backfill_candidates(papers: DataFrame) -> DataFrame:
    """Papers with a PDF address that lack authors or a publication date."""
    lacks = F.col("authors").isNull() | (F.size("authors") == 0) | F.col("publication_date").isNull()
    return papers.filter((F.coalesce("oa_pdf_url", F.lit("")) != "") & lacks)


def enriched(papers: DataFrame, found: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Papers with missing columns filled from a lookup by a key such as the doi; what is known stays. Of several answers
    to a key the smallest counts; null keys meet nothing."""
    answers = found.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*columns)).alias("__put"))
    joined = papers.join(answers, F.col(key) == F.col("__key"), "left")
    return joined.select(*[F.coalesce(c, F.col(f"__put.{c}")).alias(c) if c in columns else F.col(c) for c in papers.columns])


def unpaged(extractions: DataFrame) -> DataFrame:
    """Extractions whose page isn't known."""
    return extractions.filter("page_number is null")


def random_rows(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows drawn without bias and the same ones for a seed: those with the smallest hashes of their key."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def usage_totals(calls: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Number of calls and sums of usage columns per group; a missing figure counts as none."""
    return calls.groupBy(*by).agg(F.count("*").alias("calls"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def per_hour(rows: DataFrame, at: str) -> DataFrame:
    """(n, hours, per_hour) of rows between the first and the last moment; no rate for one moment."""
    hours = (F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))) / 3.6e9
    return rows.agg(F.count(at).alias("n"), hours.alias("hours"), F.when(hours > 0, F.count(at) / hours).alias("per_hour"))


def page_of_context(contexts: DataFrame, paper_id: int, page: int) -> DataFrame:
    return contexts.filter(F.col("paper_id") == paper_id).select("paper_id", page_text(F.col("context"), F.lit(page)).alias("text"))


def counts_with_share(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, percent) of a column, the most common first."""
    total = rows.count()
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counted.select("value", "n", F.round(F.col("n") * 100 / F.lit(max(total, 1)), 1).alias("percent")).orderBy(F.desc("n"), "value")


def timing_summary(rows: DataFrame, column: str) -> DataFrame:
    """(n, mean, median, min, p95, max); p95 is the value at place int(0.95 n) of the sorted values, counted from 0."""
    given = rows.filter(F.col(column).isNotNull()).select(column)
    n = given.count()
    place = min(int(n * 0.95), max(n - 1, 0)) + 1
    p95 = numbered(given, "place", column).filter(F.col("place") == place).first() if n else None
    return given.agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"), F.median(column).alias("median"), F.min(column).alias("min"),
        F.lit(None if p95 is None else float(p95[column])).cast("double").alias("p95"), F.max(column).alias("max"),
    )


def row_numbers(rows: DataFrame, offset: int, *order: str) -> DataFrame:
    """Display numbers of one page of rows."""
    return rows.withColumn("row_no", F.row_number().over(Window.orderBy(*order)) + offset)
