"""The text and record problems as queries over a folder of test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import consensus, copies, leaks, pieces, quality, scans, sites, tokens
from tidemark.sources.tables import table


def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.split_contexts(table(spark, folder, "paper_ocr_context"))


def p2_units(spark: SparkSession, folder: str) -> DataFrame:
    """What the pieces of each unit cover, whether they keep the limit, and how far they overlap."""
    cut = p2_pieces(spark, folder).withColumn("overlap", F.lag("end").over(Window.partitionBy("paper_id", "unit", "unit_no").orderBy("piece_no")) - F.col("start"))
    return cut.groupBy("paper_id", "unit", "unit_no").agg(
        F.max("page_number").alias("page_number"), (F.max("end") - F.min("start")).alias("covered"), (F.max(F.length("text")) <= pieces.LIMIT).alias("fits"), F.min("overlap").alias("least_overlap"), F.max("overlap").alias("most_overlap")
    ).drop("unit_no")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.oversized_pages(p2_pieces(spark, folder))


def p4_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return scans.repaired_text(table(spark, folder, "paper_ocr_context"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return scans.found_noise(table(spark, folder, "paper_ocr_context"))


def p5_records(spark: SparkSession, folder: str) -> DataFrame:
    return copies.collapse_copies(table(spark, folder, "extraction_results"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return copies.copies(table(spark, folder, "extraction_results"))


def p7_consensus(spark: SparkSession, folder: str) -> DataFrame:
    return consensus.item_consensus(table(spark, folder, "votes"))


def p7_counts(spark: SparkSession, folder: str) -> DataFrame:
    return p7_consensus(spark, folder).select("extraction_id", "n_votes", "n_yes", F.round("agreement", 9).alias("agreement"))


def p7_reliability(spark: SparkSession, folder: str) -> DataFrame:
    return consensus.voter_reliability(table(spark, folder, "votes"))


def p7_agreement(spark: SparkSession, folder: str) -> DataFrame:
    return consensus.krippendorff(table(spark, folder, "votes")).withColumn("alpha", F.round("alpha", 9))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return consensus.unreliable_voters(table(spark, folder, "votes"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_documents(table(spark, folder, "documents"))


def p8_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.round_trip(table(spark, folder, "documents"))


def p10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.text_quality(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_prose(p10_quality(spark, folder))


def p3_matches(spark: SparkSession, folder: str) -> DataFrame:
    return sites.match_sites(table(spark, folder, "entity_dim"), table(spark, folder, "site_registry"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return sites.same_sites(p3_matches(spark, folder))


def p9_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked_items(table(spark, folder, "documents"), table(spark, folder, "heldout_items"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_leaks(spark, folder).filter("kind = 'passage'").select("item_id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p2_pieces, p2_units, p2_found, p3_matches, p3_found, p4_paragraphs, p4_found, p9_leaks, p9_found, p5_records, p5_found, p7_consensus, p7_counts, p7_reliability, p7_agreement, p7_found, p8_ids, p8_round_trip, p10_quality, p10_found)
}
_OPEN = r"""(?i)<page\s+number\s*=\s*["']?\s*(\d+)\s*["']?\s*>""".replace("'", "''")
_FIELDS = ("name", "identifiers", "ecosystem_type", "location", "date", "sub_location", "additional_details", "attribute", "value", "units")


def _canonical_sql(field: str) -> str:
    low = f"replace(translate(lower(json_extract_string(data, '$.{field}')), 'µςſı', 'μσsi'), 'ß', 'ss')"
    if field in ("value", "date"):
        points = f"regexp_replace({low}, '\\.([^\\p{{N}}]|$)', '\\1', 'g')"
        return f"nullif(regexp_replace({points}, '[^\\p{{L}}\\p{{N}}\\p{{M}}\\p{{S}}\\p{{Pd}}.%‰]+', '', 'g'), '')"
    return f"nullif(regexp_replace(regexp_replace({low}, '[^\\p{{L}}\\p{{N}}\\p{{M}}\\p{{S}}%‰]+', '', 'g'), '[`^|~$]+', '', 'g'), '')"


_RECORDS = f"SELECT paper_id, result_id, {', '.join(f'{_canonical_sql(f)} AS {f}' for f in _FIELDS)} FROM (SELECT DISTINCT paper_id, result_id, data FROM extraction_results)"
_LAST_VOTES = """SELECT extraction_id AS item, vote FROM (SELECT *, row_number() OVER (PARTITION BY extraction_id, voter_hash ORDER BY created_at DESC, id DESC) AS r FROM votes WHERE voter_hash IS NOT NULL) WHERE r = 1
 UNION ALL SELECT extraction_id, vote FROM (SELECT DISTINCT id, extraction_id, vote FROM votes WHERE voter_hash IS NULL)"""

SQL: dict[str, str] = {
    "p2_found": f"""WITH p AS (SELECT paper_id, context, regexp_extract_all(context, '{_OPEN}', 1) AS n, string_split_regex(context, '{_OPEN}') AS x FROM paper_ocr_context),
u AS (SELECT paper_id, CAST(n[i] AS BIGINT) AS page_number, regexp_replace(x[i + 1], '(?is)</page\\s*>.*$', '') AS t FROM p, unnest(range(1, len(n) + 1)) AS r(i) UNION ALL SELECT paper_id, 0, context FROM p WHERE len(n) = 0)
SELECT DISTINCT paper_id, page_number FROM u WHERE length(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) > 2000""",
    "p2_units": f"""WITH p AS (SELECT paper_id, context, regexp_extract_all(context, '{_OPEN}', 1) AS n, string_split_regex(context, '{_OPEN}') AS x FROM paper_ocr_context),
u AS (SELECT paper_id, 'page' AS unit, CAST(n[i] AS BIGINT) AS page_number, regexp_replace(x[i + 1], '(?is)</page\\s*>.*$', '') AS t FROM p, unnest(range(1, len(n) + 1)) AS r(i) UNION ALL SELECT paper_id, 'page', 0, context FROM p WHERE len(n) = 0
 UNION ALL SELECT paper_id, 'context', NULL, context FROM p WHERE context IS NOT NULL), v AS (SELECT *, length(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) AS chars FROM u)
SELECT paper_id, unit, page_number, chars AS covered, true AS fits, CASE WHEN chars > 2000 THEN 200 END AS least_overlap, CASE WHEN chars > 2000 THEN 200 END AS most_overlap FROM v""",
    "p7_counts": f"""WITH i AS (SELECT item AS extraction_id, COUNT(*) AS n_votes, CAST(SUM(CASE WHEN vote THEN 1 ELSE 0 END) AS BIGINT) AS n_yes FROM ({_LAST_VOTES}) WHERE vote IS NOT NULL GROUP BY item)
SELECT extraction_id, n_votes, n_yes, CASE WHEN n_votes > 1 THEN round((n_yes * (n_yes - 1) + (n_votes - n_yes) * (n_votes - n_yes - 1)) / (n_votes * (n_votes - 1))::DOUBLE, 9) END AS agreement FROM i""",
    "p5_records": f"SELECT paper_id, MIN(result_id) AS first_id, COUNT(*) AS n_copies FROM ({_RECORDS}) GROUP BY paper_id, {', '.join(_FIELDS)}",
    "p5_found": f"SELECT first_id, copy_id FROM (SELECT MIN(result_id) OVER (PARTITION BY paper_id, {', '.join(_FIELDS)}) AS first_id, result_id AS copy_id FROM ({_RECORDS})) WHERE first_id <> copy_id",
    "p7_agreement": f"""WITH i AS (SELECT item, COUNT(*)::DOUBLE AS n, SUM(CASE WHEN vote THEN 1.0 ELSE 0.0 END)::DOUBLE AS y FROM ({_LAST_VOTES}) GROUP BY item HAVING COUNT(*) > 1)
SELECT COUNT(*) AS n_items, CAST(SUM(n) AS BIGINT) AS n_votes, round(1 - SUM(2 * y * (n - y) / (n - 1)) / (2 * SUM(y) * (SUM(n) - SUM(y)) / (SUM(n) - 1)), 9) AS alpha FROM i""",
}
