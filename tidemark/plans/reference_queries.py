"""The warehouse's operators and analytical queries over a folder of test tables, each with its SQL where it has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.functions.geo import haversine_km
from tidemark.functions.qualifier import FIELDS, qualifier
from tidemark.functions.snippets import find_pages, find_snippets, page_list
from tidemark.functions.units import canonical_factor, unit_form
from tidemark.operators.dedup import duplicate_flags, majority
from tidemark.operators.entities import point_clusters, resolve_entities
from tidemark.operators.numbering import first_seen_ids
from tidemark.operators.upsert import advance_marks, insert_if_absent, latest_per_key, on_or_after
from tidemark.plans import analytics as a
from tidemark.plans.warehouse import EVENT_KEY, QUALIFIER_KEY, Settings, accepted, build, judged, model_dimension, paper_dimension, with_id
from tidemark.session import checkpointed
from tidemark.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


# --- parsing and converting values; the SQL reads values and units from their description, with literals of its own

#: One value read from left to right: frame, first number, what follows it, the second number behind its sign.
QUALIFIED_SQL = """
WITH t AS (SELECT *, translate(replace(regexp_replace(data.value, '^\\s+|\\s+$', '', 'g'), ',', ''), '⁰¹²³⁴⁵⁶⁷⁸⁹⁻−‑', '0123456789---') AS s FROM extractions),
f AS (SELECT *, CASE WHEN s[1] IN ('<', '≤') THEN 'below' WHEN s[1] IN ('>', '≥') THEN 'above' WHEN s[1] = '(' THEN 'bracket' ELSE 'none' END AS mark FROM t),
i AS (SELECT *, ltrim(CASE mark WHEN 'none' THEN s WHEN 'bracket' THEN s[2:] ELSE CASE WHEN s[2] = '=' THEN s[3:] ELSE s[2:] END END) AS inner_text FROM f),
d AS (SELECT *, rtrim(inner_text, ')*% ') AS body FROM i),
n AS (SELECT *, ltrim(inner_text[length(body) + 1:]) AS tail, regexp_extract(body, '^-?[0-9]+([.][0-9]+)?') AS one FROM d),
r AS (SELECT *, ltrim(body[length(one) + 1:]) AS rest FROM n),
l AS (SELECT *, CASE WHEN one IS NULL OR one = '' THEN NULL WHEN rest = '' THEN 'alone' WHEN rest[1] IN ('-', '–', '—') THEN 'dash' WHEN lower(rest[:2]) = 'to' THEN 'word' WHEN rest[1] = '±' OR rest[:2] = '+-' OR rest[:3] = '+/-' THEN 'margin'
  WHEN lower(rest[1]) = 'e' THEN 'e' WHEN rest[1] IN ('×', 'x') AND ltrim(rest[2:])[:2] = '10' THEN 'ten' END AS link FROM r),
o AS (SELECT *, CASE link WHEN 'dash' THEN ltrim(rest[2:]) WHEN 'word' THEN ltrim(rest[3:]) WHEN 'margin' THEN ltrim(ltrim(rest, '±+/')[CASE WHEN rest[1] = '±' THEN 1 ELSE 2 END:]) WHEN 'e' THEN ltrim(rest[2:])
  WHEN 'ten' THEN ltrim(ltrim(rest[2:])[3:], '^') END AS two FROM l),
k AS (SELECT *, TRY_CAST(one AS DOUBLE) AS a, TRY_CAST(two AS DOUBLE) AS b, CASE
  WHEN mark IN ('below', 'above') THEN CASE WHEN link = 'alone' AND tail IN ('', '%') THEN CASE mark WHEN 'below' THEN 'less_than_or_equal' ELSE 'greater_than' END END
  WHEN link = 'dash' AND regexp_full_match(two, '-?[0-9]+([.][0-9]+)?') AND tail IN ('', ')', '%', ')%') THEN 'range'
  WHEN mark = 'bracket' THEN NULL
  WHEN link = 'word' AND regexp_full_match(two, '-?[0-9]+([.][0-9]+)?') AND tail = '' THEN 'range'
  WHEN link = 'margin' AND regexp_full_match(two, '-?[0-9]+([.][0-9]+)?') AND tail IN ('', '%') THEN 'plus_minus'
  WHEN link = 'e' AND regexp_full_match(two, '[+-]?[0-9]+') AND tail = '' THEN 'power'
  WHEN link = 'ten' AND regexp_full_match(two, '-?[0-9]+') AND tail = '' THEN 'power'
  WHEN link = 'alone' AND tail IN ('', '*', '%', '*%') THEN 'exact' END AS kind FROM o)
SELECT *, CASE kind WHEN 'power' THEN 'exact' ELSE kind END AS confidence_region, CASE kind WHEN 'exact' THEN a WHEN 'plus_minus' THEN a WHEN 'power' THEN a * pow(10.0, b) END AS quantity,
 CASE kind WHEN 'range' THEN least(a, b) END AS range_min, CASE kind WHEN 'range' THEN greatest(a, b) END AS range_max,
 CASE kind WHEN 'plus_minus' THEN a - b END AS confidence_min, CASE kind WHEN 'plus_minus' THEN a + b END AS confidence_max,
 CASE kind WHEN 'less_than_or_equal' THEN a END AS less_than_or_equal, CASE kind WHEN 'greater_than' THEN a END AS greater_than FROM k
"""


@query(f"SELECT id, {', '.join(FIELDS)} FROM ({QUALIFIED_SQL})")
def parse_qualifier(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "extractions").select("id", qualifier(F.col("data.value")).alias("q"))
    return rows.select("id", *[F.col(f"q.{f}").alias(f) for f in FIELDS])


def _sql_called(x: str) -> str:
    """A unit's name as its symbol."""
    return f"""CASE WHEN lower({x}) IN ('liter', 'liters', 'litre', 'litres') THEN 'L' WHEN lower({x}) = 'day' THEN 'd' WHEN lower({x}) = 'hr' THEN 'h' WHEN lower({x}) = 'yr' THEN 'y'
 WHEN {x} IN ('umol', 'ug', 'uL', 'uatom') THEN 'µ' || {x}[2:] WHEN {x} IN ('M', 'nM', 'pM', 'µM', 'mM', 'cM') THEN rtrim({x}, 'M') || 'mol/L' WHEN {x} = 'uM' THEN 'µmol/L' ELSE {x} END"""


#: Distinct (attribute, units) with their form and factor.
UNITS_SQL = f"""
WITH prefixes(prefix, scale) AS (VALUES ('p', 1e-12), ('n', 1e-9), ('µ', 1e-6), ('m', 1e-3), ('c', 1e-2), ('d', 1e-1), ('', 1.0), ('da', 1e1), ('h', 1e2), ('k', 1e3), ('M', 1e6), ('G', 1e9)),
num AS (SELECT prefix || base AS token, scale, base FROM prefixes, (VALUES ('mol'), ('g'), ('atm'), ('eq')) AS b(base)),
goal(attribute, canonical) AS (VALUES ('salinity', 'psu'), ('turbidity', 'NTU'), ('suspended_particulate_matter', 'mg/L'), ('light_attenuation', '/m'), ('dissolved_oxygen', 'mg/L'), ('sediment_oxygen_demand', 'mmol O2/m^2/d'),
 ('pco2', 'µatm'), ('dissolved_inorganic_carbon', 'µmol/kg'), ('total_alkalinity', 'µmol/kg'), ('co2_flux', 'mmol/m^2/d'), ('dissolved_organic_carbon', 'mg/L'), ('particulate_organic_carbon', 'mg/L'),
 ('net_primary_production', 'g C/m^2/d'), ('gross_primary_production', 'g C/m^2/d'), ('chlorophyll', 'µg/L'), ('nitrate', 'µmol/L'), ('ammonium', 'µmol/L'), ('total_nitrogen', 'µg/L'), ('denitrification', 'µmol N/m^2/h'),
 ('nitrification', 'µmol N/m^2/h'), ('nitrogen_fixation', 'µmol N/m^2/h'), ('phosphate', 'µmol/L'), ('silicate', 'µmol/L')),
raw AS (SELECT DISTINCT data.attribute AS attribute, data.units AS units FROM extractions),
clean AS (SELECT *, replace(replace(regexp_replace(regexp_replace(translate(translate(nullif(regexp_replace(units, '^\\s+|\\s+$', '', 'g'), ''), 'μ\u202f\u00a0', 'µ  '), '⁰¹²³⁴⁵⁶⁷⁸⁹⁻−‑₀₁₂₃₄₅₆₇₈₉₋', '0123456789---0123456789-'), '\\s+', ' ', 'g'), '^ | $', '', 'g'), '^{{', '^'), '}}', '') AS s FROM raw),
token AS (SELECT attribute, units, s, unnest(regexp_extract_all(s, '([A-Za-zµ]+)\\^?-([0-9]+)|[A-Za-zµ0-9_]+|[\\s\\S]', 0)) AS t, unnest(range(1, 1 + len(regexp_extract_all(s, '([A-Za-zµ]+)\\^?-([0-9]+)|[A-Za-zµ0-9_]+|[\\s\\S]', 0)))) AS place FROM clean WHERE s IS NOT NULL),
cut AS (SELECT *, regexp_extract(t, '^([A-Za-zµ]+)\\^?-([0-9]+)$', 1) AS name, regexp_extract(t, '^([A-Za-zµ]+)\\^?-([0-9]+)$', 2) AS power FROM token),
said AS (SELECT *, CASE WHEN name <> '' THEN '/' || {_sql_called("name")} || CASE WHEN power = '1' THEN '' ELSE '^' || power END ELSE {_sql_called("t")} END AS x FROM cut),
built AS (SELECT attribute, units, regexp_replace(string_agg(x, '' ORDER BY place), '(?i)\\bper meter\\b', '/m', 'g') AS y FROM said GROUP BY attribute, units),
u AS (SELECT raw.attribute, raw.units, array_to_string(list_transform(string_split(y, '/'), lambda z: regexp_replace(regexp_replace(z, '\\s+', ' ', 'g'), '^ | $', '', 'g')), '/') AS form
  FROM raw LEFT JOIN built ON built.attribute IS NOT DISTINCT FROM raw.attribute AND built.units IS NOT DISTINCT FROM raw.units),
p AS (SELECT u.*, canonical, split_part(form, '/', 1) AS top, split_part(canonical, '/', 1) AS goal_top,
  CASE WHEN contains(form, '/') THEN substr(form, strpos(form, '/') + 1) END AS below, CASE WHEN contains(canonical, '/') THEN substr(canonical, strpos(canonical, '/') + 1) END AS goal_below
  FROM u LEFT JOIN goal USING (attribute))
SELECT p.attribute, p.units, form, canonical AS units_canonical, CASE WHEN (p.attribute = 'salinity' AND form IN ('psu', 'PSU', 'ppt', 'g/kg', '‰')) OR form = canonical THEN 1.0::DOUBLE
  WHEN below = goal_below AND n.base = g.base THEN n.scale::DOUBLE / g.scale::DOUBLE END AS factor
FROM p LEFT JOIN num n ON n.token = top LEFT JOIN num g ON g.token = goal_top
"""


@query(f"SELECT attribute, units, form, round(factor, 9) AS factor FROM ({UNITS_SQL})")
def convert_units(spark: SparkSession, folder: str) -> DataFrame:
    pairs = table(spark, folder, "extractions").select("data.attribute", "data.units").distinct()
    return pairs.select("attribute", "units", unit_form(F.col("units")).alias("form"), F.round(canonical_factor(F.col("attribute"), F.col("units")), 9).alias("factor"))


_QUOTED = "CASE WHEN {0} IS NULL THEN 'None' WHEN contains({0}, '''') AND NOT contains({0}, '\"') THEN '\"' || {0} || '\"' ELSE '''' || {0} || '''' END"
JUDGED_SQL = f"""
WITH conv AS ({UNITS_SQL}), q AS ({QUALIFIED_SQL})
SELECT q.id AS extraction_id, q.paper_id, q.model_version, q.schema_name, q.data.attribute AS attribute, q.data.value AS quantity_raw, q.data.units AS units_raw, q.data.date AS date_measured,
 q.data.sub_location AS sub_location, q.data.additional_details AS additional_details, q.page_number, CAST(q.confidence AS DOUBLE) AS confidence, c.units_canonical, c.factor, q.confidence_region,
 q.quantity, q.range_min, q.range_max, q.confidence_min, q.confidence_max, q.less_than_or_equal, q.greater_than,
 CASE WHEN NOT EXISTS (SELECT 1 FROM papers p WHERE p.id = q.paper_id) THEN 'orphaned_paper'
  WHEN c.units_canonical IS NULL THEN 'unknown_attribute'
  WHEN q.confidence_region IS NULL THEN 'unparseable_value' WHEN c.factor IS NULL THEN 'unknown_unit' END AS reason
FROM q LEFT JOIN conv c ON c.attribute IS NOT DISTINCT FROM q.data.attribute AND c.units IS NOT DISTINCT FROM q.data.units
"""


@query(f"""
SELECT extraction_id, paper_id, reason, CASE reason WHEN 'orphaned_paper' THEN 'paper_id ' || paper_id || ' not found' WHEN 'unknown_attribute' THEN 'attribute=' || {_QUOTED.format("attribute")}
 WHEN 'unparseable_value' THEN 'value=' || {_QUOTED.format("quantity_raw")} ELSE 'attribute=' || {_QUOTED.format("attribute")} || ' units=' || {_QUOTED.format("units_raw")} END AS detail
FROM ({JUDGED_SQL}) WHERE reason IS NOT NULL
""")
def rejects(spark: SparkSession, folder: str) -> DataFrame:
    rows = judged(table(spark, folder, "extractions"), table(spark, folder, "papers"))
    return rows.filter("reason is not null").select("extraction_id", "paper_id", "reason", "detail")


@query(f"SELECT reason, COUNT(*) AS n FROM ({JUDGED_SQL}) WHERE reason IS NOT NULL GROUP BY reason")
def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rejects(spark, folder).groupBy("reason").agg(F.count("*").alias("n"))


_SCALED_SQL = ", ".join(f"round({c} * factor, 9) AS {'quantity_canonical' if c == 'quantity' else c}" for c in ("quantity", "range_min", "range_max", "confidence_min", "confidence_max", "less_than_or_equal", "greater_than"))


@query(f"SELECT extraction_id, attribute, units_canonical, confidence_region, {_SCALED_SQL} FROM ({JUDGED_SQL}) WHERE reason IS NULL")
def accepted_facts(spark: SparkSession, folder: str) -> DataFrame:
    rows = accepted(judged(table(spark, folder, "extractions"), table(spark, folder, "papers")))
    numbers = ["quantity_canonical", "range_min", "range_max", "confidence_min", "confidence_max", "less_than_or_equal", "greater_than"]
    return rows.select("extraction_id", "attribute", "units_canonical", "confidence_region", *[F.round(c, 9).alias(c) for c in numbers])


# --- dimensions


@query("SELECT row_number() OVER (ORDER BY schema_name, model_version) AS model_id, model_version AS model_name, CAST(NULL AS VARCHAR) AS prompt_version, CAST(NULL AS INTEGER) AS seed, CAST(NULL AS DOUBLE) AS temperature, 'extraction' AS role FROM (SELECT DISTINCT schema_name, model_version FROM extractions)")
def model_dim(spark: SparkSession, folder: str) -> DataFrame:
    return model_dimension(table(spark, folder, "extractions"), Settings())


@query("SELECT id AS paper_id, doi, title, CASE WHEN len(authors) > 0 THEN array_to_string(authors, '; ') END AS authors, publication_date, CAST(NULL AS VARCHAR) AS publisher, discovered_from, openalex_id, semantic_scholar_id FROM papers")
def paper_dim(spark: SparkSession, folder: str) -> DataFrame:
    return paper_dimension(table(spark, folder, "papers")).withColumn("authors", F.when(F.col("authors").isNotNull(), F.concat_ws("; ", "authors")))


@query(f"SELECT row_number() OVER (ORDER BY first) AS event_id, date_measured, sub_location, additional_details FROM (SELECT date_measured, sub_location, additional_details, MIN(extraction_id) AS first FROM ({JUDGED_SQL}) WHERE reason IS NULL GROUP BY ALL)")
def event_dim(spark: SparkSession, folder: str) -> DataFrame:
    rows = accepted(judged(table(spark, folder, "extractions"), table(spark, folder, "papers")))
    return first_seen_ids(rows, EVENT_KEY, "extraction_id", "event_id").select("event_id", *EVENT_KEY)


@query(f"""SELECT row_number() OVER (ORDER BY first, confidence_region) AS qualifier_id, confidence_region, round(confidence_min, 9) AS confidence_min, round(confidence_max, 9) AS confidence_max, round(range_min, 9) AS range_min,
 round(range_max, 9) AS range_max, round(less_than_or_equal, 9) AS less_than_or_equal, round(greater_than, 9) AS greater_than FROM (SELECT confidence_region, confidence_min * factor AS confidence_min, confidence_max * factor AS confidence_max,
 range_min * factor AS range_min, range_max * factor AS range_max, less_than_or_equal * factor AS less_than_or_equal, greater_than * factor AS greater_than, MIN(extraction_id) AS first FROM ({JUDGED_SQL}) WHERE reason IS NULL GROUP BY ALL)""")
def qualifier_dim(spark: SparkSession, folder: str) -> DataFrame:
    rows = accepted(judged(table(spark, folder, "extractions"), table(spark, folder, "papers")))
    ids = first_seen_ids(rows, QUALIFIER_KEY, "extraction_id", "qualifier_id")
    return ids.select("qualifier_id", "confidence_region", *[F.round(c, 9).alias(c) for c in QUALIFIER_KEY[1:]])


_RANKED = " UNION ALL ".join(f"SELECT paper_id, '{c}' AS f, data.{c} AS v, COUNT(*) AS n FROM extractions WHERE data.{c} <> '' GROUP BY ALL" for c in ("location", "identifiers", "ecosystem_type"))


@query(f"""WITH best AS (SELECT paper_id, f, v FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, f ORDER BY n DESC, v) AS r FROM ({_RANKED})) WHERE r = 1)
SELECT x.paper_id, MAX(CASE WHEN f = 'location' THEN v END) AS location, MAX(CASE WHEN f = 'identifiers' THEN v END) AS identifiers, MAX(CASE WHEN f = 'ecosystem_type' THEN v END) AS ecosystem_type
FROM (SELECT DISTINCT paper_id FROM extractions) x LEFT JOIN best USING (paper_id) GROUP BY x.paper_id""")
def majority_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "extractions")
    return rows.groupBy("paper_id").agg(*[majority(F.col(f"data.{c}")).alias(c) for c in ("location", "identifiers", "ecosystem_type")])


_RECORD = ("name", "identifiers", "ecosystem_type", "location", "date", "sub_location", "additional_details", "attribute", "value", "units")


@query(f"SELECT id, row_number() OVER (PARTITION BY paper_id, model_version, {', '.join(f'data.{c}' for c in _RECORD)}, page_number ORDER BY id DESC) = 1 AS kept FROM extractions")
def dedupe_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "extractions").select("id", "paper_id", "model_version", "page_number", *[F.col(f"data.{c}").alias(c) for c in _RECORD])
    return duplicate_flags(rows, ["paper_id", "model_version", *_RECORD, "page_number"], "id").select("id", "kept")


@query("SELECT paper_id, MAX(id) AS id FROM extractions GROUP BY paper_id")
def latest_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(table(spark, folder, "extractions").select("paper_id", "id"), "paper_id", "id")


# --- places

_HAVERSINE = "2 * {r} * asin(sqrt(least(1.0, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"


@query(f"SELECT entity_id, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN round({_HAVERSINE.format(r=6371.0088, a='52.0', b='4.5', c='latitude', d='longitude')}, 6) END AS km FROM entity_dim")
def distances(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entity_dim")
    return rows.select("entity_id", F.round(haversine_km(F.lit(52.0), F.lit(4.5), F.col("latitude"), F.col("longitude")), 6).alias("km"))


@query(f"""WITH RECURSIVE p AS (SELECT DISTINCT latitude AS lat, longitude AS lon FROM extractions WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
i AS (SELECT row_number() OVER (ORDER BY lat, lon) AS i, lat, lon FROM p),
e AS (SELECT x.i AS a, y.i AS b FROM i x JOIN i y ON y.lat BETWEEN x.lat - 0.01 AND x.lat + 0.01 AND {_HAVERSINE.format(r=6371.0088, a='x.lat', b='x.lon', c='y.lat', d='y.lon')} <= 1.0),
c(a, b) AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
m AS (SELECT a, MIN(b) AS g FROM c GROUP BY a)
SELECT i.lat, i.lon, f.lat AS first_lat, f.lon AS first_lon FROM m JOIN i ON i.i = m.a JOIN i f ON f.i = m.g""")
def geo_components(spark: SparkSession, folder: str) -> DataFrame:
    points = table(spark, folder, "extractions").filter("latitude is not null and longitude is not null").select(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).distinct()
    found = point_clusters(points)
    first = found.groupBy("component").agg(F.min(F.struct("lat", "lon")).alias("f"))
    return found.join(first, "component").select("lat", "lon", F.col("f.lat").alias("first_lat"), F.col("f.lon").alias("first_lon"))


@query()
def resolved_entities(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "extractions").select(F.col("id").alias("row_key"), F.col("data.name").alias("name"), "latitude", "longitude")
    return resolve_entities(rows)[0]


@query(f"SELECT COUNT(*) AS source_rows, COUNT(reason) AS rejected, COUNT(*) - COUNT(reason) AS facts_and_repeats, 0 AS violations FROM ({JUDGED_SQL})")
def warehouse_balance(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.plans.warehouse import REASONS, violations

    wh = build(table(spark, folder, "papers"), table(spark, folder, "extractions"))
    repeat = F.col("reason") == REASONS[-1]
    rows = wh.extractions_fact.select(F.lit(None).cast("string").alias("reason")).unionByName(wh.rejects.select("reason"))
    counted = rows.agg(F.count("*").alias("source_rows"), F.count(F.when(~repeat, 1)).alias("rejected"), F.count(F.when(repeat | F.col("reason").isNull(), 1)).alias("facts_and_repeats"))
    return counted.withColumn("violations", F.lit(violations(wh).count()))


@query()
def warehouse_fact(spark: SparkSession, folder: str) -> DataFrame:
    return build(table(spark, folder, "papers"), table(spark, folder, "extractions")).extractions_fact


# --- landing


@query("SELECT source, MAX(watermark) AS watermark FROM (SELECT source, watermark FROM crawl_state UNION ALL SELECT discovered_from, MAX(publication_date) FROM papers GROUP BY 1) GROUP BY source")
def watermark_advance(spark: SparkSession, folder: str) -> DataFrame:
    seen = table(spark, folder, "papers").groupBy(F.col("discovered_from").alias("source")).agg(F.max("publication_date").alias("watermark"))
    return advance_marks(table(spark, folder, "crawl_state"), seen)


@query("SELECT p.id FROM papers p LEFT JOIN crawl_state c ON c.source = p.discovered_from WHERE c.watermark IS NULL OR p.publication_date >= c.watermark - INTERVAL 4 YEAR")
def since_watermark(spark: SparkSession, folder: str) -> DataFrame:
    marks = table(spark, folder, "crawl_state").withColumn("watermark", F.add_months("watermark", -48))
    return on_or_after(table(spark, folder, "papers"), "publication_date", marks, "discovered_from").select("id")


@query()
def insert_new_papers(spark: SparkSession, folder: str) -> DataFrame:
    papers = table(spark, folder, "papers")
    return insert_if_absent(papers.filter("discovered_from = 'openalex'"), papers.filter("discovered_from <> 'openalex'"), "id").select("id", "doi", "openalex_id", "semantic_scholar_id")


@query(f"""WITH w AS (SELECT id, title, list_filter(flatten(list_transform(string_split(regexp_replace(title, '(<[^>]+>)', chr(1) || '\\1' || chr(1), 'g'), chr(1)),
  lambda s: CASE WHEN s LIKE '<_%>' THEN [s] ELSE string_split(regexp_replace(replace(s, '<', ''), '([A-Za-z0-9'']+)', chr(1) || '\\1' || chr(1), 'g'), chr(1)) END)), lambda s: s <> '') AS k FROM papers),
n AS (SELECT *, list_filter(list_transform(k, lambda x, i: CASE WHEN regexp_matches(x, '^[A-Za-z0-9]') THEN i END), lambda z: z IS NOT NULL) AS spots FROM w)
SELECT id, CASE WHEN title IS NULL OR len(spots) = 0 THEN title ELSE array_to_string(list_transform(k, lambda x, i: CASE WHEN NOT regexp_matches(x, '^[A-Za-z0-9]') THEN x
 WHEN lower(x) IN ('a', 'an', 'and', 'as', 'at', 'but', 'by', 'for', 'from', 'in', 'into', 'nor', 'of', 'on', 'onto', 'or', 'over', 'per', 'so', 'the', 'to', 'up', 'via', 'vs', 'with', 'yet')
  AND i <> spots[1] AND i <> spots[len(spots)] THEN lower(x) ELSE upper(substr(x, 1, 1)) || substr(x, 2) END), '') END AS title FROM n""")
def title_case(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "papers").select("id", t.title_case(F.col("title")).alias("title"))


@query(r"""SELECT id, nullif(regexp_replace(regexp_replace(regexp_replace(title, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g'), '') AS plain,
 CASE WHEN right(title, 3) IN ('CO2', 'NO2', 'NO3', 'SO2', 'SO4', 'PO4', 'NH3', 'NH4', 'H2S', 'N2O', 'CH4') OR title IS NULL THEN title
  WHEN regexp_matches(right(rtrim(title, '0123456789,'), 1), '[A-Za-z>]') AND len(list_filter(string_split(substr(title, length(rtrim(title, '0123456789,')) + 1), ','), lambda x: length(x) NOT BETWEEN 1 AND 2)) = 0
  THEN rtrim(title, '0123456789,') ELSE title END AS unmarked,
 regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, substr(sha256(title), 1, 12) AS hash FROM papers""")
def clean_titles(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col("title")
    return table(spark, folder, "papers").select("id", t.without_markup(c).alias("plain"), t.without_footnote_mark(c).alias("unmarked"), t.slug(c).alias("slug"), t.prompt_hash(c).alias("hash"))


@query("""SELECT id, nullif(regexp_replace(doi, '^https://doi\\.org/', ''), '') AS doi, CASE WHEN contains(doi, '/') THEN split_part(doi, '/', 1) ELSE 'unknown' END AS prefix,
 CASE WHEN len(list_filter(authors, lambda x: x IS NOT NULL AND x <> '')) > 0 THEN array_to_string(list_filter(authors, lambda x: x IS NOT NULL AND x <> ''), ', ') END AS authors, lower(coalesce(discovered_from, '')) = 'wiley' OR coalesce(contains(lower(oa_pdf_url), 'wiley'), false) AS is_wiley FROM papers""")
def clean_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    wiley = (F.lower(F.coalesce("discovered_from", F.lit(""))) == "wiley") | F.coalesce(F.contains(F.lower("oa_pdf_url"), F.lit("wiley")), F.lit(False))
    names = t.names_or_null(F.col("authors"))
    return table(spark, folder, "papers").select("id", t.plain_doi(F.col("doi")).alias("doi"), t.doi_prefix(F.col("doi")).alias("prefix"), F.when(names.isNotNull(), F.concat_ws(", ", names)).alias("authors"), wiley.alias("is_wiley"))


@query(r"SELECT entity_id, nullif(regexp_replace(regexp_replace(regexp_replace(lower(name), '[^\p{L}\p{M}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g'), '^ | $', '', 'g'), '') AS key FROM entity_dim")
def entity_keys(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "entity_dim").select("entity_id", t.entity_key(F.col("name")).alias("key"))


@query(r"SELECT id, nullif(abstract, '') AS abstract FROM papers")
def abstract_from_index(spark: SparkSession, folder: str) -> DataFrame:
    def places(words):
        every = F.sequence(F.lit(0), F.size(words) - 1)
        return F.map_from_entries(F.transform(F.array_distinct(words), lambda w: F.struct(w, F.filter(every, lambda i: F.get(words, i) == w))))

    index = t.let(F.split("abstract", " ", -1), places)
    return table(spark, folder, "papers").select("id", t.text_from_index(index).alias("abstract"))


@query("SELECT id, json_exists(provenance, '$.entity_id') AS has_entity, json_exists(provenance, '$.context') AS has_context FROM extractions")
def provenance_keys(spark: SparkSession, folder: str) -> DataFrame:
    p = F.col("provenance")
    return table(spark, folder, "extractions").select("id", t.has_key(p, "entity_id").alias("has_entity"), t.has_key(p, "context").alias("has_context"))


# --- pages


@query(r"""WITH p AS (SELECT paper_id, regexp_extract_all(context, '(?s)<page number="(\d+)">(.*?)</page>', 1) AS n, regexp_extract_all(context, '(?s)<page number="(\d+)">(.*?)</page>', 2) AS x FROM paper_ocr_context)
SELECT paper_id, CAST(pos AS INTEGER) AS pos, CAST(n[pos + 1] AS BIGINT) AS page, regexp_replace(x[pos + 1], '^\s+|\s+$', '', 'g') AS text FROM p, unnest(range(len(n))) AS r(pos)""")
def split_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "paper_ocr_context").select("paper_id", F.posexplode(page_list(F.col("context"))).alias("pos", "p")).select("paper_id", "pos", "p.page", "p.text")


#: Every extraction with its best place, with and without a context.
_PLACED_SQL = r"""d AS (SELECT paper_id, context, regexp_extract_all(context, '(?s)<page number="(\d+)">(.*?)</page>', 1) AS n, regexp_extract_all(context, '(?s)<page number="(\d+)">(.*?)</page>', 2) AS x FROM paper_ocr_context),
p AS (SELECT paper_id, pos, CAST(n[pos + 1] AS BIGINT) AS page, regexp_replace(x[pos + 1], '^\s+|\s+$', '', 'g') AS text FROM d, unnest(range(len(n))) AS r(pos)),
e AS (SELECT id, paper_id, data.value AS v, data.attribute AS a, data.units AS u, CASE WHEN regexp_matches(trim(replace(data.value, ',', '')), '^[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?$') THEN TRY_CAST(trim(replace(data.value, ',', '')) AS DOUBLE) END AS y FROM extractions),
m AS (SELECT *, list_transform(string_split_regex(replace(text, '-', ' -'), '[^0-9.,-]+'), lambda z: TRY_CAST(replace(rtrim(regexp_replace(z, '^(-?)[.,]+', '\1'), '.,'), ',', '') AS DOUBLE)) AS numbers FROM p),
f AS (SELECT id, v, y, pos, page, text, coalesce(v, '') <> '' AS given, CASE WHEN coalesce(v, '') <> '' AND contains(text, v) THEN string_split(text, v) END AS parts, coalesce(list_contains(numbers, y), false) AS eq,
 coalesce(a <> '' AND contains(lower(text), lower(a)), false) OR coalesce(u <> '' AND contains(lower(text), lower(u)), false) AS mentioned FROM e LEFT JOIN m USING (paper_id)),
h AS (SELECT *, coalesce(len(list_filter(range(1, len(parts)), lambda i: NOT regexp_matches(right(CASE WHEN parts[i] = '' AND i > 1 THEN v ELSE parts[i] END, 1), '[0-9.,-]')
  AND NOT regexp_matches(left(CASE WHEN parts[i + 1] = '' AND i + 1 < len(parts) THEN v ELSE parts[i + 1] END, 1), '[0-9.,]'))) > 0, false) AS lit FROM f),
g AS (SELECT *, CASE WHEN NOT given THEN 3 WHEN lit THEN 0 WHEN eq THEN 1 WHEN mentioned THEN 2 ELSE 3 END AS tier, CASE WHEN given AND mentioned THEN 0 ELSE 1 END AS o FROM h),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tier, o, pos) AS r FROM g) WHERE r = 1)"""


@query(f"WITH {_PLACED_SQL} SELECT id, page AS page_number, tier < 2 AS page_matched FROM best")
def find_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "extractions").select("id", "paper_id", "data.value", "data.attribute", "data.units")
    return find_pages(rows, table(spark, folder, "paper_ocr_context"), "id", "paper_id")


@query(f"""WITH {_PLACED_SQL} SELECT id, page AS page_number, tier < 2 AS page_matched, CASE WHEN pos IS NULL THEN substr(regexp_replace(context, '^\\s+|\\s+$', '', 'g'), 1, 2000) WHEN tier = 1 THEN NULL WHEN tier = 0 THEN NULL ELSE text END AS unmarked_text,
 CASE WHEN tier < 2 THEN length(text) END AS chars FROM best LEFT JOIN (SELECT id, context FROM extractions LEFT JOIN paper_ocr_context USING (paper_id)) c USING (id)""")
def snippets(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "extractions").select("id", "paper_id", "data.value", "data.attribute", "data.units")
    shown = find_snippets(rows, table(spark, folder, "paper_ocr_context"), "id", "paper_id")
    plain = F.replace(F.replace("text", F.lit("<mark>"), F.lit("")), F.lit("</mark>"), F.lit(""))
    return shown.select("id", "page_number", "page_matched", F.when(~F.col("page_matched"), F.col("text")).alias("unmarked_text"), F.when(F.col("page_matched"), F.length(plain)).cast("bigint").alias("chars"))


# --- votes and reports


@query("""SELECT extraction_id, CAST(SUM(CASE WHEN vote THEN 1 ELSE 0 END) AS BIGINT) AS n_valid, CAST(SUM(CASE WHEN NOT vote THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid,
 CASE WHEN SUM(CASE WHEN vote THEN 1 ELSE -1 END) > 0 THEN 'valid' WHEN SUM(CASE WHEN vote THEN 1 ELSE -1 END) < 0 THEN 'invalid' END AS judgement FROM votes GROUP BY extraction_id""")
def vote_judgements(spark: SparkSession, folder: str) -> DataFrame:
    return a.vote_judgements(table(spark, folder, "votes"))


@query("SELECT v.extraction_id AS id, e.judgement FROM (SELECT DISTINCT extraction_id FROM votes) v JOIN extractions e ON e.id = v.extraction_id")
def judgements_of_voted(spark: SparkSession, folder: str) -> DataFrame:
    return a.judgements_of(table(spark, folder, "extractions"), table(spark, folder, "votes").select(F.col("extraction_id").alias("id")))


@query("SELECT x.id AS pos, x.id, x.title, e.id AS extraction_id, e.data.attribute AS attribute, e.data.value AS value, e.data.units AS units FROM papers x LEFT JOIN extractions e ON e.paper_id = x.id")
def papers_with_extractions(spark: SparkSession, folder: str) -> DataFrame:
    papers = table(spark, folder, "papers")
    return a.papers_with_extractions(papers, table(spark, folder, "extractions"), papers.select("id", F.col("id").alias("pos")))


@query("SELECT status, COUNT(*) AS n FROM papers GROUP BY status")
def count_by_status(spark: SparkSession, folder: str) -> DataFrame:
    return a.status_counts(table(spark, folder, "papers"))


@query("""SELECT id, status, substr(title, 1, 72) AS title, CASE WHEN length(abstract) > 120 THEN substr(replace(abstract, chr(10), ' '), 1, 120) || '…' ELSE replace(abstract, chr(10), ' ') END AS abstract
FROM papers ORDER BY discovered_at DESC NULLS FIRST, id LIMIT 20""")
def recent_papers(spark: SparkSession, folder: str) -> DataFrame:
    return a.recent(table(spark, folder, "papers"), 20)


@query("SELECT discovered_from AS value, COUNT(*) AS n, round(COUNT(*) * 100 / (SELECT COUNT(*) FROM papers)::DOUBLE, 1) AS percent FROM papers GROUP BY 1")
def source_shares(spark: SparkSession, folder: str) -> DataFrame:
    return a.counts_with_share(table(spark, folder, "papers"), "discovered_from")


@query("""SELECT CASE WHEN contains(doi, '/') THEN split_part(doi, '/', 1) ELSE 'unknown' END AS prefix, CAST(COUNT(*) FILTER (WHERE discovered_from = 'openalex') AS BIGINT) AS openalex,
 CAST(COUNT(*) FILTER (WHERE discovered_from = 'semantic_scholar') AS BIGINT) AS semantic_scholar, CAST(COUNT(*) FILTER (WHERE discovered_from = 'wiley') AS BIGINT) AS wiley FROM papers GROUP BY 1""")
def prefix_pivot(spark: SparkSession, folder: str) -> DataFrame:
    sources = ["openalex", "semantic_scholar", "wiley"]
    rows = table(spark, folder, "papers").groupBy(t.doi_prefix(F.col("doi")).alias("prefix")).pivot("discovered_from", sources).agg(F.count(F.lit(1)))
    return rows.fillna(0, sources)


@query("SELECT COUNT(value) AS n, round(AVG(value), 6) AS mean, round(median(value), 6) AS median, round(MIN(value), 6) AS min, round(list_sort(list(value))[CAST(floor(COUNT(value) * 0.95) AS BIGINT) + 1], 6) AS p95, round(MAX(value), 6) AS max FROM events")
def timing_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = a.timing_summary(table(spark, folder, "events"), "value")
    return rows.select("n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "min", "p95", "max")])


# --- the analytical queries: accepted extractions as facts with the entity that their provenance names

STAR_SQL = f"""good AS (SELECT j.*, CAST(substr(json_extract_string(x.provenance, '$.entity_id'), 2) AS INTEGER) AS entity_id FROM ({JUDGED_SQL}) j JOIN (SELECT id, provenance FROM extractions) x ON x.id = j.extraction_id WHERE reason IS NULL),
event AS (SELECT row_number() OVER (ORDER BY first) AS event_id, date_measured, sub_location, additional_details FROM (SELECT date_measured, sub_location, additional_details, MIN(extraction_id) AS first FROM good GROUP BY ALL)),
fact AS (SELECT extraction_id AS source_extraction_id, paper_id, entity_id, v.event_id, attribute, quantity_raw, units_raw, page_number, confidence FROM good g JOIN event v ON v.date_measured IS NOT DISTINCT FROM g.date_measured
  AND v.sub_location IS NOT DISTINCT FROM g.sub_location AND v.additional_details IS NOT DISTINCT FROM g.additional_details),
paper AS (SELECT id AS paper_id, doi, title, CASE WHEN len(authors) > 0 THEN array_to_string(authors, ', ') END AS authors, publication_date FROM papers), entity AS (SELECT * FROM entity_dim)"""
_STARS: dict[tuple[str, str], tuple[DataFrame, DataFrame, DataFrame, DataFrame]] = {}


def star_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(fact, entity, paper, event): written to the checkpoint folder once a session, as a snapshot that is queried often."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STARS:
        extractions, papers = table(spark, folder, "extractions"), table(spark, folder, "papers")
        named = F.substring(F.get_json_object("provenance", "$.entity_id"), 2, 20).try_cast("int")
        good = checkpointed(accepted(judged(extractions, papers)).join(extractions.select(F.col("id").alias("extraction_id"), named.alias("entity_id")), "extraction_id"))
        events = checkpointed(first_seen_ids(good, EVENT_KEY, "extraction_id", "event_id", "n"))
        facts = with_id(good, events, EVENT_KEY, "n").select(F.col("extraction_id").alias("source_extraction_id"), "paper_id", "entity_id", "event_id", "attribute", "quantity_raw", "units_raw", "page_number", "confidence")
        entity = table(spark, folder, "entity_dim").select("entity_id", "latitude", "longitude", "name", "location_description", "identifiers", "ecosystem_type")
        _STARS[key] = (checkpointed(facts), checkpointed(entity), checkpointed(paper_dimension(papers)), events.select("event_id", *EVENT_KEY))
    return _STARS[key]


def _listed(rows: DataFrame) -> DataFrame:
    """Authors as one text: what is compared has no arrays."""
    return rows.withColumn("authors", F.when(F.col("authors").isNotNull(), F.concat_ws(", ", "authors")))


_LISTED = "SELECT p.paper_id AS id, any_value(title) AS title, any_value(authors) AS authors, any_value(p.publication_date) AS publication_date, any_value(doi) AS doi, COUNT(*) AS extraction_count FROM fact f JOIN entity e USING (entity_id) JOIN paper p USING (paper_id)"


@query(f"WITH {STAR_SQL} {_LISTED} WHERE attribute = 'salinity' AND ecosystem_type = 'estuary' AND title ILIKE '%a%' GROUP BY p.paper_id ORDER BY MAX(source_extraction_id) DESC LIMIT 25 OFFSET 0")
def list_papers(spark: SparkSession, folder: str) -> DataFrame:
    fact, entity, paper, _ = star_tables(spark, folder)
    return _listed(a.list_papers(fact, entity, paper, title="a", attribute="salinity", ecosystem_type="estuary"))


@query(f"WITH {STAR_SQL} {_LISTED} GROUP BY p.paper_id ORDER BY MAX(source_extraction_id) DESC LIMIT 25 OFFSET 25")
def list_papers_page_2(spark: SparkSession, folder: str) -> DataFrame:
    fact, entity, paper, _ = star_tables(spark, folder)
    return _listed(a.list_papers(fact, entity, paper, page=2))


@query(f"WITH {STAR_SQL} SELECT COUNT(DISTINCT f.paper_id) AS total, CAST(greatest(1, ceil(COUNT(DISTINCT f.paper_id) / 25.0)) AS BIGINT) AS total_pages FROM fact f JOIN entity e USING (entity_id) JOIN paper p USING (paper_id) WHERE attribute = 'salinity'")
def list_papers_total(spark: SparkSession, folder: str) -> DataFrame:
    fact, entity, paper, _ = star_tables(spark, folder)
    return a.count_papers(fact, entity, paper, attribute="salinity")


@query("SELECT DISTINCT ecosystem_type FROM entity_dim WHERE ecosystem_type IS NOT NULL")
def facet_ecosystem_types(spark: SparkSession, folder: str) -> DataFrame:
    return a.ecosystem_types(star_tables(spark, folder)[1])


@query(f"""WITH {STAR_SQL} SELECT p.paper_id AS id, title, authors, doi, publication_date FROM paper p WHERE title ILIKE '%s%' AND EXISTS (SELECT 1 FROM fact f WHERE f.paper_id = p.paper_id)
ORDER BY CASE WHEN title ILIKE 's%' THEN 0 ELSE 1 END, length(title), p.paper_id LIMIT 50""")
def search_titles(spark: SparkSession, folder: str) -> DataFrame:
    fact, _, paper, _ = star_tables(spark, folder)
    return _listed(a.search_titles(paper, fact, "s", 50, least=1))


@query(f"""WITH {STAR_SQL} SELECT e.entity_id, e.name AS entity_name, latitude, longitude, COUNT(DISTINCT f.paper_id) AS paper_count FROM fact f JOIN entity e USING (entity_id) JOIN paper p USING (paper_id)
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND attribute = 'salinity' GROUP BY ALL""")
def map_entities(spark: SparkSession, folder: str) -> DataFrame:
    fact, entity, paper, _ = star_tables(spark, folder)
    return a.map_entities(fact, entity, paper, attribute="salinity")


@query(f"WITH {STAR_SQL} SELECT page_number, COUNT(*) AS count FROM fact JOIN entity USING (entity_id) WHERE paper_id = 1000 GROUP BY page_number")
def pages_for_paper(spark: SparkSession, folder: str) -> DataFrame:
    fact, entity, _, _ = star_tables(spark, folder)
    return a.pages_of_paper(fact, entity, 1000)


_FACT_SQL = """source_extraction_id AS id, f.paper_id, attribute, quantity_raw AS value, units_raw AS units, confidence, e.entity_id, e.name AS entity_name, identifiers, location_description AS location, ecosystem_type,
 date_measured AS event_date, sub_location, additional_details"""


@query(f"""WITH {STAR_SQL} SELECT {_FACT_SQL} FROM fact f JOIN entity e USING (entity_id) JOIN paper p USING (paper_id) JOIN event v USING (event_id) WHERE f.paper_id = 1000 AND page_number = 1 AND title ILIKE '%a%'""")
def page_extractions(spark: SparkSession, folder: str) -> DataFrame:
    fact, entity, paper, event = star_tables(spark, folder)
    return a.page_facts(fact, entity, event, paper, 1000, 1, title="a")


@query(f"""WITH {STAR_SQL} SELECT e.entity_id, e.name AS entity_name, latitude AS entity_latitude, longitude AS entity_longitude, identifiers, location_description, attribute, quantity_raw AS value, units_raw AS units, ecosystem_type, date_measured AS date, sub_location,
 additional_details, x.judgement, confidence, title, authors, doi, publication_date FROM fact f JOIN entity e USING (entity_id) JOIN paper p USING (paper_id) JOIN event v USING (event_id) LEFT JOIN (SELECT id, judgement FROM extractions) x ON x.id = source_extraction_id
WHERE ecosystem_type = 'estuary'""")
def export_rows(spark: SparkSession, folder: str) -> DataFrame:
    fact, entity, paper, event = star_tables(spark, folder)
    return a.export_rows(fact, entity, event, paper, table(spark, folder, "extractions").select("id", "judgement"), ecosystem_type="estuary")


@query(f"WITH {STAR_SQL} SELECT {_FACT_SQL}, title, doi FROM fact f JOIN entity e USING (entity_id) JOIN paper p USING (paper_id) JOIN event v USING (event_id) WHERE source_extraction_id IN (SELECT extraction_id FROM votes)")
def facts_by_id(spark: SparkSession, folder: str) -> DataFrame:
    fact, entity, paper, event = star_tables(spark, folder)
    return a.facts_by_id(fact, entity, event, paper, table(spark, folder, "votes").select(F.col("extraction_id").alias("id")))


@query("SELECT id, title, doi, CASE WHEN len(authors) > 0 THEN array_to_string(authors, ', ') END AS authors FROM papers WHERE id = 1000")
def paper_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return _listed(a.get_by_id(star_tables(spark, folder)[2], "paper_id", 1000, ["title", "doi", "authors"]))


@query("SELECT entity_id AS id, name, latitude, longitude FROM entity_dim WHERE entity_id = 7")
def entity_by_id(spark: SparkSession, folder: str) -> DataFrame:
    return a.get_by_id(star_tables(spark, folder)[1], "entity_id", 7, ["name", "latitude", "longitude"])


@query("""SELECT p.status, COUNT(DISTINCT p.id) AS papers, COUNT(e.id) AS extractions, COUNT(DISTINCT CASE WHEN c.paper_id IS NOT NULL THEN p.id END) AS transcribed FROM papers p LEFT JOIN extractions e ON e.paper_id = p.id LEFT JOIN paper_ocr_context c ON c.paper_id = p.id GROUP BY p.status""")
def funnel(spark: SparkSession, folder: str) -> DataFrame:
    return a.funnel(table(spark, folder, "papers"), table(spark, folder, "extractions"), table(spark, folder, "paper_ocr_context"))


@query("""SELECT p.id, p.title FROM papers p WHERE oa_pdf_url IS NOT NULL AND oa_pdf_url <> '' AND (authors IS NULL OR len(authors) = 0 OR publication_date IS NULL)""")
def backfill_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return a.backfill_candidates(table(spark, folder, "papers")).select("id", "title")


@query("SELECT id, paper_id FROM extractions WHERE page_number IS NULL")
def unpaged_extractions(spark: SparkSession, folder: str) -> DataFrame:
    return a.unpaged(table(spark, folder, "extractions")).select("id", "paper_id")


@query("SELECT sha256(coalesce(source, 'unknown') || '|' || coalesce(section, ''))[1:16] AS voter, COUNT(*) AS n FROM documents GROUP BY 1")
def voter_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").groupBy(t.voter_hash(F.col("source"), F.col("section")).alias("voter")).agg(F.count("*").alias("n"))


@query("SELECT id, substr(error, 1, 20) AS error, CASE WHEN length(doi) = 8 THEN doi[1:4] || '-' || doi[5:] ELSE doi END AS issn, replace(oa_pdf_url, '/tdm/v2/', '/tdm/v1/') AS url FROM papers")
def clean_links(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "papers").select("id", t.short_error(F.col("error"), 20).alias("error"), t.issn(F.col("doi")).alias("issn"), t.pdf_url(F.col("oa_pdf_url")).alias("url"))
