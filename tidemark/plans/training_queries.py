"""The general training-data problems as queries over a folder of test tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quantities import changed_by_conversion, convert_quantities, masked_accuracy
from tidemark.operators.wide import contradictions, pivot_wide
from tidemark.sources.tables import table

#: Few enough that the test catalogue of 27 attributes makes more than one block.
BLOCK = 9


def p1_wide(spark: SparkSession, folder: str) -> DataFrame:
    catalogue = table(spark, folder, "attribute_catalogue")
    wide = pivot_wide(table(spark, folder, "direct_items"), catalogue, BLOCK)
    return wide.select([F.col("entity_id").cast("bigint").alias("entity_id"), "name"] + [c for c in wide.columns if not c.endswith("__conflict") and c not in ("entity_id", "name")])


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    catalogue = table(spark, folder, "attribute_catalogue")
    return contradictions(pivot_wide(table(spark, folder, "direct_items"), catalogue, BLOCK), catalogue)


def p6_quantities(spark: SparkSession, folder: str) -> DataFrame:
    return convert_quantities(table(spark, folder, "extractions"), table(spark, folder, "attribute_catalogue"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return changed_by_conversion(p6_quantities(spark, folder))


def p6_masked(spark: SparkSession, folder: str) -> DataFrame:
    return masked_accuracy(table(spark, folder, "extractions"), table(spark, folder, "attribute_catalogue"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_wide, p1_found, p6_quantities, p6_found, p6_masked)}
NUMBERS = (
    "chlorophyll", "co2_flux", "denitrification", "dissolved_inorganic_carbon", "dissolved_organic_carbon", "dissolved_oxygen", "gross_primary_production", "light_attenuation",
    "net_primary_production", "nitrate", "nitrification", "nitrogen_fixation", "particulate_organic_carbon", "pco2", "phosphate", "salinity", "sediment_oxygen_demand", "silicate",
    "suspended_particulate_matter", "total_alkalinity", "total_nitrogen", "turbidity", "ammonium",
)

#: Every row of a catalogue attribute with its trimmed value and the number it states.
STATED_SQL = f"""
look AS (SELECT regexp_replace(lower(s), '[\\s_-]+', '', 'g') AS k, MIN(attribute) AS attribute FROM (SELECT attribute, unnest(list_prepend(attribute, coalesce(aliases, []))) AS s FROM attribute_catalogue) GROUP BY 1),
kind AS (SELECT attribute, MIN(value_kind) AS value_kind FROM attribute_catalogue GROUP BY 1),
raw AS (SELECT entity_id, item_id, recorded_at, regexp_replace(lower(attribute), '[\\s_-]+', '', 'g') AS k, regexp_replace(value, '^\\s+|\\s+$', '', 'g') AS t FROM direct_items WHERE entity_id IS NOT NULL),
val AS (SELECT entity_id, item_id, recorded_at, attribute, value_kind, CASE WHEN lower(t) NOT IN ('', '—', '-', '–', 'na', 'n/a', 'nd', 'n.d.', 'bdl', 'below detection', 'not reported', 'not stated', 'null', 'none') THEN t END AS v FROM raw JOIN look USING (k) JOIN kind USING (attribute)),
plain AS (SELECT *, translate(v, '⁰¹²³⁴⁵⁶⁷⁸⁹⁻−‑', '0123456789---') AS w FROM val),
first AS (SELECT *, regexp_extract(w, '[-+]?([0-9][0-9,]*([.][0-9]+)?|[.][0-9]+)') AS one FROM plain),
power AS (SELECT *, w[strpos(w, one) + length(one):] AS rest FROM first),
stated AS (SELECT * EXCLUDE (w, one, rest), CASE WHEN value_kind IN ('number', 'integer') AND one <> '' THEN TRY_CAST(replace(one, ',', '') || 'e' || coalesce(nullif(regexp_extract(rest, '^\\s*[eE]([-+]?[0-9]+)', 1), ''),
  nullif(regexp_extract(rest, '^\\s*[×x]\\s*10\\^?\\{{?([-+]?[0-9]+)', 1), ''), '0') AS DOUBLE) END AS x FROM power)"""
_LAST = """last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, attribute ORDER BY recorded_at DESC, item_id DESC) AS r FROM stated
  WHERE CASE WHEN value_kind IN ('number', 'integer') THEN x IS NOT NULL ELSE v IS NOT NULL END) WHERE r = 1)"""
_DATE = r"""CASE WHEN regexp_matches(v, '^\d{4}-\d{2}-\d{2}$') THEN TRY_CAST(v AS DATE)
 WHEN regexp_matches(v, '^\d{1,2}[-./]\d{1,2}[-./]\d{4}$') THEN TRY_CAST(regexp_extract(v, '(\d{4})$', 1) || '-' || lpad(regexp_extract(v, '^\d{1,2}[-./](\d{1,2})', 1), 2, '0') || '-' || lpad(regexp_extract(v, '^(\d{1,2})', 1), 2, '0') AS DATE)
 WHEN regexp_matches(v, '^\d{1,2}[-./]\d{4}$') THEN TRY_CAST(regexp_extract(v, '(\d{4})$', 1) || '-' || lpad(regexp_extract(v, '^(\d{1,2})', 1), 2, '0') || '-01' AS DATE)
 WHEN regexp_matches(v, '^\d{4}$') THEN TRY_CAST(v || '-01-01' AS DATE) END"""
_FLAG = "CASE WHEN lower(v) IN ('yes', 'y', 'true', 't', '1') THEN true WHEN lower(v) IN ('no', 'n', 'false', 'f', '0') THEN false END"
_COLUMNS = [(a, "x") for a in NUMBERS] + [("sampling_date", _DATE), ("station_count", "TRY_CAST(x AS BIGINT)"), ("tidally_influenced", _FLAG), ("substrate", r"regexp_replace(lower(v), '\s+', ' ', 'g')")]

SQL: dict[str, str] = {
    "p1_found": f"WITH {STATED_SQL} SELECT CAST(entity_id AS BIGINT) AS entity_id, attribute FROM stated WHERE value_kind = 'number' GROUP BY ALL HAVING MAX(x) > MIN(x)",
    "p1_wide": f"""WITH {STATED_SQL}, {_LAST},
said AS (SELECT entity_id, nullif(regexp_replace(regexp_replace(name, '\\s+', ' ', 'g'), '^ | $', '', 'g'), '') AS name FROM direct_items WHERE entity_id IS NOT NULL),
top AS (SELECT entity_id, name FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, name) AS r FROM (SELECT entity_id, name, COUNT(*) AS n FROM said WHERE name IS NOT NULL GROUP BY ALL)) WHERE r = 1)
SELECT CAST(i.entity_id AS BIGINT) AS entity_id, any_value(top.name) AS name, {", ".join(f"MAX(CASE WHEN attribute = '{a}' THEN {e} END) AS {a}" for a, e in _COLUMNS)}
FROM (SELECT DISTINCT entity_id FROM direct_items WHERE entity_id IS NOT NULL) i LEFT JOIN last USING (entity_id) LEFT JOIN top USING (entity_id) GROUP BY i.entity_id""",
}
