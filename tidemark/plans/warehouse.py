"""The star schema over extracted measurements: built as plans, written as a snapshot, opened through a pointer."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalogue import CANONICAL_UNITS
from tidemark.functions.qualifier import FIELDS, qualifier, scaled
from tidemark.functions.units import canonical_factor, canonical_unit
from tidemark.operators.dedup import FACT_KEY, duplicate_flags, majority
from tidemark.operators.entities import resolve_entities
from tidemark.operators.numbering import first_seen_ids, numbered
from tidemark.operators.skew import attach_group
from tidemark.session import checkpointed

EVENT_KEY = ["date_measured", "sub_location", "additional_details"]
QUALIFIER_KEY = ["confidence_region", "confidence_min", "confidence_max", "range_min", "range_max", "less_than_or_equal", "greater_than"]
#: The reasons of a reject report.
REASONS = ("orphaned_paper", "unknown_attribute", "unparseable_value", "unknown_unit", "duplicate_fact_row")
#: So many pairs of attribute and unit may be sent to all executors.
FEW_UNITS = 50_000


@dataclass
class Settings:
    """What a build records about the model that is current, and the thresholds of entity resolution."""

    current_model: str | None = None
    prompt_version: str | None = None
    seed: int | None = None
    temperature: float | None = None
    distance_km: float = 1.0
    name_similarity: float = 0.85


@dataclass
class Warehouse:
    extractions_fact: DataFrame
    paper_dim: DataFrame
    model_dim: DataFrame
    entity_dim: DataFrame
    event_dim: DataFrame
    qualifier_dim: DataFrame
    rejects: DataFrame


#: Characters that a report prints as escapes: controls, formats, separators other than a blank, private and unassigned.
_HIDDEN = r"[\p{Cc}\p{Cf}\p{Zl}\p{Zp}\p{Co}\p{Cn}\p{Cs}]|(?! )\p{Zs}"


def quoted(text: Column) -> Column:
    """A text between quotes as reject reports show it, hidden characters escaped; None for null."""
    quote = F.when(F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"')), '"').otherwise("'")
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for sign, put in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(sign), F.lit(put))
    code = lambda ch, width: F.lower(F.lpad(F.hex(F.ascii(ch)), width, "0"))
    shown = lambda ch: F.when(~ch.rlike(_HIDDEN), ch).when(F.ascii(ch) < 256, F.concat(F.lit("\\x"), code(ch, 2))).when(F.ascii(ch) < 65536, F.concat(F.lit("\\u"), code(ch, 4))).otherwise(F.concat(F.lit("\\U"), code(ch, 8)))
    body = F.when(body.rlike(_HIDDEN), F.array_join(F.transform(F.split(body, ""), shown), "")).otherwise(body)
    escaped = F.when(F.contains(text, F.lit("'")) & F.contains(text, F.lit('"')), F.replace(body, F.lit("'"), F.lit("\\'"))).otherwise(body)
    return F.when(text.isNull(), "None").otherwise(F.concat(quote, escaped, quote))


def judged(extractions: DataFrame, papers: DataFrame) -> DataFrame:
    """Every extraction with its parsed quantity, unit factor, and the first reason against it, if any."""
    known = papers.select(F.col("id").alias("paper_id")).distinct().withColumn("__known", F.lit(True))
    d = F.col("data")
    pairs = checkpointed(extractions.select(d["attribute"].alias("of_attribute"), d["units"].alias("of_units")).distinct())
    if pairs.limit(FEW_UNITS + 1).count() <= FEW_UNITS:  # then each is read once; a null in either has no factor
        factors = F.broadcast(pairs.withColumn("of_factor", canonical_factor(F.col("of_attribute"), F.col("of_units"))).filter("of_factor is not null"))
        extractions, factor = extractions.join(factors, (d["attribute"] == F.col("of_attribute")) & (d["units"] == F.col("of_units")), "left"), F.col("of_factor")
    else:
        factor = canonical_factor(d["attribute"], d["units"])
    rows = extractions.join(known, "paper_id", "left").select(
        F.col("id").alias("extraction_id"), "paper_id", "schema_name", "model_version", F.coalesce("__known", F.lit(False)).alias("known"),
        d["attribute"].alias("attribute"), d["value"].alias("quantity_raw"), d["units"].alias("units_raw"),
        d["date"].alias("date_measured"), d["sub_location"].alias("sub_location"), d["additional_details"].alias("additional_details"),
        "page_number", F.col("confidence").cast("double").alias("confidence"),
        qualifier(d["value"]).alias("q"), factor.alias("factor"), canonical_unit(d["attribute"]).alias("units_canonical"),
    )
    attribute_known = F.coalesce(F.col("attribute").isin(*CANONICAL_UNITS), F.lit(False))
    reason = F.when(~F.col("known"), REASONS[0]).when(~attribute_known, REASONS[1]).when(F.col("q").isNull(), REASONS[2]).when(F.col("factor").isNull(), REASONS[3])
    detail = (
        F.when(F.col("reason") == REASONS[0], F.concat(F.lit("paper_id "), F.coalesce(F.col("paper_id").cast("string"), F.lit("None")), F.lit(" not found")))
        .when(F.col("reason") == REASONS[1], F.concat(F.lit("attribute="), quoted(F.col("attribute"))))
        .when(F.col("reason") == REASONS[2], F.concat(F.lit("value="), quoted(F.col("quantity_raw"))))
        .when(F.col("reason") == REASONS[3], F.concat(F.lit("attribute="), quoted(F.col("attribute")), F.lit(" units="), quoted(F.col("units_raw"))))
    )
    return rows.withColumn("reason", reason).withColumn("detail", detail)


def accepted(rows: DataFrame) -> DataFrame:
    """The judged rows without a reason against them, quantities and bounds in canonical units."""
    scaled_q = scaled(F.col("q"), F.col("factor"))
    return rows.filter("reason is null").withColumn("s", scaled_q).select("*", *[F.col(f"s.{f}").alias("quantity_canonical" if f == "quantity" else f) for f in FIELDS]).drop("q", "s")


def paper_dimension(papers: DataFrame) -> DataFrame:
    authors = F.when(F.size("authors") > 0, F.col("authors"))
    return papers.select(F.col("id").alias("paper_id"), "doi", "title", authors.alias("authors"), "publication_date", F.lit(None).cast("string").alias("publisher"), "discovered_from", "openalex_id", "semantic_scholar_id")


def model_dimension(extractions: DataFrame, settings: Settings) -> DataFrame:
    models = numbered(extractions.select("schema_name", "model_version").distinct(), "model_id", "schema_name", "model_version")
    current = F.col("model_version") == F.lit(settings.current_model)
    only = lambda value, kind: F.when(current, F.lit(value)).cast(kind)
    return models.select("model_id", F.col("model_version").alias("model_name"), only(settings.prompt_version, "string").alias("prompt_version"), only(settings.seed, "int").alias("seed"), only(settings.temperature, "double").alias("temperature"), F.lit("extraction").alias("role"))


def entity_dimension(extractions: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Entities over all extractions, rejected ones included, and which extraction belongs to which."""
    rows = extractions.select(F.col("id").alias("row_key"), F.col("data.name").alias("name"), "latitude", "longitude")
    entities, assigned = resolve_entities(rows, settings.distance_km, settings.name_similarity)
    said = extractions.select(F.col("id").alias("row_key"), "data.location", "data.identifiers", "data.ecosystem_type").join(assigned, "row_key")
    most = said.groupBy("entity_id").agg(majority(F.col("location")).alias("location_description"), majority(F.col("identifiers")).alias("identifiers"), majority(F.col("ecosystem_type")).alias("ecosystem_type"))
    dimension = entities.join(most, "entity_id", "left").select("entity_id", "latitude", "longitude", "name", "location_description", "identifiers", "ecosystem_type", "resolution_method")
    return dimension, assigned


def with_id(rows: DataFrame, ids: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Attaches the surrogate ids of keys in which null is a value, the most frequent keys by broadcast."""
    return attach_group(rows, ids, keys, count)


def build(papers: DataFrame, extractions: DataFrame, settings: Settings | None = None) -> Warehouse:
    """The whole star schema. The order of first sight is that of ``extractions.id``; facts and rejects together are all
    source rows. Dimensions are numbered without gaps, facts last."""
    settings = settings or Settings()
    rows = checkpointed(judged(extractions, papers))
    good = accepted(rows)
    events = checkpointed(first_seen_ids(good, EVENT_KEY, "extraction_id", "event_id", "n"))
    shapes = checkpointed(first_seen_ids(good, QUALIFIER_KEY, "extraction_id", "qualifier_id", "n"))
    models = model_dimension(extractions, settings)
    entity_dim, assigned = entity_dimension(extractions, settings)
    last_model = models.groupBy(F.col("model_name").alias("model_version")).agg(F.max("model_id").alias("extraction_model_id"))
    facts = with_id(with_id(good, events, EVENT_KEY, "n"), shapes, QUALIFIER_KEY, "n")
    same_model = F.col("model_version").eqNullSafe(F.col("of_version"))
    facts = facts.join(last_model.withColumnRenamed("model_version", "of_version"), same_model).drop("of_version").join(assigned.withColumnRenamed("row_key", "extraction_id"), "extraction_id")
    flagged = checkpointed(duplicate_flags(facts.select("extraction_id", *FACT_KEY), list(FACT_KEY), "extraction_id"))
    kept = numbered(flagged.filter("kept"), "fact_id", "extraction_id")
    fact = kept.select(
        "fact_id", F.col("extraction_id").alias("source_extraction_id"), "paper_id", "extraction_model_id", "entity_id", "event_id", "attribute", "quantity_raw", "units_raw",
        "quantity_canonical", "units_canonical", "qualifier_id", "page_number", "confidence",
    )
    same = F.concat(F.lit("identical to a kept fact row for paper_id="), F.col("paper_id").cast("string"), F.lit(" attribute="), quoted(F.col("attribute")))
    repeats = flagged.filter("not kept").select("extraction_id", "paper_id", F.lit(REASONS[4]).alias("reason"), same.alias("detail"))
    rejects = rows.filter("reason is not null").select("extraction_id", "paper_id", "reason", "detail").unionByName(repeats)
    return Warehouse(fact, paper_dimension(papers), models, entity_dim, events.select("event_id", *EVENT_KEY), shapes.select("qualifier_id", *QUALIFIER_KEY), rejects)


# --- snapshots


def write_snapshot(warehouse: Warehouse, root: str) -> str:
    """Writes all tables into a new folder and then moves the pointer to it: readers see the old or the new whole.

    ``root`` is a folder all executors share. A snapshot that is being read is never overwritten.
    """
    name = f"snapshots/{uuid.uuid4().hex}"
    for f in fields(Warehouse):
        frame = getattr(warehouse, f.name)
        target = f"{root}/{name}/{f.name}"
        frame.write.json(target) if f.name == "rejects" else frame.write.parquet(target)
    _move_pointer(warehouse.extractions_fact.sparkSession, root, json.dumps({"snapshot": name}))
    return name


def _move_pointer(spark: SparkSession, root: str, text: str) -> None:
    """Writes the pointer beside its place and renames it over the old one, in whatever file system ``root`` names."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    place, pending = hadoop.Path(f"{root}/CURRENT"), hadoop.Path(f"{root}/CURRENT.{uuid.uuid4().hex}")
    out = pending.getFileSystem(conf).create(pending, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(pending.getFileSystem(conf).makeQualified(pending).toUri(), conf).rename(pending.getFileSystem(conf).makeQualified(pending), place.getFileSystem(conf).makeQualified(place), over)


def open_current(spark: SparkSession, root: str) -> Warehouse:
    """The tables of the snapshot that the pointer names."""
    name = spark.read.schema("snapshot string").json(f"{root}/CURRENT").first()[0]
    read = lambda t: spark.read.schema("extraction_id bigint, paper_id bigint, reason string, detail string").json(f"{root}/{name}/{t}") if t == "rejects" else spark.read.parquet(f"{root}/{name}/{t}")
    return Warehouse(**{f.name: read(f.name) for f in fields(Warehouse)})


def violations(warehouse: Warehouse) -> DataFrame:
    """(table, rule, n) of broken keys: none in a sound warehouse. Spark enforces no keys, so a build checks them."""
    fact = warehouse.extractions_fact
    checks = []
    for table, key in (("extractions_fact", "fact_id"), ("paper_dim", "paper_id"), ("model_dim", "model_id"), ("entity_dim", "entity_id"), ("event_dim", "event_id"), ("qualifier_dim", "qualifier_id")):
        frame = getattr(warehouse, table)
        checks.append(frame.groupBy(key).count().filter("count > 1").agg(F.count("*").alias("n")).select(F.lit(table).alias("table"), F.lit(f"unique {key}").alias("rule"), "n"))
        column = {"model_id": "extraction_model_id"}.get(key, key)
        if table != "extractions_fact":
            orphans = fact.filter(F.col(column).isNotNull()).join(frame.select(F.col(key).alias(column)), column, "left_anti")
            checks.append(orphans.agg(F.count("*").alias("n")).select(F.lit(table).alias("table"), F.lit(f"known {key}").alias("rule"), "n"))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.filter("n > 0")
