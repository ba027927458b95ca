"""Records that differ in formatting only, by dictionary-encoded field-value tuples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import attach_group
from tidemark.session import checkpointed

#: Fields in which signs, decimal points and comparison signs are content.
NUMERIC_FIELDS = ("value", "date")
#: Lower-case letters that share their upper case with another, and that other one.
FOLDED = ("µςſı", "μσsi")


def canonical(field: Column, raw: Column) -> Column:
    """A value without white space, letter case and punctuation; null if nothing is left.

    Letters that one change of case makes equal are one, such as both micro signs. In numeric fields digits, letters, signs, comparison signs and points before a digit remain.
    """
    low = F.replace(F.translate(F.lower(raw), *FOLDED), F.lit("ß"), F.lit("ss"))
    text = F.regexp_replace(low, r"[^\p{L}\p{N}\p{M}\p{S}%‰]+", "")
    text = F.regexp_replace(text, r"[`^|~$]+", "")
    number = F.regexp_replace(low, r"\.(?!\p{N})", "")
    number = F.regexp_replace(number, r"[^\p{L}\p{N}\p{M}\p{S}\p{Pd}.%‰]+", "")
    return F.nullif(F.when(field.isin(*NUMERIC_FIELDS), number).otherwise(text), F.lit(""))


def parsed_records(results: DataFrame) -> DataFrame:
    """(row, paper_id, result_id, version, pairs): each row of the table, parsed once, with a number of its own.

    ``pairs`` are the structs (field, raw) of its object, those with a null value left out. The rows are checkpointed, so
    the numbers stay the same if a task is repeated.
    """
    rows = results.select(F.col("paper_id").cast("bigint"), F.col("result_id").cast("bigint"), "data", F.xxhash64("data").alias("version"))
    read = F.expr("try_variant_get(try_parse_json(data), '$', 'map<string,string>')")
    whole = F.array(F.struct(F.lit("_unparsed").alias("field"), F.col("data").alias("raw")))
    fields = F.transform(F.map_entries("object"), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("field"), e["value"].alias("raw")))
    pairs = F.when(F.col("object").isNotNull(), F.filter(fields, lambda e: e["raw"].isNotNull())).when(F.col("data").isNotNull(), whole)
    return checkpointed(rows.withColumn("object", read).select(F.monotonically_increasing_id().alias("row"), "paper_id", "result_id", "version", pairs.alias("pairs")))


def _pair_hash(seed: int) -> list[Column]:
    """128 bits of a field-value pair; whether any two pairs share them is tested on the dictionary."""
    return [F.xxhash64(F.lit(seed), "raw", "field").alias("h1"), F.xxhash64(F.lit(~seed), "field", "raw").alias("h2")]


def dictionary(cells: DataFrame) -> tuple[DataFrame, int]:
    """((h1, h2, n, pair_id), seed): every distinct pair canonicalised once, and one integer per canonical pair.

    A pair of which nothing is left has no entry. Pairs are named by hashes, so that records travel without their texts;
    the seed is one under which all pairs of these cells have different hashes.
    """
    seen = checkpointed(cells.groupBy("field", "raw").agg(F.count("*").alias("n")).withColumn("canonical", canonical(F.col("field"), F.col("raw"))).filter("canonical is not null"))
    seed = 0
    while seen.groupBy(*_pair_hash(seed)).count().filter("count > 1").limit(1).count():
        seed += 1
    ids = checkpointed(seen.select("field", "canonical").distinct().withColumn("pair_id", F.monotonically_increasing_id()))
    return checkpointed(seen.join(ids, ["field", "canonical"]).select(*_pair_hash(seed), "n", "pair_id")), seed


def encoded_records(results: DataFrame) -> DataFrame:
    """(paper_id, result_id, record): each record as a sorted array of integer ids of its field-value pairs.

    Records meet the dictionary through a join in which the most frequent pairs are broadcast (their number is bounded),
    so none of them is a hot key; what is shuffled is a row number and a hash for each rarer pair.
    """
    parsed = parsed_records(results)
    entries, seed = dictionary(parsed.select(F.inline("pairs")))
    cells = parsed.select("row", F.inline("pairs")).select("row", *_pair_hash(seed))
    coded = attach_group(cells, entries, ["h1", "h2"], "n", "inner")
    records = coded.groupBy("row").agg(F.array_sort(F.collect_set("pair_id")).alias("record"))
    once = parsed.groupBy("paper_id", "result_id", "version").agg(F.min("row").alias("row"))  # a row that was sent twice
    return once.join(records, "row", "left").select("paper_id", "result_id", F.coalesce("record", F.array().cast("array<bigint>")).alias("record"))


def record_groups(encoded: DataFrame) -> DataFrame:
    """(paper_id, record, first_id, n_copies): one row per distinct record of a paper."""
    return encoded.groupBy("paper_id", "record").agg(F.min("result_id").alias("first_id"), F.count("*").alias("n_copies"))


def collapse_copies(results: DataFrame) -> DataFrame:
    """(paper_id, first_id, n_copies): each record of a paper once, with the number of rows that say the same.

    results: result_id, paper_id, data (a json object of texts). Field order, white space, letter case and punctuation
    don't count, nor whether a field is null, missing or holds nothing but punctuation. Data that is no json object is
    compared as one text; null data equals null data. Null paper ids form a paper of their own. Rows that repeat an id
    with the same data are one copy. An empty table gives no rows.
    """
    return record_groups(encoded_records(results)).select("paper_id", "first_id", "n_copies")


def copies(results: DataFrame) -> DataFrame:
    """(first_id, copy_id): every copy with the smallest id of its group, also of groups that hold most of the rows."""
    encoded = checkpointed(encoded_records(results))
    groups = record_groups(encoded).filter("n_copies > 1")
    paired = attach_group(encoded, groups, ["paper_id", "record"], "n_copies")
    return paired.filter("result_id <> first_id").select("first_id", F.col("result_id").alias("copy_id")).distinct()
