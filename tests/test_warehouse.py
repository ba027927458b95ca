"""The star schema end to end, snapshots, and set-based writes."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.operators import upsert as u
from tidemark.operators.dedup import duplicate_flags, majority
from tidemark.operators.skew import HOT_FLOOR, attach_group
from tidemark.plans import analytics as a
from tidemark.plans import warehouse as w
from tidemark.schemas import EXTRACTIONS, PAPERS


def papers(spark, *ids):
    return spark.createDataFrame([(i, f"10.1/{i}", None, None, f"Title {i}", None, "openalex", None, ["X"], None, "{}", "extracted", None, None, None, None) for i in ids], PAPERS)


def extraction(i, paper=1, attribute="salinity", value="28.4", units="psu", name="Site A", page=1, lat=None, lon=None, version="v1"):
    data = (name, None, "estuary", None, None, None, None, None, None, attribute, value, units)
    return (i, paper, "schema", version, data, 0.87, "{}", lat, lon, page, None, None, None)


def test_build(spark, tmp_path):
    rows = [
        extraction(1), extraction(2), extraction(3, page=2), extraction(4, value="it's"), extraction(5, attribute="nope"), extraction(6, units="mS/cm"), extraction(7, paper=9),
        extraction(8, attribute="dissolved_inorganic_carbon", value="1–2", units="mmol/kg", name=None), extraction(9, lat=41.5, lon=-70.6, value="<5", version="v2"), extraction(10, attribute=None),
    ]
    built = w.build(papers(spark, 1, 2), spark.createDataFrame(rows, EXTRACTIONS), w.Settings(current_model="v2", seed=42))
    facts = {r.source_extraction_id: r for r in built.extractions_fact.collect()}
    assert sorted(facts) == [2, 3, 8, 9] and sorted(r.fact_id for r in facts.values()) == [1, 2, 3, 4]
    assert facts[2].quantity_canonical == 28.4 and facts[8].quantity_canonical is None and facts[8].units_canonical == "µmol/kg"
    rejects = {r.extraction_id: (r.reason, r.detail) for r in built.rejects.collect()}
    assert rejects[1][0] == "duplicate_fact_row" and rejects[4] == ("unparseable_value", 'value="it\'s"') and rejects[5] == ("unknown_attribute", "attribute='nope'")
    assert rejects[6] == ("unknown_unit", "attribute='salinity' units='mS/cm'") and rejects[7] == ("orphaned_paper", "paper_id 9 not found") and rejects[10][1] == "attribute=None"
    assert len(facts) + len(rejects) == len(rows)
    bounds = {r.qualifier_id: r for r in built.qualifier_dim.collect()}
    assert (round(bounds[facts[8].qualifier_id].range_min, 6), bounds[facts[9].qualifier_id].less_than_or_equal) == (1000.0, 5.0)
    assert {r.model_name: r.seed for r in built.model_dim.collect()} == {"v1": None, "v2": 42}
    assert w.violations(built).count() == 0
    root = str(tmp_path / "wh")
    first = w.write_snapshot(built, root)
    opened = w.open_current(spark, root)
    assert opened.extractions_fact.count() == 4 and opened.rejects.count() == 6
    second = w.write_snapshot(opened, root)  # a rebuild reads the old snapshot while the new one is written
    assert first != second and w.open_current(spark, root).extractions_fact.count() == 4
    listed = a.list_papers(opened.extractions_fact, opened.entity_dim, opened.paper_dim).collect()
    assert [(r.id, r.extraction_count) for r in listed] == [(1, 4)]
    a.write_csv(a.export_rows(opened.extractions_fact, opened.entity_dim, opened.event_dim, opened.paper_dim, spark.createDataFrame([(2, "valid")], "id bigint, judgement string")), str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()
    assert len(text) == 5 and text[0].split(",")[:3] == ["entity_id", "entity_name", "entity_latitude"] and "valid" in text[1]


def test_unknown_models_and_hidden_characters(spark):
    """A null model version is a model like others, and reports show what can't be seen."""
    rows = [extraction(1, version=None), extraction(2, version="v1"), extraction(3, value="a\u00a0b\r\u202f\x07"), extraction(4, attribute="x\n'\"\\")]
    built = w.build(papers(spark, 1), spark.createDataFrame(rows, EXTRACTIONS))
    facts = {r.source_extraction_id: r.extraction_model_id for r in built.extractions_fact.collect()}
    names = {r.model_id: r.model_name for r in built.model_dim.collect()}
    assert {i: names[m] for i, m in facts.items()} == {1: None, 2: "v1"}
    details = {r.extraction_id: r.detail for r in built.rejects.collect()}
    assert details == {3: "value=" + repr("a\u00a0b\r\u202f\x07"), 4: "attribute=" + repr("x\n'\"\\")}


def test_enrichment_and_samples(spark):
    known = spark.createDataFrame([(1, "d1", None, None), (2, "d2", "T", None), (3, None, None, None)], "id int, doi string, title string, publisher string")
    found = spark.createDataFrame([("d1", "B", "P"), ("d1", "A", "Q"), ("d2", "Z", "R"), (None, "N", "N")], "doi string, title string, publisher string")
    assert sorted(map(tuple, a.enriched(known, found, "doi", ["title", "publisher"]).collect())) == [(1, "d1", "A", "Q"), (2, "d2", "T", "R"), (3, None, None, None)]
    rows = spark.range(500)
    drawn = [r.id for r in a.random_rows(rows, "id", 40, 3).collect()]
    assert len(set(drawn)) == 40 and drawn == [r.id for r in a.random_rows(rows.repartition(7), "id", 40, 3).collect()] and drawn != [r.id for r in a.random_rows(rows, "id", 40, 4).collect()]
    calls = spark.createDataFrame([("m", 3, None), ("m", 4, 5), ("n", None, None)], "model string, prompt int, completion int")
    assert sorted(map(tuple, a.usage_totals(calls, ["prompt", "completion"], ["model"]).collect())) == [("m", 2, 7, 5), ("n", 1, 0, 0)]
    times = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, i * 30) as t from (select explode(sequence(0, 4)) as i)")
    assert tuple(a.per_hour(times, "t").first()) == (5, 2.0, 2.5) and a.per_hour(times.limit(0), "t").first()[0] == 0


def test_claims_take_rows_once(spark):
    queue = spark.createDataFrame([(i, "new" if i % 2 else "done") for i in range(10)], "id int, status string")
    taken, left = u.claim_and_set(queue, "status", "new", "busy", "id", 3)
    again, rest = u.claim_and_set(left, "status", "new", "busy", "id", 3)
    assert sorted(r.id for r in taken.collect()) == [1, 3, 5] and sorted(r.id for r in again.collect()) == [7, 9]
    assert {r.id: r.status for r in rest.collect()} == {i: "busy" if i % 2 else "done" for i in range(10)}


def test_build_of_nothing(spark):
    built = w.build(papers(spark), spark.createDataFrame([], EXTRACTIONS))
    assert built.extractions_fact.count() == 0 and built.rejects.count() == 0 and built.entity_dim.count() == 0


def test_titles_are_literal(spark):
    paper = spark.createDataFrame([(1, "100% salt_marsh"), (2, "1000 saltXmarsh"), (3, None)], "paper_id bigint, title string").withColumn("authors", F.array()).withColumn("publication_date", F.lit(None)).withColumn("doi", F.lit(None))
    fact = spark.createDataFrame([(1,), (1,), (2,), (3,)], "paper_id bigint")
    assert [r.id for r in a.search_titles(paper, fact, "100%", 8).collect()] == [1]
    assert [r.id for r in a.search_titles(paper, fact, "SALT_", 8).collect()] == [1]
    assert a.search_titles(paper, fact, " x ", 8).count() == 0


def test_insert_if_absent_against_single_inserts(spark):
    import random

    rng = random.Random(1)
    pick = lambda p: f"{p}{rng.randint(1, 9)}" if rng.random() < 0.6 else rng.choice([None, ""])
    batch = [(i, pick("d"), pick("o"), pick("s")) for i in range(60)]
    target = [("d1", "o2", None), (None, "o3", "s3")]
    taken = [{x[i] for x in target if x[i]} for i in range(3)]
    want = []
    for bucket in range(3):
        for i, *ids in batch:
            own = next((k for k in range(3) if ids[k]), None)
            if own == bucket and not any(ids[k] in taken[k] for k in range(3) if ids[k] and (bucket == 0 or k == bucket)):
                if any(ids[k] in taken[k] for k in range(3) if ids[k]):
                    continue  # a later identifier is taken by a row added before
                want.append(i)
                for k in range(3):
                    if ids[k]:
                        taken[k].add(ids[k])
    ddl = "doi string, openalex_id string, semantic_scholar_id string"
    got = u.insert_if_absent(spark.createDataFrame(target, ddl), spark.createDataFrame(batch, "id int, " + ddl), "id")
    assert sorted(r.id for r in got.collect()) == sorted(want)


def test_updates_and_marks(spark, rows):
    target = spark.createDataFrame([(1, "new", "e"), (2, "old", None), (3, None, "x")], "id int, state string, error string")
    assert rows(u.keyed_update(target, spark.createDataFrame([(1, None), (3, "y")], "id int, error string"), "id")) == [(1, "new", None), (2, "old", None), (3, None, "y")]
    assert rows(u.compare_and_set(target, spark.createDataFrame([(1,), (2,), (9,)], "id int"), "id", "state", "new", "done")) == [(1, "done", "e"), (2, "old", None), (3, None, "x")]
    assert [r.id for r in u.claim(target, "state", "old", "id", 5).collect()] == [2]
    old = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", None)], "source string, watermark date")
    seen = spark.createDataFrame([("a", date(2023, 1, 1)), ("b", date(2022, 1, 1)), ("c", None)], "source string, watermark date")
    assert rows(u.advance_marks(old, seen)) == [("a", date(2024, 1, 1)), ("b", date(2022, 1, 1)), ("c", None)]
    texts = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id int, v int, t string")
    assert rows(u.last_write_wins(texts, spark.createDataFrame([(2, 1, "c"), (2, 2, "d"), (3, 1, "e")], texts.schema), "id", "v")) == [(1, 1, "a"), (2, 2, "d"), (3, 1, "e")]


def test_dedup_and_majority(spark, rows):
    frame = spark.createDataFrame([(1, None, 2.0), (2, None, 2.0), (3, "a", 2.0), (4, "a", None)], "id int, k string, v double")
    assert rows(duplicate_flags(frame, ["k", "v"], "id").select("id", "kept")) == [(1, False), (2, True), (3, True), (4, True)]
    said = spark.createDataFrame([(1, "b"), (1, "a"), (1, ""), (2, None), (2, "")], "g int, v string")
    assert rows(said.groupBy("g").agg(majority(F.col("v")).alias("m"))) == [(1, "a"), (2, None)]


def test_hot_groups_meet_by_broadcast(spark):
    n = HOT_FLOOR + 10
    frame = spark.range(n + 5).select(F.when(F.col("id") < n, None).otherwise(F.col("id")).alias("k"), "id")
    groups = frame.groupBy("k").agg(F.max("id").alias("last"), F.count("*").alias("n"))
    got = attach_group(frame, groups, ["k"], "n")
    assert got.count() == n + 5 and got.filter("k is null").agg(F.min("last"), F.max("last")).first()[:] == (n - 1, n - 1)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert attach_group(frame.limit(0), groups, ["k"], "n").count() == 0


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
def test_only_what_facts_need_is_flagged(spark, monkeypatch):
    """What goes through the joins and the checkpoint of facts is the key of a fact, not the whole judged row."""
    seen = []
    real = w.duplicate_flags
    monkeypatch.setattr(w, "duplicate_flags", lambda rows, *a: seen.append(rows.columns) or real(rows, *a))
    built = w.build(spark.read.parquet(f"{SMALL}/papers.parquet"), spark.read.parquet(f"{SMALL}/extractions.parquet"))
    assert set(seen[0]) == {"extraction_id", *w.FACT_KEY}
    assert built.extractions_fact.count() + built.rejects.count() == spark.read.parquet(f"{SMALL}/extractions.parquet").count()
