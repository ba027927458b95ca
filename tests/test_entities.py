"""Entity resolution, components and numbering against plain versions."""

from __future__ import annotations

import math
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tidemark.operators import components, entities
from tidemark.operators.components import connected_components
from tidemark.operators.entities import name_leaders, point_clusters, resolve_entities, similar_names
from tidemark.operators.numbering import first_seen_ids, numbered
from tidemark.operators.sampling import hash_sample
from tidemark.session import checkpointed

DDL = "row_key bigint, name string, latitude double, longitude double, entity_id string"


def resolved(spark, rows):
    entities, assigned = resolve_entities(spark.createDataFrame([(*r, "clash") for r in rows], DDL))
    by_id = {r.entity_id: r for r in entities.collect()}
    return {r.row_key: by_id[r.entity_id] for r in assigned.collect()}


def test_coordinates(spark):
    got = resolved(spark, [(1, "A", 10.000, 20.0), (2, "A", 10.005, 20.0), (3, "B", 10.5, 20.0), (4, "A", 10.000, 20.0)])
    assert got[1].entity_id == got[2].entity_id == got[4].entity_id == 1 and got[3].entity_id == 2
    assert got[1].latitude == pytest.approx(10.0025) and got[1].resolution_method == "coordinate"


def test_names_and_leftovers(spark):
    rows = [(1, "Cedar Marsh", None, None), (2, "  CEDAR   marsh!! ", None, None), (3, "Pacific Ocean Deep Trench", None, None), (4, None, None, None), (5, "", 1.0, None), (6, "Cedar Marsh", 1.0, 2.0), (7, "Cedar Marshs", 5.0, None)]
    got = resolved(spark, rows)
    assert got[1].entity_id == got[2].entity_id == got[7].entity_id != got[3].entity_id
    assert got[4].entity_id != got[5].entity_id and {got[4].resolution_method, got[5].resolution_method} == {"unresolved"}
    assert got[6].resolution_method == "coordinate" and got[6].entity_id == 1 and got[1].name == "Cedar Marsh"
    assert sorted({g.entity_id for g in got.values()}) == [1, 2, 3, 4, 5]
    assert resolved(spark, []) == {}


def test_leaders_follow_the_order(spark):
    rng = random.Random(4)
    names = sorted({"".join(rng.choice(["lo", "la", "mar", "ke", "no", "ti"]) for _ in range(rng.randint(2, 5))) + rng.choice(["", "s", " bay", " bays", " marsh"]) for _ in range(120)})
    rng.shuffle(names)
    leaders, want = [], {}
    for name in names:
        lead = next((x for x in leaders if SequenceMatcher(None, name, x).ratio() >= 0.85), None)
        if lead is None:
            leaders.append(name)
        want[name] = lead or name
    frame = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "key string, pos bigint")
    got = {r.key: names[r.leader] for r in name_leaders(frame).collect()}
    assert got == want


@pytest.mark.parametrize("similarity", [0.85, 0.75])
def test_similar_names_against_all_pairs(spark, similarity):
    rng = random.Random(6)

    def changed(name: str) -> str:
        for _ in range(rng.randint(0, 5)):
            i = rng.randrange(len(name))
            name = rng.choice([name[:i] + name[i + 1 :] or name, name[:i] + rng.choice("aeo rst7") + name[i:], name[:i] + rng.choice("aeo rst") + name[i + 1 :]])
        return name

    roots = ["".join(rng.choice(["lo", "la", "mar", "ke", "no", "ti", "a", "ee"]) for _ in range(n)) for n in (1, 2, 2, 3, 3, 4, 5, 6, 7, 9, 14, 40, 45, 60)]
    names = sorted({changed(r) for r in roots for _ in range(12)} | {"é" * 5, "é" * 6, "aaaaaaaaab", "aaaaaaaaa"})
    rng.shuffle(names)
    want = {(i, j) for i, x in enumerate(names) for j, y in enumerate(names[:i]) if SequenceMatcher(None, x, y).ratio() >= similarity}
    got = [tuple(r) for r in similar_names(spark.createDataFrame([(n, i) for i, n in enumerate(names)], "key string, pos bigint"), similarity).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_leaders_of_many_links_in_rounds(spark, monkeypatch):
    """One task and rounds tell the same leaders."""
    rng = random.Random(5)
    frame = checkpointed(spark.createDataFrame([("".join(rng.choice("ab") for _ in range(7)) + str(i % 9), i) for i in rng.sample(range(500), 80)], "key string, pos bigint"))
    at_once = sorted(tuple(r) for r in name_leaders(frame).collect())
    monkeypatch.setattr(entities, "FEW_LINKS", 0)
    assert sorted(tuple(r) for r in name_leaders(frame).collect()) == at_once and len({r[2] for r in at_once}) < 80


@pytest.mark.parametrize("size", [3, 40])
def test_similar_names_in_chunks(spark, monkeypatch, size):
    """Pairs are found across chunks, also of names longer than a word, and no candidates are shuffled for it."""
    monkeypatch.setattr(entities, "CHUNK", size)
    rng = random.Random(8)
    roots = ["".join(rng.choice(["lo", "mar", "ke", "no", "ti", "é"]) for _ in range(n)) for n in (3, 4, 5, 6, 30, 31, 32)]
    names = sorted({r[:i] + rng.choice("aeo ") + r[i + rng.randint(0, 1) :] for r in roots for i in rng.sample(range(len(r)), 5)})
    rng.shuffle(names)
    want = {(i, j) for i, x in enumerate(names) for j, y in enumerate(names[:i]) if SequenceMatcher(None, x, y).ratio() >= 0.85}
    frame = similar_names(spark.createDataFrame([(n, i) for i, n in enumerate(names)], "key string, pos bigint"))
    got = [tuple(r) for r in frame.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_components_work_on_linked_nodes_only(spark, monkeypatch):
    """Lone nodes keep their own label without taking part in the rounds."""
    sizes = []
    monkeypatch.setattr(components, "checkpointed", lambda frame: sizes.append(checkpointed(frame).count()) or checkpointed(frame))
    nodes, edges = spark.range(1000).select(F.col("id").alias("node")), spark.createDataFrame([(1, 2), (3, 2), (7, 5000)], "a bigint, b bigint")
    got = {r.node: r.component for r in components.connected_components(nodes, edges).collect()}
    assert got == {i: 1 if i in (2, 3) else i for i in range(1000)} and max(sizes) <= 6


def test_clusters_against_all_pairs(spark):
    rng = random.Random(2)
    centres = [(89.999, 0.0), (-89.995, 120.0), (0.0, 179.999), (0.002, -179.999), (45.0, 7.0), (45.02, 7.01)]
    points = sorted({(max(-90.0, min(90.0, a + rng.gauss(0, 0.006))), (b + rng.gauss(0, 0.006) + 180) % 360 - 180) for a, b in centres for _ in range(40)})

    def km(p, q):
        a = math.sin(math.radians(q[0] - p[0]) / 2) ** 2 + math.cos(math.radians(p[0])) * math.cos(math.radians(q[0])) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(min(1, a)))

    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if km(points[i], points[j]) <= 1.0:
                root[find(i)] = find(j)
    want = {frozenset(k for k in range(len(points)) if find(k) == g) for g in {find(k) for k in range(len(points))}}
    place = {p: i for i, p in enumerate(points)}
    groups: dict = {}
    for r in point_clusters(spark.createDataFrame(points, "lat double, lon double")).collect():
        groups.setdefault(tuple(r.component), set()).add(place[(r.lat, r.lon)])
    assert {frozenset(g) for g in groups.values()} == want


def test_components_of_a_chain(spark):
    nodes = spark.range(200).select(F.col("id").alias("node"))
    edges = spark.range(149).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.node: r.component for r in connected_components(nodes, edges).collect()}
    assert all(got[i] == (0 if i < 150 else i) for i in range(200))


def test_numbering(spark):
    frame = spark.createDataFrame([(3, "b"), (1, None), (2, "a"), (5, "b"), (4, None)], "id int, k string")
    assert [(r.id, r.n) for r in numbered(frame, "n", "id").orderBy("id").collect()] == [(i, i) for i in range(1, 6)]
    assert sorted((str(r.k), r.n) for r in first_seen_ids(frame, ["k"], "id", "n").collect()) == [("None", 1), ("a", 2), ("b", 3)]
    assert numbered(frame.limit(0), "n", "id").count() == 0


def test_hash_sample(spark):
    drawn = [r.id for r in hash_sample(spark.range(20_000), 1000, "id").collect()]
    assert 750 <= len(drawn) <= 1000 and sorted(drawn) == sorted(r.id for r in hash_sample(spark.range(20_000).repartition(7), 1000, "id").collect())
    assert hash_sample(spark.range(5), 10, "id").count() == 5 and hash_sample(spark.range(0), 10, "id").count() == 0
    copies = spark.range(5000).select(F.lit(1).alias("id"))
    assert hash_sample(copies, 100, "id").count() <= 100
