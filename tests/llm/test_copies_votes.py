"""Formatting duplicates and consensus against plain versions."""

from __future__ import annotations

import json
import math
import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.llm import consensus, copies

DDL = "result_id bigint, paper_id bigint, data string, record string, n bigint"
BASE = {"name": "Cedar Marsh", "location": "near Bay", "value": "1,211.5", "units": "µg / L", "date": "07-04-1994", "identifiers": None}


def dumped(spark, records):
    return spark.createDataFrame([(i, p, d if d is None or isinstance(d, str) else json.dumps(d, ensure_ascii=False), "r", 1) for i, (p, d) in enumerate(records)], DDL)


def test_copies(spark):
    swapped = {k: BASE[k] for k in reversed(BASE)} | {"name": " CEDAR marsh;", "location": '"Near-Bay"', "units": "Μg/l", "value": "1211.5", "identifiers": ""}
    records = [
        (1, BASE), (1, swapped), (1, BASE | {"value": "-1,211.5"}), (1, BASE | {"value": "<1211.5"}), (1, BASE | {"value": "12115"}), (1, BASE | {"date": "07-04-1995"}), (2, BASE), (1, BASE | {"extra": "x"}),
        (1, {k: v for k, v in BASE.items() if k != "identifiers"}), (1, None), (1, None), (1, "not json"), (1, "NOT  json!"), (None, BASE), (None, swapped), (1, "{}"), (3, "[1, 2]"),
    ]
    frame = dumped(spark, records)
    assert sorted(map(tuple, copies.copies(frame.unionByName(frame.filter("result_id = 1"))).collect())) == [(0, 1), (0, 8), (9, 10), (9, 15), (11, 12), (13, 14)]
    groups = {r.first_id: r.n_copies for r in copies.collapse_copies(frame).collect()}
    assert groups[0] == 3 and groups[2] == 1 and groups[9] == 3 and sum(groups.values()) == len(records)
    assert copies.copies(frame.limit(0)).count() == 0 and copies.collapse_copies(frame.limit(0)).count() == 0


def test_a_group_of_most_rows(spark):
    frame = spark.range(30_000).select(F.col("id").alias("result_id"), F.lit(1).cast("bigint").alias("paper_id"), F.when(F.col("id") % 50 == 0, F.concat(F.lit('{"value": "'), F.col("id").cast("string"), F.lit('"}'))).otherwise(F.lit(' {"value" : "7 "}')).alias("data"))
    out = copies.copies(frame)
    assert out.count() == 29_399 and out.agg(F.min("first_id"), F.max("first_id")).first()[:] == (1, 1)


def test_digamma(spark):
    xs = [0.1, 0.5, 1.0, 2.5, 30.0, 1e6]
    got = [r.d for r in spark.createDataFrame([(x,) for x in xs], "x double").select(consensus.digamma(F.col("x")).alias("d")).collect()]
    want = [-10.4237549404, -1.9635100260, -0.5772156649, 0.7031566406, 3.3844381326, 13.8155100579]
    assert got == pytest.approx(want, abs=1e-8)


VOTES = "id bigint, extraction_id bigint, vote boolean, voter_hash string, created_at timestamp, item string"


def simulated(seed=3, items=400):
    rng = random.Random(seed)
    truth = {i: rng.random() < 0.55 for i in range(items)}
    kinds = {f"good{k}": 0.88 for k in range(25)} | {f"spam{k}": None for k in range(4)} | {"against": 0.15, "yes": "yes"}
    rows = []
    for voter, right in kinds.items():
        for i in rng.sample(range(items), 90):
            vote = rng.random() < 0.5 if right is None else True if right == "yes" else truth[i] == (rng.random() < right)
            rows.append((i, vote, voter))
    return truth, rows


def test_voters_and_labels(spark):
    truth, rows = simulated()
    day = lambda k: datetime(2024, 1, 1 + k % 27)
    frame = spark.createDataFrame([(k, i, v, h, day(0), "clash") for k, (i, v, h) in enumerate(rows)] + [(10_001, 0, None, "good0", day(1), "c"), (10_002, None, True, "good0", day(1), "c"), (10_003, 1, True, None, None, "c")], VOTES)
    assert sorted(r.voter_hash for r in consensus.unreliable_voters(frame).collect()) == ["against", "spam0", "spam1", "spam2", "spam3", "yes"]
    labels = {r.extraction_id: r for r in consensus.item_consensus(frame).collect()}
    right = sum(labels[i].label == truth[i] for i in labels if labels[i].label is not None)
    plain = defaultdict(int)
    for i, v, _ in rows:
        plain[i] += 1 if v else -1
    assert right >= sum((plain[i] > 0) == truth[i] for i in plain if plain[i]) and right / len(labels) > 0.93
    good = [r for r in consensus.voter_reliability(frame).collect() if r.voter_hash.startswith("good")]
    assert all(r.low <= r.dependence <= r.high for r in good) and all(r.low < 0.76 + 0.25 for r in good)


def test_last_vote_counts(spark):
    day = lambda d: datetime(2024, 1, d)
    rows = [(1, 1, True, "a", day(1), "c"), (2, 1, False, "a", day(2), "c"), (2, 1, False, "a", day(2), "c"), (3, 1, True, None, day(1), "c"), (3, 1, True, None, day(1), "c"), (4, 1, False, None, None, "c")]
    got = sorted((r.item, r.voter or "", r.vote) for r in consensus.last_votes(spark.createDataFrame(rows, VOTES)).collect())
    assert got == [(1, "", 0.0), (1, "", 1.0), (1, "a", 0.0)]
    empty = spark.createDataFrame([], VOTES)
    assert consensus.item_consensus(empty).count() == 0 and consensus.unreliable_voters(empty).count() == 0


def test_krippendorff(spark):
    units = {1: [1, 1], 2: [0, 0, 0], 3: [1, 0], 4: [1]}
    rows = [(10 * i + k, i, bool(v), f"v{k}", datetime(2024, 1, 1), "c") for i, vs in units.items() for k, v in enumerate(vs)]
    n, ones = 7, 3
    observed = 2 * 1 * 1 / 1
    expected = 2 * ones * (n - ones) / (n - 1)
    row = consensus.krippendorff(spark.createDataFrame(rows, VOTES)).first()
    assert (row.n_items, row.n_votes) == (3, 7) and math.isclose(row.alpha, 1 - observed / expected)


def test_unknown_voters_keep_their_weight(spark):
    _, rows = simulated()
    day = datetime(2024, 1, 1)
    known = [(k, i, v, h, day, "c") for k, (i, v, h) in enumerate(rows)]
    unknown = [(20_000, 900, False, None, day, "c"), (20_001, 901, True, None, day, "c"), *((20_010 + k, 902, k == 0, None, day, "c") for k in range(3))]
    got = {r.extraction_id: r for r in consensus.item_consensus(spark.createDataFrame(known + unknown, VOTES)).collect()}
    assert [got[i].label for i in (900, 901, 902)] == [False, True, False]
    prior = [math.log(got[i].probability / (1 - got[i].probability)) for i in (900, 901, 902)]
    assert prior[1] - prior[0] == pytest.approx(2 * (1 + 1 / 2 + 1 / 3)) and prior[0] == pytest.approx(prior[2])


def test_hot_items_and_many_voters_give_the_same_posteriors(spark, monkeypatch):
    _, rows = simulated(items=120)
    frame = spark.createDataFrame([(k, i % 60 if k % 3 else 0, v, f"{h}-{k % 7}" if h else None, datetime(2024, 1, 1), "c") for k, (i, v, h) in enumerate(rows)], VOTES)
    plain = {r.item: (round(r.q, 9), r.n_votes, r.n_yes) for r in consensus.fit_votes(frame)[0].collect()}
    monkeypatch.setattr(consensus, "HOT_FLOOR", 30)
    monkeypatch.setattr(consensus, "BROADCAST_VOTERS", 3)
    split = {r.item: (round(r.q, 9), r.n_votes, r.n_yes) for r in consensus.fit_votes(frame)[0].collect()}
    assert split == plain and len(split) == frame.select("extraction_id").distinct().count()


def test_class_row_counts_items(spark):
    """An item with many votes counts once: nine items of no with one vote each outweigh one of yes with thirty."""
    rows = [(k, 0, True, f"v{k}", datetime(2024, 1, 1), "c") for k in range(30)] + [(100 + k, 1 + k, False, f"v{k}", datetime(2024, 1, 1), "c") for k in range(9)] + [(200, 50, True, None, datetime(2024, 1, 1), "c"), (201, 51, False, None, datetime(2024, 1, 1), "c")]
    got = {r.extraction_id: r.probability for r in consensus.item_consensus(spark.createDataFrame(rows, VOTES)).collect()}
    odds = lambda i: math.log(got[i] / (1 - got[i]))
    assert odds(50) + odds(51) < 0  # twice the expected log odds of the classes
    assert consensus.psi(3.0) - consensus.psi(1.0) == pytest.approx(1.5)
