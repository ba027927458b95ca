"""Feed mappers, page texts, model stages and streams."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.functions.json_salvage import first_json, leading_items, response_items
from tidemark.functions.snippets import find_pages, find_snippets, marked_literal, marked_number, numbers_in, page_list
from tidemark.sources import feeds
from tidemark.streaming import ingest, stages


def one(spark, column, kind="string", **values):
    names = list(values)
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {kind}" for n in names))
    return frame.select(column(*[F.col(n) for n in names]).alias("x")).first().x


def test_text_functions(spark):
    assert one(spark, t.title_case, x="the <i>of</i> pH and CO2 in a bay") == "The <i>of</i> PH and CO2 in a Bay"
    assert one(spark, t.without_footnote_mark, x="Narragansett Bay1,2") == "Narragansett Bay" and one(spark, t.without_footnote_mark, x="Flux of CO2") == "Flux of CO2"
    assert one(spark, t.rendered_title, x='a <b class="q">salt</b> <script>x</script>marsh3') == "A <b>Salt</b> Xmarsh"
    assert one(spark, t.without_markup, x="<jats:p> a\n b </jats:p>") == "a b" and one(spark, t.without_markup, x="<p/>") is None
    assert one(spark, t.plain_doi, x="https://doi.org/10.1/X") == "10.1/X" and one(spark, t.plain_doi, x="") is None and one(spark, t.last_segment, x="https://o.org/W1") == "W1"
    assert one(spark, t.slug, x="Salt Marsh / É") == "salt_marsh" and one(spark, t.entity_key, x="  CEDAR   marsh!! ") == "cedar marsh" and one(spark, t.entity_key, x="!!") is None
    assert one(spark, t.iso_date, x="2024-06") is None and str(one(spark, t.iso_date, x="2024-06-30")) == "2024-06-30" and one(spark, t.iso_date, x="2024-13-01") is None
    assert str(one(spark, t.date_from_parts, kind="array<int>", x=[2020, 2])) == "2020-02-01" and one(spark, t.date_from_parts, kind="array<int>", x=[2020, 13]) is None and one(spark, t.date_from_parts, kind="array<int>", x=[]) is None
    assert one(spark, t.text_from_index, kind="map<string, array<int>>", x={"b": [1, 3], "a": [0], "c": [3]}) == "a b c" and one(spark, t.text_from_index, kind="map<string, array<int>>", x=None) is None
    assert one(spark, t.voter_hash, ip=None, agent="z") == one(spark, t.voter_hash, ip="unknown", agent="z") and len(one(spark, t.prompt_hash, x="p")) == 12


def test_json_keys(spark):
    assert one(spark, lambda x: t.without_key(x, "context"), x='{"a": "1", "context": "long", "b": null}') == '{"a":"1","b":null}'
    assert one(spark, lambda x: t.without_key(x, "context"), x='{"a": "1"}') == '{"a": "1"}' and one(spark, lambda x: t.without_key(x, "context"), x=None) is None


PAGES = '<page number="0">\n\nnitrate was low\n\n</page>\n<page number="1">\n\nvalue 28.4 and 1,234.50\n\n</page>\n<page number="2">\n\nsalinity 28.4 psu, 125.3\n\n</page>'


def test_pages(spark):
    rows = [("a", PAGES, "28.4", None, None), ("b", PAGES, "28.4", "salinity", None), ("c", PAGES, "1234.5", None, None), ("d", PAGES, None, "salinity", None), ("e", PAGES, "99.9", "salinity", None), ("f", "no tags", "1", None, None), ("g", PAGES, "5", None, "zz"), ("h", PAGES, "(?x", None, None)]
    frame = spark.createDataFrame(rows, "k string, context string, value string, attribute string, units string").withColumn("d", F.col("k"))
    got = {r.k: (r.page_number, r.page_matched) for r in find_pages(frame, frame.select("k", F.col("k").alias("d"), "context").drop("k"), "k", "d").collect()}
    assert got == {"a": (1, True), "b": (2, True), "c": (1, True), "d": (0, False), "e": (2, False), "f": (None, False), "g": (0, False), "h": (0, False)}
    rows = frame.unionByName(spark.createDataFrame([("i", None, "28.4", None, None, "nowhere"), ("j", None, "28.4", None, None, None)], frame.schema))
    texts = frame.select("d", "context").unionByName(spark.createDataFrame([("other", PAGES)], "d string, context string"))
    shown = {r.k: r for r in find_snippets(rows, texts, "k", "d").collect()}
    assert {k: (r.page_number, r.page_matched) for k, r in shown.items()} == got | {"i": (None, False), "j": (None, False)}
    assert shown["a"].text == "value <mark>28.4</mark> and 1,234.50" and shown["c"].text == "value 28.4 and <mark>1,234.50</mark>" and shown["e"].text == "salinity 28.4 psu, 125.3"
    assert shown["f"].text == "no tags" and shown["i"].text is None
    assert find_pages(frame.limit(0), texts, "k", "d").count() == 0 and find_pages(frame, texts.limit(0), "k", "d").filter("page_matched or page_number is not null").count() == 0
    for text, value, want in (("-5.0 and 5.0", "5.0", "-5.0 and <mark>5.0</mark>"), ("55 5", "5", "55 <mark>5</mark>"), ("125.3", "5", "125.3"), ("a|b", "a|b", "<mark>a|b</mark>"), ("1.1.1", "1.1", "1.1.1"), ("5", "5", "<mark>5</mark>"), ("ND,", "ND", "ND,")):
        assert one(spark, lambda x, v: marked_literal(x, v), x=text, v=value) == want, text
    assert sorted(one(spark, lambda x: numbers_in(x), x="3-5, 1,234.50; x12. .5")) == [-5.0, 3.0, 5.0, 12.0, 1234.5]
    assert one(spark, lambda x: page_list(x), x=PAGES)[1].text == "value 28.4 and 1,234.50"
    assert one(spark, lambda x, v: marked_literal(x, v), x="5 125.5 5.", v="5") == "<mark>5</mark> 125.5 5."
    frame = spark.createDataFrame([("1,234.50 and 9", 1234.5), (None, 1.0)], "t string, n double")
    assert [r.x for r in frame.select(marked_number(F.col("t"), F.col("n")).alias("x")).collect()] == ["<mark>1,234.50</mark> and 9", None]


def test_json_salvage():
    assert first_json('Sure! ```json\n{"items": []}\n```') == {"items": []} and first_json("nothing") is None and first_json(None) is None
    cut = '{"items": [{"attribute": "a", "value": "1"}, {"attribute": "b", "val'
    assert [i["attribute"] for i in leading_items(cut)] == ["a"] and [json.loads(x)["attribute"] for x in response_items(cut)] == ["a"]
    assert response_items('{"items": [{"x": 1}, {"attribute": "c"}]}') == ['{"attribute": "c"}'] and response_items(None) == []


def write_pages(folder):
    works = {"meta": {"next_cursor": "x"}, "results": [
        {"id": "https://openalex.org/W1", "doi": "https://doi.org/10.1/a", "title": "T", "abstract_inverted_index": {"b": [1], "a": [0]}, "open_access": {"oa_url": "u"}, "publication_date": "2024-05-02", "authorships": [{"author": {"display_name": "N"}}, {"author": {"display_name": ""}}]},
        {"id": "https://openalex.org/W2", "doi": None, "title": "U", "open_access": None, "publication_date": "2030-01-01"}]}
    items = {"message": {"next-cursor": "y", "items": [{"DOI": "10.1/a", "title": ["V"], "abstract": "<p>z</p>", "published": {"date-parts": [[2023, 7]]}, "link": [], "author": [{"given": "A", "family": "B"}, {}]}, {"DOI": "10.1/c", "published": {"date-parts": [[2020]]}}]}}
    for name, page in (("openalex", works), ("wiley", items)):
        (folder / name).mkdir(parents=True)
        (folder / name / "1.json").write_text(json.dumps(page))


def test_discover(spark, tmp_path):
    write_pages(tmp_path)
    papers = spark.createDataFrame([], "doi string, openalex_id string, semantic_scholar_id string")
    marks = spark.createDataFrame([("wiley", date(2021, 1, 1))], "source string, watermark date")
    warned: list[str] = []
    new, advanced = feeds.discover(spark, {"openalex": str(tmp_path / "openalex"), "wiley": str(tmp_path / "wiley"), "nope": "x"}, papers, marks, warned.append)
    got = {r.doi: r for r in new.collect()}
    assert list(got) == ["10.1/a"] and warned == ["unknown source nope"]
    assert {r.source: str(r.watermark) for r in advanced.collect()} == {"openalex": "2030-01-01", "wiley": "2023-07-01"}
    landed = {r.openalex_id: r for r in feeds.read_pages(spark, "openalex", str(tmp_path / "openalex")).collect()}
    assert (landed["W1"].abstract, landed["W1"].authors, landed["W2"].abstract) == ("a b", ["N"], None)
    registry = {r.doi: r for r in feeds.read_pages(spark, "wiley", str(tmp_path / "wiley")).collect()}
    assert registry["10.1/c"].oa_pdf_url.endswith("/articles/10.1/c") and registry["10.1/a"].authors == ["A B"]
    assert feeds.items_filter(["12345678"], date(2024, 1, 1)).endswith("issn:1234-5678,from-pub-date:2024-01-01") and feeds.search_query(" a*\n b ") == "a b"
    with pytest.raises(ValueError):
        feeds.items_filter([], None)


def test_retry():
    answers = iter([(429, {"Retry-After": "3"}, ""), (429, {}, ""), (200, {}, "ok")])
    slept: list[float] = []
    assert feeds.get_with_retry(lambda: next(answers), sleep=slept.append) == "ok" and slept == [3.0, 60.0]
    assert feeds.split_setting('["a", "b"]') == feeds.split_setting("a, b,") == ["a", "b"] and feeds.split_setting(" ") == []


def test_streamed_landing_is_idempotent(spark, tmp_path):
    write_pages(tmp_path / "in")
    run = lambda: ingest.land_stream(ingest.stream_feed(spark, "openalex", str(tmp_path / "in" / "openalex")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    run()
    (tmp_path / "in" / "openalex" / "2.json").write_text((tmp_path / "in" / "openalex" / "1.json").read_text())
    run()
    assert [r.openalex_id for r in spark.read.parquet(str(tmp_path / "out" / "batch=*")).collect()] == ["W1"]


def test_live_judgements(spark, tmp_path):
    (tmp_path / "votes").mkdir()
    lines = [{"id": i, "extraction_id": e, "vote": v, "created_at": "2024-01-01T00:00:00"} for i, (e, v) in enumerate([(1, True), (1, True), (1, False), (2, True), (2, False), (3, None)])]
    (tmp_path / "votes" / "a.json").write_text("\n".join(map(json.dumps, lines)))
    query = ingest.live_judgements(ingest.stream_votes(spark, str(tmp_path / "votes"))).writeStream.outputMode("complete").format("memory").queryName("judged").start()
    query.processAllAvailable()
    query.stop()
    assert {r.extraction_id: r.judgement for r in spark.sql("select * from judged").collect()} == {1: "valid", 2: None}


class Shout:
    def __call__(self, texts):
        if "bad" in texts:
            raise RuntimeError("no")
        return [x.upper() for x in texts]


def test_model_stage(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (3, "bad")], "id bigint, text string").coalesce(1)
    got = {r.id: (r.answer, r.error) for r in stages.run_model(frame, "id", "text", Shout(), chunk=2).collect()}
    assert got == {1: ("A", None), 2: (None, "empty answer"), 3: (None, "RuntimeError: no")}
    top = spark.createDataFrame([([(" True", -0.1), ("false", -2.5)],), ([("x", -1.0)],)], "t array<struct<token: string, logprob: double>>").select(stages.truth_confidence(F.col("t")).alias("c")).collect()
    assert top[0].c.relevant and top[0].c.confidence == pytest.approx(0.9168, abs=1e-3) and not top[1].c.relevant and top[1].c.confidence is None
    doc = spark.createDataFrame([(["---\nx: 1\n---\nA <table>", "<table>B"],)], "p array<string>").select(stages.tagged_pages(F.col("p")).alias("d")).first().d
    assert doc.startswith('<page number="0">\n\nA <table number="1">') and '<table number="2">B' in doc
    records = stages.extracted_records(spark.createDataFrame([(1, '{"items": [{"attribute": "a", "value": "1"}, {"attribute": "b"}]}')], "id bigint, answer string"), "id", "attribute string, value string").collect()
    assert [(r.id, r.record.attribute) for r in records] == [(1, "a")]


class Moody:
    """Fails at first, then answers one text more each time."""

    def __init__(self):
        self.turn = 0

    def __call__(self, texts):
        self.turn += 1
        if self.turn == 2:
            raise RuntimeError("busy")
        return [f"{{{x}}}" if i < self.turn else "?" for i, x in enumerate(texts)]


def test_answers_survive_a_later_failure():
    waits: list[float] = []
    answers, errors = stages._asked(["a", "b", "c"], Moody(), 3, lambda x: x.startswith("{"), 2.0, waits.append)
    assert answers == ["{a}", "{b}", "{c}"] and errors == [None] * 3 and waits == [2.0, 4.0]
    answers, errors = stages._asked(["a", "b"], Moody(), 2, lambda x: x.startswith("{"))
    assert answers == ["{a}", None] and errors == [None, "RuntimeError: busy"] and stages._asked([], Moody(), 2) == ([], [])


def test_records_become_rows(spark):
    records = spark.createDataFrame([(1, ("a", "1", "whole text", 3, 41.5)), (2, ("b", None, None, None, None))], "id bigint, record struct<attribute: string, value: string, context: string, page_number: int, lat: double>")
    rows = {r.id: r for r in stages.extraction_rows(records, "id", "s", "v", "lat", "lon").collect()}
    assert rows[1].data.asDict() == {"attribute": "a", "value": "1", "page_number": 3, "lat": 41.5} and (rows[1].latitude, rows[1].longitude) == (41.5, None)
    assert json.loads(rows[2].provenance) == dict.fromkeys(stages.PROVENANCE) and json.loads(rows[1].provenance)["page_number"] == 3


def test_pages_are_followed_to_the_last(spark, tmp_path):
    asked: list[dict] = []

    def transport(answers):
        left = iter(answers)

        def get(params):
            asked.append(params)
            return json.dumps(next(left))

        return get

    works = feeds.works_pages(transport([{"meta": {"next_cursor": "x"}, "results": []}, {"meta": {"next_cursor": None}, "results": []}]), ["T1"])
    saved: dict[str, str] = {}
    assert feeds.save_pages(works, date(2024, 1, 2), saved.__setitem__) == 2 and sorted(saved) == ["2024-01-02-000001.json", "2024-01-02-000002.json"]
    assert [p["cursor"] for p in asked] == ["*", "x"] and "from_publication_date:2024-01-02" in asked[0]["filter"]
    asked.clear()
    search = feeds.search_pages(transport([{"token": "t", "data": [1]}, {"token": "u", "data": []}]), "man*grove  reef")
    assert feeds.save_pages(search, None, lambda *_: None) == 2 and [p.get("token") for p in asked] == [None, "t"] and asked[0]["query"] == "mangrove reef"
    asked.clear()
    items = feeds.items_pages(transport([{"message": {"next-cursor": "y", "items": [1, 2]}}, {"message": {"next-cursor": "z", "items": [1]}}]), ["1234-5678"], size=2)
    assert feeds.save_pages(items, None, lambda *_: None) == 2 and [p["cursor"] for p in asked] == ["*", "y"]
    claimed, files = spark.range(4).withColumnRenamed("id", "paper_id"), spark.createDataFrame([(1, "x"), (3, "y"), (9, "z")], "paper_id bigint, text string")
    there, back = feeds.with_files(claimed, files, "paper_id")
    assert sorted(map(tuple, there.collect())) == [(1, "x"), (3, "y")] and sorted(r.paper_id for r in back.collect()) == [0, 2]


def test_idle_clock():
    now = [0.0]
    clock = stages.IdleClock(10, lambda: now[0])
    now[0] = 9
    assert not clock.done(0, 5) and clock.done(0, 0)
    assert not clock.done(1, 5)
    now[0] = 19
    assert clock.done(0, 5)
