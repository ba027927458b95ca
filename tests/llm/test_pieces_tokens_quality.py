"""Splitting, tokens and text statistics on small and odd texts."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import pieces, quality, tokens

CONTEXT = "paper_id bigint, context string, text string, page_number int"


def test_pages():
    text = '<page number="3"> a\n\n<page number=\'4\'>\nbb</page> tail <page number="5">'
    assert [(n, text[a:b]) for n, a, b in pieces.pages(text)] == [(3, "a"), (4, "bb"), (5, "")]
    assert pieces.pages(" xy ") == [(0, 1, 3)] and pieces.pages("") == [(0, 0, 0)]


def test_pieces_cover_and_overlap():
    rng = random.Random(3)
    bits = ["Word", "tide. ", "Salt\n", "\n\n", "## Head\n", "- item\n", "<table><tr><td>1</td></tr></table>\n", "1|2|3|", " ", "é", "x" * 700]
    for _ in range(120):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 900)))
        spans = pieces.split_text(text, 500, 60)
        assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(b - a <= 500 for a, b in spans)
        assert all(q[0] == max(0, p[1] - 60) and q[1] > p[1] for p, q in zip(spans, spans[1:]))
        assert len(text) > 500 or len(spans) == 1


def test_pieces_end_at_sentences():
    text = " ".join(f"Sentence number {i} ends here." for i in range(300))
    assert all(text[:b].rstrip().endswith(".") for _, b in pieces.split_text(text))


def test_only_oversized_nodes_are_opened():
    """Sections that fit stay whole or are merged; what an opened section leaves isn't put together with its sibling."""
    sentence = "The salinity of the lagoon rose after the storm. "
    small = [f"### A{i} small\n{sentence * 3}\n" for i in range(3)]
    text = "# Top\n\n" + f"### A1 large\n{sentence * 30}\n" + "".join(small) + "## B\n" + sentence * 20
    spans = pieces.split_text(text, 700, 60)
    ends = [b for _, b in spans]
    second = text.index("### A0")
    assert second in ends and text.index("## B") in ends and len(small[0]) * 3 < 640
    assert not any(second < e < text.index("## B") for e in ends)


def test_nested_lists_and_tables():
    items = "".join(f"- item {i}\n" + "".join(f"  - part {i}.{k} of the same item\n" for k in range(4)) for i in range(12))
    ends = [b for _, b in pieces.split_text(items, 400, 40)]
    assert all(items[e:].startswith("- item") or e == len(items) for e in ends) and len(ends) > 3
    table = "<table>" + "".join(f"<tr><td>{i}</td><td>value; of, a cell</td></tr>" for i in range(60)) + "</table>"
    assert all(table[e:].startswith(("<tr", "</table")) or e == len(table) for _, e in pieces.split_text(table, 500, 50))
    deep = "".join(" " * i + "- x\n" for i in range(3000))
    assert all(b - a <= 500 for a, b in pieces.split_text(deep, 500, 50))


def test_split_contexts(spark):
    long = "A sentence of words. " * 200
    rows = [(1, f'<page number="0">short</page><page number="1">{long}</page><page number="1">{long}', "x", 1), (2, None, "x", 1), (3, "", "x", 1), (None, "   ", "x", 1), (4, "y" * 100_000, "x", 1), (4, "y" * 100_000, "x", 1)]
    out = pieces.split_contexts(spark.createDataFrame(rows, CONTEXT)).collect()
    assert all(len(r.text) <= 2000 for r in out) and not [r for r in out if r.paper_id == 2]
    assert [(r.unit, r.text) for r in out if r.paper_id == 3] == [("page", ""), ("context", "")]
    found = pieces.oversized_pages(spark.createDataFrame([tuple(r) for r in out], pieces.SCHEMA)).collect()
    assert sorted(map(tuple, found)) == [(1, 1), (4, 0)]
    assert pieces.split_contexts(spark.createDataFrame([], CONTEXT)).count() == 0


@pytest.fixture(scope="module")
def encoding():
    return tokens.encoder(tokens.load_ranks(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"))


def test_parts_encode_like_the_whole(encoding):
    rng = random.Random(5)
    bits = ["word", " ", "  ", "\n", "\n\n", "'s", "'ll", "12", "é", "漢字", "🏝️", "\t", "...", " x", " ", "<|endoftext|>"]
    for _ in range(60):
        text = "".join(rng.choice(bits) for _ in range(400))
        whole = encoding.encode_ordinary(text)
        assert [i for p in tokens.safe_parts(text, 40) for i in encoding.encode_ordinary(p)] == whole
        assert tokens.decode(whole, encoding) == text


def test_encode_documents(spark, encoding):
    texts = ["Hello world", None, "", "  ", "<|endoftext|>", "long word " * 9000, "Hello world"]
    frame = spark.createDataFrame([(i, x, [1]) for i, x in enumerate(texts)], "doc_id bigint, text string, ids array<int>")
    got = {r.doc_id: r.ids for r in tokens.encode_documents(frame).collect()}
    assert got == {i: encoding.encode_ordinary(x or "") for i, x in enumerate(texts)} and got[1] == got[2] == [] and 50256 not in got[4]
    assert all(r.same for r in tokens.round_trip(frame).collect()) and tokens.encode_documents(frame.limit(0)).count() == 0


PROSE = "Nitrate in the lagoon rose sharply during the wet season. It isn't clear whether the tide or the river set the flux. We measured it twice."
JUNK = {
    "list": "\n".join(f"{i}) tidal creek" for i in range(20)),
    "table": "\n".join(f"| Reef {i} | 1.2 | 3.4 |" for i in range(9)),
    "fixed": "\n".join(f"nitrate {i}            1.2      3.4     n.d." for i in range(9)),
    "log": "\n".join(f"2024-01-0{i} 10:00:00 [INFO] sonde_1 salinity=3.4" for i in range(1, 9)),
    "reference": "\n".join(f"Kelren D., Pelro L. (19{80 + i}) Benthic respiration in the mudflat. Annals of Shore Studies 40:62-35{i}" for i in range(9)),
    "nav": "Home | Search | Print | Log in | Terms | Next >",
    "cloud": "NO3 kelp bed " * 40,
    "noise": "{%~ 1#~@ ¤I }{^@ l% {=™ <¶|" * 5,
    "csv": "id;date;station;attr;val\n" + "\n".join(f"{i};2003;ST28;nitrate;5.1" for i in range(9)),
    "names": "\n".join(["Kroriti Reef", "filtered grab samples", "denitrification", "a towed profiler", "Selte Creek", "salinity"]),
}


def test_verdicts():
    share = quality.STATS.names.index("prose_share")
    rng = random.Random(3)
    pick = lambda words: rng.choice(words.split())
    said = lambda: f"The {pick('salinity depth colour level smell name shape')} of the {pick('lagoon river marsh reef bay delta creek')} {pick('rose fell stayed changed grew')} {pick('after before during with')} the {pick('storm flood drought winter tide harvest')}, and {pick('fish birds boats weeds sands')} {pick('came left moved turned')} {pick('up down in out over')} as they had {pick('always never once often')} been."
    long = " ".join(said() for _ in range(40))
    assert quality.describe(PROSE)[share] == 1.0 and quality.describe(PROSE)[-1]
    for kind, text in JUNK.items():
        assert quality.describe(text)[share] < 0.3, kind
        assert not quality.describe(text)[-1], kind
        assert quality.describe(f"{long}\n\n{text}")[-1], kind
    wrapped = "Nitrate in the lagoon rose\nsharply during the wet season\nand it fell again when the\nriver ran dry in the summer."
    assert quality.describe(wrapped)[-1]
    for other in ("Se tomaron muestras de agua en la laguna con una sonda en el verano.", "Wie stark die Erwärmung den Sauerstoffgehalt prägt, blieb im Jahr 1991 offen.", "Replicates (n = 37) agreed within 8%, except across three years."):
        assert quality.describe(other)[-1], other


def test_repetition():
    at = {n: i for i, n in enumerate(quality.STATS.names)}
    row = quality.describe("a b c d e\na b c d e\n\nx")
    assert row[at["duplicate_line_share"]] == pytest.approx(9 / 19) and row[at["n_lines"]] == 3 and row[at["repeated_5gram_coverage"]] > 0.4
    assert quality.describe(None) == (None,) * len(at) and quality.describe(" \n")[at["is_prose"]] is False and quality.describe("")[0] == 0


def test_repetition_decides(spark):
    """The same sentences again and again are no prose, though each of them is one."""
    at = {n: i for i, n in enumerate(quality.STATS.names)}
    line = "Nitrate in the lagoon rose sharply during the wet season of that year.\n"
    row = quality.describe(line * 200)
    assert row[at["duplicate_line_share"]] > 0.99 and row[at["boilerplate_share"]] == pytest.approx(0.99) and not row[at["is_prose"]]
    assert not quality.describe(line.strip().replace(".", "") * 1 + " " + "the same few words of the river and the lagoon " * 40 + ".")[at["is_prose"]]
    assert quality.describe(line * 2)[at["is_prose"]] and quality.describe(line)[at["is_prose"]]


def test_text_quality(spark):
    frame = spark.createDataFrame([(1, PROSE, 1), (2, None, 1), (3, " ", 1), (4, JUNK["list"], 1), (4, JUNK["list"], 1), (5, "word " * 30_000, 1)], "doc_id bigint, text string, n_words int")
    got = quality.text_quality(frame)
    assert sorted(r.doc_id for r in quality.not_prose(got).collect()) == [4, 4, 5] and got.count() == 6
    assert quality.text_quality(frame.limit(0)).count() == 0
