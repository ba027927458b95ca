"""Site matching, leak search and scan repair on made-up cases with known truth."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import leaks, scans, sites

ENTITIES = "entity_id int, name string, latitude double, longitude double, location_description string, key string, anchors string"
REGISTRY = "registry_id bigint, site_name string, latitude double, longitude double, location string, key string, bits string"


def test_reading_names_and_places():
    assert sites.read_name("Marsh at Nesmarisin (in.)") == ("nesmarisin", "marsh", "inner")
    assert sites.read_name("Site Lo. Ulvnetórie, point (UL-3)") == ("ulvnetorie", "point", "lower")
    assert sites.read_name("") == sites.read_name(None) == (None, None, None)
    assert sites.read_location("TORGUDALE / Wenab Est.") == ("wenab estuary", "torgudale") == sites.read_location("Wenab Estuary (Torgudale Coast)")
    assert sites.read_location("north shore of Wenab Estuary in the Torgudale") == ("wenab estuary", "torgudale") and sites.read_location(None) == (None, None)


def test_one_edit_stays_within_the_radius():
    rng = random.Random(1)
    letters = "abcdefghilmnoprstuv"
    for _ in range(300):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(6, 14)))
        i = rng.randrange(len(word) - 1)
        other = rng.choice([word[:i] + word[i + 1] + word[i] + word[i + 2 :], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :], word[:i] + word[i] + word[i:]])
        a, b = sites.bit_chunks(word), sites.bit_chunks(other)
        assert sum((x ^ y).bit_count() for x, y in zip(a, b)) <= sites.RADIUS and any(x == y != 0 for x, y in zip(a, b))


def made_up_sites(spark, n=150):
    rng = random.Random(9)
    syllables = ["bar", "dol", "fen", "gri", "hal", "kel", "lem", "mor", "nes", "osk", "pir", "quen", "ras", "tam", "ulv", "zel"]
    core = lambda: "".join(rng.choice(syllables) for _ in range(4)).title()
    left, right, truth = [], [], set()
    for i in range(n):
        name, water, region, lat, lon = core(), core(), core(), rng.uniform(-60, 60), rng.uniform(-179, 179)
        typo = name[:3] + name[4] + name[3] + name[5:] if i % 3 == 0 else name
        far = i % 7 == 1
        left.append((i, None if i % 29 == 5 else f"{typo} Marsh", None if i % 5 == 2 else lat, None if i % 5 == 2 else lon, None if i % 6 == 4 else f"{water} Bay, {region} Shelf", "k", "a"))
        if i % 4 == 3:  # a neighbour, and a site of the same name elsewhere
            right.append((10_000 + i, f"North {name} Marsh", lat + 0.02, lon, f"{water} Bay, west side", "k", "b"))
            right.append((20_000 + i, f"{name} Marsh", -lat, lon / 2, f"{core()} Sound ({core()} Coast)", "k", "b"))
            left[-1] = (i, f"South {name} Marsh", lat, lon, f"{water} Bay, {region} Shelf", "k", "a")
        else:
            right.append((10_000 + i, f"{name} Saltmarsh", None if far else lat + 0.002, None if far else lon, f"{region.upper()} / {water} Bay", "k", "b"))
            truth.add((i, 10_000 + i))
    return spark.createDataFrame(left, ENTITIES), spark.createDataFrame(right, REGISTRY), truth


def test_sites(spark):
    left, right, truth = made_up_sites(spark)
    matches = sites.match_sites(left.unionByName(left.filter("entity_id = 1")), right)
    got = {tuple(r) for r in sites.same_sites(matches).collect()}
    assert not got - truth and len(got & truth) >= 0.93 * len(truth)
    assert all(0 <= r.confidence <= 1 for r in matches.collect())
    assert sites.match_sites(left.limit(0), right).count() == 0 and sites.match_sites(left, right.limit(0)).count() == 0


def passages():
    rng = random.Random(4)
    made = lambda n: ["".join(rng.choice(["ba", "ko", "li", "mur", "ten", "sta", "vo", "ri"]) for _ in range(3)) for _ in range(n)]
    who, did, what, rose, when = made(30), made(30), made(90), made(30), made(40)
    said = lambda: f"the {rng.choice(who)} {rng.choice(did)} that {rng.choice(what)} {rng.choice(what)} {rng.choice(rose)} above the {rng.choice(what)} {rng.choice(what)} at the {rng.choice(when)} {rng.randint(2, 99)} times"
    return [". ".join(said() for _ in range(5)) + ". What happened first?" for _ in range(40)], said


def test_leaks(spark):
    items, said = passages()
    rng = random.Random(8)
    filler = "Nitrate in the lagoon rose during the wet season while salinity near the mouth stayed close to its mean and turbidity fell. "
    docs, truth = [], set()
    for d in range(300):
        i = d % len(items)
        words = items[i].split()
        at = rng.randrange(len(words) - 26)
        kind = d % 4
        if kind == 0:
            piece = " ".join(words[at : at + 22]).upper().replace(" ", "  ")
        elif kind == 1:
            part = words[at : at + 24]
            part[11] = "perhaps"
            piece = "\n".join([" ".join(part[:6]), " ".join(part[6:])]).replace(",", ";")
        elif kind == 2:
            piece = " ".join(words[at : at + 8])  # short shared wording
        else:
            piece = said()
        docs.append((1000 + d, filler * rng.randint(0, 3) + piece + " " + filler * rng.randint(0, 3), 7))
        if kind < 2:
            truth.add((i, 1000 + d))
    docs += [(5000, None, 7), (5001, "", 7), (5002, " ".join(["word"] * 20_000) + " " + items[3], 7), (5003, "too short", 7)]
    truth.add((3, 5002))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    held = spark.createDataFrame([*enumerate(items), (900, None), (901, "five words are too few"), (902, "")], "item_id bigint, text string")
    got = {(r.item_id, r.doc_id) for r in leaks.leaked_items(frame.unionByName(frame.limit(1)), held).collect()}
    assert truth <= got and len(got - truth) <= 2
    assert leaks.leaked_items(frame, held.limit(0)).count() == 0 and leaks.leaked_items(frame.limit(0), held).count() == 0


def test_alignment():
    item = [f"w{i}" for i in range(40)]
    text = ["x"] * 9 + item[5:12] + ["new"] + item[12:20] + item[21:26] + ["y"] * 9
    matching, edits, score, spanned = leaks.aligned(item, text)
    assert (matching, edits, spanned) == (20, 2, 21) and score == pytest.approx(17)
    masks = {w: 1 << i for i, w in enumerate(item)}
    assert leaks.common_length(masks, 40, text) == 20 and leaks.common_length(masks, 40, ["q"]) == 0


def brute_score(item, words):
    """Local alignment cell by cell."""
    above, best = [0.0] * (len(words) + 1), 0.0
    for a in item:
        row = [0.0]
        for j, b in enumerate(words):
            row.append(max(0.0, above[j] + (1.0 if a == b else -leaks.EDIT_COST), above[j + 1] - leaks.EDIT_COST, row[j] - leaks.EDIT_COST))
        above, best = row, max(best, *row)
    return best


def test_alignment_equals_brute_force():
    rng = random.Random(21)
    item = [f"w{i}" for i in range(30)]
    three = item[:10] + ["x", "y", "z"] + item[10:20]
    assert leaks.aligned(item, three) == (20, 3, 15.5, 20)
    for _ in range(200):
        words = list(item[rng.randrange(10) : rng.randrange(18, 30)])
        for _ in range(rng.randrange(7)):
            i = rng.randrange(len(words))
            words[i : i + rng.randrange(3)] = [f"n{rng.randrange(9)}"] * rng.randrange(5) if rng.random() < 0.7 else [rng.choice(item)]
            words = words or ["none"]
        words = ["a"] * rng.randrange(4) + words + words[: rng.randrange(6)]
        matching, edits, score, _ = leaks.aligned(item, words)
        best = brute_score(item, words)
        assert score == pytest.approx(best if best >= leaks.LEAST_SCORE else 0) and score == pytest.approx(matching - leaks.EDIT_COST * edits)


@pytest.mark.parametrize("many", [160, 2000])
def test_every_passage_is_found_among_many_items(spark, many):
    """Candidate search in the latent space against alignment of every planted pair."""
    _, said = passages()
    items = [". ".join(said() for _ in range(4)) for _ in range(many)]
    rng = random.Random(many)
    docs, truth = [], set()
    for d in range(250):
        i = rng.randrange(many)
        words = items[i].split()
        at, size = rng.randrange(len(words) - 30), rng.choice([16, 18, 24])
        part = words[at : at + size]
        if d % 3 == 0:
            part[size // 2] = "perhaps"
        filler = "salinity near the mouth stayed close to its mean and turbidity fell again when the river ran dry "
        docs.append((d, filler * rng.randint(1, 4) + " ".join(part) + " " + filler * rng.randint(1, 4)))
        truth.add((i, d))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r.item_id, r.doc_id) for r in leaks.leaked_items(frame, spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")).collect()}
    assert len(truth & got) >= 0.98 * len(truth) and len(got - truth) <= 0.02 * len(truth)


def test_reworded_items_are_told_by_their_answers(spark):
    items, said = passages()
    words = items[5].split()
    again = " ".join(w if k % 3 else f"{w} indeed still" for k, w in enumerate(words))  # no run of it aligns
    other = " ".join(f"{w} indeed still" for k, w in enumerate(words) if k % 3 == 0)  # a third of it, no answers
    frame = spark.createDataFrame([(1, again), (2, other), (3, said())], "doc_id bigint, text string")
    got = {(r.item_id, r.doc_id): r for r in leaks.leaked_items(frame, spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")).collect()}
    assert set(got) == {(5, 1)} and got[5, 1].kind == "reworded" and got[5, 1].answers >= leaks.ANSWER_SHARE and got[5, 1].common > 0.8


KNOWN = "salinity nitrate turbidity sediment estuary lagoon mangrove stormwater photosynthesis denitrification remained increased between observed stations samples channel seasonal baseline inventory".split()
_rng = random.Random(11)
WORDS = sorted(set(KNOWN) | {"".join(_rng.choice(["sal", "tor", "min", "be", "lo", "ca", "ren", "du", "po", "sti", "gra", "ve"]) for _ in range(_rng.randint(2, 4))) for _ in range(250)})


def scanned(rng, broken: dict):
    """A made-up scan of several pages and what was done to it, by line number."""
    lines, truth = [], set()
    for page in range(5):
        lines += [f'<page number="{page}">', "", f"Journal of Tides {40 + page}", ""]
        truth.add((len(lines) - 1, "furniture"))
        if page == 2:
            lines += ["## Methods", ""]
        for row in range(14):
            if page != 2 and row == 7:
                lines += ["", "## Methods", ""]  # headings stand at the top of a page and inside
            words = [rng.choice(WORDS) for _ in range(8)]
            if rng.random() < 0.06:
                at, (seen, read) = rng.randrange(8), rng.choice([("o", "0"), ("l", "1"), ("e", "c"), ("s", "5")])
                words[at] = rng.choice([w for w in WORDS if seen in w and len(w) > 5]).replace(seen, read, 1)
                truth.add((len(lines) + 1, "glyph"))
            end = ""
            if rng.random() < 0.3:
                word = rng.choice([w for w in WORDS if len(w) > 7])
                end, rest = f" {word[:4]}-", word[4:]
                truth.add((len(lines) + 1, "hyphen"))
                lines += [" ".join(words) + end, rest + " " + " ".join(rng.choice(WORDS) for _ in range(7))]
            else:
                lines += [" ".join(words)]
        lines += ["", f"- {100 + page} -", "", "</page>", ""]
        truth.add((len(lines) - 3, "furniture"))
    return "\n".join(lines), truth


def test_scans(spark):
    rng = random.Random(2)
    made = {k: scanned(rng, {}) for k in range(40)}
    digital = "\n\n".join("Salinity remained close to the baseline in all of the sampled stations between the lagoon and the sea, as it did before." for _ in range(9))
    rows = [(k, text, "clash", 1) for k, (text, _) in made.items()] + [(900, digital, "c", 1), (901, None, "c", 1), (902, "", "c", 1), (903, " \n ", "c", 1), (3, made[3][0], "c", 2)]
    frame = spark.createDataFrame(rows, "paper_id bigint, context string, features string, line_no int")
    repair = scans.Repair(frame)
    got = {tuple(r) for r in repair.found().collect()}
    truth = {(k, no, kind) for k, (_, t) in made.items() for no, kind in t}
    for kind in ("furniture", "hyphen", "glyph"):
        mine, want = {x for x in got if x[2] == kind}, {x for x in truth if x[2] == kind}
        assert len(mine & want) >= 0.9 * len(want), (kind, len(mine), len(want), sorted(want - mine)[:5])
        assert len(mine & want) >= 0.9 * len(mine), (kind, len(mine), len(want), sorted(mine - want)[:5])
    text = {r.paper_id: r.paragraphs for r in repair.paragraphs().collect()}
    joined = " ".join(" ".join(p) for p in text.values())
    assert set(text) == set(made)
    assert joined.count("Journal of Tides") + joined.count("- 102 -") == 0
    assert joined.count("## Methods") >= 4 * len(made)
    words = joined.split()
    assert sum(any(c.isdigit() for c in w) for w in words) < 0.01 * len(words) and sum(w in set(WORDS) for w in words) > 0.98 * len(words)
    assert scans.found_noise(frame.limit(0)).count() == 0 and scans.repaired_text(frame.filter("paper_id = 900")).count() == 0


def test_a_null_id_is_an_id_like_others(spark):
    rng = random.Random(2)
    made = {k: scanned(rng, {}) for k in range(12)}
    rows = [(k, text) for k, (text, _) in made.items()] + [(None, made[3][0])]
    repair = scans.Repair(spark.createDataFrame(rows, "paper_id bigint, context string"))
    found = repair.found().collect()
    of = lambda k: sorted((r.line_no, r.kind) for r in found if r.paper_id == k)
    assert of(None) == of(3) and {kind for _, kind in of(3)} == {"furniture", "hyphen", "glyph"}
    text = {r.paper_id: r.paragraphs for r in repair.paragraphs().collect()}
    assert text[None] == text[3] and len(text) == 13
    assert repair.broken.filter(f"pid = {scans.NO_PAPER}").agg({"n_l": "max"}).first()[0] > 0


def test_scanned_pages_are_told_page_by_page():
    line = "the salinity of the lagoon remained close to what it was before the storm and the"
    scan = ['<page number="1">', *[line] * 100, "</page>"]
    digital = [x for k in range(10) for x in (f'<page number="{k + 2}">', *[y for _ in range(6) for y in (line * 3 + ".", "")], "</page>")]
    flags = scans.scanned_lines(scan + digital)
    assert all(flags[:102]) and not any(flags[102:]) and not any(scans.scanned_lines(digital))
    assert [r["no"] for r in scans.page_lines("\n".join(scan + digital))] == list(range(2, 102))
    wide = ["w" * 146] * 30
    assert all(scans.scanned_lines(wide)) and scans.scanned_lines([]) == [] and scans.page_lines("") == []
    mixed = [line] * 90 + [""] + [y for _ in range(60) for y in (line * 3 + ".", "")]
    assert all(scans.scanned_lines(mixed)[:90]) and not any(scans.scanned_lines(mixed)[120:])


def test_the_rest_of_a_broken_word_may_stand_far_off():
    row = lambda no, text, page, table=False: {"no": no, "text": text, "page": page, "table": table}
    rows = [row(1, "the sali-", 1), *(row(3 + k, "1 | 2 | 3", 1, True) for k in range(30)), row(40, "nity rose", 2)]
    assert scans._following(rows, 0)["no"] == 40
    assert scans._following([rows[0], row(40, "Nothing", 2), row(50, "nity", 3)], 0) is None


def test_confusions_that_share_no_gram_are_candidates_however_often_they_occur(spark):
    pairs = [("forclng", 60, "forcing", 20_000), ("earller", 5, "earlier", 1600), ("drlfted", 70, "drifted", 9000), ("prlmary", 51, "primary", 9000)]
    assert not any(set(scans._grams(a)) & set(scans._grams(b)) for a, _, b, _ in pairs)
    words = spark.createDataFrame([x for a, n, b, m in pairs for x in ((a, n, n), (b, m, m))], "word string, n bigint, n_low bigint")
    met = scans.candidate_words(words, spark.sparkContext.broadcast(scans.letter_model(words))).collect()
    assert {(r.word, r.n, r.true, r.n_true) for r in met} >= set(pairs) and len(met) == len({(r.word, r.true) for r in met})


def test_misspelt_sites_that_share_no_place(spark):
    same = "Orlfitenard Bay|Selistisar Inlet|Varnadekie Reef|Rasminisess Flat|Zelsofenard Lagoon|Yorsaverike Creek|Pelemdraave Pond|Biravlinemi Marsh".split("|")
    near = [("Falgamunorm Pond", "Falgamunorrm Tidal Pond"), ("Peldolokade Crk", "Pedolokade Creek"), ("Mormirelnch Inlet", "Mormirelach Inlet"), ("Elmlunoriss Marsh", "Elmounoriss Marsh")]
    pairs = [(n, n) for n in same] + near
    left = [(i, a, 10.0 + i, 20.0, None, "c", "c") if i % 2 else (i, a, None, None, f"Lake{i} Estuary", "c", "c") for i, (a, _) in enumerate(pairs)]
    right = [(1000 + i, b, None, None, f"Lake{i} Estuary", "c", "c") if i % 2 else (1000 + i, b, 10.0 + i, 20.0, None, "c", "c") for i, (_, b) in enumerate(pairs)]
    matches = sites.match_sites(spark.createDataFrame(left, ENTITIES), spark.createDataFrame(right, REGISTRY))
    assert sorted(tuple(r) for r in sites.same_sites(matches).collect()) == [(i, 1000 + i) for i in range(len(pairs))]
    assert matches.count() == matches.select("entity_id", "registry_id").distinct().count()


def test_words_hold_the_bits_of_a_vector_exactly(spark):
    """Also beside records without a name, whose words are null."""
    names = ["Falgamunorm Pond", None, "Peldolokade Creek", "", "Orlfitenard Bay near Selistisar"]
    rows = spark.createDataFrame([(i, n, 1.0, 2.0, "Torsa Bay") for i, n in enumerate(names)], "k int, n string, y double, x double, w string")
    got = {r.key: [r[c] for c in sites.NAME_WORDS] for r in sites.prepared(rows.coalesce(1), "k", "n", "y", "x", "w", 0.0).collect()}
    assert got == {i: sites.bit_words(sites.read_name(n)[0]) for i, n in enumerate(names)}
    assert got[1] == [None] * len(sites.NAME_WORDS) and max(got[0]) > 1 << 53


def test_every_pair_of_near_names_is_a_candidate(spark):
    """Against all pairs that share an anchor; names of two misspellings, short ones and long ones included."""
    rng = random.Random(11)
    letters = "abcdefghilmnoprstuv"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))

    def misspelt(name: str, times: int) -> str:
        for _ in range(times):
            i = rng.randrange(max(1, len(name) - 1))
            name = rng.choice([name[:i] + name[i + 1 : i + 2] + name[i : i + 1] + name[i + 2 :], name[:i] + name[i + 1 :] or name, name[:i] + rng.choice(letters) + name[i + 1 :], name[: i + 1] + name[i:]])
        return name

    names = [word(n) for n in (2, 3, 4, 5, 5, 6, 7, 8, 9, 10, 11, 12, 14, 17, 22, 27, 32) for _ in range(6)]
    place = lambda i: (10.0, 20.0, None) if i % 3 == 0 else (None, None, "Torsa Bay") if i % 3 == 1 else (None, None, None)
    left = [(i, n, *place(i)) for i, n in enumerate(names)]
    right = [(1000 + 10 * i + k, misspelt(n, k), *place(i)) for i, n in enumerate(names) for k in (1, 2, 3)]
    a, b = (sites.prepared(spark.createDataFrame(x, "k int, n string, y double, x double, w string"), "k", "n", "y", "x", "w", km) for x, km in ((left, 0.0), (right, sites.NEAR_KM)))

    def near(p, q) -> bool:
        p, q = ({i for c, chunk in enumerate(sites.bit_chunks(sites.read_name(t)[0])) for i in range(c * 64, c * 64 + 64) if chunk >> (i - c * 64) & 1} for t in (p, q))
        return len(p ^ q) <= sites.RADIUS or 2 * len(p & q) / (len(p) + len(q)) >= 0.7

    want = {(i[0], j[0]) for i in left for j in right if sites.read_name(i[1])[0] and sites.read_name(j[1])[0] and near(i[1], j[1])}
    found = [(r.a_key, r.b_key) for r in sites.candidate_pairs(a, b).collect()]
    assert len(found) == len(set(found)) and set(found) == want
