"""Scanned page text into continuous paragraphs: furniture, line-end hyphens and misread characters.

Three trained parts work together. A line classifier finds what belongs to the printed page. A line-pair classifier
decides whether a hyphen at a line's end vanishes. A boosted ranking chooses corrections for words, which character
q-gram joins retrieve from the corpus' own vocabulary. All labels come from the corpus: repeated page edges, words that
occur whole elsewhere, and vocabulary words misread on purpose.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.boosting import BoostedTrees
from tidemark.llm.pieces import _CLOSE, _OPEN
from tidemark.operators.sampling import hash_sample
from tidemark.operators.skew import attach_group
from tidemark.session import checkpointed

#: Each classifier is trained on at most this many rows; counts, vocabulary and decisions cover every row.
TRAINING_LINES, TRAINING_HYPHENS, TRAINING_WORDS = 30_000, 10_000, 4_000
#: Furniture is looked for among so many lines from either edge of a page.
EDGE_LINES = 3
#: A stretch of a context is scanned if this share of its longer lines goes on in the next line; the share of the whole
#: context counts like so many lines of the stretch. Pages without tags are cut into stretches of so many lines.
WRAPPED_FROM, CONTEXT_WEIGHT, STRETCH_LINES = 0.3, 5, 80
#: Decisions are taken from this probability on.
FURNITURE_FROM, HYPHEN_FROM, MISREAD_FROM = 0.5, 0.5, 0.5
#: A correction that isn't in the vocabulary itself needs more: right words without a known neighbour are far more
#: common than misread ones, so they weigh more in training.
UNSEEN_FROM, UNSEEN_WEIGHT = 0.97, 8.0
#: Words of more characters meet by halves of their shape.
LONG_WORD = 40
#: How often one form of a misreading occurs for each time its word does, roughly.
MISREAD_RATE = 0.004

#: What was printed, and what a reader takes it for.
CONFUSIONS = (
    ("o", "0"), ("l", "1"), ("i", "1"), ("i", "l"), ("l", "i"), ("e", "c"), ("c", "e"), ("a", "o"), ("o", "a"), ("t", "f"), ("f", "t"),
    ("s", "5"), ("h", "b"), ("b", "h"), ("g", "q"), ("q", "g"), ("v", "y"), ("b", "6"), ("g", "9"), ("z", "2"),
    ("d", "cl"), ("cl", "d"), ("u", "ii"), ("m", "rn"), ("rn", "m"), ("w", "vv"), ("nn", "m"), ("h", "li"), ("n", "ri"), ("m", "nn"),
)
#: Characters and pairs that are taken for each other share one shape; shapes are what q-grams are taken from.
_PAIR_SHAPES = (("rn", "m"), ("nn", "m"), ("vv", "w"), ("cl", "d"), ("ii", "u"), ("li", "h"), ("ri", "n"))
_SHAPES = str.maketrans("01i|cao5h6q9yf2", "ollleoosbbggvtz")
MARKS = "-‐¬­"
#: Stands for a null paper_id inside of the joins.
NO_PAPER = -(1 << 63)

_DIGITS, _HASHES, _BETWEEN = re.compile(r"\d+"), re.compile(r"#+"), re.compile(r"\W+")
_ROMAN = re.compile(r"[ivxlc]{1,8}")
_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_TAG = re.compile(r"^\s*</?(?:page|table|tr|td|th)\b", re.I)
_TABLE, _TABLE_END, _ROW = re.compile(r"<table\b", re.I), re.compile(r"</table>", re.I), re.compile(r"<(?:tr|table)\b", re.I)
_HEAD = re.compile(r"^\s*(?:#{1,6}\s|\d+(?:\.\d+)*\.?\s+[A-Z])")
_NUMERAL = r"(?:page\s+|p\.\s*)?(?:(?-i:[\dOolIiSB]{1,5})|[ivxlc]{1,8})(?:\s*(?:of|/)\s*(?-i:[\dOolISB]{1,5}))?"
_PAGE_NO = re.compile(rf"^(?:{_NUMERAL}|[-–—|]\s*{_NUMERAL}\s*[-–—|]|\(\s*{_NUMERAL}\s*\)|\[\s*{_NUMERAL}\s*\])$", re.I)

#: The word pattern in Spark's dialect: letters and digits, with apostrophes inside.
WORD = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"


def shape(word: str) -> str:
    low = word.lower()
    for pair, one in _PAIR_SHAPES:
        low = low.replace(pair, one)
    return low.translate(_SHAPES)


def edge_key(line: str) -> str:
    """A page edge without its numbers and without what is often misread."""
    return _BETWEEN.sub(" ", _HASHES.sub("#", shape(_DIGITS.sub("#", line)))).strip() if line else ""


LINES = T.StructType(
    [
        T.StructField("pid", T.LongType()), T.StructField("version", T.LongType()), T.StructField("line_no", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("page", T.IntegerType()), T.StructField("body", T.BooleanType()), T.StructField("joins", T.BooleanType()), T.StructField("begun", T.BooleanType()),
        T.StructField("next_no", T.LongType()), T.StructField("next_text", T.StringType()), T.StructField("mark_share", T.DoubleType()),
        T.StructField("features", T.ArrayType(T.FloatType())), T.StructField("repeats", T.IntegerType()), T.StructField("key", T.LongType()),
    ]
)
_ARROW_LINES = pa.schema(
    [("pid", pa.int64()), ("version", pa.int64()), ("line_no", pa.int64()), ("text", pa.string()), ("page", pa.int32()), ("body", pa.bool_()), ("joins", pa.bool_()), ("begun", pa.bool_()),
     ("next_no", pa.int64()), ("next_text", pa.string()), ("mark_share", pa.float64()), ("features", pa.list_(pa.float32())), ("repeats", pa.int32()), ("key", pa.int64())]
)
FEATURES = (
    "top", "bottom", "blank_before", "blank_after", "after_table", "length", "relative", "digits", "upper", "page_number", "roman", "repeats", "sequence",
    "sentence_end", "numbered_end", "heading", "pages", "words", "lower_start", "inside", "next_lower", "inner_lines", "edge_lines",
)
_REPEATS, _SEQUENCE, _TOP, _BOTTOM = (FEATURES.index(n) for n in ("repeats", "sequence", "top", "bottom"))


def wrapped_lines(lines: list[str]) -> list[bool | None]:
    """Of each line whether its paragraph goes on in the next one; None for short lines, tables and tags."""
    flow = [bool(s.strip()) and not _TAG.match(s) and s.count("|") < 2 for s in lines]
    follows = flow[1:] + [False]
    return [(after and s.rstrip()[-1:] not in ".!?:;") if ok and len(s) > 20 else None for s, ok, after in zip(lines, flow, follows)]


def scanned_lines(lines: list[str]) -> list[bool]:
    """Which lines of a context come from a scan, where paragraphs run over lines, decided for each page by itself.

    A page is a stretch; a long one, such as a context without tags, is cut at blank lines into several. A stretch of a
    few lines goes with its context.
    """
    wrapped = wrapped_lines(lines)
    known = [w for w in wrapped if w is not None]
    share = sum(known) / len(known) if known else 0.0
    out: list[bool] = []
    stretch: list[int] = []

    def close() -> None:
        own = [wrapped[i] for i in stretch if wrapped[i] is not None]
        scanned = bool(known) and sum(own) + CONTEXT_WEIGHT * share >= WRAPPED_FROM * (len(own) + CONTEXT_WEIGHT)
        out.extend([scanned] * len(stretch))
        stretch.clear()

    for i, line in enumerate(lines):
        if stretch and (_OPEN.search(line) or not line.strip() and len(stretch) >= STRETCH_LINES):
            close()
        stretch.append(i)
    close()
    return out


def page_lines(context: str) -> list[dict]:
    """The text lines of the scanned pages of a context, each with its place on the page; none for a digital one."""
    lines = [s.rstrip("\r") for s in context.split("\n")]
    scanned = scanned_lines(lines)
    if not any(scanned):
        return []
    page, table, rows, pages = 0, False, [], defaultdict(list)
    for no, line in enumerate(lines, 1):
        if _OPEN.search(line):
            page += 1
        tagged = bool(_TAG.match(line)) or bool(_CLOSE.search(line))
        if _TABLE.search(line):
            table = True
        inside = table or tagged or line.count("|") >= 2
        if _TABLE_END.search(line):
            table = False
        if not scanned[no - 1] or not line.strip() or tagged and not _ROW.search(line):
            continue
        row = {"no": no, "text": line.strip(), "page": page, "table": inside, "before": not lines[no - 2].strip() or bool(_TAG.match(lines[no - 2])) if no > 1 else True,
               "after": not lines[no].strip() or bool(_TAG.match(lines[no])) if no < len(lines) else True}
        pages[page].append(row)
        rows.append(row)
    _place(pages)
    return rows


def _place(pages: dict[int, list[dict]]) -> None:
    body = [len(r["text"]) for rs in pages.values() for r in rs if not r["table"]]
    width = float(np.quantile(body, 0.8)) if body else 1.0
    seen: Counter = Counter()
    offsets: Counter = Counter()
    for number, rs in pages.items():
        for i, r in enumerate(rs):
            r["top"], r["bottom"] = i, len(rs) - 1 - i
            r["after_table"] = i > 0 and rs[i - 1]["table"]
            r["key"] = edge_key(r["text"])
        for key in {(r["key"], r["top"] < 2) for r in rs if not r["table"] and min(r["top"], r["bottom"]) < EDGE_LINES}:
            seen[key] += 1
        for value in {(v, r["top"] < 2) for r in rs if not r["table"] and min(r["top"], r["bottom"]) < EDGE_LINES for v in _numbers(r["text"])}:
            offsets[(value[0] - number, value[1])] += 1
    for number, rs in pages.items():
        for r in rs:
            t = r["text"]
            letters = sum(map(str.isalpha, t))
            near = min(r["top"], r["bottom"]) < EDGE_LINES
            r["repeats"] = seen[(r["key"], r["top"] < 2)] if near else 0
            sequence = max((offsets[(v - number, r["top"] < 2)] for v in _numbers(t)), default=0) if near else 0
            r["features"] = [
                min(r["top"], 4), min(r["bottom"], 4), r["before"], r["after"], r["after_table"], min(len(t), 150), len(t) / max(width, 1),
                sum(map(str.isdigit, t)) / max(len(t), 1), sum(map(str.isupper, t)) / max(letters, 1), bool(_PAGE_NO.match(t)), bool(_ROMAN.fullmatch(t)),
                min(r["repeats"], 6), min(sequence, 6), t[-1:] in ".!?;,", t[-1:].isdigit() or t[:1].isdigit(), bool(_HEAD.match(t)), min(len(pages), 6),
                min(len(t.split()), 20), t[:1].islower(), len(rs) > 6, _goes_on(rs, r["top"]), 0, 0,
            ]


def _goes_on(rows: list[dict], i: int) -> bool:
    """Whether the next line of the page follows at once and doesn't begin anew."""
    return i + 1 < len(rows) and rows[i + 1]["no"] == rows[i]["no"] + 1 and not rows[i + 1]["text"][:1].isupper()


def _numbers(text: str) -> list[int]:
    out = [int(x) for x in re.findall(r"(?<![\d.])\d{1,5}(?![\d.])", text)]
    if _ROMAN.fullmatch(text.strip(" -–[]().")):
        out.append(_roman(text.strip(" -–[]().")))
    return out


def _roman(text: str) -> int:
    values = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
    total = 0
    for a, b in zip(text, text[1:] + " "):
        total += -values[a] if b != " " and values[a] < values[b] else values[a]
    return total


def scan_lines(contexts: DataFrame) -> DataFrame:
    """LINES of every scanned context, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for paper, version, context in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows = page_lines(context)
                ends = Counter(r["text"][-1] for r in rows if not r["table"] and r["text"][-1] in MARKS and r["text"][-2:-1].isalpha())
                total = sum(ends.values())
                follows = [_following(rows, i) if not r["table"] and r["text"][-1] in MARKS and r["text"][-2:-1].isalpha() else None for i, r in enumerate(rows)]
                begun = {f["no"] for f in follows if f}
                for r, follow in zip(rows, follows):
                    out.append((
                        paper, version, r["no"], r["text"], r["page"], not r["table"], follow is not None, r["no"] in begun, follow and follow["no"], follow and follow["text"],
                        ends[r["text"][-1]] / total if follow else None, r["features"], r["repeats"], _hash(r["key"]) if not r["table"] and r["key"] else None,
                    ))
            if out:
                columns = list(zip(*out))
                arrays = [_matrix(c) if f.name == "features" else pa.array(c, f.type) for c, f in zip(columns, _ARROW_LINES)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW_LINES)

    pid = F.coalesce(F.col("paper_id").cast("bigint"), F.lit(NO_PAPER))
    source = contexts.filter("context is not null").select(pid.alias("pid"), F.xxhash64("context").alias("version"), "context").distinct()
    return source.mapInArrow(run, LINES)


def _matrix(rows: tuple[list, ...]) -> pa.Array:
    """Lists of the same length as one Arrow array."""
    flat = np.array(rows, dtype=np.float32)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _paper() -> Column:
    return F.nullif("pid", F.lit(NO_PAPER)).alias("paper_id")


def _following(rows: list[dict], i: int) -> dict | None:
    """The line that goes on with the word at the end of line i: the next one, or the first such one of the next page."""
    pages = 0
    for before, r in zip(rows[i:], rows[i + 1 :]):
        pages += r["page"] != before["page"]
        if pages > 1:
            return None
        if r["table"]:
            continue
        if r["text"][:1].isalpha() and (r["text"][:1].islower() or r["no"] == rows[i]["no"] + 1) or r["text"][:1].isdigit() and re.match(r"\d*[a-z]", r["text"]) and r["no"] == rows[i]["no"] + 1:
            return r
        if r["page"] == rows[i]["page"] and r["no"] == rows[i]["no"] + 1:
            return None
    return None


# --- furniture


def count_places(lines: DataFrame) -> DataFrame:
    """Adds to the features how often else a line stands inside of pages and at edges, over the whole corpus.

    A section heading stands inside of pages as well, a running head only at their edges.
    """
    edge = F.least(F.get("features", F.lit(_TOP)), F.get("features", F.lit(_BOTTOM))) < 2
    places = lines.filter("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.sum((~edge).cast("int")).alias("inner_n"), F.countDistinct(F.when(edge, F.struct("pid", "version"))).alias("edge_n"))
    counted = attach_group(lines, places.filter("n > 1"), ["key"], "n", "left")
    log = lambda c: F.log1p(F.least(F.coalesce(c, F.lit(0)), F.lit(50))).cast("float")
    others = F.col("inner_n") - (~edge).cast("int")
    return counted.withColumn("features", F.concat(F.slice("features", 1, len(FEATURES) - 2), F.array(log(others), log(F.col("edge_n"))))).drop("inner_n", "edge_n", "key")


def fit_furniture(lines: DataFrame) -> BoostedTrees:
    """Trains on page edges that repeat or count on from page to page, against the lines inside of pages.

    Half of the training edges hide their repetition, so the form of a running head is learned as well; short lines
    inside of pages also take part as if they stood at an edge, so headings are told from running heads.
    """
    keys = ("pid", "version", "line_no")
    sample = hash_sample(lines.filter("body").select("features", *keys), TRAINING_LINES, *keys).select("features", "draw", "line_no").toPandas().sort_values(["draw", "line_no"])
    x = np.array(sample["features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    edge = np.minimum(x[:, _TOP], x[:, _BOTTOM])
    sure = (edge <= 1) & ((x[:, _REPEATS] >= 3) | (x[:, _SEQUENCE] >= 3) & ((x[:, FEATURES.index("page_number")] > 0) | (x[:, FEATURES.index("relative")] < 0.9)))
    sure |= (x[:, _BOTTOM] == 0) & (x[:, FEATURES.index("page_number")] > 0) & (x[:, FEATURES.index("blank_before")] > 0)
    inner = edge >= 3
    headings = (x[:, FEATURES.index("inner_lines")] > math.log(2.5)) & (x[:, FEATURES.index("page_number")] == 0)
    heading_edge = (edge <= 1) & headings
    sure &= ~headings & ~((x[:, _BOTTOM] == 0) & (x[:, FEATURES.index("blank_before")] == 0) & (x[:, FEATURES.index("sentence_end")] > 0))
    rng = np.random.default_rng(5)
    hidden = x[sure].copy()
    hidden[:, [_REPEATS, _SEQUENCE]] = rng.integers(1, 3, (len(hidden), 1))
    short = x[inner & (x[:, FEATURES.index("relative")] < 0.85)].copy()
    short[:, _TOP] = rng.integers(0, 2, len(short))
    short[:, [_REPEATS, _SEQUENCE]] = rng.integers(0, 2, (len(short), 2))
    low = x[inner].copy()[: 2 * len(hidden) + 50]
    low[:, _BOTTOM] = rng.integers(0, 2, len(low))
    low[:, [_REPEATS, _SEQUENCE]] = rng.integers(0, 2, (len(low), 2))
    first = x[inner].copy()[: 2 * len(hidden) + 50]
    first[:, _TOP] = 0
    first[:, [_REPEATS, _SEQUENCE]] = 1
    flow = x[(x[:, _BOTTOM] == 0) & (x[:, FEATURES.index("blank_before")] == 0) & (x[:, FEATURES.index("sentence_end")] > 0)]
    data = np.concatenate([x[sure], hidden, x[inner], short, low, first, x[heading_edge], flow])
    y = np.concatenate([np.ones(sure.sum() + len(hidden)), np.zeros(inner.sum() + len(short) + len(low) + len(first) + heading_edge.sum() + len(flow))])
    order = rng.permutation(len(y))
    return BoostedTrees(trees=60, depth=4).fit(data[order], y[order]) if len(y) and 0 < y.mean() < 1 else BoostedTrees()


def mark_furniture(lines: DataFrame, model: BoostedTrees) -> DataFrame:
    known = lines.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(features: pd.Series) -> pd.Series:
        x = np.array(features.tolist(), dtype=float).reshape(-1, len(FEATURES))
        p = np.zeros(len(x))
        near = np.minimum(x[:, _TOP], x[:, _BOTTOM]) < EDGE_LINES
        ends = (x[:, _BOTTOM] == 0) & (x[:, FEATURES.index("sentence_end")] > 0) & (x[:, FEATURES.index("page_number")] == 0)
        running = ends & ((x[:, FEATURES.index("blank_before")] == 0) | (x[:, _REPEATS] < 3) & (x[:, FEATURES.index("words")] >= 4))
        near &= ~running  # the end of a paragraph
        if known.value.edges and near.any():
            p[near] = known.value.probability(x[near])
        return pd.Series(p)

    return lines.withColumn("furniture", F.col("body") & (chance("features") >= FURNITURE_FROM)).drop("features")


# --- vocabulary and hyphens


def broken_words(lines: DataFrame) -> DataFrame:
    """Lines that end in a hyphen mark, with the fragments of the broken word on both sides."""
    left = F.regexp_extract("text", r"([\p{L}\p{N}'’]+)[-‐¬­]$", 1)
    right = F.regexp_extract("next_text", r"^([\p{L}\p{N}'’]+)", 1)
    own = F.regexp_extract("text", r"([\p{L}\p{N}'’]+-)[\p{L}\p{N}'’]+[-‐¬­]$", 1)
    return lines.filter("joins and not furniture").select(
        "pid", "version", "line_no", "next_no", "mark_share", F.substring("text", -1, 1).alias("mark"),
        F.lower(left).alias("left"), F.lower(right).alias("right"), (own != "").alias("compound_left"), left.rlike(r"^\p{Lu}").alias("capital"),
    ).filter("left <> '' and right <> ''")


def vocabulary(lines: DataFrame) -> DataFrame:
    """(word, n, n_low): words and hyphenated compounds of running text in lower case, and how often they begin so.

    Fragments of words that are broken at a line's end don't count.
    """
    text = F.when(F.col("joins"), F.regexp_replace("text", r"[^\s]+$", "")).otherwise(F.col("text"))
    text = F.when(F.col("begun"), F.regexp_replace(text, r"^[^\s]+", "")).otherwise(text)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    compounds = F.regexp_extract_all(text, F.lit(r"[\p{L}]+(?:-[\p{L}]+)+"), F.lit(0))
    said = lines.filter("body and not furniture").select(F.explode(F.concat(words, compounds)).alias("said"))
    return said.groupBy(F.lower("said").alias("word")).agg(F.count("*").alias("n"), F.sum((~F.col("said").rlike(r"^\p{Lu}")).cast("bigint")).alias("n_low"))


def hyphen_features(broken: DataFrame, words: DataFrame) -> DataFrame:
    """The broken words with the counts of what they may be: one word, a compound, or two words."""
    asked = broken.select(
        "pid", "version", "line_no",
        F.explode(F.array(F.struct(F.lit("joined").alias("what"), F.concat("left", "right").alias("word")), F.struct(F.lit("compound").alias("what"), F.concat_ws("-", "left", "right").alias("word")),
                          F.struct(F.lit("l").alias("what"), F.col("left").alias("word")), F.struct(F.lit("r").alias("what"), F.col("right").alias("word")))).alias("q"),
    ).select("pid", "version", "line_no", "q.*")
    needed = asked.groupBy("word").agg(F.count("*").alias("asked")).join(words.select("word", "n"), "word")
    counts = attach_group(asked, needed.select("word", "n", "asked"), ["word"], "asked", "inner")
    wide = counts.groupBy("pid", "version", "line_no").agg(*[F.max(F.when(F.col("what") == w, F.col("n"))).alias(f"n_{w}") for w in ("joined", "compound", "l", "r")])
    return broken.join(wide, ["pid", "version", "line_no"], "left").fillna(0, [f"n_{w}" for w in ("joined", "compound", "l", "r")])


_HYPHEN_COLUMNS = ["mark", "mark_share", "left", "right", "n_joined", "n_compound", "n_l", "n_r", "compound_left"]


def _hyphen_matrix(frame: pd.DataFrame) -> np.ndarray:
    log = lambda c: np.log1p(frame[c].to_numpy(dtype=float))
    return np.stack(
        [
            (frame["mark"] == "-").to_numpy(dtype=float), frame["mark_share"].fillna(1.0).to_numpy(dtype=float), log("n_joined"), log("n_compound"), log("n_l"), log("n_r"),
            log("n_joined") - log("n_compound"), frame["left"].str.len().to_numpy(dtype=float), frame["right"].str.len().to_numpy(dtype=float), frame["compound_left"].to_numpy(dtype=float),
        ], axis=1,
    )


def fit_hyphens(broken: DataFrame) -> BoostedTrees:
    """Trains on words that occur whole elsewhere in one way only; half of the rows hide that, so fragments teach as well."""
    keys = ("pid", "version", "line_no")
    sample = hash_sample(broken.select(*keys, *_HYPHEN_COLUMNS), TRAINING_HYPHENS, *keys).toPandas().sort_values(["draw", "line_no"]).reset_index(drop=True)
    joined = (sample["n_joined"] >= 3) & (sample["n_compound"] * 20 < sample["n_joined"])
    compound = (sample["n_compound"] >= 3) & (sample["n_joined"] * 20 < sample["n_compound"])
    sure = sample[joined | compound]
    if not len(sure) or joined.sum() == 0 or compound.sum() == 0:
        return BoostedTrees()
    hidden = sure.copy()
    hidden[["n_joined", "n_compound"]] = 0
    both = pd.concat([sure, hidden])
    y = np.concatenate([joined[joined | compound]] * 2).astype(float)
    order = np.random.default_rng(6).permutation(len(y))
    return BoostedTrees(trees=40, depth=4).fit(_hyphen_matrix(both)[order], y[order])


def decide_hyphens(broken: DataFrame, model: BoostedTrees) -> DataFrame:
    """The broken words with ``vanish``: whether the mark disappears when the word is put together."""
    known = broken.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def vanish(mark: pd.Series, mark_share: pd.Series, left: pd.Series, right: pd.Series, n_joined: pd.Series, n_compound: pd.Series, n_l: pd.Series, n_r: pd.Series, compound_left: pd.Series) -> pd.Series:
        frame = pd.concat([mark, mark_share, left, right, n_joined, n_compound, n_l, n_r, compound_left], axis=1, keys=_HYPHEN_COLUMNS)
        if not known.value.edges:
            return (frame["mark"] != "-") | (frame["n_joined"] >= frame["n_compound"])
        return pd.Series((known.value.probability(_hyphen_matrix(frame)) >= HYPHEN_FROM) | (frame["mark"] == "­").to_numpy())

    return broken.withColumn("vanish", vanish(*_HYPHEN_COLUMNS))


# --- misread words


class Letters:
    """How usual a word's letters are, by trigrams of the vocabulary."""

    def __init__(self, counts: dict[str, int]):
        self.three = counts
        self.two: Counter = Counter()
        for gram, n in counts.items():
            self.two[gram[:2]] += n

    def scores(self, word: str, own: int = 0) -> tuple[float, float]:
        """(mean, least) log probability of the word's trigrams, without the ``own`` counts that the word brought in."""
        padded = f"^^{_folded(word)}$"
        logs = [
            math.log((max(self.three.get(padded[i : i + 3], 0) - own, 0) + 0.02) / (max(self.two.get(padded[i : i + 2], 0) - own, 0) + 0.8))
            for i in range(len(padded) - 2)
        ]
        return (sum(logs) / len(logs), min(logs))


def _folded(word: str) -> str:
    return re.sub(r"[^a-z0-9]", "?", word.lower())


def letter_model(words: DataFrame) -> Letters:
    """Trigram counts over the distinct words; the alphabet has 39 signs, so there are under 60,000 trigrams."""
    padded = F.concat(F.lit("^^"), F.regexp_replace("word", "[^a-z0-9]", "?"), F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))
    weight = F.ceil(F.log2(F.col("n") + 1))
    counted = words.filter("n >= 2 and word not like '%-%'").select(F.explode(grams).alias("gram"), weight.alias("weight")).groupBy("gram").agg(F.sum("weight").alias("n"))
    return Letters({r.gram: int(r.n) for r in counted.collect()})


def change(read: str, true: str) -> tuple[str, str, int]:
    """What differs between two words, as (read part, true part, place)."""
    a = 0
    while a < min(len(read), len(true)) and read[a] == true[a]:
        a += 1
    b = 0
    while b < min(len(read), len(true)) - a and read[-1 - b] == true[-1 - b]:
        b += 1
    return read[a : len(read) - b], true[a : len(true) - b], a


_KNOWN = {(seen, printed) for printed, seen in CONFUSIONS}


def is_known(read: str, true: str) -> bool:
    """Whether one listed confusion turns ``true`` into ``read``."""
    part, other, at = change(read, true)
    for left in range(0, 2):
        for right in range(0, 2):
            a, b = at - left, at + len(part) + right
            c, d = at - left, at + len(other) + right
            if a >= 0 and b <= len(read) and d <= len(true) and (read[a:b], true[c:d]) in _KNOWN:
                return True
    return False


def variants(word: str) -> list[str]:
    """The words that one listed confusion could have been read from."""
    out = set()
    for printed, seen in CONFUSIONS:
        at = word.find(seen)
        while at >= 0:
            out.add(word[:at] + printed + word[at + len(seen) :])
            at = word.find(seen, at + 1)
    return sorted(out)


def misread(word: str, rng: np.random.Generator) -> str | None:
    """The word with one listed confusion, for training."""
    places = [(i, printed, seen) for printed, seen in CONFUSIONS for i in range(len(word)) if word.startswith(printed, i)]
    if not places:
        return None
    i, printed, seen = places[rng.integers(len(places))]
    return word[:i] + seen + word[i + len(printed) :]


def pair_features(read: str, n_read: int, low_read: float, true: str, n_true: int, low_true: float, letters: Letters, own: tuple[int, int] = (0, 0)) -> list[float]:
    """What tells whether ``read`` is ``true`` misread. A form of a misreading is expected MISREAD_RATE times as often."""
    mean_r, least_r = letters.scores(read, own[0])
    mean_t, least_t = letters.scores(true, own[1])
    part, other, at = change(read, true)
    digit = any(ch.isdigit() for ch in read) and any(ch.isalpha() for ch in read)
    return [
        math.log(n_read / (1 + MISREAD_RATE * n_true)), float(n_true > 0), low_read, low_true, float(len(read)), float(is_known(read, true)), float(digit),
        mean_r, least_r, mean_t - mean_r, least_t - least_r, float(len(part) + len(other)), float(at == 0), least_t, float(any(ch.isdigit() for ch in true)),
        math.log1p(min(n_true, 200)),
    ]


def _grams(word: str) -> list[str]:
    """Gapped q-grams of a word's shape that one more misreading leaves whole: the shape, and the shape without one of its
    characters. They are as long as the word itself, so none is shared by many words."""
    s = shape(word)
    if len(s) > LONG_WORD:
        half = len(s) // 2
        return [f"={s}", f"^{s[:half]}", f"{s[-half:]}$"]
    return sorted({f"={s}", *(f"{s[:i]}{s[i + 1 :]}" for i in range(len(s)))}) if len(s) >= 4 else [f"={s}"]


def candidate_words(words: DataFrame, letters) -> DataFrame:
    """(word, n, low, true, n_true, low_true): retrieval of corrections through joins on q-grams.

    A word meets words four times as frequent of nearly its length with which it shares a q-gram; pairs further apart than
    two edits fall away at once. A confusion of a pair of letters may change the shape so that no q-gram is left: each word
    also meets every more frequent word that one listed confusion leads back to, however often it occurs itself, and the
    most usual of all that a confusion leads back to, which the vocabulary may lack.
    """

    @F.pandas_udf("array<string>")
    def grams(word: pd.Series) -> pd.Series:
        return word.map(_grams)

    @F.pandas_udf("array<struct<true:string,usual:boolean>>")
    def sources(word: pd.Series) -> pd.Series:
        def of(w: str) -> list[dict]:
            options = variants(w)
            best = max(options, key=lambda v: (sum(letters.value.scores(v)), v), default=None)
            return [{"true": v, "usual": v == best} for v in options]

        return word.map(of)

    plain = words.filter(r"word not like '%-%' and length(word) >= 3 and word rlike '[\\p{L}].*[\\p{L}]'").select("word", "n", (F.col("n_low") / F.col("n")).alias("low"))
    keyed = plain.withColumn("gram", F.explode(grams("word"))).withColumn("size", F.length("word"))
    right = keyed.filter("n >= 4").select("gram", F.col("word").alias("true"), F.col("n").alias("n_true"), F.col("low").alias("low_true"), F.col("size").alias("size_true"))
    near = F.abs(F.col("size") - F.col("size_true")) <= 1
    met = keyed.join(right, "gram").filter(near & (F.col("n_true") >= 4 * F.col("n")) & (F.col("word") != F.col("true")))
    met = met.filter(F.levenshtein("word", "true", 2) >= 0).select("word", "n", "low", "true", "n_true", "low_true")
    other = words.select(F.col("word").alias("true"), F.col("n").alias("n_true"), (F.col("n_low") / F.col("n")).alias("low_true"))
    led = plain.select("word", "n", "low", F.inline(sources("word"))).join(other, "true", "left").filter("usual or n_true >= 4 * n")
    return met.unionByName(led.select("word", "n", "low", "true", F.coalesce("n_true", F.lit(0)).alias("n_true"), F.coalesce("low_true", "low").alias("low_true"))).distinct()


def fit_words(words: DataFrame, letters: Letters) -> BoostedTrees:
    """Trains on vocabulary words misread on purpose, against words left as they are and offered as their own neighbours."""
    sample = words.filter("n >= 4 and word not like '%-%' and length(word) >= 3 and word rlike '^[a-z]+$'").transform(hash_sample, TRAINING_WORDS, "word").toPandas().sort_values(["draw", "word"])
    rng = np.random.default_rng(7)
    counts = dict(zip(sample["word"], sample["n"]))
    low = dict(zip(sample["word"], sample["n_low"] / sample["n"]))
    x, y, weight = [], [], []

    def own(word: str, as_if_new: bool) -> int:
        return math.ceil(math.log2(counts[word] + 1)) if as_if_new and word in counts else 0

    def add(label: float, importance: float, *pair, new_read: bool = False, new_true: bool = False) -> None:
        x.append(pair_features(*pair, letters, (own(pair[0], new_read), own(pair[3], new_true))))
        y.append(label)
        weight.append(importance)

    for word, n in counts.items():
        for hide in (False, False, True):
            read = misread(word, rng)
            if read and read not in counts:
                seen = 1 if hide else max(1, int(rng.poisson(n * MISREAD_RATE * 4 ** rng.uniform(-1, 1))))
                add(1.0, 1.0, read, seen, float(rng.random() < low[word]), word, 0 if hide else n, low[word], new_true=hide)
        options = variants(word)
        if options:  # a right word, rare or not, against what a confusion would make of it
            best = max(options, key=lambda v: (sum(letters.scores(v)), v))
            if best in counts:
                add(0.0, 1.0, word, int(n), low[word], best, counts[best], low[best])
            else:
                for seen in (1, 2, int(n)):
                    add(0.0, UNSEEN_WEIGHT, word, seen, low[word], best, 0, low[word], new_read=seen < 3)
    shapes = defaultdict(list)
    for word in counts:
        for gram in _grams(word):
            shapes[gram].append(word)
    for group in shapes.values():  # right words that are each other's neighbours; names may well be rare
        for a, b in zip(group, group[1:]):
            if abs(len(a) - len(b)) <= 1:
                few, many = sorted((a, b), key=counts.get)
                if counts[few] > 5 * (1 + MISREAD_RATE * counts[many]) or not is_known(few, many):  # else it may be one
                    add(0.0, 1.0, few, counts[few], low[few], many, counts[many], low[many])
                if low[few] < 0.1 and low[many] < 0.1:
                    add(0.0, 2.0, few, 1, 0.0, many, counts[many], low[many], new_read=True)
    if not y or min(y) == max(y):
        return BoostedTrees()
    order = rng.permutation(len(y))
    return BoostedTrees(trees=80, depth=4).fit(np.array(x)[order], np.array(y)[order], np.array(weight)[order])


def misread_words(words: DataFrame, letters: Letters, model: BoostedTrees) -> DataFrame:
    """(word, true, place, chance, n): the best correction of each word that is misread, and where the misreading is."""
    context = words.sparkSession.sparkContext
    known = context.broadcast((letters, model))
    result = T.StructType([T.StructField("chance", T.DoubleType()), T.StructField("place", T.IntegerType())])

    @F.pandas_udf(result)
    def rank(word: pd.Series, n: pd.Series, low: pd.Series, true: pd.Series, n_true: pd.Series, low_true: pd.Series) -> pd.DataFrame:
        usual, trees = known.value
        x = np.array([pair_features(*row, usual) for row in zip(word, n, low, true, n_true, low_true)])
        p = trees.probability(x) if trees.edges and len(x) else np.zeros(len(word))
        return pd.DataFrame({"chance": p, "place": [change(a, b)[2] for a, b in zip(word, true)]})

    plausible = F.col("n") <= 5 * (1 + MISREAD_RATE * F.col("n_true"))  # what is said that often is a word
    ranked = candidate_words(words, context.broadcast(letters)).filter(plausible | (F.col("n_true") == 0)).withColumn("r", rank("word", "n", "low", "true", "n_true", "low_true")).filter(F.col("r.chance") >= F.when(F.col("n_true") > 0, MISREAD_FROM).otherwise(UNSEEN_FROM))
    best = F.max(F.struct((F.col("n_true") > 0).alias("known"), "r.chance", "n_true", "true", "r.place", "n"))
    return ranked.groupBy("word").agg(best.alias("b")).select("word", "b.true", "b.place", "b.chance", "b.n")


# --- the whole


class Repair:
    """The decisions for all scanned contexts: lines, broken words and misread words.

    Each step is written to the shared checkpoint folder: later steps read it several times, and their plans stay small.
    """

    def __init__(self, contexts: DataFrame):
        parsed = checkpointed(count_places(checkpointed(scan_lines(contexts))))
        self.lines = checkpointed(mark_furniture(parsed, fit_furniture(parsed)))
        base = checkpointed(vocabulary(self.lines))
        broken = checkpointed(hyphen_features(broken_words(self.lines), base))
        self.broken = checkpointed(decide_hyphens(broken, fit_hyphens(broken)))
        joined = self.broken.filter("vanish").groupBy(F.concat("left", "right").alias("word")).agg(F.count("*").alias("n"), F.sum((~F.col("capital")).cast("bigint")).alias("n_low"))
        words = checkpointed(base.unionByName(joined).groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_low").alias("n_low")))
        letters = letter_model(words)
        self.misread = checkpointed(misread_words(words, letters, fit_words(words, letters)))

    def tokens(self) -> DataFrame:
        """(paper_id, version, line_no, other_no, cut, word): words of running text; a broken word stands on two lines."""
        ends = self.broken.filter("vanish").select("pid", "version", "line_no", F.lit(True).alias("cut_end"))
        begins = self.broken.filter("vanish").select("pid", "version", F.col("next_no").alias("line_no"), F.lit(True).alias("cut_start")).distinct()
        text = self.lines.filter("body and not furniture").select("pid", "version", "line_no", "text")
        text = text.join(ends, ["pid", "version", "line_no"], "left").join(begins, ["pid", "version", "line_no"], "left")
        body = F.when(F.col("cut_end"), F.regexp_replace("text", r"[\p{L}\p{N}'’]+[-‐¬­]$", "")).otherwise(F.col("text"))
        body = F.when(F.col("cut_start"), F.regexp_replace(body, r"^[\p{L}\p{N}'’]+", "")).otherwise(body)
        none = F.lit(None).cast("bigint")
        whole = text.select("pid", "version", "line_no", none.alias("other_no"), none.cast("int").alias("cut"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower(body), F.lit(WORD), F.lit(0)))).alias("word"))
        parted = self.broken.filter("vanish").select("pid", "version", "line_no", F.col("next_no").alias("other_no"), F.length("left").alias("cut"), F.concat("left", "right").alias("word"))
        return whole.unionByName(parted)

    def misread_tokens(self) -> DataFrame:
        """The tokens that are misread, on the line where the misreading is, with their correction."""
        # words that pass unhurt are by far the most: the misread ones are found by a join that AQE and Bloom filters prune
        met = self.tokens().join(self.misread.select("word", "true", "place", "chance"), "word")
        line = F.when(F.col("place") >= F.col("cut"), F.col("other_no")).otherwise(F.col("line_no"))
        return met.select("pid", "version", line.alias("line_no"), "word", "true")

    def found(self) -> DataFrame:
        """(paper_id, line_no, kind), once each."""
        kind = lambda frame, name: frame.select(_paper(), "line_no", F.lit(name).alias("kind"))
        return kind(self.lines.filter("furniture"), "furniture").unionByName(kind(self.broken.filter("vanish"), "hyphen")).unionByName(kind(self.misread_tokens(), "glyph")).distinct()

    def paragraphs(self) -> DataFrame:
        """(paper_id, paragraphs): the repaired running text of each scanned context; tables stay where they were."""
        fixes = self.misread_tokens().groupBy("pid", "version", "line_no").agg(F.collect_set(F.struct("word", "true")).alias("fixes"))
        ends = self.broken.filter("vanish").select("pid", "version", "line_no", "next_no")
        rows = self.lines.filter("not furniture").join(ends.withColumnRenamed("next_no", "goes_on"), ["pid", "version", "line_no"], "left").join(fixes, ["pid", "version", "line_no"], "left")
        line = F.struct("line_no", "text", "body", "goes_on", "fixes", "page")

        @F.pandas_udf("array<string>")
        def assemble(lines: pd.Series) -> pd.Series:
            return lines.map(lambda rows: _assembled(sorted(rows, key=lambda r: r["line_no"])))

        grouped = rows.groupBy("pid", "version").agg(F.collect_list(line).alias("lines"))  # the lines of one context
        return grouped.select(_paper(), assemble("lines").alias("paragraphs"))


def _assembled(rows: list[dict]) -> list[str]:
    out: list[str] = []
    last, open_word, table = None, None, False
    pending: dict = {}
    for r in rows:
        text = r["text"]
        fixes = {f["word"]: f["true"] for f in (r["fixes"] if r["fixes"] is not None else [])}
        starts = open_word == r["line_no"]
        follows = last is not None and (r["line_no"] == last + 1 or starts or r["page"] != page and out and out[-1][-1:] not in ".!?:" and text[:1].islower())
        if not r["body"]:
            (out.append(text) if not (table and follows) else out.__setitem__(-1, f"{out[-1]}\n{text}"))
        elif starts and out:
            out[-1] = out[-1] + text
        elif follows and not table and out and not _HEAD.match(text):
            out[-1] = f"{out[-1]}{'' if out[-1][-1:] == '-' and out[-1][-2:-1].isalpha() else ' '}{text}"
        else:
            out.append(text)
        pending |= fixes
        goes = r["goes_on"]
        if r["body"] and goes is not None and goes == goes:
            out[-1] = out[-1][:-1]
            open_word = int(goes)
        else:
            if pending and r["body"]:
                out[-1] = _TOKEN.sub(lambda m: _cased(m[0], pending.get(m[0].lower())), out[-1])
            pending = {} if open_word is None or starts or open_word == r["line_no"] else pending
            open_word = None
        last, page, table = r["line_no"], r["page"], not r["body"]
    return out


def _cased(word: str, true: str | None) -> str:
    if true is None:
        return word
    if word.isupper():
        return true.upper()
    return true[:1].upper() + true[1:] if word[:1].isupper() else true


def found_noise(contexts: DataFrame) -> DataFrame:
    """(paper_id, line_no, kind) of what noise every scanned context holds.

    contexts: paper_id, context. Kinds are ``furniture``, ``hyphen`` and ``glyph``; lines count from 1 between line
    feeds. A digital context, whose paragraphs don't run over lines, has none; nor has a null, empty or blank one. A
    row that occurs twice counts once; a null paper_id stays null. Whole contexts are read.
    """
    return Repair(contexts).found()


def repaired_text(contexts: DataFrame) -> DataFrame:
    """(paper_id, paragraphs) of every scanned context, with the cases of ``found_noise``."""
    return Repair(contexts).paragraphs()
