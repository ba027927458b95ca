"""Per-document text statistics, repetition statistics and the verdict whether a text is natural prose."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The most common words of the corpus languages.
COMMON = {
    "en": "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know but both near between while although however where",
    "es": "el la los las de del que y en un una se no por con para es fue su al lo como más pero sus le ha o este entre cuando muy sin sobre también hasta hay donde durante cada desde todo nos uno",
    "pt": "o a os as de do da dos das que e em um uma não para com por foi se na no nas nos mais ao como mas é ou sua seu entre quando ao longo sem até também durante cada houve",
    "fr": "le la les de des du et à en un une que qui dans pour par sur ne pas se au aux plus est été avec ce cette il elle nous mais ou son ses entre près dont où sans lors ont a l d",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch man etwa blieb blieben wurden darauf",
}
COMMON_WORDS = frozenset(w for words in COMMON.values() for w in words.split())
#: Sentences hold at least this share of a natural text.
PROSE_FROM = 0.5
#: Repetition from which a text is boilerplate whatever its sentences look like: the share of characters in lines or
#: paragraphs that were there before, in 5-grams that occurred before, and under the one dominant 3-gram.
REPEATED_LINES, REPEATED_WORDS, DOMINANT_GRAM = 0.5, 0.8, 0.6
#: Shorter texts may well repeat themselves by chance, such as a caption of two sentences.
LONG_ENOUGH = 30
#: A sentence counts as prose the first two times a text says it.
SAID_TWICE = 2
#: Labels of links on web pages.
NAVIGATION = frozenset(
    "home|search|print|share|login|log in|log out|sign in|register|subscribe|contact|about|help|sitemap|terms|privacy|cite|next|previous|next >|< previous|back to top|top|menu|download|download pdf|data portal|skip to content|cookies|accept|rss|archive".split("|")
)

_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?:['’-][^\W\d_]+)*(?!\w)")
_LINE = re.compile(r"\r\n|\r|\n| | |\f|\v")
_END = re.compile(r"[.!?…][\"'”’»)\]]*$")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+(?=[^\Wa-zà-ÿ_]|[\"“«(\d])")
_BULLET = re.compile(r"^\s*(?:[-–—•*·▪◦‣o]\s+|\(?(?:\d{1,3}|[a-z]|[ivx]{1,4})[.)]\s+)")
_LOG = re.compile(r"^\s*(?:\[?\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}|\[(?:INFO|WARN|ERROR|DEBUG)\])")
_PAIR = re.compile(r"(?<![\w.])[A-Za-z][\w -]{1,40}?\s*[:=]\s*[-+<>≤≥]?\d[\d.,]*(?:[eE][-+]?\d+)?(?!\w)")
_PAIR_INLINE = re.compile(r"(?<![\w.])[A-Za-z]\w{1,40}\s*[:=]\s*[-+<>≤≥]?\d[\d.,]*(?!\w)")
_REFERENCE = re.compile(r"^\W*\w[\w'’-]+,?\s+(?:[A-Z]\.[ -]?){1,3}.{0,200}?\(\d{4}[a-z]?\).{5,200}?\d+\s*(?:\(\d+\))?\s*:\s*\d+\s*[-–]\s*\d+|\bdoi\.org/|^\s*\[\d+\]\s+\w+")
_HEADING = re.compile(r"^\s*(?:#{1,6}\s+\S|\d+(?:\.\d+)*\.?\s+[A-Z])")


_WIDE = re.compile(r"\s\s")
_GAP = re.compile(r"\S\s{2,}(?=\S)")
_CELLS = re.compile(r"\s{2,}")
_BITS = re.compile(r"\s[·•|>/]\s|\s{2,}")
_BARS = re.compile(r"[|\t]")
_BIT_MARKS = frozenset("·•|>/")


class _Lookup(dict):
    """Whether a word is common, worked out once per spelling; short forms in capitals (DO, AT, NO) are not."""

    def __missing__(self, word: str) -> bool:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = word.lower() in COMMON_WORDS and not (len(word) > 1 and word.isupper())
        return found


_IS_COMMON = _Lookup()


def _solid(text: str) -> int:
    return sum(map(len, text.split()))


def _refers(text: str) -> bool:
    return ("(" in text or "[" in text or "doi.org/" in text) and _REFERENCE.search(text) is not None


def _structure(line: str, words: list[str]) -> str | None:
    """The kind of a line (with its words) that is no sentence by its form, or None."""
    s = line.strip()
    letters, solid = sum(map(len, words)), _solid(s)
    if _LOG.match(s):
        return "data"
    if _refers(s):
        return "reference"
    sentence = len(words) >= 6 and _END.search(s) is not None and _common(words) >= 0.12
    if s.count("|") >= 2 or "\t" in s.strip("\t") and not sentence:
        parts = [p.strip().lower() for p in _BARS.split(s) if p.strip()]
        return "navigation" if parts and sum(p in NAVIGATION for p in parts) * 2 > len(parts) else "table"
    if not sentence and s.count(";") >= 3:
        fields = s.split(";")
        if all(len(f) <= 45 for f in fields) and " " not in fields[1].strip():
            return "table"
    wide = _WIDE.search(s) is not None
    if not sentence and wide and len(_GAP.findall(s)) >= 2:
        cells = _CELLS.split(s)
        if sum(c.lower() in NAVIGATION for c in cells) * 2 > len(cells):
            return "navigation"
        if sum(any(ch.isdigit() for ch in c) or c.lower() in ("n.d.", "nd", "na", "-", "—") for c in cells) * 2 >= len(cells):
            return "table"
    if solid and letters < 0.5 * solid and not sentence:
        return "junk"
    if len(s) <= 60 and s.lower().strip(" <>·|»«") in NAVIGATION:
        return "navigation"
    if wide or not _BIT_MARKS.isdisjoint(s):
        bits = [b.strip().lower() for b in _BITS.split(s)]
        if len(bits) >= 3 and sum(b.strip(" <>") in NAVIGATION or b in NAVIGATION for b in bits) * 2 > len(bits):
            return "navigation"
    if not sentence and (":" in s or "=" in s) and _PAIR.fullmatch(s):
        return "data"
    if _BULLET.match(s) and not (sentence and len(words) >= 8):
        return "list"
    return None


def _common(words: list[str]) -> float:
    """The share of common words."""
    return sum(map(_IS_COMMON.__getitem__, words)) / len(words) if words else 0.0


def _flow(text: str, said: Counter) -> list[tuple[str, int]]:
    """(kind, characters) of a run of text: its sentences, the data written into them, and what is neither.

    ``said`` counts the text's sentences: one that comes again and again is boilerplate.
    """
    out = []
    for piece in _SENTENCE.split(text):
        inline = sum(_solid(m[0]) for m in _PAIR_INLINE.finditer(piece)) if ":" in piece or "=" in piece else 0
        rest = _PAIR_INLINE.sub(" ", piece) if inline else piece
        solid = _solid(rest)
        if inline:
            out.append(("data", inline))
        if not solid:
            continue
        words = _WORD.findall(rest)
        letters = sum(map(len, words))
        share = _common(words)
        ended = _END.search(rest.strip()) is not None
        if letters < 0.5 * solid and not (ended and share >= 0.12):
            kind = "junk"
        elif _refers(piece):
            kind = "reference"
        elif ended and len(words) >= 3 or len(words) >= 6 and share >= 0.15 or len(words) >= 4 and share >= 0.3:
            key = piece.strip()
            said[key] += 1
            kind = "prose" if said[key] <= SAID_TWICE else "boilerplate"
        else:
            kind = "list"
        out.append((kind, solid))
    return out


def _wide_repeat(words: list[str]) -> bool:
    """Whether a run of words keeps saying the same few words, as boilerplate and tag clouds do and sentences don't."""
    return len(words) >= 20 and len(set(words)) / len(words) < 0.35 and _common(words) < 0.15


def kinds(lines: list[str], words: list[list[str]]) -> Counter:
    """Non-blank characters of lines (with their words) by kind: prose, list, table, data, reference, navigation, junk, boilerplate."""
    total: Counter = Counter()
    said: Counter = Counter()
    run: list[int] = []
    shapes = [(_structure(line, own) if line.strip() else "blank") for line, own in zip(lines, words)]
    labels = _listlike(lines, words, shapes)
    for i, (line, shape) in enumerate([*zip(lines, labels), ("", "blank")]):
        if shape is None:
            run.append(i)
            continue
        if run:
            joined = " ".join(lines[j] for j in run)
            if _wide_repeat([w.lower() for j in run for w in words[j]]):
                total["list"] += _solid(joined)
            else:
                for kind, n in _flow(joined, said):
                    total[kind] += n
            run = []
        if shape == "list":  # the first item may follow a sentence, the last may be followed by one
            for kind, n in _flow(_BULLET.sub("", line), said) if len(_SENTENCE.split(line)) > 1 and len(line) > 60 else [("list", _solid(line))]:
                total[kind] += n
        elif shape == "data" and len(line) > 60:
            pair = _LOG.match(line) is None
            tail = _SENTENCE.split(line)
            total["data"] += _solid(tail[0])
            for kind, n in _flow(" ".join(tail[1:]), said) if len(tail) > 1 and pair else [("data", _solid(" ".join(tail[1:])))]:
                total[kind] += n
        elif shape != "blank":
            total[shape] += _solid(line)
    return total


def _listlike(lines: list[str], words: list[list[str]], shapes: list[str | None]) -> list[str | None]:
    """Marks runs of three or more short lines without sentence ends as lists: names under each other, menus, keywords."""
    out = list(shapes)
    run: list[int] = []
    for i, (line, shape) in enumerate([*zip(lines, shapes), ("", "end")]):
        s = line.strip()
        short = shape is None and len(s) <= 60 and not _END.search(s) and not _HEADING.match(s) and len(words[i]) <= 7
        if short:
            run.append(i)
            continue
        if shape == "blank" and run:
            continue
        # lines of narrow running text are short as well, but they hold common words
        if len(run) >= 3 and _common([w for j in run for w in words[j]]) < 0.2:
            for j in run:
                out[j] = "list"
        run = []
    return out


STATS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_chars_solid", "n_words", "n_lines", "n_paragraphs")]
    + [
        T.StructField(n, T.DoubleType())
        for n in (
            "mean_word_length", "symbol_ratio", "digit_ratio", "line_end_punct_share", "bullet_line_share", "common_word_share",
            "duplicate_line_share", "duplicate_paragraph_share", "top_2gram_coverage", "top_3gram_coverage", "top_4gram_coverage",
            "repeated_5gram_coverage", "list_share", "table_share", "data_share", "reference_share", "navigation_share", "junk_share", "boilerplate_share", "prose_share",
        )
    ]
    + [T.StructField("is_prose", T.BooleanType())]
)


def _duplicates(parts: list[str]) -> float | None:
    """The share of characters in parts that were there before."""
    size = sum(map(len, parts))
    seen: set[str] = set()
    again = 0
    for p in parts:
        again += len(p) if p in seen else 0
        seen.add(p)
    return again / size if size else None


def _coverage(words: list[str], size: int, n: int) -> float | None:
    """The share of word characters that the most frequent n-gram covers; 0 if none occurs twice."""
    if not size:
        return None
    grams = Counter(zip(*(words[i:] for i in range(n))))
    times = max(grams.values(), default=1)
    if times == 1:
        return 0.0
    return min(1.0, times * max(sum(map(len, gram)) for gram, k in grams.items() if k == times) / size)


def _repeated(words: list[str], size: int, n: int = 5) -> float | None:
    """The share of word characters inside n-grams that occurred before."""
    if not size:
        return None
    grams = list(zip(*(words[i:] for i in range(n))))
    seen: set[tuple] = set()
    if len(set(grams)) == len(grams):
        return 0.0
    covered = [False] * len(words)
    for i, gram in enumerate(grams):
        if gram in seen:
            covered[i : i + n] = [True] * n
        seen.add(gram)
    return sum(len(w) for w, c in zip(words, covered) if c) / size


_KINDS = ("list", "table", "data", "reference", "navigation", "junk", "boilerplate", "prose")
_PARAGRAPHS = re.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)+")


def describe(text: str | None) -> tuple:
    """The row of STATS of one text; null for a null text, zeros and nulls and no prose for an empty or blank one."""
    if text is None:
        return (None,) * len(STATS.names)
    solid = _solid(text)
    if not solid:
        return (0,) * 4 + (None,) * (len(STATS.names) - 5) + (False,)
    raw = _LINE.split(text)
    by_line = [_WORD.findall(line) for line in raw]
    words = [w for line in by_line for w in line]
    low = [w.lower() for w in words]
    size = sum(map(len, low))
    lines = [s for s in map(str.strip, raw) if s]
    paragraphs = [s for s in (p.strip() for p in _PARAGRAPHS.split(text)) if s]
    signs = Counter(text)
    digits = sum(n for ch, n in signs.items() if ch.isdigit())
    alnum = sum(n for ch, n in signs.items() if ch.isalnum())
    by = kinds(raw, by_line)
    total = sum(by.values()) or 1
    share = [by[k] / total for k in _KINDS]
    again_lines, again_paragraphs = _duplicates(lines), _duplicates(paragraphs)
    top = [_coverage(low, size, n) for n in (2, 3, 4)]
    again_words = _repeated(low, size)
    repeats = max(again_lines or 0.0, again_paragraphs or 0.0) >= REPEATED_LINES or (again_words or 0.0) >= REPEATED_WORDS or (top[1] or 0.0) >= DOMINANT_GRAM
    return (
        solid, len(words), len(lines), len(paragraphs),
        sum(map(len, words)) / len(words) if words else None, (solid - alnum) / solid, digits / solid,
        sum(_END.search(s) is not None for s in lines) / len(lines), sum(_BULLET.match(s) is not None for s in lines) / len(lines),
        _common(words) if words else None,
        again_lines, again_paragraphs, *top, again_words, *share,
        share[-1] >= PROSE_FROM and not (repeats and len(words) >= LONG_ENOUGH),
    )


def text_quality(documents: DataFrame) -> DataFrame:
    """(doc_id, statistics of STATS): one row per row of documents (doc_id, text).

    Kinds of lines are told apart by combined rules: form (bullets, separators, timestamps, references), sentence
    ends, shares of letters and of common words of five languages, and repetition. ``is_prose`` is whether sentences
    hold at least half of the non-blank characters, those said more than twice left out, and the text as a whole isn't
    a repetition: by the shares of repeated lines and paragraphs and of repeated 5-grams, and by the dominant 3-gram. A
    null text has nulls only; an empty or blank text has zero counts and is no prose; whole texts are read, in one pass
    without a shuffle.
    """

    @F.arrow_udf(STATS)
    def stats(texts: pa.Array) -> pa.Array:
        columns = list(zip(*map(describe, texts.to_pylist()))) or [()] * len(STATS.names)
        kinds_of = [pa.int64()] * 4 + [pa.float64()] * (len(STATS.names) - 5) + [pa.bool_()]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds_of)], STATS.names)

    return documents.select(F.col("doc_id").cast("bigint"), "text").withColumn("s", stats("text")).select("doc_id", "s.*")


def not_prose(quality: DataFrame) -> DataFrame:
    """(doc_id) of non-blank texts that are no natural prose."""
    return quality.filter((F.col("n_chars_solid") > 0) & ~F.col("is_prose")).select("doc_id")
