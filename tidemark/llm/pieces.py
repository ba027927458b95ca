"""Oversized pages and contexts into overlapping pieces, by packing a structure tree."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 2000, 200

_OPEN = re.compile(r"<page\s+number\s*=\s*[\"']?\s*(\d+)\s*[\"']?\s*>", re.I)
_CLOSE = re.compile(r"</page\s*>", re.I)

_TAG = re.compile(r"(?=<page\b)", re.I)
_HEADING = re.compile(r"^(?:(#{1,6})\s|(\d+(?:\.\d+)*)\.?[ \t]+[A-Z][^\n]{0,80}(?<![.!?;,:])$)", re.M)
_BLOCK = re.compile(r"(?=<table\b)|(?<=</table>)|(?<=\n)[ \t\r]*\n+(?=.)", re.S)
_ITEM = re.compile(r"^([ \t]*)(?:[-–•*]|\(?(?:\d{1,3}|[a-z])[.)])[ \t]", re.M)
_ROW = re.compile(r"(?=<tr\b)|^(?=[ \t]*\|)|(?<=\n)", re.M)
#: What the text of a paragraph, an item or a row is made of, from the largest to the smallest.
_PARTS = {
    "text": ("sentence", re.compile(r"(?<=[.!?])[\"'”’)\]]*\s+(?=\S)")),
    "sentence": ("line", re.compile(r"\n(?=.)", re.S)),
    "line": ("clause", re.compile(r"(?<=[;,|])\s*(?=\S)")),
    "clause": ("word", re.compile(r"\s+(?=\S)")),
}


def pages(context: str) -> list[tuple[int, int, int]]:
    """(page number, start, end) of each page's text, white space at both ends removed; number 0 for an untagged context."""
    tags = list(_OPEN.finditer(context))
    spans = []
    for i, tag in enumerate(tags):
        stop = tags[i + 1].start() if i + 1 < len(tags) else len(context)
        close = _CLOSE.search(context, tag.end(), stop)
        spans.append((int(tag[1]), tag.end(), close.start() if close else stop))
    out = []
    for number, start, end in spans or [(0, 0, len(context))]:
        inner = context[start:end]
        lead = len(inner) - len(inner.lstrip())
        out.append((number, start + lead, start + lead + len(inner.strip())))
    return out


class Tree:
    """The structure of a text, worked out where a node is opened: a context's pages, the sections of a page by the depth
    of their headings, the blocks of a section, the nested items of a list and the rows of a table, then sentences,
    lines, clauses and words. A node is (start, end, kind); the children of a node follow each other without a gap."""

    def __init__(self, text: str):
        self.text = text
        self.headings = [(m.start(), len(m[1]) if m[1] else min(m[2].count(".") + 1, 20)) for m in _HEADING.finditer(text)]

    def children(self, start: int, end: int, kind: str) -> list[tuple[int, int, str]]:
        if kind == "context":
            return self._cut(start, end, (m.end() for m in _TAG.finditer(self.text, start, end)), "section")
        if kind == "section":
            return self._outermost(start, end, self.headings, "section", "blocks")
        if kind == "blocks":
            return [(a, b, self._block(a, b)) for a, b, _ in self._cut(start, end, (m.end() for m in _BLOCK.finditer(self.text, start, end)), "")]
        if kind == "list":
            items = [(m.start(), min(len(m[1].expandtabs(4)), 60)) for m in _ITEM.finditer(self.text, start, end)]
            return self._outermost(start, end, items, "list", "text")
        if kind == "table":
            return self._cut(start, end, (m.end() for m in _ROW.finditer(self.text, start, end)), "line")
        if kind in _PARTS:
            smaller, where = _PARTS[kind]
            return self._cut(start, end, (m.end() for m in where.finditer(self.text, start, end)), smaller)
        return []

    def _block(self, start: int, end: int) -> str:
        if self.text.startswith("<table", start) or self.text.count("|", start, end) >= 4:
            return "table"
        return "list" if _ITEM.search(self.text, start, end) else "text"

    @staticmethod
    def _cut(start: int, end: int, places, kind: str) -> list[tuple[int, int, str]]:
        cuts = [start, *sorted({p for p in places if start < p < end}), end]
        return [(a, b, kind) for a, b in zip(cuts, cuts[1:])]

    def _outermost(self, start: int, end: int, marks: list[tuple[int, int]], kind: str, rest: str) -> list[tuple[int, int, str]]:
        """Nodes at the marks of the least depth inside, each with the deeper ones that follow it; what stands before the
        first is of another kind."""
        inside = [(p, depth) for p, depth in marks if start < p < end]
        if not inside:
            return [(start, end, rest)]
        least = min(depth for _, depth in inside)
        nodes = self._cut(start, end, (p for p, depth in inside if depth == least), kind)
        return [(nodes[0][0], nodes[0][1], rest if nodes[0][1] == inside[0][0] else kind), *nodes[1:]]

    def packed(self, start: int, end: int, kind: str, cap: int, least: int, lead: int | None = None) -> list[tuple[int, int]]:
        """Spans of at most ``cap`` that cover the node: sibling subtrees are merged as long as they fit, and only a node
        that is too large is opened. What an opened node leaves isn't merged with its siblings; only siblings shorter
        than ``least`` before it are put to its beginning, from ``lead`` on."""
        lead = start if lead is None else lead
        if end - lead <= cap:
            return [(lead, end)]
        nodes = self.children(start, end, kind)
        if not nodes:
            return self._chopped(lead, end, cap)
        spans: list[tuple[int, int]] = []
        run: tuple[int, int] | None = (lead, start) if lead < start else None
        for a, b, inner in nodes:
            if run and b - run[0] <= cap:
                run = (run[0], b)
                continue
            if run and run[1] - run[0] < least:
                spans += self.packed(a, b, inner, cap, least, run[0])
                run = None
                continue
            if run:
                spans.append(run)
            run = (a, b) if b - a <= cap else None
            if run is None:
                spans += self.packed(a, b, inner, cap, least)
        return [*spans, run] if run else spans

    def _chopped(self, start: int, end: int, cap: int) -> list[tuple[int, int]]:
        """A word that is too large, cut between characters."""
        out = []
        while end - start > cap:
            cut = start + cap
            while cut > start + cap // 2 and unicodedata.combining(self.text[cut]):
                cut -= 1
            out.append((start, cut))
            start = cut
        return [*out, (start, end)]


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of consecutive pieces of at most ``limit`` characters, each beginning ``overlap`` before the last end."""
    if len(text) <= limit:
        return [(0, len(text))]
    ends = [b for _, b in Tree(text).packed(0, len(text), "context", limit - overlap, overlap + 1)]
    starts = [0] + [max(0, e - overlap) for e in ends[:-1]]
    return list(zip(starts, ends))


SCHEMA = "paper_id bigint, unit string, page_number bigint, unit_no int, piece_no int, n_pieces int, unit_chars bigint, start bigint, end bigint, text string"
_ARROW = pa.schema(
    [("paper_id", pa.int64()), ("unit", pa.string()), ("page_number", pa.int64()), ("unit_no", pa.int32()), ("piece_no", pa.int32()),
     ("n_pieces", pa.int32()), ("unit_chars", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]
)


def _unit_rows(paper: int | None, context: str, limit: int, overlap: int) -> Iterator[tuple]:
    inner = context.strip()
    lead = len(context) - len(context.lstrip())
    units = [("page", number, i, start, context[start:end]) for i, (number, start, end) in enumerate(pages(context))]
    for unit, number, i, offset, text in [*units, ("context", None, 0, lead, inner)]:
        spans = split_text(text, limit, overlap)
        for k, (a, b) in enumerate(spans):
            yield (paper, unit, number, i, k, len(spans), len(text), offset + a, offset + b, text[a:b])


def split_contexts(contexts: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every page and of every whole context.

    contexts: paper_id, context. A unit within the limit comes out as one piece; a longer one as consecutive pieces
    of at most ``limit`` characters (code points) that end where nodes of its structure tree end: page, section, block,
    list item or table row, sentence, line, clause, word. Each piece but the first repeats the last
    ``overlap`` characters before it. ``start`` and ``end`` count in the context.

    A null context has no units; an empty or blank one is one empty piece per unit; a row that occurs twice comes out
    twice; a null paper_id stays null. One pass without a shuffle; a text is held by one task, as a row is anyway.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for paper, context in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if context is None:
                    continue
                for row in _unit_rows(paper, context, limit, overlap):
                    rows.append(row)
                    size += len(row[-1])
                if size > 4_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return contexts.select(F.col("paper_id").cast("bigint"), "context").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(columns, _ARROW)], schema=_ARROW)


def oversized_pages(pieces: DataFrame) -> DataFrame:
    """(paper_id, page_number) of pages that were cut, once each."""
    return pieces.filter((F.col("unit") == "page") & (F.col("n_pieces") > 1)).select("paper_id", "page_number").distinct()
