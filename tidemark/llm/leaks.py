"""Evaluation passages inside corpus documents, by latent semantic retrieval and alignment."""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sampling import hash_sample
from tidemark.session import checkpointed

#: Words in a row that make a leak.
MIN_WORDS = 15
#: Windows of 24 words every 6 (documents) or 8 (items): a run of 15 words lies whole in one window of either kind.
WINDOW, DOC_STEP, ITEM_STEP = 24, 6, 8
#: Hashed unigrams and bigrams, and the dimensions of the latent space.
FEATURES, RANK, EXTRA, POWER = 1 << 14, 96, 16, 2
#: The space is fitted on at most this many documents and items; counts and search cover every document and item.
FIT_DOCUMENTS, FIT_ITEMS = 2_000, 2_000
ITEM_WEIGHT = 3.0
#: Least cosine of a document window and an item window that is aligned.
COSINE = 0.4
#: Least common subsequence of an item and a window of a document that is aligned.
LEAST_COMMON = MIN_WORDS - 3
#: Items are searched in blocks of this many characters, so what is broadcast is bounded; one block is one pass.
BLOCK_CHARS = 16_000_000
#: Alignment: a changed, added or missing word costs this; the best run must keep this score.
EDIT_COST, LEAST_SCORE = 1.5, 10.0
#: A reworded item: least cosine, least share of the item's words in common order, and least share of its answer words
#: (numbers and the rarer half of its vocabulary), all within one stretch of a document about as long as the item.
PARAPHRASE_COSINE, PARAPHRASE_COMMON, ANSWER_SHARE = 0.6, 0.5, 0.8

_BROKEN = re.compile(r"[-‐¬­]\s*[\r\n]+\s*(?=[^\W\d_])")
_WORDS = re.compile(r"[^\W_]+")


class _Unaccented(dict):
    """A translation that drops combining marks, filled as characters occur."""

    def __missing__(self, code: int) -> int | None:
        found = self[code] = None if unicodedata.combining(chr(code)) else code
        return found


_PLAIN = _Unaccented()


def words_of(text: str | None) -> list[str]:
    """Words without letter case, accents, punctuation and line-end hyphens."""
    if not text:
        return []
    plain = _BROKEN.sub("", text).replace("­", "").replace("​", "")
    plain = plain.lower()
    if not plain.isascii():
        plain = unicodedata.normalize("NFKD", plain).translate(_PLAIN)
    return _WORDS.findall(plain)


class _Hashes(dict):
    """The hash of a word, worked out once per spelling."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1 << 20:
            self.clear()
        found = self[word] = zlib.crc32(word.encode())
        return found


_HASH = _Hashes()


def slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each word and of each pair of neighbours (the pair belongs to its second word)."""
    h = np.fromiter(map(_HASH.__getitem__, words), dtype=np.uint64, count=len(words))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)
    return (h % np.uint64(FEATURES)).astype(np.int64), (pairs % np.uint64(FEATURES)).astype(np.int64)


def starts(n: int, step: int) -> list[int]:
    """Where windows begin; the last one ends with the text."""
    if n <= WINDOW:
        return [0] if n else []
    return sorted({*range(0, n - WINDOW + 1, step), n - WINDOW})


def window_rows(words: list[str], idf: np.ndarray, step: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each window as a sparse unit vector of TF-IDF weights."""
    one, two = slots(words)
    out = []
    for s in starts(len(words), step):
        seen = Counter(one[s : s + WINDOW].tolist())
        seen.update(two[s : s + WINDOW - 1].tolist())
        at = np.fromiter(seen, dtype=np.int64, count=len(seen))
        weight = np.sqrt(np.fromiter(seen.values(), dtype=float, count=len(seen))) * idf[at]
        norm = np.linalg.norm(weight)
        if norm:
            out.append((at, (weight / norm).astype(np.float32)))
    return out


_SLOTS = 1 << 40


def read_corpus(documents: DataFrame) -> tuple[np.ndarray, DataFrame]:
    """(inverse document frequencies of all features, texts to fit the space on), from one pass over all documents.

    Each task sends one count per feature at most, and the few documents with its smallest hashes: together they hold
    the FIT_DOCUMENTS smallest hashes of all. What a task keeps depends on the number of tasks, not on its rows.
    """
    source = documents.filter("text is not null").select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(_SLOTS)).alias("draw"), "text")
    tasks = source._jdf.queryExecution().toRdd().getNumPartitions()
    keep = 4 * -(-FIT_DOCUMENTS // max(tasks, 1)) + 32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, dtype=np.int64), 0
        drawn: list[tuple[int, str]] = []
        for batch in batches:
            draws, texts = (batch.column(i).to_pylist() for i in (0, 1))
            for text in texts:
                one, two = slots(words_of(text))
                total[np.unique(np.concatenate([one, two]))] += 1
            n += len(texts)
            drawn = heapq.nsmallest(keep, chain(drawn, zip(draws, texts)))
        at = np.flatnonzero(total)
        none = len(at) + 1
        feature = pa.array([*at.tolist(), -1, *[None] * len(drawn)], pa.int64())
        times = pa.array([*total[at].tolist(), n, *[None] * len(drawn)], pa.int64())
        draw, text = (pa.array([*[None] * none, *(d[i] for d in drawn)], kind) for i, kind in ((0, pa.int64()), (1, pa.string())))
        yield pa.RecordBatch.from_arrays([feature, times, draw, text], ["feature", "n", "draw", "text"])

    told = checkpointed(source.mapInArrow(count, "feature bigint, n bigint, draw bigint, text string"))
    found = {r.feature: r.n for r in told.filter("feature is not null").groupBy("feature").agg(F.sum("n").alias("n")).collect()}  # FEATURES + 1 rows at most
    n = found.pop(-1, 0)
    idf = np.full(FEATURES, math.log((n + 1) / 1) + 1)
    for feature, df in found.items():
        idf[feature] = math.log((n + 1) / (df + 1)) + 1
    sample = told.filter("feature is null").select("draw", "text")
    if n > FIT_DOCUMENTS:
        sample = sample.filter(F.col("draw") < int(_SLOTS * (FIT_DOCUMENTS - 4 * FIT_DOCUMENTS**0.5) / n))
    return idf.astype(np.float32), sample.limit(FIT_DOCUMENTS).select("text")


def latent_space(sample: DataFrame, item_rows: list, idf: np.ndarray) -> np.ndarray:
    """FEATURES x RANK right singular vectors of the passages' TF-IDF matrix, by randomised subspace iteration.

    Each task multiplies its passages with the current basis and back, one task adds the products up, and the driver
    makes the sum orthogonal: its size depends on FEATURES and RANK alone.
    """
    spark = sample.sparkSession
    sample = checkpointed(sample.repartition(4))
    weights = spark.sparkContext.broadcast(idf)
    width = RANK + EXTRA
    basis = np.random.default_rng(17).standard_normal((FEATURES, width)).astype(np.float32)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(FEATURES * width, dtype=np.float32)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                out += np.frombuffer(part, dtype=np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

    for _ in range(POWER + 1):
        sent = spark.sparkContext.broadcast(basis)

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((FEATURES, width), dtype=np.float32)
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    _accumulate(out, window_rows(words_of(text), weights.value, WINDOW), sent.value)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

        total = np.zeros((FEATURES, width), dtype=np.float32)
        _accumulate(total, [(at, w * ITEM_WEIGHT) for at, w in item_rows], basis)
        for r in sample.mapInArrow(multiply, "part binary").repartition(1).mapInArrow(add, "part binary").collect():
            total += np.frombuffer(r.part, dtype=np.float32).reshape(FEATURES, width)
        basis = np.linalg.qr(total)[0].astype(np.float32)
    # the basis' directions by their weight over the items' passages: the strongest RANK are kept
    small = np.stack([(w[:, None] * basis[at]).sum(0) for at, w in item_rows])
    turn = np.linalg.svd(small, full_matrices=False)[2]
    return (basis @ turn.T[:, :RANK]).astype(np.float32)


def _accumulate(out: np.ndarray, rows: list, basis: np.ndarray) -> None:
    for at, w in rows:
        out[at] += w[:, None] * (w @ basis[at])[None, :]


def projected(rows: list, space: np.ndarray) -> np.ndarray:
    """Unit vectors of sparse rows in the latent space."""
    out = np.stack([w @ space[at] for at, w in rows]) if rows else np.zeros((0, space.shape[1]), np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def document_windows(words: list[str], weighted: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Unit vectors of a document's windows at ``begin``, by differences of running sums; repeats in a window count fully.

    ``weighted`` are the rows of the latent space times their inverse document frequency.
    """
    one, two = slots(words)
    n = len(words)
    pairs = weighted[two]
    total = np.zeros((n + 1, weighted.shape[1]), dtype=np.float32)
    total[1:] = weighted[one]
    total[2:] += pairs
    np.cumsum(total, axis=0, out=total)
    out = total[np.minimum(begin + WINDOW, n)] - total[begin]
    out[begin > 0] -= pairs[begin[begin > 0] - 1]  # the pair that reaches over the window's start
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def common_length(masks: dict[str, int], size: int, words: list[str]) -> int:
    """Length of the longest common subsequence of an item (as bit masks of its words' places) and some words."""
    v = (1 << size) - 1
    full = v
    for w in words:
        u = v & masks.get(w, 0)
        v = (v + u | v - u) & full
    return size - v.bit_count()


def _best_score(item: list[str], ids: dict[str, int], text: np.ndarray, added: np.ndarray) -> float:
    gains: dict[str, np.ndarray] = {}
    h, nh, best = np.zeros(len(text) + 1), np.zeros(len(text) + 1), 0.0
    for w in item:
        if w not in gains:
            gains[w] = np.where(text == ids[w], 1.0, -EDIT_COST)
        nh[0] = 0.0
        np.add(h[:-1], gains[w], out=nh[1:])
        h -= EDIT_COST
        np.maximum(nh, h, out=nh)
        nh += added
        np.maximum.accumulate(nh, out=nh)
        nh -= added
        np.maximum(nh, 0.0, out=nh)
        best = max(best, nh.max())
        h, nh = nh, h
    return float(best)


def aligned(item: list[str], words: list[str]) -> tuple[int, int, float, int]:
    """(matching words, edits, score, item words spanned) of the best run of an item's words in a text; zeros if no run
    keeps LEAST_SCORE.

    Local alignment: a matching word counts 1, a changed, missing or added one costs EDIT_COST, in any number. The
    scores come first; where the best run lies is only followed up if it counts.
    """
    ids = {w: i for i, w in enumerate(dict.fromkeys(item))}
    text = np.array([ids.get(w, -1) for w in words])
    n = len(text)
    at = np.arange(n + 1)
    if _best_score(item, ids, text, EDIT_COST * at) < LEAST_SCORE:
        return (0, 0, 0.0, 0)
    h, m, e, begun = np.zeros(n + 1), np.zeros(n + 1, dtype=int), np.zeros(n + 1, dtype=int), np.zeros(n + 1, dtype=int)
    best = (0, 0, 0.0, 0)
    for i, w in enumerate(item):
        same = text == ids[w]
        nh, nm, ne, nb = np.zeros(n + 1), np.zeros(n + 1, dtype=int), np.zeros(n + 1, dtype=int), np.full(n + 1, i)
        nh[1:] = h[:-1] + np.where(same, 1.0, -EDIT_COST)
        nm[1:], ne[1:], nb[1:] = m[:-1] + same, e[:-1] + ~same, np.where(h[:-1] > 0, begun[:-1], i)
        up = h - EDIT_COST  # a missing word
        take = up > nh
        nh[take], nm[take], ne[take], nb[take] = up[take], m[take], e[take] + 1, begun[take]
        # added words: each place may be reached from every one before it
        lifted = nh + EDIT_COST * at
        source = np.maximum.accumulate(np.where(lifted >= np.maximum.accumulate(lifted), at, 0))
        nh, nm, ne, nb = lifted[source] - EDIT_COST * at, nm[source], ne[source] + at - source, nb[source]
        dead = nh <= 0
        nh[dead], nm[dead], ne[dead], nb[dead] = 0.0, 0, 0, i + 1
        h, m, e, begun = nh, nm, ne, nb
        k = int(h.argmax())
        if h[k] > best[2]:
            best = (int(m[k]), int(e[k]), float(h[k]), i + 1 - int(begun[k]))
    return best


class Items:
    """A block of evaluation items, ready to be searched for."""

    def __init__(self, rows: list[tuple[int, str]], idf: np.ndarray):
        self.ids = [i for i, _ in rows]
        self.words = [words_of(t) for _, t in rows]
        self.vocabulary = frozenset(w for words in self.words for w in words)
        self.masks, self.answers = [], []
        for words in self.words:
            masks: dict[str, int] = {}
            for k, w in enumerate(words):
                masks[w] = masks.get(w, 0) | 1 << k
            self.masks.append(masks)
            rare = sorted(masks, key=lambda w: (-idf[_HASH[w] % FEATURES], w))[: (len(masks) + 1) // 2]
            self.answers.append(frozenset(rare) | {w for w in masks if w.isdigit()})
        self.rows, self.owner = [], []
        for k, words in enumerate(self.words):
            for row in window_rows(words, idf, ITEM_STEP):
                self.rows.append(row)
                self.owner.append(k)

    def leaks(self, words: list[str], hits: Iterable[tuple[int, int, bool]]) -> Iterator[tuple]:
        """(item id, kind, words, edits, score, common, answers) of the items that the hit windows (begin, item, very
        near) really hold."""
        by_item: dict[int, list[int]] = {}
        near = set()
        for begin, item, very in hits:
            by_item.setdefault(item, []).append(begin)
            if very:
                near.add(item)
        for item, begins in by_item.items():
            own, masks, size = self.words[item], self.masks[item], len(self.words[item])
            held = [b for b in begins if common_length(masks, size, words[b : b + WINDOW]) >= LEAST_COMMON]
            best = max((aligned(own, words[a:b]) for a, b in _spans(held, len(words))), key=lambda x: x[2], default=(0, 0, 0.0, 0))
            if best[3] >= MIN_WORDS and best[2] >= LEAST_SCORE:
                yield (self.ids[item], "passage", *best[:3], None, None)
            elif item in near and size >= MIN_WORDS:
                said = max((self._said(item, words[a:b]) for a, b in _spans(begins, len(words), size)), default=(0.0, 0.0))
                if said[0] >= PARAPHRASE_COMMON and said[1] >= ANSWER_SHARE:
                    yield (self.ids[item], "reworded", *best[:3], *said)

    def _said(self, item: int, words: list[str]) -> tuple[float, float]:
        """(share of the item's words in common order, share of its answer words) of a stretch of a document."""
        there = set(words)
        return common_length(self.masks[item], len(self.words[item]), words) / len(self.words[item]), len(self.answers[item] & there) / len(self.answers[item])


def _spans(begins: list[int], n: int, margin: int = WINDOW) -> list[tuple[int, int]]:
    """The stretches of a text around windows, those that overlap made one."""
    out: list[tuple[int, int]] = []
    for b in sorted(begins):
        low, high = max(0, b - margin), min(n, b + WINDOW + margin)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in blocks of BLOCK_CHARS characters, or one item if that is longer."""
    block, size = [], 0
    for r in items.filter("text is not null").select("item_id", "text").distinct().orderBy("item_id", "text").toLocalIterator():
        if block and size + len(r.text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += len(r.text)
    if block:
        yield block


SCHEMA = "item_id bigint, doc_id bigint, kind string, n_words int, n_edits int, score double, common double, answers double"


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, doc_id, kind, n_words, n_edits, score, common, answers): documents that hold text of an item.

    documents: doc_id, text; items: item_id, text. Kind ``passage``: MIN_WORDS words in a row of the item's text, where
    letter case, punctuation, white space, line breaks and an occasional changed, added or missing word don't matter.
    Kind ``reworded``: no such run, but near in the latent space, most of the item's words in the same order, and its
    answer words; ``common`` and ``answers`` are those two shares, null for a passage.

    Every document is searched whole, window by window, in one pass without a shuffle: cosine in the latent space finds
    candidates, the longest common subsequence and a local alignment decide. A window of which fewer words than such a
    subsequence needs occur in any item is passed over, as it can't be a leak. Null, empty or blank texts and items of
    fewer than MIN_WORDS words match nothing; equal items are all reported; repeated documents come out once per
    (item_id, doc_id), as passage if they are one.
    """
    spark = documents.sparkSession
    blocks = item_blocks(items)
    first = next(blocks, None)
    if first is None:
        return spark.createDataFrame([], SCHEMA)
    idf, sample = read_corpus(documents)
    fit = items.filter("text is not null").select("item_id", "text").distinct()
    drawn = first if len(first) <= FIT_ITEMS else [(r.item_id, r.text) for r in hash_sample(fit, FIT_ITEMS, "item_id", "text").collect()]
    rows = Items(drawn, idf).rows
    if not rows:
        return spark.createDataFrame([], SCHEMA)
    space = latent_space(sample, rows, idf)
    found = None
    for part in chain([first], blocks):
        block = Items(part, idf)
        if not block.rows:
            continue
        known = spark.sparkContext.broadcast((block, space * idf[:, None], projected(block.rows, space), np.array(block.owner)))
        leaks = documents.filter("text is not null").select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_search(known), SCHEMA)
        found = leaks if found is None else found.unionByName(leaks)
    if found is None:
        return spark.createDataFrame([], SCHEMA)
    columns = ("kind", "n_words", "n_edits", "score", "common", "answers")
    best = F.max(F.struct((F.col("kind") == "passage").alias("whole"), "score", *[c for c in columns if c != "score"]))
    return found.groupBy("item_id", "doc_id").agg(best.alias("best")).select("item_id", "doc_id", *[f"best.{c}" for c in columns])


def _search(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weighted, latent, owner = known.value
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if len(words) < LEAST_COMMON:
                    continue
                for row in block.leaks(words, _hits(words, block.vocabulary, weighted, latent, owner)):
                    out.append((row[0], doc, *row[1:]))
            if out:
                types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [c.split()[0] for c in SCHEMA.split(", ")])

    return run


def _hits(words: list[str], vocabulary: frozenset, weighted: np.ndarray, latent: np.ndarray, owner: np.ndarray) -> set[tuple[int, int, bool]]:
    """(begin, item, very near) of the document's windows that are near an item's in the latent space."""
    shared = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(vocabulary.__contains__, words), dtype=np.int64, count=len(words)), out=shared[1:])
    begin = np.array(starts(len(words), DOC_STEP))
    begin = begin[shared[np.minimum(begin + WINDOW, len(words))] - shared[begin] >= LEAST_COMMON]
    hits = set()
    for a in range(0, len(begin), 1000):  # long texts in stretches
        low = int(begin[a])
        some = begin[a : a + 1000]
        vectors = document_windows(words[low : int(some[-1]) + WINDOW], weighted, some - low)
        for c in range(0, len(latent), 20_000):
            cosine = vectors @ latent[c : c + 20_000].T
            for k, j in zip(*np.nonzero(cosine >= COSINE)):
                hits.add((int(some[k]), int(owner[c + j]), bool(cosine[k, j] >= PARAPHRASE_COSINE)))
    return hits
