"""The corpus as token ids of a public vocabulary."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the vocabulary files lie on the driver; executors get the ranks by broadcast.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-tokenisation pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts are encoded in parts of about this many characters, cut where the pattern cuts anyway.
PART = 20_000
#: Before a single space or line feed between two visible characters no token of the pattern ever continues.
_SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")


def load_ranks(path: str | Path) -> dict[bytes, int]:
    """The vocabulary of a rank file: base64 of a token and its id on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line)}


#: By the identity of the ranks, which are kept with it, so that no other vocabulary can have the same.
_ENCODERS: dict[int, tuple[dict[bytes, int], object]] = {}


def encoder(ranks: dict[bytes, int]):
    """The encoding of a vocabulary, made once per process."""
    import tiktoken

    if id(ranks) not in _ENCODERS:
        _ENCODERS[id(ranks)] = (ranks, tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return _ENCODERS[id(ranks)][1]


def safe_parts(text: str, part: int = PART) -> Iterator[str]:
    """The text in parts that encode to the same ids as the whole."""
    at = 0
    while len(text) - at > part:
        cut = _SAFE.search(text, at + part)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def encode(text: str | None, encoding) -> list[int]:
    """The ids of a text; none for a null or empty one."""
    if not text:
        return []
    if len(text) <= PART:
        return encoding.encode_ordinary(text)
    return [i for part in safe_parts(text) for i in encoding.encode_ordinary(part)]


def decode(ids: list[int], encoding) -> str:
    """The text of ids, through the raw bytes of the tokens: a token may end inside a character."""
    return b"".join(encoding.decode_single_token_bytes(i) for i in ids).decode("utf-8", errors="replace")


def encode_documents(documents: DataFrame, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, ids): every row's text as ids of the vocabulary, without special tokens.

    documents: doc_id, text. A null or empty text has an empty list of ids; blank text has the ids of its blanks;
    strings of special tokens are ordinary text. Repeated rows each keep their row. One pass without a shuffle.
    """
    spark: SparkSession = documents.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(ranks.value)
        for batch in batches:
            lists = [encode(text, encoding) for text in batch.column(1).to_pylist()]
            offsets = np.zeros(len(lists) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            values = np.fromiter((i for x in lists for i in x), dtype=np.int32, count=int(offsets[-1]))
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def round_trip(documents: DataFrame, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, n_ids, same): whether decoding a row's ids gives its text back (an empty one for null)."""
    spark = documents.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(ranks.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [encode(text, encoding) for text in texts]
            same = [decode(x, encoding) == (text or "") for x, text in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "n_ids", "same"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_ids bigint, same boolean")
