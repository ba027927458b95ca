"""Model stages over rows: any callable in place of a model, errors as data, answers kept once."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json_salvage import salvaged_items
from tidemark.functions.text import short_error

CHUNK = 20


class Model(Protocol):
    """Answers a list of texts in order; it is sent to the executors, so it must pickle."""

    def __call__(self, texts: list[str]) -> list[str]: ...


def run_model(
    rows: DataFrame, key: str, text: str, model: Model, chunk: int = CHUNK, rounds: int = 1, valid: Callable[[str], bool] | None = None, wait: float = 0.0
) -> DataFrame:
    """(key, answer, error): the model's answer to each row, in chunks; a failing chunk fails its own rows only.

    Rows whose answer is empty or not ``valid``, and rows of a chunk that failed, are asked again ``rounds`` - 1 times,
    ``wait`` seconds later and twice as long each time; answers that were given stay. Errors come as data, so that a
    repeated task asks again and a finished one doesn't: write the result before anything depends on it.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), chunk):
                part = frame.iloc[at : at + chunk]
                answers, error = _asked(list(part[text].fillna("")), model, rounds, valid, wait)
                yield pd.DataFrame({key: part[key].to_numpy(), "answer": answers, "error": error})

    kind = dict(rows.dtypes)[key]
    result = rows.select(key, text).mapInPandas(ask, f"{key} {kind}, answer string, error string")
    return result.select(key, "answer", short_error(F.col("error")).alias("error"))


def _asked(
    texts: list[str], model: Model, rounds: int, valid: Callable[[str], bool] | None = None, wait: float = 0.0, sleep: Callable[[float], None] = time.sleep
) -> tuple[list[str | None], list[str | None]]:
    answers: list[str | None] = [None] * len(texts)
    errors: list[str | None] = ["empty answer"] * len(texts)
    for turn in range(max(rounds, 1)):
        todo = [i for i, a in enumerate(answers) if a is None]
        if not todo:
            break
        if turn and wait:
            sleep(wait * 2 ** (turn - 1))
        try:
            given = list(model([texts[i] for i in todo]))
        except Exception as problem:  # noqa: BLE001 - whatever a model raises belongs to its rows
            for i in todo:
                errors[i] = f"{type(problem).__name__}: {problem}"
            continue
        for i, a in zip(todo, given):
            fits = bool(a) and (valid is None or valid(a))
            answers[i], errors[i] = (a, None) if fits else (None, "invalid answer" if a else "empty answer")
    return answers, errors


def truth_confidence(top: Column) -> Column:
    """array<struct<token, logprob>> to (relevant, confidence): the weight of ``true`` against ``false``; (false, null)
    if neither is among the tokens."""
    weight = lambda word: F.aggregate(F.filter(top, lambda t: F.lower(F.trim(t["token"])) == word), F.lit(0.0), lambda s, t: s + F.exp(t["logprob"]))
    total = weight("true") + weight("false")
    confidence = F.when(total > 0, weight("true") / total)
    return F.struct(F.coalesce(confidence >= 0.5, F.lit(False)).alias("relevant"), confidence.alias("confidence"))


def tagged_pages(pages: Column) -> Column:
    """Transcribed pages as one document: front matter dropped, pages tagged from 0, tables numbered from 1."""
    clean = F.transform(pages, lambda p: F.regexp_replace(p, r"^---[\s\S]*?---\s*", ""))
    blocks = F.transform(clean, lambda p, i: F.concat(F.lit('<page number="'), i.cast("string"), F.lit('">\n\n'), p, F.lit("\n\n</page>\n\n")))
    parts = F.split(F.array_join(blocks, ""), "<table>")
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit('<table number="'), i.cast("string"), F.lit('">'), p))), "")


def extracted_records(answers: DataFrame, key: str, schema: str) -> DataFrame:
    """(key, record): the records that a model's answers hold, those without a value dropped; cut answers give what is whole."""
    items = answers.filter("answer is not null").select(key, F.explode(salvaged_items("answer")).alias("item"))
    return items.select(key, F.from_json("item", schema).alias("record")).filter("record.value is not null")


#: What a record tells about where it was read.
PROVENANCE = ("page_number", "table_number", "row_index", "column_index", "source")


def extraction_rows(records: DataFrame, key: str, schema_name: str, model_version: str, latitude: str | None = None, longitude: str | None = None) -> DataFrame:
    """(key, schema_name, model_version, data, provenance, confidence, latitude, longitude) of records: ``data`` without the
    document's text, ``provenance`` with the fields of PROVENANCE, null where a record has none, coordinates from the
    named fields. Rows are appended, never replaced."""
    fields = records.schema["record"].dataType.names
    told = F.struct(*[(F.col(f"record.{p}") if p in fields else F.lit(None).cast("string")).alias(p) for p in PROVENANCE])
    place = lambda name: (F.col(f"record.{name}").cast("double") if name in fields else F.lit(None).cast("double"))
    return records.select(
        key, F.lit(schema_name).alias("schema_name"), F.lit(model_version).alias("model_version"), F.struct(*[F.col(f"record.{f}").alias(f) for f in fields if f != "context"]).alias("data"),
        F.to_json(told, {"ignoreNullFields": "false"}).alias("provenance"), F.lit(None).cast("float").alias("confidence"), place(latitude).alias("latitude"), place(longitude).alias("longitude"),
    )


class IdleClock:
    """Tells when a polling loop may end: only progress resets it; an empty queue ends it at once."""

    def __init__(self, limit: float, now: Callable[[], float] = time.monotonic):
        self.limit, self.now = limit, now
        self.since = now()

    def done(self, progress: int, waiting: int) -> bool:
        if progress:
            self.since = self.now()
        return not waiting or self.now() - self.since >= self.limit
