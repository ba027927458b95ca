"""JSON that a model wrote: with prose around it, or cut off."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_json(text: str | None):
    """The first JSON object or array in a text, or None."""
    decoder, at = json.JSONDecoder(), 0
    while text and at < len(text):
        starts = [i for i in (text.find("{", at), text.find("[", at)) if i >= 0]
        if not starts:
            return None
        at = min(starts)
        try:
            return decoder.raw_decode(text, at)[0]
        except ValueError:
            at += 1
    return None


def leading_items(text: str | None) -> list[dict]:
    """The complete objects at the start of a cut ``"items": [...``; stops at the first that doesn't parse."""
    key = text.find('"items"') if text else -1
    at = text.find("[", key) + 1 if key >= 0 else 0
    decoder, out = json.JSONDecoder(), []
    while at:
        while at < len(text) and text[at] in " \t\r\n,":
            at += 1
        if at >= len(text) or text[at] != "{":
            return out
        try:
            item, at = decoder.raw_decode(text, at)
        except ValueError:
            return out
        out.append(item)
    return out


def response_items(text: str | None) -> list[str]:
    """The items of a model's answer as JSON texts: of the whole answer if it parses, else what can be saved."""
    whole = first_json(text)
    items = whole.get("items") if isinstance(whole, dict) and "items" in whole else whole if isinstance(whole, list) else None
    if not isinstance(items, list):
        items = leading_items(text)
    return [json.dumps(i, ensure_ascii=False) for i in items if isinstance(i, dict) and isinstance(i.get("attribute"), str)]


@F.pandas_udf(T.ArrayType(T.StringType()))
def salvaged_items(text: pd.Series) -> pd.Series:
    return text.astype(object).where(text.notna(), None).map(response_items)
