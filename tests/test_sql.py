"""Every query that has SQL gives the same rows as that SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

duckdb = pytest.importorskip("duckdb")
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for f in Path(SMALL).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v if v is None or isinstance(v, (bool, str)) else float(f"{float(v):.9g}") if isinstance(v, (int, float)) or hasattr(v, "quantize") else str(v)


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, views, name):
    frame = entry.queries()[name](spark, SMALL)
    want = views.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(want.columns)
    order = sorted(frame.columns)
    got_rows = sorted((tuple(plain(r[c]) for c in order) for r in frame.collect()), key=repr)
    at = [want.columns.index(c) for c in order]
    want_rows = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert got_rows == want_rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
