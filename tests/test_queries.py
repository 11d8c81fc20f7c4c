"""Every query with a DuckDB twin, on the smallest tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cellweave import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


def plain(value):
    import datetime
    import math

    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)[:10] if not isinstance(value, datetime.datetime) or value.time() == datetime.time() else str(value)
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    if name not in ORACLES:
        assert len(got) > 0
        return
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    want = sorted((tuple(plain(v) for _, v in sorted(zip(names, row))) for row in cur.fetchall()), key=repr)
    have = sorted((tuple(plain(r[c]) for c in order) for r in got), key=repr)
    assert len(have) == len(want)
    assert have == want


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
