"""Every query of the line engine against its SQL in DuckDB."""

import math
from datetime import datetime
from pathlib import Path

import duckdb
import pytest

from lineflow.plans.registry import ORACLES, QUERIES


def comparable(rows):
    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v.replace(tzinfo=None) if isinstance(v, datetime) else v

    return sorted((tuple(value(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def tables(sf_dir):
    for p in Path(sf_dir).glob("*.parquet"):
        duckdb.sql(f"create or replace view {p.stem} as select * from read_parquet('{p}')")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, tables, name):
    got = QUERIES[name](spark, sf_dir)
    if name not in ORACLES:
        assert got.count() > 0
        return
    want = duckdb.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(want.columns)
    rows = [dict(zip(want.columns, r)) for r in want.fetchall()]
    assert rows, "the oracle gives no rows"
    assert comparable(tuple(r[c] for c in order) for r in got.select(order).collect()) == comparable(tuple(r[c] for c in order) for r in rows)
