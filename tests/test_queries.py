"""Every registered query against its SQL on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from tidewell.plans import registry

SF = os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")
registry.load()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    rows = df.collect()
    if name not in registry.oracle_sql():
        assert rows
        return
    rel = duck.sql(registry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    got = sorted(([plain(r[c]) for c in order] for r in rows), key=repr)
    want = sorted(([plain(r[names.index(c)]) for c in order] for r in rel.fetchall()), key=repr)
    assert got == want
