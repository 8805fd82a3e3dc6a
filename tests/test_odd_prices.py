"""Queries against their SQL on tables where prices are missing, NaN, or zero on many days."""

from pathlib import Path

import duckdb
import pytest
from test_queries import SF, plain

from tidewell.plans import registry

NULLS = ["target_stop_outcomes", "trade_summary", "edge_decay", "equal_weights", "benchmark_analysis", "capacity_sweep", "contract_price_features", "lags_and_flows", "market_features"]
CASES = [("null", n) for n in NULLS] + [(kind, n) for kind in ("nan", "zero") for n in ("equal_weights", "volatility_scaled_weights", "same_day_hit_rate", "technical_indicators")]
VALUES = {"null": "CASE WHEN event_id % 7 = 1 THEN NULL ELSE value END", "nan": "CASE WHEN event_id % 9 = 1 THEN 'NaN'::DOUBLE ELSE value END", "zero": "CASE WHEN event_id % 3 > 0 THEN 0 ELSE value END"}


@pytest.fixture(scope="session")
def odd(tmp_path_factory):
    out = {}
    for kind, value in VALUES.items():
        folder, con = tmp_path_factory.mktemp(kind), duckdb.connect()
        for p in Path(SF).glob("*.parquet"):
            con.execute(f"COPY (SELECT {f'* REPLACE ({value} AS value)' if p.stem == 'events' else '*'} FROM '{p}') TO '{folder / p.name}' (FORMAT parquet)")
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{folder / p.name}'")
        out[kind] = str(folder), con
    return out


@pytest.mark.parametrize(("kind", "name"), CASES)
def test_odd_prices(spark, odd, kind, name):
    folder, con = odd[kind]
    df = registry.queries()[name](spark, folder)
    rows, rel = df.collect(), con.sql(registry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    order = sorted(names)
    got = sorted(([plain(r[c]) for c in order] for r in rows), key=repr)
    want = sorted(([plain(r[names.index(c)]) for c in order] for r in rel.fetchall()), key=repr)
    assert got == want
