"""Queries against their SQL on tables with prices of zero, after which returns are infinite."""

import pytest
from test_queries import SF, plain

from tidewell.plans import registry

ZERO = [
    "prediction_scorecard",
    "target_stop_outcomes",
    "trade_summary",
    "volatility_estimators",
    "edge_decay",
    "ensemble_diversity",
    "equal_weights",
    "factor_gate",
    "factor_regression",
    "aligned_labels",
    "benchmark_analysis",
    "capacity_sweep",
    "contract_price_features",
    "lags_and_flows",
    "market_features",
    "full_symbol_snapshots",
    "scenario_metrics",
]


@pytest.fixture(scope="session")
def zero(tmp_path_factory):
    """A folder of tables: those of the smallest size with a value of zero in some events; and a connection to them."""
    from pathlib import Path

    import duckdb

    out, con = tmp_path_factory.mktemp("zero"), duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        value = "* REPLACE (CASE WHEN event_id % 90 = 7 THEN 0 ELSE value END AS value)" if p.stem == "events" else "*"
        con.execute(f"COPY (SELECT {value} FROM '{p}') TO '{out / p.name}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{out / p.name}'")
    return str(out), con


@pytest.mark.parametrize("name", ZERO)
def test_zero_prices(spark, zero, name):
    folder, con = zero
    df = registry.queries()[name](spark, folder)
    rows, rel = df.collect(), con.sql(registry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    order = sorted(names)
    got = sorted(([plain(r[c]) for c in order] for r in rows), key=repr)
    want = sorted(([plain(r[names.index(c)]) for c in order] for r in rel.fetchall()), key=repr)
    assert got == want
