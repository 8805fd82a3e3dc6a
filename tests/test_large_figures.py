"""Queries against their SQL on a few bars of larger tables where a figure stands on a limit or is infinite."""

import duckdb
import pytest
from test_queries import plain

from tidewell.plans import registry

registry.load()


def events(*series) -> str:
    """SQL of events from (user, first day of January 2024, a list of the values of each day)."""
    rows = [(user, first + i, k, v) for user, first, days in series for i, values in enumerate(days) for k, v in enumerate(values)]
    text = ", ".join(f"({n}::BIGINT, TIMESTAMP '2024-01-{day:02d} {8 + k:02d}:00:00', {user}::BIGINT, 'view', CAST('{v}' AS DOUBLE), '{{\"k\": 1}}')" for n, (user, day, k, v) in enumerate(rows))
    return f"SELECT * FROM (VALUES {text}) t(event_id, ts, user_id, event_type, value, props)"


SIZES = events((5199, 2, [[88.92, 87.42, 115.92]]), (3201, 17, [[40.92, 37.42]]), (1629, 21, [[13.83, 60.83]]), (3939, 17, [[51.4, 61.9]]), (12349, 2, [[36.81, 26.18]]))
ENDLESS = events((1, 1, [[0.0], [5.0], [7.5]]), (2, 1, [[3.0]] * 9 + [[0.0], [4.0]]), (3, 1, [[0.0], [2.0], [0.0], [9.0], [1.0]]))
MISSING = events((1, 1, [[5.0 + i] for i in range(8)] + [["NaN"], [6.0]]), (2, 1, [[2.0 + i % 3] for i in range(12)]))
GAPS = f"SELECT * REPLACE (CASE WHEN isnan(value) OR user_id = 2 AND event_id % 5 = 1 THEN NULL ELSE value END AS value) FROM ({MISSING})"
SIGNED = events((1, 1, [[5.0], ["-0.0"], [7.5], [0.0], [2.0], ["-0.0"], ["-0.0"], [3.0]]))
WAVES = events((1, 1, [[0.0]] + [[10.0 + i * 7 % 11] for i in range(27)]), (2, 1, [[7.0]] * 24 + [[9.0]]), (3, 1, [[0.0]] * 26), (4, 1, [[20.0 + i * 5 % 13] for i in range(28)]))
LEVEL = events((952, 1, [[6.62], [7.36], [6.99], [29.49], [87.81], [1.93], [38.36], [6.42], [81.0], [48.04], [76.85], [54.32], [30.05], [32.34], [8.65], [102.88], [], [18.41], [71.16], [49.19], [27.07], [28.38], [19.73], [52.43], [13.12], [11.6], [104.22], [68.6], [2.39], []]))
NEAR = events((4940, 1, [[10.69], [47.13], [31.08], [], [94.94], [56.6], [26.0], [15.9], [36.94], [83.28], [18.08], [31.21], [18.89], [45.14], [5.71], [31.94], [0.13], [6.17], [41.28], [126.1], [102.45], [], [7.53], [11.02], [0.72], [35.98], [75.39], [4.36], [5.28], [9.04]]))
BIG = events((1, 1, [[2097475047.6473374], [8.155060151683571e+16], [1852867173.8462474], [831918320106.9789], [1.0]]))
CASES = [
    ("risk_budget_sizes", SIZES),
    ("symbol_snapshots", ENDLESS),
    ("symbol_snapshots", GAPS),
    ("symbol_snapshots", SIGNED),
    ("full_symbol_snapshots", ENDLESS),
    ("full_symbol_snapshots", GAPS),
    ("signal_pipeline", WAVES),
    ("contract_price_features", SIGNED),
    ("lags_and_flows", SIGNED),
    ("regime_performance", LEVEL),
    ("regime_performance", NEAR),
    ("lags_and_flows", BIG),
]


@pytest.mark.parametrize(("name", "sql"), CASES)
def test_large_figures(spark, tmp_path, name, sql):
    con = duckdb.connect()
    con.execute(f"COPY ({sql}) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    rows, rel = registry.queries()[name](spark, str(tmp_path)).collect(), con.sql(registry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    order = sorted(names)
    got = sorted(([plain(r[c]) for c in order] for r in rows), key=repr)
    want = sorted(([plain(r[names.index(c)]) for c in order] for r in rel.fetchall()), key=repr)
    assert got == want
