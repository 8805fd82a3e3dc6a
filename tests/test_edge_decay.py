"""edge_decay evaluates all six measures of the edge monitor on series of a month."""

from test_queries import SF

from tidewell.plans import registry

registry.load()


def test_edge_decay_is_whole(spark):
    got = registry.queries()["edge_decay"](spark, SF).collect()
    measures = ["win_rate", "profit_factor", "sharpe", "hit_rate", "hit_decay", "winner_loser", "hurst"]
    assert got and all(r[c] is not None for r in got for c in measures if r.n == 10)
    assert all((r.level == "GREEN") == (r.breaches == "") for r in got) and {"YELLOW", "ORANGE"} & {r.level for r in got}


def test_a_null_symbol_keeps_its_row(spark, tmp_path):
    import duckdb

    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN user_id = 3 THEN NULL ELSE user_id END AS user_id) FROM '{SF}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    got = registry.queries()["edge_decay"](spark, str(tmp_path)).collect()
    assert sum(r.symbol is None for r in got) == 1
