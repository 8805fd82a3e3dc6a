"""Jobs end to end, run logs and lineage."""

from datetime import date, timedelta

import numpy as np

from tidewell.operators import lineage, modeling
from tidewell.plans import jobs
from tidewell.sources import ingest


def test_daily_prices_job(spark, tmp_path):
    day = date(2024, 1, 2)
    rows = [(s, day + timedelta(days=i), 10.0 + i, 11.0 + i, 9.0 + i, 10.5 + i, 10.5 + i, 100, None, 0.0) for s in ("A", "B") for i in range(10)]
    rows.append((None, day, 1.0, 1.0, 1.0, 1.0, 1.0, 1, None, 0.0))
    spark.createDataFrame(rows, ingest.SOURCES["prices"].schema).write.parquet(f"{tmp_path}/in")
    out = f"file://{tmp_path}/out"
    tables = []
    for run in ("r1", "r2"):
        alerts = jobs.daily_prices(spark, f"file://{tmp_path}/in", out, run, "2024-02-01 00:00:00", "2024-01-03", "2024-01-12")
        assert {r.severity for r in alerts.collect()} == {"ok"}
        tables.append(sorted(map(tuple, spark.read.parquet(f"{out}/snap_symbol").collect()), key=repr))
    assert tables[0] == tables[1] and len(tables[0]) == 20
    assert spark.read.json(f"{out}/quarantine").count() == 1
    assert {r.status for r in lineage.latest_runs(spark, f"{out}/runs").collect()} <= {"started", "finished"}
    # the snapshot of a day does not know that day's close, which comes 16:15 later
    first = [r for r in spark.read.parquet(f"{out}/snap_symbol").collect() if r.asof_ts.day == 3]
    assert {r.price for r in first} == {10.5}


def test_lineage_and_journal(spark, tmp_path):
    a, b = spark.range(5).toDF("x"), spark.range(3).toDF("x")
    rec = lineage.record({"a": a, "b": b}, a.union(b), "c", "2024-01-01 00:00:00")
    assert {r.table_name for r in lineage.upstream(rec, "c").collect()} == {"a", "b"}
    assert {r.table_name for r in lineage.downstream(rec, "a").collect()} == {"c"}
    again = lineage.record({"a": a.repartition(3), "b": b}, b.union(a), "c", "2024-01-01 00:00:00")
    assert {r.output_hash for r in rec.collect()} == {r.output_hash for r in again.collect()}
    events = spark.sql("SELECT 1 AS id, TIMESTAMP '2024-01-01 05:00:00' AS ts UNION ALL SELECT 2, TIMESTAMP '2024-01-02 05:00:00'")
    lineage.append_journal(events, f"file://{tmp_path}/j")
    assert [r.id for r in lineage.journal(spark, f"file://{tmp_path}/j", "2024-01-02", "2024-01-02").collect()] == [2]
    lineage.append_metrics(spark.sql("SELECT 'm' AS k, 1.5D AS sharpe, 3 AS n"), f"file://{tmp_path}/m", "r", ["k"])
    assert {(r.name, r.value) for r in spark.read.parquet(f"file://{tmp_path}/m").collect()} == {("sharpe", 1.5), ("n", 3.0)}


def test_signal_run_and_back_fill(spark, tmp_path):
    rows, start, rng = [], date(2024, 1, 1), np.random.default_rng(3)
    for k in range(40):
        close = 50.0 * np.exp(np.cumsum(rng.normal(0.006, 0.02, 60)))
        rows += [(f"S{k}", start + timedelta(days=i), float(c), float(c * 1.01), float(c * 0.99), float(c), float(rng.integers(50, 200))) for i, c in enumerate(close)]
    bars = spark.createDataFrame(rows, "symbol string, ts date, open double, high double, low double, close double, volume double")
    out = f"file://{tmp_path}/out"
    whole = jobs.signal_run(spark, bars, out, "r1", "2024-03-01 00:00:00", "2024-01-20", "2024-02-29").collect()
    assert whole and {r.direction for r in whole} == {"LONG"}
    day = max(r.date for r in whole)
    alone = jobs.signal_run(spark, bars.where(f"ts <= DATE '{day}'"), out, "r2", "2024-03-01 00:00:00", str(day)).collect()
    assert sorted(alone) == sorted(r for r in whole if r.date == day)
    read = spark.read.option("header", True).csv(f"{out}/signals")
    parsed = ingest.parse_blotter(read)
    assert parsed.count() == len(whole)

    try:
        jobs.signal_run(spark, bars.drop("close"), out, "r3", "2024-03-01 00:00:00", "2024-01-20")
        raise AssertionError("no error")
    except Exception as e:
        assert "close" in str(e)
    assert spark.read.parquet(f"{out}/runs").where("run_id = 'r3' AND status = 'failed'").count() == 1
    assert spark.read.parquet(f"{out}/runs").where("run_id IN ('r1', 'r2') AND status = 'finished'").count() == 2


def test_classifier_search(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 2))
    y = (x[:, 0] + 0.3 * rng.standard_normal(300) > 0).astype(int)
    rows = [(i // 100, "train" if i % 100 < 70 else "test", float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y, strict=True))]
    rows += [(3, "train" if i < 7 else "test", 0.1 * i, 0.0, 1) for i in range(10)] + [(0, "test", None, 0.0, 1), (0, "test", 0.0, 0.0, None)]
    folds = spark.createDataFrame(rows, "fold int, role string, a double, b double, y int")
    models = {k: m for k, m in modeling.classifiers("y").items() if k in ("logistic_0.01", "sparse_logistic_0.1", "forest", "boosted")}
    got = modeling.classifier_search(folds, ["a", "b"], "y", models).collect()
    assert {(r.model, r.fold) for r in got} == {(m, f) for m in models for f in (0, 1, 2)} and {r.n for r in got} == {30}
    assert all(r.hit_rate > 0.7 and 0 < r.brier < 0.25 and abs(r.rmse**2 - r.brier) < 1e-12 for r in got)
    best = modeling.best_model(modeling.classifier_search(folds, ["a", "b"], "y", models))
    assert best.where("best").count() == 1
    assert modeling.classifier_search(folds.where("false"), ["a", "b"], "y", models).count() == 0
