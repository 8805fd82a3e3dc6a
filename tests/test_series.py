"""Long series, exits, inference and stores against brute force."""

import json
import math
import os
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import asof, evaluate, inference, lineage, ranks, research, rules, series, snapshots, statistics
from tidewell.sources import ingest
from tidewell.streaming import delta, jobs


@pytest.fixture(scope="module")
def points(spark):
    """A hot series, some small ones and one without a name; ties in time."""
    rng = np.random.default_rng(1)
    rows = [("hot" if rng.random() < 0.8 else [None, "a", "b"][rng.integers(3)], int(rng.integers(0, 300)), k, float(rng.integers(0, 40)) if rng.random() < 0.95 else None) for k in range(1500)]
    return spark.createDataFrame(rows, "s string, t int, k int, x double").cache(), rows


def grouped(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    return by


def test_numbers_and_running_sums_of_hot_series(points):
    df, rows = points
    want = {}
    for v in grouped(rows).values():
        total = 0.0
        for i, r in enumerate(v):
            total += r[3] or 0.0
            want[r[2]] = (i, total)
    for tasks in (1, 7, None):
        got = series.numbered(df, ["s"], ["t", "k"], tasks=tasks, sums={"c": F.col("x")}).collect()
        assert {r.k: (r.i, r.c) for r in got} == want and len(got) == len(rows)
    parts = series.dealt(df, ["s"], "t", 8).groupBy("s", "__b").count().collect()
    assert max(r["count"] for r in parts) < 450 and len([r for r in parts if r.s == "hot"]) > 4  # of 1200 hot rows
    assert series.numbered(df.where("false"), ["s"], ["t", "k"]).count() == 0


def test_as_of_reads_of_hot_series(points):
    df, _ = points
    facts = df.select("s", F.col("t").alias("available_time"), "k", "x")
    cells = df.select("s", (F.col("t") + F.col("k") % 7 - 3).alias("asof_ts"))
    want = sorted(map(repr, asof.latest(cells, facts, "s", ["available_time", "k"], ["x", "k"]).collect()))
    for tasks in (1, 9):
        assert sorted(map(repr, series.latest(cells, facts, "s", ["available_time", "k"], ["x", "k"], tasks=tasks).collect())) == want


@pytest.mark.parametrize("block", [2, 5, 32])
def test_first_hits(points, block):
    df, rows = points
    at = series.numbered(df, ["s"], ["t", "k"])
    queries = at.select("s", (F.col("i") - 1).alias("i"), (F.coalesce("x", F.lit(20.0)) + F.col("k") % 9 - 2).alias("level"))
    xs = {s: [r[3] for r in v] for s, v in grouped(rows).items()}
    got = series.first_hit(queries, at, ["s"], "level", block=block).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.hit == next((j for j in range(r.i + 1, len(xs[r.s])) if xs[r.s][j] is not None and xs[r.s][j] >= r.level), None)
    none = series.first_hit(queries, at.where("false"), ["s"], "level").collect()
    assert len(none) == len(rows) and all(r.hit is None for r in none)


def test_exits_by_blocks(spark):
    """Many positions on intraday bars, with gaps in ranges and dates, against a walk over each path."""
    rng = np.random.default_rng(4)
    bars, t = [], datetime(2024, 1, 1)
    for s in ("A", "B"):
        price, t = 100.0, datetime(2024, 1, 1)
        for i in range(250):
            price = max(1.0, price + float(rng.integers(-4, 5)))
            t += timedelta(hours=int(rng.integers(1, 60)))
            bars.append((s, t, price + float(rng.integers(0, 3)), price - float(rng.integers(0, 3)), price, None if i < 5 else 2.0))
    df = spark.createDataFrame(bars, "symbol string, ts timestamp, high double, low double, close double, atr double")
    pos = [(f"p{i}", *v) for i, v in enumerate((b[0], b[1] + timedelta(minutes=int(rng.integers(0, 90))), b[4], b[4] - 9, b[4] + 12) for b in bars)]
    pos += [("none", "C", datetime(2024, 1, 2), 1.0, 1.0, 1.0), ("early", "A", datetime(2020, 1, 1), 100.0, None, 1000.0), ("nul", None, datetime(2024, 1, 2), 1.0, 1.0, 1.0)]
    p = spark.createDataFrame(pos, "id string, symbol string, entry_date timestamp, entry double, stop double, target double")
    got = {r.id: (r.exit_date, r.reason) for r in rules.exits(p, df, 3.0, 7).collect()}
    assert len(got) == len(pos)
    for key, s, entered, entry, stop, target in pos:
        top, want = entry, (None, None)
        for _, d, high, low, _, atr in (b for b in bars if b[0] == s and b[1] > entered):
            why = "stop" if stop is not None and low <= stop else "trailing" if atr is not None and low + 3.0 * atr <= top else "target" if high >= target else "time" if (d.date() - entered.date()).days >= 7 else None
            if why:
                want = (d, why)
                break
            top = max(top, high)
        assert got[key] == want, key


def brute_newey_west(x, y, lags):
    x = np.column_stack([np.ones(len(x)), x])
    inv = np.linalg.inv(x.T @ x)
    beta = inv @ x.T @ y
    e = y - x @ beta
    if lags is None:
        cov = inv * (e @ e) / (len(y) - x.shape[1])
    else:
        g = x * e[:, None]
        s = g.T @ g
        for k in range(1, lags + 1):
            c = g[k:].T @ g[:-k]
            s += (1 - k / (lags + 1)) * (c + c.T)
        cov = inv @ s @ inv
    return beta, np.sqrt(np.diag(cov))


def test_robust_errors(spark):
    rng = np.random.default_rng(2)
    rows = []
    for key, n in (("long", 1000), ("mid", 100), ("short", 20), ("edge", 21), ("flat", 30), ("two", 3)):
        e = np.convolve(rng.standard_normal(n + 4), [1, 0.8, 0.6, 0.4, 0.2], "valid")
        f = rng.standard_normal((n, 2)) * (key != "flat")
        rows += [(key, i, float(v), float(a), float(b)) for i, (v, (a, b)) in enumerate(zip(0.1 + f @ [1.5, -0.5] + e, f, strict=True))]
    rows += [("mid", 1000, None, 1.0, 1.0), ("mid", 50000, 1.0, None, 1.0)]
    df = spark.createDataFrame(rows, "k string, t int, y double, a double, b double")
    got = {(r.k, r.term): r for r in inference.newey_west(df.orderBy(F.rand(1)), ["k"], "t", "y", ["a", "b"]).collect()}
    assert {k for k, _ in got} == {"long", "mid", "short", "edge"}
    for key, lags in (("long", 6), ("mid", 4), ("short", None), ("edge", 2)):
        mine = [r for r in rows if r[0] == key and None not in r]
        beta, se = brute_newey_west(np.array([r[3:] for r in mine]), np.array([r[2] for r in mine]), lags)
        for i, term in enumerate(("alpha", "a", "b")):
            r = got[key, term]
            assert abs(r.beta - beta[i]) < 1e-9 and abs(r.se - se[i]) < 1e-9 and abs(r.t - beta[i] / se[i]) < 1e-6 and (r.n, r.lags) == (len(mine), lags or 0)
    # Student's t: known two-sided values
    for t, free, p in ((2.228139, 10, 0.05), (1.0, 1, 0.5), (2.575829, 1e7, 0.01), (0.0, 5, 1.0), (12.7062, 1, 0.05), (63.6567, 1, 0.01)):
        assert abs(inference.t_tail(t, free) - p) < 2e-5
    assert inference.newey_west(df.where("false"), ["k"], "t", "y", ["a"]).count() == 0


def test_bootstrap_agrees_with_the_moment_interval(spark):
    rng = np.random.default_rng(3)
    rows = [("iid", i, float(v)) for i, v in enumerate(rng.normal(0.001, 0.01, 600))] + [("few", i, 0.01 * i) for i in range(5)] + [("one", 0, 0.1), ("iid", 9999, None)]
    df = spark.createDataFrame(rows, "k string, t int, ret double")
    for block in (1, 21):
        got = {r.k: r for r in inference.bootstrap(df, ["k"], "t", block=block).collect()}
        m = evaluate.sharpe_interval(evaluate.moments(df.where("k = 'iid' AND ret IS NOT NULL"), ["k"]), 0.9).first()
        r = got["iid"]
        assert r.replicates == 500 and abs(r.low - m.sharpe_low) < 0.35 and abs(r.high - m.sharpe_high) < 0.35
        assert got["one"].low is None and got["few"].low <= got["few"].high
    assert inference.bootstrap(df.where("false"), ["k"], "t").count() == 0


def test_permutations(spark):
    rows = [(n, i) for n in (1, 2, 3, 5, 16, 17, 100, 257) for i in range(n)]
    df = spark.createDataFrame(rows, "n long, i long").withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(40)))).withColumn("seed", F.lit(0))
    got = {}
    for r in inference.permuted(df, "i", "n", ["rep", "seed"]).collect():
        got.setdefault((r.n, r.rep), {})[r.i] = r.j
    for (n, _), m in got.items():
        assert sorted(m.values()) == list(range(n))
    moved = np.array([[got[257, rep][i] for i in range(257)] for rep in range(1, 41)])
    assert len({tuple(m) for m in moved}) == 40
    assert abs(np.mean([np.corrcoef(m, np.arange(257))[0, 1] for m in moved])) < 0.04 and 0.3 < np.std([np.corrcoef(m, np.arange(257))[0, 1] for m in moved]) * 16 < 2
    # under a true null the replicates have the mean and deviation of all permutations
    rng = np.random.default_rng(8)
    s, r = rng.standard_normal(400), rng.standard_normal(400)
    df = spark.createDataFrame([("k", i, float(a), float(b)) for i, (a, b) in enumerate(zip(s, r, strict=True))] + [("k", 900, None, 1.0)], "k string, t int, s double, r double")
    (t,) = inference.shuffle_test(df, ["k"], "t", "s", "r", replicates=300).collect()
    std = s.std() * r.std() / math.sqrt(399)
    assert abs(t.real - (s * r).mean()) < 1e-12 and abs(t["mean"] - s.mean() * r.mean()) < 4 * std / math.sqrt(300) and 0.85 < t["std"] / std < 1.15
    assert inference.shuffle_test(df.where("false"), ["k"], "t", "s", "r").count() == 0
    (t,) = inference.shuffle_test(df.withColumn("r", F.col("s")), ["k"], "t", "s", "r").collect()
    assert t.p < 0.02 and t.z > 5


def test_selection_and_mean_correlation(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((800, 4))
    y = 2 * x[:, 0] - x[:, 1] + rng.standard_normal(800)
    df = spark.createDataFrame([(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))], "id int, a double, b double, c double, d double, y double")
    got = {r.feature: r for r in inference.stability_selection(df, "id", "y", ["a", "b", "c", "d"]).collect()}
    assert got["a"].selected == got["b"].selected == 1.0 and got["a"].stable and not got["c"].stable and got["c"].selected == 0
    assert abs(got["a"].importance - abs(np.corrcoef(x[:, 0], y)[0, 1])) < 1e-9
    m = rng.standard_normal((60, 1)) + rng.standard_normal((60, 6))
    long = spark.createDataFrame([(f"s{j}", i, float(m[i, j])) for i in range(60) for j in range(6)] + [("flat", i, 1.0) for i in range(60)], "s string, t int, x double")
    c = np.corrcoef(m.T)
    for r in inference.mean_correlation(long, "s", "t", "x").collect():
        assert abs(r.mean_corr - (c[int(r.s[1:])].sum() - 1) / 5) < 1e-9 and abs(r.market_corr - (c.sum() - 6) / 30) < 1e-9


def test_fold_metrics_with_total_losses(spark):
    cases = {"loss": [0.1, -1.0, 0.1], "zero": [0.0, 0.0, 0.0], "up": [0.01, 0.02], "one": [0.5], "mix": [0.05, -0.1, 0.0, 0.02, -0.02, 0.01], "below": [0.1, -1.5, 0.2]}
    df = spark.createDataFrame([(k, i, v) for k, vs in cases.items() for i, v in enumerate(vs)], "k string, ts int, ret double")
    got = {r.k: r for r in research.strategy_metrics(df, ["k"]).collect()}
    assert abs(got["loss"].total_return + 1) < 1e-12 and got["loss"].max_drawdown == -1 and got["loss"].annual_return == -1
    assert (got["zero"].win_rate, got["zero"].sharpe, got["zero"].profit_factor) == (0.0, 0.0, math.inf) and got["up"].profit_factor == math.inf
    assert got["one"][2:] == (0.0,) * 6
    assert abs(got["below"].total_return - (1.1 * -0.5 * 1.2 - 1)) < 1e-12
    r, m = np.array(cases["mix"]), got["mix"]
    value = np.cumprod(1 + r)
    annual = value[-1] ** (252 / 6) - 1
    want = (value[-1] - 1, annual, annual / (r.std(ddof=1) * math.sqrt(252)), (value / np.maximum.accumulate(value) - 1).min(), 3 / 5, 0.08 / 0.12)
    assert np.allclose([m.total_return, m.annual_return, m.sharpe, m.max_drawdown, m.win_rate, m.profit_factor], want)
    assert evaluate.moments(df.where("k = 'loss'"), ["k"]).first().total_return == -1


def test_halves_and_worst_month(spark):
    rng = np.random.default_rng(7)
    r = rng.normal(0, 0.02, 61)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(61)]
    df = spark.createDataFrame([("a", d, float(v)) for d, v in zip(days, r, strict=True)] + [("b", days[0], 0.1), ("b", days[1], -1.0)], "k string, ts date, ret double")
    got = {x.k: x for x in evaluate.return_stability(df, ["k"], "ts").collect()}
    s = [v.mean() / v.std(ddof=1) * math.sqrt(252) for v in (r[:30], r[30:])]
    months = [np.prod(1 + r[[d.month == m for d in days]]) - 1 for m in (1, 2, 3)]
    a = got["a"]
    assert np.allclose([a.sharpe_first, a.sharpe_second, a.sharpe_stability, a.worst_return], [*s, min(s) / max(map(abs, s)), min(months)]) and a.worst_month.month == int(np.argmin(months)) + 1
    assert got["b"].sharpe_first is None and got["b"].worst_return == -1
    ref, cur = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "y int"), spark.createDataFrame([(1,), (0,), (0,)], "y int")
    shift = evaluate.label_shift(ref, cur).first()
    assert abs(shift["shift"] - 1 / 3) < 1e-12 and shift.shifted
    assert abs(evaluate.label_shift(ref.where("y = 0"), cur).first()["shift"] - 1 / 3) < 1e-12


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_delta_table_replays_reads_back_and_stays_small(spark, tmp_path):
    t = delta.DeltaTable(f"file://{tmp_path}/t", ["k"], ["v"], fan=3, retain=3)
    rng, model, past = random.Random(1), {}, {}
    for n in range(9):
        rows = [(rng.randrange(60) or None, n * 10 + rng.randrange(10), f"x{n}") for _ in range(12 if n else 40)]
        batch = spark.createDataFrame(rows, "k long, v int, s string")
        t.write(batch, n)
        if n % 3 == 0:
            t.write(batch.limit(1), n)  # committed already: passed over
        for k in {r[0] for r in rows}:
            model[k] = max(r[1:] for r in rows if r[0] == k)
        past[n] = dict(model)
        for upto in (None, n - 1, n - 2):
            if upto is None or upto >= 0:
                assert {r.k: (r.v, r.s) for r in t.read(spark, upto).collect()} == past[n if upto is None else upto]
    with pytest.raises(ValueError):
        t.read(spark, 2)
    assert len(os.listdir(f"{tmp_path}/t/runs")) < 9 and len(os.listdir(f"{tmp_path}/t/manifest")) <= 5
    with pytest.raises(ValueError):
        delta.DeltaTable(f"file://{tmp_path}/none", ["k"]).read(spark)


def test_delta_writes_grow_with_the_batch(spark, tmp_path):
    """Small batches into a large table: what they write is a small part of it, and runs are merged in tiers."""
    t = delta.DeltaTable(f"file://{tmp_path}/t", ["k"], fan=3)
    t.write(spark.range(200_000).selectExpr("id AS k", "hash(id) AS v"), 0)
    base = size_of(f"{tmp_path}/t/runs")
    for n in range(1, 7):
        t.write(spark.range(50).selectExpr(f"(id * 37 + {n} * 50) % 200000 AS k", f"{n} AS v"), n)
    assert size_of(f"{tmp_path}/t/runs") < base * 1.05
    _, runs = t.state(spark)
    assert sorted(r.tier for r in runs) == [-1, 1, 1]
    assert t.read(spark).count() == 200_000 and t.read(spark).where("v BETWEEN 1 AND 6").count() >= 250


class Stop(Exception):
    pass


def test_streams_go_on_after_being_killed_in_a_batch(spark, tmp_path):
    """Latest quotes, upserts and inventory: stopped in the middle of a batch's sink and started again from the checkpoint,
    they end as one run does."""
    start = datetime(2024, 1, 1)
    for i in range(4):
        rows = [(["a", "b", "c"][(i + j) % 3], start + timedelta(minutes=10 * i + j), "trade" if j % 2 else "quote", 10.0 + i + j, 9.0 + j, 11.0 + j, float(j - 2), i * 10 + j) for j in range(6)]
        spark.createDataFrame(rows, "symbol string, ts timestamp, kind string, price double, bid double, ask double, quantity double, n int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    sources = {"quotes": lambda s: jobs.latest_quotes(s), "inventory": lambda s: jobs.inventory_stream(s), "upserts": lambda s: s.select("symbol", "n", "price")}
    for name, made in sources.items():
        ends = []
        for kill in (False, True):
            path, seen = f"{tmp_path}/{name}-{kill}", []
            table = delta.DeltaTable(f"file://{path}/t", ["symbol"], ["n"] if name == "upserts" else [], fan=2)

            def each(batch, number, table=table, seen=seen, kill=kill):
                seen.append(number)
                if kill and number == 1 and seen.count(1) == 1:
                    table._add(batch, 0, number, number, {r.folder for r in table.state(batch.sparkSession)[1]})  # files of a run, then no commit
                    raise Stop("killed")
                table.write(batch, number)
                if kill and number == 2 and seen.count(2) == 1:
                    raise Stop("killed after the commit")  # the batch comes again and is passed over

            for _ in range(4):
                try:
                    jobs.run_available(made(jobs.parquet_stream(spark, f"{tmp_path}/in", schema)), f"{path}/cp", mode="append" if name == "upserts" else "update", each=each)
                    break
                except Exception as e:
                    assert "killed" in str(e)
            assert seen.count(1) == (2 if kill else 1) and table.state(spark)[0] == 3
            ends.append(sorted(map(tuple, table.read(spark).select(*sorted(table.read(spark).columns)).collect()), key=repr))
        assert ends[0] == ends[1] and len(ends[0]) == 3


def test_trial_registry(spark, tmp_path):
    path = f"file://{tmp_path}/trials"
    trial = lambda *ps: spark.createDataFrame([(f"t{i}", p, 0.1 * i, p is not None and p < 0.1) for i, p in enumerate(ps)], "name string, p double, ic double, passed boolean")
    lineage.register_trials(trial(0.02, 0.9), path, "r1")
    first = {(r.run, r.name): r.rejected_now for r in lineage.trial_verdicts(lineage.registered_trials(spark, path)).collect()}
    assert first == {("r1", "t0"): True, ("r1", "t1"): False}
    lineage.register_trials(trial(0.001, 0.5, None, float("nan")), path, "r2")
    lineage.register_trials(trial(0.0, 0.0, 0.0), path, "r1")  # there already: adds nothing
    rows = lineage.registered_trials(spark, path)
    assert rows.count() == 6 and {r.seq for r in rows.where("run = 'r2'").collect()} == {1}
    got = {(r.run, r.name): (r.rejected_then, r.rejected_now) for r in lineage.trial_verdicts(rows).collect()}
    # of six p values the second, 0.02, is over 2 * 0.05 / 6
    assert got == {("r1", "t0"): (True, False), ("r1", "t1"): (False, False), ("r2", "t0"): (True, True), ("r2", "t1"): (False, False), ("r2", "t2"): (False, False), ("r2", "t3"): (False, False)}
    s = lineage.trial_summary(lineage.trial_verdicts(rows)).first()
    assert (s.n_trials, s.n_passed, s.n_rejected) == (6, 2, 1) and abs(s.best - 0.3) < 1e-12


def test_events_of_chart_payloads(spark):
    stamp = lambda d: int(datetime(2024, 1, d, 14, 30).timestamp() - datetime(1970, 1, 1).timestamp())
    quote = {"open": [1.0, 2.0, None, 4.0], "high": [1.0, 2.0, 3.0, 4.0], "low": [1.0, 2.0, 3.0, 4.0], "close": [1.0, 2.0, 3.0, 4.0], "volume": [10, None, 30, 40]}
    chart = lambda **more: json.dumps({"chart": {"result": [{"timestamp": [stamp(d) for d in (2, 3, 4, 5)], "indicators": {"quote": [quote], "adjclose": [{"adjclose": [0.5, 1.0, 1.5, 2.0]}]}, **more}]}})
    events = {"splits": {str(stamp(3) - 3600): {"splitRatio": "4:1"}, str(stamp(5)): {}, str(stamp(9)): {"splitRatio": "9:1"}}, "dividends": {str(stamp(2)): {"amount": 0.1}, str(stamp(2) + 60): {"amount": 0.25}, "odd": {"amount": 7.0}}}
    rows = [("A", chart(events=events)), ("B", chart()), ("C", json.dumps({"chart": {"result": []}})), ("D", "no json"), ("E", None), ("F", json.dumps({"chart": {"result": [{"indicators": {"quote": [quote]}}]}}))]
    got = {(r.ticker, r.date.day): r for r in ingest.bars_with_events(spark.createDataFrame(rows, "ticker string, payload string")).collect()}
    assert sorted(got) == [(t, d) for t in "AB" for d in (2, 3, 5)]
    assert [got["A", d].split_ratio for d in (2, 3, 5)] == [None, "4:1", "1:1"] and [got["A", d].dividend for d in (2, 3, 5)] == [0.25, 0.0, 0.0]
    assert [got["B", d].split_ratio for d in (2, 3, 5)] == [None] * 3 and got["B", 2].dividend == 0.0
    assert got["A", 2].adj_close == 0.5 and got["A", 3].volume is None


def test_quarantine_keeps_whole_records_of_every_run(spark, tmp_path):
    df = spark.createDataFrame([(None, "x" * 5000), ("k", "y")], "id string, body string")
    good, bad = ingest.split_required(df, ["id"])
    assert good.count() == 1 and json.loads(bad.first().record)["body"] == "x" * 5000
    path = f"file://{tmp_path}/q"
    other = ingest.split_required(df.withColumn("body", F.lit("z")), ["id"])[1]
    for run, rows in (("r1", bad), ("r2", bad.union(other)), ("r2", bad.union(other)), ("r3", bad)):
        ingest.quarantine(rows, path, "posts", run, "2024-01-01 00:00:00")
    ingest.quarantine(bad, path, "prices", "r1", "2024-01-01 00:00:00")
    kept = ingest.quarantined(spark, path)
    assert sorted((r.source, r.run_id, len(r.record) > 5000) for r in kept.collect()) == [("posts", "r1", True), ("posts", "r2", False), ("prices", "r1", True)]
    assert {(r.source, r.n) for r in ingest.quarantine_summary(kept).collect()} == {("posts", 2), ("prices", 1)}


def test_prefix_sums_in_ranges_and_in_one_step(spark):
    rng = np.random.default_rng(6)
    rows = [("hot" if rng.random() < 0.9 else "b", float(rng.integers(0, 400))) for _ in range(3000)]
    counts = spark.createDataFrame(rows, "k string, x double").groupBy("k", "x").agg(F.count("*").alias("t"))
    a, b = (sorted(map(tuple, ranks.prefix(counts, ["k"], "x", ["t"], few=few).select("k", "x", "t", "before_t").collect())) for few in (0, 10**6))
    assert a == b
    for k in ("hot", "b"):
        v = np.sort([x for s, x in rows if s == k])
        assert all(before == np.searchsorted(v, x) for s, x, _, before in a if s == k)


def test_intraday_limits_and_sustained_alerts(spark):
    rows = [("s", i, v) for i, v in enumerate([10.0, -40.0, None, -30.0, 100.0, -150.0, 400.0, 0.0])] + [("t", 0, -200.0)]
    got = {(r.k, r.i): r for r in rules.intraday_state(spark.createDataFrame(rows, "k string, i int, d double"), ["k"], ["i"], "d", 1000.0, 0.05, 100.0).collect()}
    assert [got["s", i].state for i in range(8)] == ["ok", "ok", "ok", "throttle", "ok", "shutdown", "ok", "ok"]
    assert [got["s", i].halted for i in range(8)] == [False] * 5 + [True] * 3 and got["t", 0].state == "shutdown"
    assert abs(got["s", 5].drawdown - (890 / 1040 - 1)) < 1e-12 and got["s", 6].drawdown == 0.0
    history = spark.createDataFrame([("a", i, n) for i, n in enumerate([3, 4, 3, 3, 2, 3, 1, 0])], "k string, m int, n_breaches int")
    assert [r.level for r in statistics.edge_levels(history, ["k"], "m").orderBy("m").collect()] == ["ORANGE", "ORANGE", "RED", "RED", "ORANGE", "ORANGE", "YELLOW", "GREEN"]


def test_edge_monitor(spark):
    gains = [0.02, -0.01, 0.03, 0.0, 0.01] * 6
    trades = spark.createDataFrame([("good", i, v, v > 0.015) for i, v in enumerate(gains)] + [("bad", i, -abs(v), i < 10) for i, v in enumerate(gains)] + [("few", i, 0.1, True) for i in range(5)], "k string, i int, p double, hit boolean")
    equity = spark.createDataFrame([(k, i, 1.0 * i * i) for k in ("good", "few") for i in range(120)] + [("bad", i, 1.0 * i) for i in range(50)], "k string, i int, v double")
    got = {r.k: r for r in statistics.edge_monitor(trades, ["k"], ["i"], "p", "hit", equity, "v", ["i"], window=20).collect()}
    last = np.array(gains[-20:])
    g = got["good"]
    assert abs(g.win_rate - 0.6) < 1e-12 and abs(g.profit_factor - last[last > 0].sum() / -last[last < 0].sum()) < 1e-9
    assert abs(g.sharpe - last.mean() / last.std() * math.sqrt(252)) < 1e-9 and abs(g.winner_loser - last[last > 0].mean() / abs(last[last <= 0].mean())) < 1e-9
    assert g.level == "GREEN" and g.breaches == [] and g.hurst > 0.45
    assert got["bad"].breaches == ["win_rate", "profit_factor", "sharpe", "hit_rate", "winner_loser"] and got["bad"].level == "ORANGE" and got["bad"].hurst is None
    assert got["few"].level == "GREEN" and got["few"].win_rate is None


def test_event_counts_with_and_without_a_short_spine(spark, monkeypatch):
    at = lambda h: datetime(2024, 1, 5) + timedelta(hours=h)
    times = spark.createDataFrame([(at(0),), (at(24),), (at(900),)], "asof_ts timestamp_ntz")
    events = spark.createDataFrame([(at(-1), at(-1), 2.0), (at(-1), at(5), 4.0), (at(-30), at(-30), 8.0), (at(23), at(24), 1.0)], "ts timestamp_ntz, available_time timestamp_ntz, tone double")
    want = [(1, 2.0, 1, 1, 2), (1, 1.0, 1, 1, 4), (0, 0.0, 0, 0, 0)]
    for most in (10, 0):
        monkeypatch.setattr(snapshots, "SPINE", most)
        got = snapshots.event_counts(times, events, events.drop("tone")).orderBy("asof_ts").collect()
        assert [(r.event_count, r.event_tone, r.news_1h, r.news_24h, r.news_168h) for r in got] == want
