"""Queries on research: horizons, gates, strategy folds, trades, ensembles, experiments, bias tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import windows as W
from ..operators import evaluate as ev
from ..operators import indicators as ind
from ..operators import research
from ..sources import tables as T
from ._common import cdf_sql, r, rounded
from .evaluation import _RET, returns
from .portfolio import _OUT, _outcomes
from .registry import query

_RANK = "(rank() OVER (PARTITION BY {k} ORDER BY {x}) + (count(*) OVER (PARTITION BY {k}, {x}) - 1) / 2) / count(*) OVER (PARTITION BY {k})"


def _rank(k: str, x: str) -> str:
    return _RANK.format(k=k, x=x)


_LONG = f"""s0 AS (SELECT symbol, ts, close, close / lag(close, 5) OVER o - 1 AS signal, {", ".join(f"lead(close, {h}) OVER o / close - 1 AS f{h}" for h in research.HORIZONS)} FROM bars_user_d WINDOW o AS (PARTITION BY symbol ORDER BY ts)),
long AS ({" UNION ALL ".join(f"SELECT symbol, ts, {h} AS horizon, signal, f{h} AS fwd FROM s0" for h in research.HORIZONS)}),
k AS (SELECT horizon, ts, {_rank("horizon, ts", "signal")} AS a, {_rank("horizon, ts", "fwd")} AS b FROM long WHERE signal IS NOT NULL AND fwd IS NOT NULL),
ic AS (SELECT horizon, ts, count(*) AS n, corr(a, b) AS ic FROM k GROUP BY 1, 2 HAVING count(*) >= 3)"""


def _long(spark: SparkSession, sf_dir: str, horizons=research.HORIZONS) -> DataFrame:
    return research.forward_long(T.bars_user_d(spark, sf_dir), W.returns(F.col("close"), ind.DEFAULT, 5), ind.DEFAULT, horizons)


@query(T.with_tables("bars_user_d", then=f"""
, {_LONG}, g AS (SELECT horizon, count(ic) AS n_dates, avg(ic) AS mean_ic, stddev_samp(ic) AS std_ic, avg(ic) / nullif(stddev_samp(ic), 0) AS ir FROM ic GROUP BY horizon)
SELECT horizon, n_dates, {r('mean_ic', 'mean_ic')}, {r('std_ic', 'std_ic')}, {r('ir', 'ir')}, horizon = (SELECT horizon FROM g ORDER BY coalesce(ir, '-inf'::DOUBLE) DESC, horizon LIMIT 1) AS best FROM g"""))
def ic_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(research.ic_decay(_long(spark, sf_dir)))


_DAYS = "d AS (SELECT ts, dense_rank() OVER (ORDER BY ts) - 1 AS i FROM (SELECT DISTINCT ts FROM bars_user_d)), nd AS (SELECT count(*) AS n FROM d), fd AS (SELECT unnest(generate_series(0, CAST(floor((n - 10 - 1 - 5) / 5) AS BIGINT))) AS fold FROM nd), sp AS (SELECT ts, fold, CASE WHEN i >= fold * 5 AND i < fold * 5 + 10 THEN 'train' WHEN i >= fold * 5 + 11 AND i < fold * 5 + 16 THEN 'test' END AS role FROM d, fd)"


def _folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = T.bars_user_d(spark, sf_dir).select("ts").distinct()
    return ev.walk_forward(days, "ts", 10, 5, 5, 1)


@query(T.with_tables("bars_user_d", then=f"""
, {_LONG}, {_DAYS}, m AS (SELECT fold, avg(ic) AS m FROM ic JOIN sp USING (ts) WHERE role = 'test' AND horizon = 5 AND ic IS NOT NULL GROUP BY fold),
g AS (SELECT count(m) AS n_folds, avg(m) AS mean_ic, avg(m) * sqrt(count(m)) / nullif(stddev_samp(m), 0) AS t FROM m), p AS (SELECT *, CASE WHEN t IS NOT NULL THEN 2 * (1 - {cdf_sql('abs(t)')}) END AS p FROM g)
SELECT n_folds, {r('mean_ic', 'mean_ic')}, {r('t', 't')}, {r('p', 'p')}, coalesce(p < 0.05 AND mean_ic > 0, false) AS passed FROM p"""))
def walk_forward_ic_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ic = research.ic_by(_long(spark, sf_dir, (5,)), ["ts"])
    return rounded(research.fold_gate(ic, _folds(spark, sf_dir)))


_TOP = f"""s1 AS (SELECT ts, signal, f1 AS fwd, {_rank("ts, signal IS NULL", "signal")} AS rk FROM s0), top AS (SELECT ts, coalesce(avg(CASE WHEN signal IS NOT NULL AND rk >= 0.8 THEN fwd END), 0) AS ret, count(CASE WHEN signal IS NOT NULL AND rk >= 0.8 THEN fwd END) AS names FROM s1 GROUP BY ts)"""


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research.top_share_returns(_long(spark, sf_dir, (1,)))


@query(T.with_tables("bars_user_d", then=f", {_LONG}, {_TOP} SELECT ts, {r('ret', 'ret')}, names FROM top"))
def top_quintile_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_top(spark, sf_dir))


@query(T.with_tables("bars_user_d", then=f"""
, {_LONG}, {_TOP}, {_DAYS}, v AS (SELECT fold, role, ts, ret - 0.0001 AS r, product(1 + ret - 0.0001) OVER (PARTITION BY fold, role ORDER BY ts) AS v FROM top JOIN sp USING (ts) WHERE role IS NOT NULL),
dd AS (SELECT *, v / nullif(max(v) OVER (PARTITION BY fold, role ORDER BY ts), 0) - 1 AS dd FROM v), g AS (SELECT fold, role, count(*) AS n, product(1 + r) AS g, stddev_samp(r) * sqrt(252) AS s, min(dd) AS dd, count_if(r > 0) AS w, count_if(r <> 0) AS t, coalesce(sum(CASE WHEN r > 0 THEN r END), 0) AS up, -coalesce(sum(CASE WHEN r < 0 THEN r END), 0) AS down FROM dd GROUP BY fold, role)
SELECT fold, role, n, {r('CASE WHEN n >= 2 THEN g - 1 ELSE 0 END', 'total_return')}, {r('CASE WHEN n >= 2 THEN pow(g, 252 / n) - 1 ELSE 0 END', 'annual_return', 4)}, {r('CASE WHEN n >= 2 AND s > 0 THEN (pow(g, 252 / n) - 1) / s ELSE 0 END', 'sharpe', 4)}, {r('CASE WHEN n >= 2 THEN dd ELSE 0 END', 'max_drawdown')}, {r('CASE WHEN n >= 2 AND t > 0 THEN w / t ELSE 0 END', 'win_rate')}, {r("CASE WHEN n < 2 THEN 0 WHEN down > 0 THEN up / down ELSE 'inf'::DOUBLE END", 'profit_factor')} FROM g"""))
def strategy_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _top(spark, sf_dir).join(F.broadcast(_folds(spark, sf_dir)), "ts")
    got = research.strategy_metrics(rows, ["fold", "role"], cost=0.0001)
    return rounded(rounded(got.withColumns({c: F.round(F.col(c) + 3.3e-9, 4) for c in ("annual_return", "sharpe")})))


@query(T.with_tables("bars_user_d", then=f"""
, {_OUT} SELECT symbol, count(*) AS n, {r('avg(CASE WHEN pnl_pct > 0 THEN 1.0 ELSE 0 END)', 'hit_rate')}, {r('sum(CASE WHEN pnl_pct > 0 THEN pnl_pct END) / nullif(-sum(CASE WHEN pnl_pct < 0 THEN pnl_pct END), 0)', 'profit_factor')}, {r('avg(CASE WHEN pnl_pct > 0 THEN pnl_pct END)', 'mean_win')}, {r('avg(CASE WHEN pnl_pct < 0 THEN pnl_pct END)', 'mean_loss')}, {r('avg(exit_date - entry_date)', 'mean_days')},
  count(*) FILTER (WHERE outcome = 'target') AS n_target, count(*) FILTER (WHERE outcome = 'stop') AS n_stop, count(*) FILTER (WHERE outcome = 'expired') AS n_expired FROM o WHERE pnl_pct IS NOT NULL GROUP BY symbol"""))
def trade_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(research.trade_summary(_outcomes(spark, sf_dir), ["symbol"]))


@query(T.with_tables("bars_supp_d", then=f"""
, a AS (SELECT symbol, ts, close AS e, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS r, close / max(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS d FROM bars_supp_d),
g AS (SELECT symbol, count(*) AS n, arg_min(e, ts) AS a, arg_max(e, ts) AS b, (max(ts) - min(ts)) / 365.25 AS y, count(r) AS k, avg(r) AS m, stddev_samp(r) AS s, sqrt(avg(CASE WHEN r < 0 THEN r * r END)) AS down, min(d) AS dd, avg(d) AS ad FROM a GROUP BY 1),
c AS (SELECT *, CASE WHEN y > 0 AND b / a > 0 THEN pow(b / a, 1 / y) - 1 END AS cagr FROM g)
SELECT symbol, n, {r('b / a - 1', 'total_return')}, {r('cagr', 'cagr')}, {r('CASE WHEN k > 20 AND s > 0 THEN m / s * sqrt(252) END', 'sharpe', 6)}, {r('CASE WHEN down > 0 THEN m / down * sqrt(252) END', 'sortino', 6)}, {r('dd', 'max_drawdown')}, {r('ad', 'avg_drawdown')}, {r('CASE WHEN dd < 0 THEN cagr / abs(dd) END', 'calmar')} FROM c"""))
def equity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' average unit prices by day stand for equity."""
    return rounded(research.equity_summary(T.bars_supp_d(spark, sf_dir), ["symbol"], equity="close"))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, g AS (SELECT symbol, ts, ret, close / lag(close, 5) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS signal FROM ret)
SELECT symbol, count(*) AS n, {r('avg(CASE WHEN sign(signal) = sign(ret) THEN 1.0 ELSE 0 END)', 'hit_rate')} FROM g WHERE signal IS NOT NULL AND ret IS NOT NULL GROUP BY symbol"""))
def same_day_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = returns(spark, sf_dir)
    signals = rr.select("symbol", "ts", W.returns(F.col("close"), ind.DEFAULT, 5).alias("signal"))
    return rounded(research.same_day_hits(signals, rr.select("symbol", "ts", "ret"), ["symbol"], ["symbol", "ts"]))


_PREDS = "q AS (SELECT symbol, ts, close / lag(close) OVER o - 1 AS p1, close / lag(close, 3) OVER o - 1 AS p2, volume / lag(volume) OVER o - 1 AS p3 FROM bars_user_d WINDOW o AS (PARTITION BY symbol ORDER BY ts))"
_PAIRS = [("p1", "p2"), ("p1", "p3"), ("p2", "p3")]


@query(T.with_tables("bars_user_d", then=f"""
, {_PREDS}, g AS (SELECT symbol, unnest([{", ".join(f"corr({a}, {b})" for a, b in _PAIRS)}]) AS c, unnest([{", ".join(f"avg(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CASE WHEN sign({a}) <> sign({b}) THEN 1.0 ELSE 0 END END)" for a, b in _PAIRS)}]) AS d FROM q GROUP BY symbol)
SELECT symbol, {r('avg(CASE WHEN isnan(c) THEN NULL ELSE c END)', 'mean_corr')}, {r('avg(d)', 'mean_disagreement')} FROM g GROUP BY symbol"""))
def ensemble_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, f = F.col("close"), ind.DEFAULT
    q = T.bars_user_d(spark, sf_dir).select("symbol", W.returns(c, f).alias("p1"), W.returns(c, f, 3).alias("p2"), W.returns(F.col("volume"), f).alias("p3"))
    return rounded(research.diversity(q, ["p1", "p2", "p3"], ["symbol"]))


@query(f"""
WITH b AS (SELECT user_id, event_type, max(value) AS b FROM events WHERE value IS NOT NULL GROUP BY 1, 2), w AS (SELECT arg_min(event_type, (-b, event_type)) AS event_type FROM b GROUP BY user_id), won AS (SELECT event_type, count(*) AS problems_won FROM w GROUP BY 1),
t AS (SELECT event_type, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std, max(value) AS best FROM events WHERE value IS NOT NULL GROUP BY 1)
SELECT event_type, n, {r('mean', 'mean')}, {r('std', 'std')}, {r('best', 'best')}, coalesce(problems_won, 0) AS problems_won FROM t LEFT JOIN won USING (event_type)""")
def experiment_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(research.leaderboard(T.table(spark, sf_dir, "events"), "event_type", "user_id", "value"))


@query("SELECT user_id, ts, event_id, value FROM (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM events WHERE value IS NOT NULL) WHERE b IS NULL OR value > b")
def running_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research.improvements(T.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"], "value")


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, m AS (SELECT min(ts) + CAST((max(ts) - min(ts)) // 2 AS INTEGER) AS mid FROM ret), c AS (SELECT symbol, avg(CASE WHEN ts <= mid THEN ret END) / nullif(stddev_samp(CASE WHEN ts <= mid THEN ret END), 0) AS train, avg(CASE WHEN ts > mid THEN ret END) / nullif(stddev_samp(CASE WHEN ts > mid THEN ret END), 0) AS test FROM ret, m GROUP BY symbol),
v AS (SELECT * FROM c WHERE train IS NOT NULL AND test IS NOT NULL), q AS (SELECT quantile_cont(train, 0.9) AS cut, quantile_cont(test, 0.5) AS mid FROM v)
SELECT count(*) AS n, count(*) FILTER (WHERE train >= cut) AS chosen, {r('avg(CASE WHEN train >= cut THEN CASE WHEN test < mid THEN 1.0 ELSE 0 END END)', 'overfit')} FROM v, q"""))
def overfit_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = returns(spark, sf_dir)
    mid = rr.agg(F.expr("date_add(min(ts), cast(floor(datediff(max(ts), min(ts)) / 2) as int))").alias("mid"))
    s = lambda c: F.try_divide(F.avg(F.when(c, F.col("ret"))), F.stddev_samp(F.when(c, F.col("ret"))))
    scores = rr.crossJoin(F.broadcast(mid)).groupBy("symbol").agg(s(F.col("ts") <= F.col("mid")).alias("train"), s(F.col("ts") > F.col("mid")).alias("test"))
    return rounded(research.overfit_share(scores))


_LAGS = range(1, 51)


@query(T.with_tables("bars_h", then=f"""
, q0 AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars_h), q AS (SELECT symbol, ts, count(*) OVER p AS n, ret - avg(ret) OVER p AS c FROM q0 WHERE ret IS NOT NULL WINDOW p AS (PARTITION BY symbol)),
z AS (SELECT symbol, n, c * c AS v, {", ".join(f"c * lag(c, {k}) OVER (PARTITION BY symbol ORDER BY ts) AS p{k}" for k in _LAGS)} FROM q),
a AS (SELECT symbol, max(n) AS n, {", ".join(f"CASE WHEN {k} <= floor(max(n) / 3) AND abs(sum(p{k}) / nullif(sum(v), 0)) > 1.96 / sqrt(max(n)) THEN {k} ELSE 0 END AS h{k}" for k in _LAGS)} FROM z GROUP BY symbol)
SELECT symbol, n, CAST(CASE WHEN n < 30 THEN n ELSE greatest(least(greatest({", ".join(f"h{k}" for k in _LAGS)}) + 1, floor(sqrt(n))), 5) END AS BIGINT) AS block FROM a"""))
def bootstrap_block_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_h(spark, sf_dir).withColumn("ret", W.returns(F.col("close"), ind.DEFAULT))
    return research.block_size(b, ind.DEFAULT)


@query(T.with_tables("probs", then=f"""
, c AS (SELECT id % 7 AS candidate, avg(pow(p - y, 2)) AS brier, avg(abs(p - y)) AS mae, avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0 END) AS hit_rate FROM probs GROUP BY 1)
SELECT candidate, {r('brier', 'brier')}, {r('mae', 'mae')}, {r('hit_rate', 'hit_rate')}, candidate = (SELECT candidate FROM c ORDER BY hit_rate DESC, candidate LIMIT 1) AS best FROM c"""))
def candidate_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates are residues of the id (seven made-up models that share one set of predictions)."""
    rows = T.probs(spark, sf_dir).withColumn("candidate", F.col("id") % 7)
    long = ev.classification(rows, ["candidate"]).unpivot(["candidate"], ["brier", "mae", "hit_rate"], "metric", "value")
    return rounded(research.compare(long, "candidate", "metric", "value", ["brier", "mae", "hit_rate"], "hit_rate"))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, x AS (SELECT symbol, ret, lead(ret) OVER o AS y, ret AS y1, lag(ret, 4) OVER o AS y5, lag(ret, 9) OVER o AS y10 FROM ret WINDOW o AS (PARTITION BY symbol ORDER BY ts)),
g AS (SELECT unnest([0, 1, 5, 10]) AS shift, unnest([corr(ret, y), corr(ret, y1), corr(ret, y5), corr(ret, y10)]) AS corr FROM x), b AS (SELECT corr AS b FROM g WHERE shift = 0)
SELECT shift, {r('corr', 'corr')}, {r('(abs(b) - abs(corr)) / nullif(abs(b), 0)', 'degradation', 3)}, shift > 0 AND coalesce((abs(b) - abs(corr)) / nullif(abs(b), 0) < 0.1, false) AS suspicious FROM g, b"""))
def target_shift_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = returns(spark, sf_dir).select("symbol", "ts", "ret")
    rr = rr.withColumn("y", W.lead(F.col("ret"), ind.DEFAULT))
    got = research.shift_test(rr, ind.DEFAULT, "ret", "y")
    return rounded(got.withColumn("degradation", F.round(F.col("degradation") + 3.3e-9, 3)))


@query(T.with_tables("probs", then=f"""
, t AS (SELECT CAST(unnest([0.3, 0.4, 0.5, 0.6, 0.7]) AS DOUBLE) AS parameter), m AS (SELECT parameter, avg(CASE WHEN (p > parameter) = (y = 1) THEN 1.0 ELSE 0 END) AS metric FROM probs, t GROUP BY 1)
SELECT {r('avg(metric)', 'mean')}, {r('stddev_samp(metric)', 'std')}, {r('abs(stddev_samp(metric) / nullif(avg(metric), 0))', 'cv')}, coalesce(abs(stddev_samp(metric) / nullif(avg(metric), 0)) < 0.5, false) AS robust FROM m"""))
def sensitivity_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = lambda t: F.avg(((F.col("p") > t) == (F.col("y") == 1)).cast("double"))
    return rounded(research.sensitivity(T.probs(spark, sf_dir), [0.3, 0.4, 0.5, 0.6, 0.7], hit)[1])


@query(f"""
WITH u AS (SELECT event_type, avg(CASE WHEN user_id % 2 = 0 THEN value END) AS a, avg(CASE WHEN user_id % 2 = 1 THEN value END) AS b FROM events GROUP BY 1), t AS (SELECT count(DISTINCT event_type) FILTER (WHERE abs(b / a - 1) > 0.02) AS triggered FROM u)
SELECT triggered, CASE WHEN triggered >= 2 THEN 'retrain' WHEN triggered >= 1 THEN 'investigate' ELSE 'none' END AS action FROM t""")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Axes are event types; one is triggered where the two halves of users differ by over 2 percent in the mean."""
    e = T.table(spark, sf_dir, "events")
    half = lambda k: F.avg(F.when(F.col("user_id") % 2 == k, F.col("value")))
    axes = e.groupBy(F.col("event_type").alias("axis")).agg((F.abs(F.try_divide(half(1), half(0)) - 1) > 0.02).alias("triggered"))
    return research.drift_report(axes)


@query(f"SELECT count(*) AS runs, count(DISTINCT (user_id, event_type)) AS unique_configs, count(*) - count(DISTINCT (user_id, event_type)) AS duplicate_configs, {r('avg(CASE WHEN value IS NOT NULL AND props IS NOT NULL THEN 1.0 ELSE 0 END)', 'fully_captured')} FROM events")
def experiment_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(research.audit(T.table(spark, sf_dir, "events"), ["user_id", "event_type"], ["value", "props"]))


@query(T.with_tables("bars_user_d", then=f""", {_RET}, e AS (SELECT CAST(ts AS DATE) AS d, avg(value) AS level FROM events GROUP BY 1)
SELECT ts, count(*) AS n, {r('avg(ret)', 'mean_return')}, {r('stddev_samp(ret)', 'dispersion')}, {r('stddev_samp(close)', 'volatility')}, {r('max(level)', 'macro_level')} FROM ret LEFT JOIN e ON e.d = ts WHERE ret IS NOT NULL GROUP BY ts"""))
def market_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of all events of a day stands for a macro series."""
    macro = T.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("ts")).agg(F.avg("value").alias("level"))
    return rounded(research.market_features(T.bars_user_d(spark, sf_dir), ind.DEFAULT, macro=macro))


@query(f"SELECT event_type, count(value) AS n, {r('min(value)', 'low')}, {r('max(value)', 'high')}, {r('avg(value)', 'mean')}, {r('quantile_cont(value, 0.95)', 'p95')} FROM events GROUP BY event_type")
def metric_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(research.timers(T.table(spark, sf_dir, "events"), ["event_type"], "value"))


@query(T.with_tables("bars_supp_d", then=f"""
, t AS (SELECT symbol, ts, close, max(close) OVER (PARTITION BY symbol ORDER BY ts) AS top FROM bars_supp_d WHERE close IS NOT NULL), s AS (SELECT *, sum(CASE WHEN close = top THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY ts) AS spell FROM t),
g AS (SELECT symbol, spell, min(ts) AS peak, arg_min(ts, (close, ts)) AS trough, min(close) AS low, max(top) AS top, count(*) - 1 AS rows FROM s GROUP BY 1, 2), a AS (SELECT *, lead(peak) OVER (PARTITION BY symbol ORDER BY spell) AS recovered FROM g)
SELECT symbol, peak, trough, recovered, {r('(low - top) / top', 'depth')}, rows FROM a WHERE rows > 0"""))
def drawdown_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ind.drawdown_episodes(T.bars_supp_d(spark, sf_dir)))


@query(T.with_tables("probs", then=f"""
, e AS (SELECT id % 12 AS month, avg(pow(p - y, 2)) AS b FROM probs GROUP BY 1)
SELECT count(*) AS periods, {r('avg(b)', 'mean_brier')}, {r('stddev_samp(b)', 'std_brier')}, arg_min(month, (-b, month)) AS worst_period, {r('max(b)', 'worst_brier')} FROM e"""))
def prediction_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residues of the id stand for months."""
    return rounded(ev.stability(T.probs(spark, sf_dir).withColumn("month", F.col("id") % 12), "month"))


@query(f"""
WITH s AS (SELECT o_orderstatus AS k, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS y, o_orderdate < TIMESTAMP '1998-01-01' AS old FROM orders), g AS (SELECT k, avg(CASE WHEN old THEN y END) AS before, avg(CASE WHEN NOT old THEN y END) AS now FROM s GROUP BY k)
SELECT k, {r('before', 'before')}, {r('now', 'now')}, {r('CASE WHEN before = 0 THEN abs(now - before) ELSE abs(now - before) / abs(before) END', 'shift')}, coalesce(CASE WHEN before = 0 THEN abs(now - before) ELSE abs(now - before) / abs(before) END > 0.2, false) AS shifted FROM g""")
def label_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dear orders as labels, before 1998 and from then on, by status."""
    o = T.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("k"), F.when(F.col("o_totalprice") > 150000, 1).otherwise(0).alias("y"), (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).alias("old"))
    return rounded(ev.label_shift(o.where("old"), o.where("not old"), ["k"]))


@query(T.with_tables("bars_supp_d", then=f"""
, q AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars_supp_d), k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i, count(*) OVER (PARTITION BY symbol) AS n FROM q WHERE ret IS NOT NULL),
s AS (SELECT symbol, max(n) AS n, avg(CASE WHEN i <= n // 2 THEN ret END) / nullif(stddev_samp(CASE WHEN i <= n // 2 THEN ret END), 0) * sqrt(252) AS a, avg(CASE WHEN i > n // 2 THEN ret END) / nullif(stddev_samp(CASE WHEN i > n // 2 THEN ret END), 0) * sqrt(252) AS b FROM k GROUP BY symbol),
m AS (SELECT symbol, CAST(date_trunc('month', ts) AS DATE) AS month, product(1 + ret) - 1 AS c FROM k GROUP BY 1, 2), w AS (SELECT symbol, arg_min(month, (c, month)) AS worst_month, min(c) AS c FROM m GROUP BY symbol), z AS (SELECT symbol, n, CASE WHEN n >= 20 THEN coalesce(a, 0) END AS a, CASE WHEN n >= 20 THEN coalesce(b, 0) END AS b FROM s)
SELECT symbol, n, {r('a', 'sharpe_first')}, {r('b', 'sharpe_second')}, {r('CASE WHEN n >= 20 THEN least(a, b) / greatest(abs(a), abs(b), 1e-10) END', 'sharpe_stability')}, worst_month, {r('c', 'worst_return')} FROM z JOIN w USING (symbol)"""))
def return_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_supp_d(spark, sf_dir)
    return rounded(ev.return_stability(b.select("symbol", "ts", W.returns(F.col("close"), ind.DEFAULT).alias("ret")), ["symbol"], "ts"))
