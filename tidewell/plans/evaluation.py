"""Queries on evaluation: predictions, returns, signals, portfolios, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import windows as W
from ..operators import evaluate as ev
from ..operators import indicators as ind
from ..sources import tables as T
from ._common import cdf_sql, r, rounded
from .registry import oracle_sql, query

_RET = "ret AS (SELECT symbol, ts, close, volume, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars_user_d)"


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir)
    return b.select("symbol", "ts", "close", "volume", W.returns(F.col("close"), ind.DEFAULT).alias("ret"))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, m AS (SELECT symbol, count(ret) AS n, avg(ret) AS mean, stddev_samp(ret) AS std, CASE WHEN count(ret) > 2 THEN skewness(ret) END AS skew, CASE WHEN count(ret) > 3 THEN kurtosis(ret) END AS kurt,
  avg(ret) / stddev_samp(ret) * sqrt(252) AS sharpe, avg(ret) / sqrt(avg(CASE WHEN ret < 0 THEN ret * ret END)) * sqrt(252) AS sortino, avg(CASE WHEN ret > 0 THEN 1.0 WHEN ret <= 0 THEN 0 END) AS win_rate,
  sum(CASE WHEN ret > 0 THEN ret END) / -sum(CASE WHEN ret < 0 THEN ret END) AS profit_factor, exp(sum(ln(1 + ret))) - 1 AS total_return FROM ret GROUP BY symbol),
e AS (SELECT *, sqrt(greatest((1 + 0.5 * pow(sharpe / sqrt(252), 2) - skew * sharpe / sqrt(252) + kurt / 4 * pow(sharpe / sqrt(252), 2)) / n, 0)) * sqrt(252) AS se FROM m)
SELECT symbol, n, {", ".join(r(c, c) for c in ('mean', 'std', 'skew', 'kurt', 'sharpe', 'sortino', 'win_rate', 'profit_factor', 'total_return'))},
  {r('CASE WHEN n >= 10 THEN sharpe - 1.959963984540054 * se END', 'sharpe_low')}, {r('CASE WHEN n >= 10 THEN sharpe + 1.959963984540054 * se END', 'sharpe_high')} FROM e"""))
def return_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.sharpe_interval(ev.moments(returns(spark, sf_dir), ["symbol"])))


_BEST = ev.best_of_trials(150)


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, m AS (SELECT symbol, count(ret) AS n, avg(ret) / nullif(stddev_samp(ret), 0) AS s, CASE WHEN count(ret) > 2 THEN skewness(ret) END AS skew, CASE WHEN count(ret) > 3 THEN kurtosis(ret) END AS kurt FROM ret GROUP BY symbol),
z AS (SELECT symbol, s * sqrt(252) AS sharpe, CASE WHEN n > 1 THEN (s - {_BEST!r} / sqrt(n - 1)) / sqrt(greatest(1 - skew * s + (kurt + 2) / 4 * s * s, 1e-12) / (n - 1)) END AS z FROM m)
SELECT symbol, {r('sharpe', 'sharpe')}, {r(cdf_sql('z'), 'deflated')} FROM z"""))
def deflated_sharpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.deflated(ev.moments(returns(spark, sf_dir), ["symbol"]), trials=150).select("symbol", "sharpe", "deflated"))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, b AS (SELECT ts, avg(ret) AS bench FROM ret GROUP BY ts), j AS (SELECT symbol, ret, bench FROM ret JOIN b USING (ts) WHERE ret IS NOT NULL AND bench IS NOT NULL)
SELECT symbol, count(*) AS n, {r('avg(ret - bench) * 252', 'active_return')}, {r('stddev_samp(ret - bench) * sqrt(252)', 'tracking_error')}, {r('avg(ret - bench) / stddev_samp(ret - bench) * sqrt(252)', 'information_ratio')}, {r('covar_samp(ret, bench) / var_samp(bench)', 'beta')},
  {r('(avg(ret) - covar_samp(ret, bench) / var_samp(bench) * avg(bench)) * 252', 'alpha')}, {r('avg(CASE WHEN bench > 0 THEN ret END) / avg(CASE WHEN bench > 0 THEN bench END)', 'up_capture')}, {r('avg(CASE WHEN bench < 0 THEN ret END) / avg(CASE WHEN bench < 0 THEN bench END)', 'down_capture')}, {r('corr(ret, bench)', 'correlation')}
FROM j GROUP BY symbol HAVING count(*) >= 20"""))
def benchmark_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = returns(spark, sf_dir)
    return rounded(ev.benchmark(rr.join(rr.groupBy("ts").agg(F.avg("ret").alias("bench")), "ts"), ["symbol"]))


_CLIP = "greatest(least(p, 1 - 1e-12), 1e-12)"


@query(T.with_tables("probs", then=f"""
SELECT count(*) AS n, {r('avg(pow(p - y, 2))', 'brier')}, {r(f'avg(-(y * ln({_CLIP}) + (1 - y) * ln(1 - {_CLIP})))', 'log_loss')}, {r('avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0 END)', 'hit_rate')}, {r('sqrt(avg(pow(p - y, 2)))', 'rmse')}, {r('avg(abs(p - y))', 'mae')},
  {r('avg(CASE WHEN p > 0.5 AND y = 0 THEN 1.0 ELSE 0 END)', 'over_confident')}, {r('avg(CASE WHEN p <= 0.5 AND y = 1 THEN 1.0 ELSE 0 END)', 'under_confident')} FROM probs"""))
def prediction_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.classification(T.probs(spark, sf_dir)))


_BINS = "e AS (SELECT min(p) AS lo, max(p) AS hi, count(*) AS n FROM probs), b AS (SELECT CAST(least(greatest(ceil(round((p - lo) / (hi - lo) * 10, 9)) - 1, 0), 9) AS INTEGER) AS bin, p, y, n FROM probs, e), c AS (SELECT bin, count(*) AS n, avg(p) AS confidence, avg(y) AS observed, count(*) / max(n) * abs(avg(y) - avg(p)) AS gap FROM b GROUP BY bin)"


@query(T.with_tables("probs", then=f", {_BINS} SELECT bin, n, {r('confidence', 'confidence')}, {r('observed', 'observed')}, {r('gap', 'gap')} FROM c"))
def reliability_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.reliability(T.probs(spark, sf_dir)))


@query(T.with_tables("probs", then=f", {_BINS}, t AS (SELECT sum(n) AS tn, sum(n * observed) / sum(n) AS base FROM c) SELECT {r('sum(n / tn * pow(confidence - observed, 2))', 'reliability')}, {r('sum(n / tn * pow(observed - base, 2))', 'resolution')}, {r('max(base * (1 - base))', 'uncertainty')}, {r('sum(gap)', 'ece')} FROM c, t"))
def brier_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.brier_parts(ev.reliability(T.probs(spark, sf_dir))))


@query(T.with_tables("probs", then=f"""
, t AS (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]) AS threshold), c AS (SELECT CAST(threshold AS DOUBLE) AS threshold, count(*) FILTER (WHERE p >= threshold AND y = 1) AS tp, count(*) FILTER (WHERE p >= threshold AND y = 0) AS fp, count(*) FILTER (WHERE p < threshold AND y = 0) AS tn, count(*) FILTER (WHERE p < threshold AND y = 1) AS fn FROM probs, t GROUP BY threshold)
SELECT {r('threshold', 'threshold')}, tp, fp, tn, fn, {r('tp / nullif(tp + fp, 0)', 'precision')}, {r('tp / nullif(tp + fn, 0)', 'recall')}, {r('2 * tp / nullif(2 * tp + fp + fn, 0)', 'f1')}, {r('(tp - fp) / nullif(tp + fp, 0)', 'expected_value')}, {r('(tp + fp) / (tp + fp + fn + tn)', 'acted')} FROM c"""))
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.threshold_sweep(T.probs(spark, sf_dir), [0.1, 0.25, 0.5, 0.75, 0.9]))


@query(T.with_tables("probs", then=f"""
, t AS (SELECT unnest([0.0, 0.1, 0.2, 0.3, 0.4, 0.5]) AS level), a AS (SELECT CAST(level AS DOUBLE) AS level, round(abs(p - 0.5), 12) >= level AS act, (p > 0.5) = (y = 1) AS ok FROM probs, t)
SELECT {r('level', 'level')}, count(*) FILTER (WHERE act) AS acted, count(*) FILTER (WHERE NOT act) AS abstained, {r('avg(CASE WHEN act THEN CASE WHEN ok THEN 1.0 ELSE 0 END END)', 'accuracy')} FROM a GROUP BY level"""))
def abstention_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.abstention_sweep(T.probs(spark, sf_dir), [0.0, 0.1, 0.2, 0.3, 0.4, 0.5]))


_SIG = f"{_RET}, s AS (SELECT symbol, ts, close / lag(close, 5) OVER o - 1 AS signal, lead(close, 5) OVER o / close - 1 AS fwd FROM ret WINDOW o AS (PARTITION BY symbol ORDER BY ts)), v AS (SELECT * FROM s WHERE signal IS NOT NULL AND fwd IS NOT NULL), k AS (SELECT *, rank() OVER (PARTITION BY ts ORDER BY signal) + (count(*) OVER (PARTITION BY ts, signal) - 1) / 2 AS a, rank() OVER (PARTITION BY ts ORDER BY fwd) + (count(*) OVER (PARTITION BY ts, fwd) - 1) / 2 AS b FROM v), ic AS (SELECT ts, count(*) AS n, corr(a, b) AS ic FROM k GROUP BY ts HAVING count(*) >= 3)"


def _signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, f = F.col("close"), ind.DEFAULT
    return T.bars_user_d(spark, sf_dir).select("symbol", "ts", "close", W.returns(c, f, 5).alias("signal"), W.forward_returns(c, f, 5).alias("fwd"))


@query(T.with_tables("bars_user_d", then=f", {_SIG} SELECT ts, n, {r('ic', 'ic')} FROM ic"))
def rank_ic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.rank_ic(_signal(spark, sf_dir), "signal", "fwd"))


@query(T.with_tables("bars_user_d", then=f", {_SIG} SELECT count(ic) AS n_dates, {r('avg(ic)', 'mean_ic')}, {r('stddev_samp(ic)', 'std_ic')}, {r('avg(ic) / stddev_samp(ic)', 'ir')} FROM ic"))
def rank_ic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.ic_summary(ev.rank_ic(_signal(spark, sf_dir), "signal", "fwd")))


@query(T.with_tables("bars_user_d", then=f"""
, {_SIG}, w AS (SELECT symbol, ts, signal, greatest(floor(round(count(*) OVER (PARTITION BY ts) * 0.2, 9)), 1) AS k, row_number() OVER (PARTITION BY ts ORDER BY signal DESC, symbol) AS top, row_number() OVER (PARTITION BY ts ORDER BY signal, symbol DESC) AS low FROM s WHERE signal IS NOT NULL)
SELECT symbol, ts, {r('CASE WHEN low <= k THEN -1 / k WHEN top <= k THEN 1 / k ELSE 0 END', 'weight')} FROM w"""))
def quantile_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.quantile_portfolio(_signal(spark, sf_dir), "signal").select("symbol", "ts", "weight"))


@query(T.with_tables("bars_user_d", then=f"""
, {_SIG}, w AS (SELECT symbol, ts, signal, greatest(floor(round(count(*) OVER (PARTITION BY ts) * 0.2, 9)), 1) AS k, row_number() OVER (PARTITION BY ts ORDER BY signal DESC, symbol) AS top, row_number() OVER (PARTITION BY ts ORDER BY signal, symbol DESC) AS low FROM s WHERE signal IS NOT NULL),
p AS (SELECT symbol, ts, CASE WHEN low <= k THEN -1 / k WHEN top <= k THEN 1 / k ELSE 0 END AS weight FROM w), d AS (SELECT ts, coalesce(abs(weight - lag(weight) OVER (PARTITION BY symbol ORDER BY ts)), 0) AS c FROM p)
SELECT ts, {r('sum(c) / 2', 'turnover')} FROM d GROUP BY ts"""))
def portfolio_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.turnover(ev.quantile_portfolio(_signal(spark, sf_dir), "signal"), ind.DEFAULT))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, b AS (SELECT ts, avg(ret) AS m FROM ret GROUP BY ts), j AS (SELECT symbol, ret, m FROM ret JOIN b USING (ts) WHERE ret IS NOT NULL AND m IS NOT NULL)
SELECT symbol, {r('regr_intercept(ret, m)', 'alpha')}, {r('regr_slope(ret, m)', 'beta')}, {r('regr_r2(ret, m)', 'r2')}, count(*) AS n FROM j GROUP BY symbol HAVING count(*) > 2"""))
def factor_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = returns(spark, sf_dir)
    got = ev.ols(rr.join(rr.groupBy("ts").agg(F.avg("ret").alias("m")), "ts"), ["symbol"], "ret", ["m"])
    wide = got.groupBy("symbol").agg(F.max(F.when(F.col("term") == "alpha", F.col("beta"))).alias("alpha"), F.max(F.when(F.col("term") == "m", F.col("beta"))).alias("b"), F.max("r2").alias("r2"), F.max("n").alias("n"))
    return rounded(wide.withColumnRenamed("b", "beta"))


_P = "p AS (SELECT event_type AS family, user_id AS name, (user_id * 7919 % 1009 + 0.5) / 1009 * CASE WHEN user_id % 5 = 0 THEN 0.01 ELSE 1 END AS p FROM events GROUP BY 1, 2)"


def _p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    e = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("family"), u.alias("name")).distinct()
    n = F.col("name")
    return e.withColumn("p", (n * 7919 % 1009 + 0.5).cast("double") / 1009 * F.when(n % 5 == 0, 0.01).otherwise(1.0))


@query(f"""WITH {_P}, k AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p, name) AS i, count(*) OVER (PARTITION BY family) AS m FROM p), z AS (SELECT *, max(CASE WHEN p <= i * 0.05 / m THEN i END) OVER (PARTITION BY family) AS last FROM k)
SELECT family, name, {r('p', 'p')}, {r('least(1, (m - i + 1) * p)', 'p_holm')}, coalesce(i <= last, false) AS rejected FROM z""")
def multiple_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.benjamini_hochberg(ev.holm(_p_values(spark, sf_dir), ["family"]), ["family"]))


@query(f"""
WITH a AS (SELECT value AS x FROM events WHERE user_id % 2 = 0), b AS (SELECT value AS x FROM events WHERE user_id % 2 = 1),
e AS (SELECT list_distinct(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM a),
c AS (SELECT len(list_filter(e, lambda v: v < x)) AS bin, count(*) FILTER (WHERE s = 0) AS a, count(*) FILTER (WHERE s = 1) AS b FROM (SELECT x, 0 AS s FROM a UNION ALL SELECT x, 1 FROM b), e GROUP BY 1),
t AS (SELECT greatest(a / sum(a) OVER (), 1e-6) AS pa, greatest(b / sum(b) OVER (), 1e-6) AS pb FROM c) SELECT {r('sum((pb - pa) * ln(pb / pa))', 'psi')} FROM t""")
def population_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.table(spark, sf_dir, "events").select("user_id", F.col("value").alias("x"))
    return rounded(ev.population_stability(e.where("user_id % 2 = 0"), e.where("user_id % 2 = 1"), "x"))


@query(f"""
WITH u AS (SELECT value AS x, user_id % 2 AS s FROM events), c AS (SELECT x, sum(CASE WHEN s = 0 THEN 1 ELSE 0 END) AS a, sum(s) AS b FROM u GROUP BY x), g AS (SELECT abs(sum(a) OVER (ORDER BY x) / sum(a) OVER () - sum(b) OVER (ORDER BY x) / sum(b) OVER ()) AS gap FROM c)
SELECT {r('max(gap)', 'ks')}, (SELECT count(*) FROM u WHERE s = 0) AS n, (SELECT count(*) FROM u WHERE s = 1) AS m FROM g""")
def kolmogorov_smirnov(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.table(spark, sf_dir, "events").select("user_id", F.col("value").alias("x"))
    return rounded(ev.kolmogorov(e.where("user_id % 2 = 0"), e.where("user_id % 2 = 1"), "x"))


@query(T.with_tables("bars_h", then=f"""
, q AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars_h)
SELECT x.symbol AS a, y.symbol AS b, count(*) AS n, {r('corr(x.ret, y.ret)', 'corr')} FROM q x JOIN q y ON x.ts = y.ts AND x.symbol < y.symbol WHERE x.ret IS NOT NULL AND y.ret IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 10"""))
def correlation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_h(spark, sf_dir)
    return rounded(ev.correlations(b.withColumn("ret", W.returns(F.col("close"), ind.DEFAULT))))


@query(T.with_tables("bars_user_d", then="""
, d AS (SELECT ts, dense_rank() OVER (ORDER BY ts) - 1 AS i FROM (SELECT DISTINCT ts FROM bars_user_d)), n AS (SELECT count(*) AS n FROM d),
f AS (SELECT unnest(generate_series(0, CAST(floor((n - 10 - 1 - 5) / 5) AS BIGINT))) AS fold FROM n),
s AS (SELECT ts, fold, CASE WHEN i >= fold * 5 AND i < fold * 5 + 10 THEN 'train' WHEN i >= fold * 5 + 11 AND i < fold * 5 + 16 THEN 'test' END AS role FROM d, f)
SELECT fold, role, count(*) AS rows, min(ts) AS first, max(ts) AS last FROM s JOIN bars_user_d USING (ts) WHERE role IS NOT NULL GROUP BY ALL"""))
def walk_forward_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ev.walk_forward(T.bars_user_d(spark, sf_dir), "ts", 10, 5, 5, 1)
    return got.groupBy("fold", "role").agg(F.count("*").alias("rows"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query(T.with_tables("bars_user_d", then="""
, d AS (SELECT ts, dense_rank() OVER (ORDER BY ts) - 1 AS i FROM (SELECT DISTINCT ts FROM bars_user_d)), n AS (SELECT ceil(count(*) / 5) AS z FROM d),
s AS (SELECT ts, CAST(fold AS INTEGER) AS fold, CASE WHEN i >= fold * z AND i < (fold + 1) * z THEN 'test' WHEN i < fold * z OR i >= (fold + 1) * z + 2 THEN 'train' END AS role FROM d, n, (SELECT unnest([0, 1, 2, 3, 4]) AS fold))
SELECT fold, role, count(*) AS rows, min(ts) AS first, max(ts) AS last FROM s JOIN bars_user_d USING (ts) WHERE role IS NOT NULL GROUP BY ALL"""))
def purged_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ev.purged_folds(T.bars_user_d(spark, sf_dir), "ts", 5, 2)
    return got.groupBy("fold", "role").agg(F.count("*").alias("rows"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query(T.with_tables("bars_user_d", then=f"""
, e AS (SELECT symbol, ts, close / 500 AS price, (open + close) / 1000 AS model, (open + close) / 1000 - close / 500 AS edge, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM bars_user_d),
s AS (SELECT symbol, i, CASE WHEN abs(edge) > 0.05 THEN CASE WHEN edge > 0 THEN 100.0 ELSE -100.0 END ELSE 0.0 END AS held, 1 AS age FROM e WHERE i = 1
  UNION ALL SELECT e.symbol, e.i, CASE WHEN s.held <> 0 AND s.age < 3 THEN s.held WHEN abs(edge) > 0.05 THEN CASE WHEN edge > 0 THEN 100.0 ELSE -100.0 END ELSE 0.0 END, CASE WHEN (s.held = 0 OR s.age >= 3) AND abs(edge) > 0.05 THEN 1 ELSE s.age + 1 END FROM s JOIN e ON e.symbol = s.symbol AND e.i = s.i + 1)
SELECT symbol, ts, {r('price', 'price')}, {r('model', 'model')}, {r('held', 'position')} FROM s JOIN e USING (symbol, i)""").replace("WITH ", "WITH RECURSIVE ", 1))
def edge_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir)
    px = b.select("symbol", "ts", (F.col("close") / 500).alias("price"), ((F.col("open") + F.col("close")) / 1000).alias("model"))
    return rounded(ev.edge_positions(px, "symbol", "ts", "price", "model"))


@query(T.with_tables("holdings", then=f"""
SELECT filer, quarter, asset, value, {r('CASE WHEN sum(value) OVER (PARTITION BY filer, quarter) > 0 THEN value / sum(value) OVER (PARTITION BY filer, quarter) END', 'weight')} FROM holdings"""))
def holding_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    h = T.holdings(spark, sf_dir)
    total = F.sum("value").over(Window.partitionBy("filer", "quarter"))
    got = h.withColumn("weight", F.when(total > 0, F.col("value") / total))
    return got.withColumn("weight", F.round(F.col("weight") + 3.3e-9, 6) + F.lit(0.0))


@query("""
SELECT c_mktsegment, o_orderpriority, count(*) AS orders, CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers, round(sum(o_totalprice) + 3.3e-9, 2) + 0.0 AS total, grouping(c_mktsegment) AS g1, grouping(o_orderpriority) AS g2
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment, o_orderpriority)""")
def scorecard_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.table(spark, sf_dir, "orders").join(T.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    got = o.rollup("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers"), F.sum("o_totalprice").alias("total"), F.grouping("c_mktsegment").cast("long").alias("g1"), F.grouping("o_orderpriority").cast("long").alias("g2"))
    return rounded(got, 2)


_SPANS = {"first_week": ("2024-01-01", "2024-01-07"), "mid_month": ("2024-01-10", "2024-01-20"), "none": ("2020-02-15", "2020-05-31")}
_VALUES = f"""z AS MATERIALIZED ({oracle_sql()['edge_positions']}),
k AS (SELECT *, coalesce(abs(position - lag(position) OVER o), 0) AS t, abs(position - coalesce(lag(position) OVER o, 0)) AS c, coalesce(lag(position) OVER o * (price - lag(price) OVER o), 0) AS g FROM z WINDOW o AS (PARTITION BY symbol ORDER BY ts)),
d AS (SELECT ts, sum(g) AS profit, sum(c * price * 0.001) AS fee, sum(t) / 2 AS turnover FROM k GROUP BY ts), v AS (SELECT *, 100000 + sum(profit - fee) OVER (ORDER BY ts) AS value FROM d), n AS (SELECT *, value / coalesce(lag(value) OVER (ORDER BY ts), 100000) - 1 AS r FROM v)"""


@query(f"WITH {_VALUES} SELECT ts, {r('profit', 'profit', 3)}, {r('fee', 'fee', 3)}, {r('turnover', 'turnover', 3)}, {r('value', 'value', 3)}, {r('r', 'net_return')} FROM n")
def market_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily values of the portfolio of edge_positions."""
    got = ev.market_values(edge_positions(spark, sf_dir), "symbol", "ts", "price", "position", 1e5)
    return rounded(got.select("ts", *[(F.round(F.col(c) + 3.3e-9, 3) + F.lit(0.0)).alias(c) for c in ("profit", "fee", "turnover", "value")], "net_return"))


@query(f"""
WITH {_VALUES}, w AS (SELECT *, exp(sum(ln(1 + r)) OVER (ORDER BY ts)) AS u FROM n), x AS (SELECT *, u / max(u) OVER (ORDER BY ts) - 1 AS dd FROM w),
q AS (SELECT CASE WHEN price > 0.5 THEN 1 ELSE 0 END AS y, model AS p FROM z), e AS (SELECT min(p) AS lo, max(p) AS hi, count(*) AS n FROM q), b AS (SELECT least(greatest(ceil(round((p - lo) / (hi - lo) * 10, 9)) - 1, 0), 9) AS bin, p, y, n FROM q, e), c AS (SELECT bin, count(*) / max(n) * abs(avg(y) - avg(p)) AS gap FROM b GROUP BY bin),
m AS (SELECT 'sharpe' AS metric, avg(r) / nullif(stddev_samp(r), 0) * sqrt(252) AS value FROM x UNION ALL SELECT 'sortino', avg(r) / sqrt(avg(CASE WHEN r < 0 THEN r * r END)) * sqrt(252) FROM x UNION ALL SELECT 'max_drawdown', min(dd) FROM x UNION ALL SELECT 'turnover', avg(turnover) FROM x UNION ALL SELECT 'total_return', product(1 + r) - 1 FROM x
  {" ".join(f"UNION ALL SELECT 'stress:{n}', product(CASE WHEN ts BETWEEN DATE '{a}' AND DATE '{b}' THEN 1 + r END) - 1 FROM x" for n, (a, b) in _SPANS.items())}
  UNION ALL SELECT 'brier', avg(pow(p - y, 2)) FROM q UNION ALL SELECT 'log_loss', avg(-(y * ln({_CLIP}) + (1 - y) * ln(1 - {_CLIP}))) FROM q UNION ALL SELECT 'calibration_error', sum(gap) FROM c)
SELECT metric, {r('value', 'value', 4)} FROM m UNION ALL SELECT 'sharpe_gt_2', coalesce(max(value) > 2, false)::DOUBLE FROM m WHERE metric = 'sharpe' UNION ALL SELECT 'sortino_gt_2', coalesce(max(value) > 2, false)::DOUBLE FROM m WHERE metric = 'sortino' UNION ALL SELECT 'max_dd_gt_-0_10', coalesce(max(value) > -0.1, false)::DOUBLE FROM m WHERE metric = 'max_drawdown'""")
def prediction_market_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The portfolio of edge_positions as one report; whether the price is above one half stands for a contract's outcome."""
    z = edge_positions(spark, sf_dir)
    predictions = z.select((F.col("price") > 0.5).cast("int").alias("y"), F.col("model").alias("p"))
    values = ev.market_values(z, "symbol", "ts", "price", "position", 1e5)
    return rounded(ev.market_report(values, predictions, "ts", _SPANS), 4)
