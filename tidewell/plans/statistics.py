"""Queries on multi-pass statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import windows as W
from ..operators import indicators as ind
from ..operators import statistics as st
from ..sources import tables as T
from ._common import r, rounded
from .evaluation import _RET, returns
from .registry import query


@query(T.with_tables("bars_h", then=f"""
, n AS (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM bars_h), l AS (SELECT unnest(generate_series(2, 100)) AS lag),
d AS (SELECT a.symbol, lag, stddev_pop(a.close - b.close) AS dev, count(*) AS c FROM n a, l JOIN n b ON b.symbol = a.symbol AND b.i = a.i - lag GROUP BY 1, 2)
SELECT symbol, count(*) AS n_lags, {r('regr_slope(ln(dev), ln(lag))', 'hurst')} FROM d WHERE c > 1 AND dev > 0 GROUP BY symbol"""))
def hurst_exponent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(st.hurst(T.bars_h(spark, sf_dir), F.col("close"), ind.DEFAULT))


@query(T.with_tables("bars_h", then=f"""
, v AS (SELECT symbol, close, volume, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) - 1 AS age FROM bars_h),
s AS (SELECT symbol, sum(pow({1 - 2 / 61}, age)) AS w, sum(pow({1 - 2 / 61}, age) * close) AS x, sum(pow({1 - 2 / 61}, age) * volume) AS y, sum(pow({1 - 2 / 61}, age) * close * close) AS xx, sum(pow({1 - 2 / 61}, age) * volume * volume) AS yy, sum(pow({1 - 2 / 61}, age) * close * volume) AS xy FROM v GROUP BY symbol)
SELECT symbol, {r('(xy / w - x / w * y / w) / sqrt((xx / w - x / w * x / w) * (yy / w - y / w * y / w))', 'corr')} FROM s"""))
def weighted_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(st.ewm_correlation(T.bars_h(spark, sf_dir), "close", "volume", ind.DEFAULT))


@query(f"""
WITH k AS (SELECT event_type AS g, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2 AS rk, count(*) OVER () AS n FROM events),
t AS (SELECT sum(pow(c, 3) - c) AS ties FROM (SELECT count(*) AS c FROM events GROUP BY value)),
p AS (SELECT g, count(*) AS c, sum(rk) AS s, max(n) AS n FROM k GROUP BY g), h AS (SELECT count(*) AS groups, (12 / (max(n) * (max(n) + 1)) * sum(s * s / c) - 3 * (max(n) + 1)) / (1 - max(ties) / (pow(max(n), 3) - max(n))) AS h FROM p, t)
SELECT groups, {r('h', 'h', 4)}, {r('exp(-h / 2) * (1 + h / 2)', 'p')} FROM h""")
def kruskal_wallis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values by event type; the SQL's p is that of four degrees of freedom (five types)."""
    got = st.kruskal(T.table(spark, sf_dir, "events"), "event_type", "value")
    return got.select("groups", (F.round(F.col("h") + 3.3e-9, 4) + F.lit(0.0)).alias("h"), (F.round(F.col("p") + 3.3e-9, 6) + F.lit(0.0)).alias("p"))


@query(T.with_tables("bars_h", then=f"""
, f AS (SELECT ts, symbol, volume AS x FROM bars_h WHERE ts IN (SELECT ts FROM bars_h GROUP BY ts HAVING count(*) = (SELECT count(DISTINCT symbol) FROM bars_h))), c AS (SELECT ts, symbol, x - avg(x) OVER (PARTITION BY symbol) AS x FROM f),
p AS (SELECT a.symbol AS a, b.symbol AS b, avg(a.x * b.x) AS s, avg(pow(a.x * b.x, 2)) AS q, count(*) AS n FROM c a JOIN c b USING (ts) GROUP BY 1, 2),
t AS (SELECT avg(CASE WHEN a = b THEN s END) AS mu, sum(q - s * s) AS phi, max(n) AS n, sum(s * s) AS ss, count(*) FILTER (WHERE a = b) AS k FROM p), z AS (SELECT mu, greatest(least(phi / (ss - k * mu * mu) / n, 1), 0) AS z FROM t)
SELECT a, b, {r('z * CASE WHEN a = b THEN mu ELSE 0 END + (1 - z) * s', 'cov')}, {r('z', 'intensity')} FROM p, z"""))
def shrunk_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(st.shrunk_covariance(T.bars_h(spark, sf_dir), "ts", "symbol", "volume"))


@query(T.with_tables("bars_user_d", then=f"""
SELECT 'open' AS feature, {r('avg(CASE WHEN open IS NULL THEN 1.0 ELSE 0 END)', 'missing', 4)}, {r('var_samp(open)', 'variance', 4)}, {r('corr(open, close)', 'corr', 4)} FROM bars_user_d UNION ALL SELECT 'volume', {r('0', 'missing', 4)}, {r('var_samp(volume)', 'variance', 4)}, {r('corr(volume, close)', 'corr', 4)} FROM bars_user_d"""))
def feature_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir).withColumn("flat", F.lit(1.0))
    return rounded(st.selected_features(st.feature_report(b, ["open", "volume", "flat"], "close"), 2), 4)


@query(f"""
WITH g AS (SELECT event_type AS test, CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS arm, value FROM events), s AS (SELECT test, avg(value) FILTER (WHERE arm = 'A') AS ma, avg(value) FILTER (WHERE arm = 'B') AS mb, var_samp(value) FILTER (WHERE arm = 'A') AS va, var_samp(value) FILTER (WHERE arm = 'B') AS vb, count(*) FILTER (WHERE arm = 'A') AS na, count(*) FILTER (WHERE arm = 'B') AS nb FROM g GROUP BY test)
SELECT test, {r('ma', 'mean_a')}, {r('mb', 'mean_b')}, na AS n_a, nb AS n_b, {r('(mb - ma) / sqrt(va / na + vb / nb)', 'z')}, abs((mb - ma) / sqrt(va / na + vb / nb)) >= 1.959963984540054 / sqrt(0.5) AS stop FROM s""")
def interim_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("test"), F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("arm"), "value")
    return rounded(st.interim(e, "test", "arm", "value", 4, 2).drop("p"))


@query(T.with_tables("trades", then=f"""
, b AS (SELECT CAST(floor(price / 50.0) AS BIGINT) AS bin, count(*) AS n, sum(size * 0.1) AS pnl, avg(size * 0.1) AS mean_pnl, avg(size) AS mean_size, quantile_cont(size, [0.5, 0.95, 0.99]) AS q FROM trades GROUP BY 1)
SELECT bin, n, {r('n / sum(n) OVER ()', 'share')}, {r('pnl', 'pnl', 4)}, {r('mean_pnl', 'mean_pnl')}, {r('mean_size', 'mean_size')}, {r('q[1]', 'p50')}, {r('q[2]', 'p95')}, {r('q[3]', 'p99')} FROM b"""))
def fill_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = st.fill_analytics(T.trades(spark, sf_dir), 50.0, F.col("price"), F.col("size") * 0.1)
    return rounded(got.withColumn("pnl", F.round(F.col("pnl") + 3.3e-9, 4)))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, t AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) <= 10 AS inside, ret > 0.05 AS hit FROM ret WHERE ret IS NOT NULL),
g AS (SELECT symbol, count(*) FILTER (WHERE inside) AS n, avg(CASE WHEN ret > 0 THEN 1.0 ELSE 0 END) AS win_rate_all, avg(CASE WHEN inside THEN CASE WHEN ret > 0 THEN 1.0 ELSE 0 END END) AS win_rate, coalesce(sum(ret) FILTER (WHERE inside AND ret > 0), 0) AS up, coalesce(-sum(ret) FILTER (WHERE inside AND ret <= 0), 0) AS down, count(*) FILTER (WHERE inside AND ret > 0) AS w, count(*) FILTER (WHERE inside AND ret <= 0) AS l, avg(ret) FILTER (WHERE inside) AS m, stddev_pop(ret) FILTER (WHERE inside) AS s, avg(CASE WHEN inside THEN CASE WHEN hit THEN 1.0 ELSE 0 END END) AS hit_rate, avg(CASE WHEN hit THEN 1.0 ELSE 0 END) AS total FROM t GROUP BY symbol),
c AS (SELECT symbol, ts, round(close * 1e6) AS close, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS age FROM ret WHERE close IS NOT NULL), e AS (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i, count(*) OVER (PARTITION BY symbol) AS k FROM c WHERE age <= 252),
lags AS (SELECT unnest(generate_series(2, 100)) AS lag), d AS (SELECT a.symbol, lag, max(a.k) AS k, stddev_pop(a.close - b.close) AS dev, count(*) AS c FROM e a, lags JOIN e b ON b.symbol = a.symbol AND b.i = a.i - lag GROUP BY 1, 2),
h AS (SELECT symbol, CASE WHEN count(*) >= 5 AND max(k) >= 20 THEN regr_slope(ln(dev), ln(lag)) END AS hurst FROM d WHERE c > 1 AND dev > 0 GROUP BY symbol),
x AS (SELECT symbol, n, win_rate_all, win_rate, CASE WHEN down > 0 THEN up / down ELSE 'inf'::DOUBLE END AS profit_factor, CASE WHEN s > 0 THEN m / s * sqrt(252) ELSE 0 END AS sharpe, hit_rate, CASE WHEN total > 0 THEN (total - hit_rate) / total END AS hit_decay, CASE WHEN down > 0 THEN coalesce(up / nullif(w, 0), 0) / (down / l) ELSE 'inf'::DOUBLE END AS winner_loser, hurst FROM g LEFT JOIN h USING (symbol)),
b AS (SELECT *, CASE WHEN n >= 10 THEN concat_ws(',', CASE WHEN round(win_rate, 12) < 0.45 THEN 'win_rate' END, CASE WHEN round(profit_factor, 12) < 1 THEN 'profit_factor' END, CASE WHEN round(sharpe, 12) < 0 THEN 'sharpe' END, CASE WHEN round(hit_decay, 12) > 0.2 THEN 'hit_rate' END, CASE WHEN round(winner_loser, 12) < 1 THEN 'winner_loser' END, CASE WHEN round(hurst, 12) < 0.45 THEN 'hurst' END) ELSE '' END AS breaches FROM x)
SELECT symbol, n, {r('win_rate_all', 'win_rate_all')}, {", ".join(r(f'CASE WHEN n >= 10 THEN {c} END', c) for c in ('win_rate', 'profit_factor', 'sharpe', 'hit_rate', 'hit_decay', 'winner_loser', 'hurst'))}, breaches, CASE WHEN breaches = '' THEN 'GREEN' WHEN strpos(breaches, ',') > 0 THEN 'ORANGE' ELSE 'YELLOW' END AS level FROM b"""))
def edge_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last ten daily moves against all, with breaches and level. These series are of a month, so that ten moves are enough
    for a Sharpe ratio and twenty closes (in millionths) for the equity curve's Hurst exponent."""
    rr = returns(spark, sf_dir)
    trades = rr.where("ret IS NOT NULL").select("symbol", "ts", "ret", (F.col("ret") > 0.05).alias("hit"))
    equity = rr.where("close IS NOT NULL").select("symbol", "ts", F.round(F.col("close") * 1e6).alias("close"))
    got = st.edge_monitor(trades, ["symbol"], ["ts"], "ret", "hit", equity, "close", ["ts"], window=10, least_returns=10, least_equity=20)
    return rounded(got.withColumn("breaches", F.array_join("breaches", ",")))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, m AS (SELECT symbol, avg(ret) AS m, stddev_samp(ret) AS s FROM ret GROUP BY symbol), g AS (SELECT unnest([10000.0, 100000.0, 1000000.0]) AS c), n AS (SELECT symbol, CAST(c AS DOUBLE) AS capital, m * 252 - (0.02 * 0.1 * sqrt(CAST(c AS DOUBLE) / 50 / 100000) + 0.0005) * 12 AS net, s FROM m, g)
SELECT symbol, {r('capital', 'capital')}, {r('net', 'net_return')}, {r('net / nullif(s * sqrt(252), 0)', 'net_sharpe')} FROM n"""))
def capacity_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(st.capacity(returns(spark, sf_dir), ["symbol"], [1e4, 1e5, 1e6], 50.0, 1e5))




@query(T.with_tables("bars_h", then=f"""
, q AS (SELECT symbol, ts, close, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS p, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS age FROM bars_h), t AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) <= 60 AS inside, p > 0.05 AS hit FROM q WHERE p IS NOT NULL),
g AS (SELECT symbol, count(*) FILTER (WHERE inside) AS n, avg(CASE WHEN inside THEN CASE WHEN p > 0 THEN 1.0 ELSE 0 END END) AS win_rate, coalesce(sum(p) FILTER (WHERE inside AND p > 0), 0) AS up, coalesce(-sum(p) FILTER (WHERE inside AND p <= 0), 0) AS down, count(*) FILTER (WHERE inside AND p > 0) AS w, count(*) FILTER (WHERE inside AND p <= 0) AS l, avg(p) FILTER (WHERE inside) AS m, stddev_pop(p) FILTER (WHERE inside) AS s, avg(CASE WHEN inside THEN CASE WHEN hit THEN 1.0 ELSE 0 END END) AS hit_rate, avg(CASE WHEN hit THEN 1.0 ELSE 0 END) AS total FROM t GROUP BY symbol),
e AS (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i, count(*) OVER (PARTITION BY symbol) AS k FROM q WHERE age <= 252), lags AS (SELECT unnest(generate_series(2, 100)) AS lag), d AS (SELECT a.symbol, lag, max(a.k) AS k, stddev_pop(a.close - b.close) AS dev, count(*) AS c FROM e a, lags JOIN e b ON b.symbol = a.symbol AND b.i = a.i - lag GROUP BY 1, 2),
h AS (SELECT symbol, CASE WHEN count(*) >= 5 AND max(k) >= 100 THEN regr_slope(ln(dev), ln(lag)) END AS hurst FROM d WHERE c > 1 AND dev > 0 GROUP BY symbol),
x AS (SELECT symbol, n, win_rate, CASE WHEN down > 0 THEN up / down ELSE 'inf'::DOUBLE END AS profit_factor, CASE WHEN n >= 20 THEN CASE WHEN s > 0 THEN m / s * sqrt(252) ELSE 0 END END AS sharpe, hit_rate, CASE WHEN total > 0 THEN (total - hit_rate) / total END AS hit_decay, CASE WHEN down > 0 THEN coalesce(up / nullif(w, 0), 0) / (down / l) ELSE 'inf'::DOUBLE END AS winner_loser, hurst FROM g LEFT JOIN h USING (symbol)),
b AS (SELECT *, concat_ws(',', CASE WHEN round(win_rate, 12) < 0.45 THEN 'win_rate' END, CASE WHEN round(profit_factor, 12) < 1 THEN 'profit_factor' END, CASE WHEN round(sharpe, 12) < 0 THEN 'sharpe' END, CASE WHEN round(hit_decay, 12) > 0.2 THEN 'hit_rate' END, CASE WHEN round(winner_loser, 12) < 1 THEN 'winner_loser' END, CASE WHEN round(hurst, 12) < 0.45 THEN 'hurst' END) AS breaches FROM x)
SELECT symbol, n, {r('win_rate', 'win_rate')}, {r('profit_factor', 'profit_factor')}, {r('sharpe', 'sharpe')}, {r('hit_rate', 'hit_rate')}, {r('hit_decay', 'hit_decay')}, {r('winner_loser', 'winner_loser')}, {r('hurst', 'hurst')}, breaches, CASE WHEN breaches = '' THEN 'GREEN' WHEN strpos(breaches, ',') > 0 THEN 'ORANGE' ELSE 'YELLOW' END AS level FROM b"""))
def edge_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly moves stand for trades, moves of over 5 percent for reached targets, closes for the equity curve."""
    b = T.bars_h(spark, sf_dir)
    trades = b.select("symbol", "ts", W.returns(F.col("close"), ind.DEFAULT).alias("p")).withColumn("hit", F.col("p") > 0.05)
    got = st.edge_monitor(trades, ["symbol"], ["ts"], "p", "hit", b.select("symbol", "ts", "close"), "close", ["ts"])
    return rounded(got.drop("win_rate_all").withColumn("breaches", F.array_join("breaches", ",")))


@query(T.with_tables("bars_supp_d", then=f"""
, q AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS p FROM bars_supp_d), m AS (SELECT symbol, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(round(avg(p), 12) < 0 AS INT) + CAST(avg(CASE WHEN p > 0 THEN 1.0 ELSE 0 END) < 0.5 AS INT) + CAST(round(min(p), 12) < -0.2 AS INT) AS n_breaches FROM q WHERE p IS NOT NULL GROUP BY 1, 2),
w AS (SELECT *, count(CASE WHEN n_breaches >= 3 THEN 1 END) OVER (PARTITION BY symbol ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS k FROM m)
SELECT symbol, month, n_breaches, CASE WHEN k >= 3 THEN 'RED' WHEN n_breaches >= 2 THEN 'ORANGE' WHEN n_breaches = 1 THEN 'YELLOW' ELSE 'GREEN' END AS level FROM w"""))
def edge_alert_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three breaches of a supplier's month: a mean move below 0, under half of the moves up, a fall of over a fifth."""
    q = T.bars_supp_d(spark, sf_dir).select("symbol", F.trunc("ts", "month").alias("month"), W.returns(F.col("close"), ind.DEFAULT).alias("p"))
    b = lambda c: c.cast("int")
    months = q.where("p IS NOT NULL").groupBy("symbol", "month").agg((b(F.round(F.avg("p"), 12) < 0) + b(F.avg((F.col("p") > 0).cast("double")) < 0.5) + b(F.round(F.min("p"), 12) < -0.2)).alias("n_breaches"))
    return st.edge_levels(months, ["symbol"], "month")
