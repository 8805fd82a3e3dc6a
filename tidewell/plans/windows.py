"""Queries on series: indicators, volatility, risk, robust statistics, signals, adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import windows as W
from ..operators import indicators as ind
from ..sources import tables as T
from ._common import r, rounded
from .registry import query

KEY = ["symbol", "ts"]


def sma(x: str, k: int, fn: str = "avg", m: int | None = None) -> str:
    """Rolling aggregate over the last k rows with min_periods, in SQL; needs the named window o."""
    w = f"OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) {w} >= {m or k} THEN {fn}({x}) {w} END"


_O = "WINDOW o AS (PARTITION BY symbol ORDER BY ts), u AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query(T.with_tables("bars_h", then=f"""
, a AS (SELECT *, close - lag(close) OVER o AS d, lag(close) OVER o AS pc,
  100 * (close - {sma('low', 14, 'min')}) / nullif({sma('high', 14, 'max')} - {sma('low', 14, 'min')}, 0) AS k
  FROM bars_h {_O}),
b AS (SELECT *, CASE WHEN d > 0 THEN d ELSE 0 END AS up, CASE WHEN d < 0 THEN -d ELSE 0 END AS down,
  greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, coalesce(sign(d), 1) * volume AS flow FROM a)
SELECT symbol, ts, {r(sma('close', 20), 'sma_20')},
  {r(f"100 - 100 / (1 + {sma('up', 14)} / nullif({sma('down', 14)}, 0))", 'rsi_14')},
  {r(f"{sma('close', 20)} - 2 * {sma('close', 20, 'stddev_samp')}", 'bb_low')}, {r(f"{sma('close', 20)} + 2 * {sma('close', 20, 'stddev_samp')}", 'bb_high')},
  {r(f"4 * {sma('close', 20, 'stddev_samp')} / {sma('close', 20)}", 'bb_width')},
  {r(f"(close - {sma('close', 20)} + 2 * {sma('close', 20, 'stddev_samp')}) / nullif(4 * {sma('close', 20, 'stddev_samp')}, 0)", 'bb_position')},
  {r(sma('tr', 14), 'atr_14')}, {r('sum(flow) OVER u', 'obv')}, {r('k', 'stoch_k')}, {r(sma('k', 3), 'stoch_d')},
  {r(f"-100 * ({sma('high', 14, 'max')} - close) / nullif({sma('high', 14, 'max')} - {sma('low', 14, 'min')}, 0)", 'williams_r')},
  {r('close - lag(close, 10) OVER o', 'momentum_10')}, {r('100 * (close / lag(close, 10) OVER o - 1)', 'roc_10')},
  {r('(close - lag(close, 5) OVER o) / 5', 'slope_5')}, {r('close / lag(close) OVER o - 1', 'return_1')}
FROM b {_O}"""))
def technical_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ind.technical(T.bars_h(spark, sf_dir)).drop("open", "high", "low", "close", "volume"))


@query(T.with_tables("bars_user_d", then=f"""
SELECT symbol, ts, {r('ln(close)', 'log_close')}, {r('close - lag(close) OVER o', 'diff_1')}, {r('close - lag(close, 24) OVER o', 'diff_24')},
  {r('close / lag(close) OVER o - 1', 'return_1')}, {r('close / lag(close, 24) OVER o - 1', 'return_24')}, {r(sma('close', 6), 'sma_6')}, {r(sma('close', 24), 'sma_24')},
  {r(sma('close', 6, 'stddev_samp'), 'std_6')}, {r(sma('close', 24, 'stddev_samp'), 'std_24')}, {r(sma('close', 24, 'max'), 'max_24')}, {r(sma('close', 24, 'min'), 'min_24')},
  {r(sma('close', 24, 'max') + ' - ' + sma('close', 24, 'min'), 'range_24')}, {r('close - lag(close, 6) OVER o', 'momentum_6')}
FROM bars_user_d {_O}"""))
def contract_price_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ind.price_features(T.bars_user_d(spark, sf_dir)).drop("open", "high", "low", "close", "volume"))


@query(T.with_tables("bars_h", then=f"""
, a AS (SELECT *, ln(close / lag(close) OVER o) AS lr, ln(open / lag(close) OVER o) AS lo, ln(close / open) AS oc,
  ln(high / close) * ln(high / open) + ln(low / close) * ln(low / open) AS rs, pow(ln(high / low), 2) AS pk,
  0.5 * pow(ln(high / low), 2) - (2 * ln(2.0) - 1) * pow(ln(close / open), 2) AS gk FROM bars_h {_O})
SELECT symbol, ts, {r(f"{sma('lr', 20, 'stddev_samp', 2)} * sqrt(252)", 'vol_close')}, {r(f"sqrt({sma('pk', 20, 'avg', 2)} / (4 * ln(2.0))) * sqrt(252)", 'vol_parkinson')},
  {r(f"CASE WHEN count(gk) OVER u >= 2 THEN sqrt(greatest({sma('gk', 20, 'avg', 2)}, 0)) * sqrt(252) END", 'vol_garman_klass')},
  {r(f"sqrt(greatest({sma('lo', 20, 'var_samp', 2)} + {0.34 / (1.34 + 21 / 19)} * {sma('oc', 20, 'var_samp', 2)} + {1 - 0.34 / (1.34 + 21 / 19)} * {sma('rs', 20, 'avg', 2)}, CASE WHEN count(lo) OVER u >= 2 THEN 0 END)) * sqrt(252)", 'vol_yang_zhang')}
FROM a {_O}"""))
def volatility_estimators(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ind.volatility(T.bars_h(spark, sf_dir))
    ready = lambda c, x: F.when(F.count(x).over(ind.DEFAULT.upto()) >= 2, F.col(c))
    prev = W.log(W.ratio(F.col("open"), W.lag(F.col("close"), ind.DEFAULT)))
    got = got.withColumn("__p", prev).withColumns({"vol_yang_zhang": ready("vol_yang_zhang", "__p"), "vol_garman_klass": ready("vol_garman_klass", "close")})
    return rounded(got.select(*KEY, "vol_close", "vol_parkinson", "vol_garman_klass", "vol_yang_zhang"))


_W60 = "OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"


@query(T.with_tables("bars_h", then=f"""
, a AS (SELECT *, close / lag(close) OVER o - 1 AS ret, max(close) OVER u AS peak FROM bars_h {_O}),
b AS (SELECT *, CASE WHEN count(ret) {_W60} >= 20 THEN quantile_cont(ret, 0.05) {_W60} END AS v, list(ret) {_W60} AS rs,
  avg(ret) {_W60} AS m, stddev_samp(ret) {_W60} AS s, count(ret) {_W60} AS n, skewness(ret) {_W60} AS sk, kurtosis(ret) {_W60} AS ku,
  (close - peak) / peak AS drawdown, sum(CASE WHEN close = peak THEN 1 ELSE 0 END) OVER u AS isle FROM a {_O}),
c AS (SELECT *, row_number() OVER (PARTITION BY symbol, isle ORDER BY ts) - 1 AS since_peak,
  min(drawdown) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS mdd,
  list_filter(rs, lambda x: x IS NOT NULL AND x <= v) AS lows, -1.6448536269514722 AS z FROM b)
SELECT symbol, ts, {r('v', 'var_hist')}, {r('list_avg(lows)', 'cvar_hist')}, {r('CASE WHEN n >= 10 THEN m + z * s END', 'var_normal')},
  {r('CASE WHEN n >= 60 THEN m + s * (z + (z * z - 1) * sk / 6 + (pow(z, 3) - 3 * z) * ku / 24 - (2 * pow(z, 3) - 5 * z) * sk * sk / 36) END', 'var_cornish_fisher')},
  {r('CASE WHEN n >= 20 THEN m / nullif(s, 0) * sqrt(252) END', 'sharpe')},
  {r(f"CASE WHEN n >= 20 THEN m / sqrt(avg(CASE WHEN ret < 0 THEN ret * ret END) {_W60}) * sqrt(252) END", 'sortino')},
  {r('CASE WHEN n >= 60 THEN sk END', 'skew')}, {r('CASE WHEN n >= 60 THEN ku END', 'kurtosis')}, {r('drawdown', 'drawdown')}, since_peak, {r('mdd', 'max_drawdown')},
  {r(f"{sma('ret', 252, 'avg', 20)} * 252 / nullif(abs(mdd), 0)", 'calmar')}
FROM c {_O}"""))
def risk_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ind.risk(T.bars_h(spark, sf_dir))
    return rounded(got.select(*KEY, "var_hist", "cvar_hist", "var_normal", "var_cornish_fisher", "sharpe", "sortino", "skew", "kurtosis", "drawdown", F.col("since_peak").cast("long").alias("since_peak"), "max_drawdown", "calmar"))


_W20 = "OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


@query(T.with_tables("bars_supp_d", then=f"""
, a AS (SELECT *, list(close) {_W20} AS xs, count(close) {_W20} AS n, quantile_cont(close, [0.01, 0.25, 0.75, 0.99]) {_W20} AS q, avg(close) {_W20} AS m, stddev_samp(close) {_W20} AS s FROM bars_supp_d),
b AS (SELECT *, CASE WHEN n >= 10 THEN list_median(xs) END AS med FROM a),
c AS (SELECT *, CASE WHEN n >= 10 THEN list_median(list_transform(xs, lambda x: abs(x - med))) END AS md, q[3] - q[2] AS iqr FROM b)
SELECT symbol, ts, {r('med', 'median', 3)}, {r('md', 'mad', 3)}, {r('0.6745 * (close - med) / nullif(md, 0)', 'mad_z', 3)}, {r('1.4826 * md', 'robust_std', 3)},
  {r('CASE WHEN n >= 10 THEN list_avg(list_sort(xs)[1 + CAST(floor(n * 0.05) AS INT) : n - CAST(floor(n * 0.05) AS INT)]) END', 'trimmed_mean', 3)}, {r('CASE WHEN n >= 10 THEN iqr END', 'iqr', 3)},
  {r('CASE WHEN n >= 10 THEN greatest(least(close, q[4]), q[1]) END', 'winsorized', 3)}, CASE WHEN n >= 10 THEN abs((close - m) / s) > 3 END AS outlier_z,
  abs(0.6745 * (close - med)) > 3 * md AS outlier_mad, CASE WHEN n >= 10 THEN close < q[2] - 1.5 * iqr OR close > q[3] + 1.5 * iqr END AS outlier_iqr
FROM c"""))
def robust_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ind.robust(T.bars_supp_d(spark, sf_dir), F.col("close")).drop("close", "high", "low", "volume"), 3)


@query(T.with_tables("bars_user_d", then=f"""
, a AS (SELECT *, close - lag(close) OVER o AS d, close / lag(close) OVER o - 1 AS ret FROM bars_user_d {_O}),
b AS (SELECT *, CASE WHEN d > 0 THEN d ELSE 0 END AS up, CASE WHEN d < 0 THEN -d ELSE 0 END AS down FROM a),
s AS (SELECT symbol, ts, lag(close, 2) OVER o / lag(close, 20) OVER o - 1 AS momentum, {sma('close', 5)} / {sma('close', 20)} - 1 AS ma_cross,
  50 - (100 - 100 / (1 + {sma('up', 14)} / nullif({sma('down', 14)}, 0))) AS reversion, {sma('ret', 10, 'stddev_samp')} AS volatility,
  -abs(close / lag(close, 5) OVER o - 1) / {sma('ret', 10, 'stddev_samp')} AS crash, volume / {sma('volume', 20)} AS volume_ratio,
  (close - {sma('close', 20)} + 2 * {sma('close', 20, 'stddev_samp')}) / (4 * {sma('close', 20, 'stddev_samp')}) AS percent_b FROM b {_O}),
n AS (SELECT symbol, ts, momentum, ma_cross, reversion, volatility, crash, volume_ratio, percent_b,
  {", ".join(f"CASE WHEN {x} IS NOT NULL AND count({x}) OVER k >= 5 THEN ({x} - avg({x}) OVER k) / nullif(stddev_samp({x}) OVER k, 0) END AS {x}_n" for x in ('momentum', 'reversion', 'volatility'))}
  FROM s WINDOW k AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
g AS (SELECT *, (coalesce(momentum_n, 0) * 0.5 + coalesce(reversion_n, 0) * 0.3 - coalesce(volatility_n, 0) * 0.2) / 1.0 AS signal FROM n)
SELECT symbol, ts, {", ".join(r(x, x) for x in ('momentum', 'ma_cross', 'reversion', 'volatility', 'crash', 'volume_ratio', 'percent_b', 'momentum_n', 'reversion_n', 'volatility_n', 'signal'))},
  {r('(rank() OVER (PARTITION BY ts ORDER BY round(signal, 9)) + (count(*) OVER (PARTITION BY ts, round(signal, 9)) - 1) / 2) / count(signal) OVER (PARTITION BY ts)', 'cross_rank')}
FROM g"""))
def signal_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ind.normalized(ind.raw_signals(T.bars_user_d(spark, sf_dir)), ["momentum", "reversion", "volatility"], k=10, m=5)
    got = got.withColumn("signal", ind.combined({"momentum_n": 0.5, "reversion_n": 0.3, "volatility_n": 0.2}, {"volatility_n"})).withColumn("__s", F.round("signal", 9))
    got = got.withColumn("cross_rank", W.cross_rank(F.col("__s"), ["ts"])).drop("__s", "open", "high", "low", "close", "volume")
    return rounded(got)


@query(T.with_tables("bars_supp_d", then=f"""
, a AS (SELECT *, {sma('close', 200, 'avg', 50)} AS ma, close / max(close) OVER u - 1 AS dd FROM bars_supp_d {_O})
SELECT symbol, ts, {r('ma', 'ma', 3)}, {r('dd', 'drawdown', 3)}, CASE WHEN round(close - ma, 9) < 0 OR dd < -0.2 THEN 'bear' WHEN round(close - ma, 9) > 0 AND dd > -0.1 THEN 'bull' ELSE 'flat' END AS regime FROM a"""))
def regime_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ind.regime(T.bars_supp_d(spark, sf_dir), digits=9).select(*KEY, "ma", "drawdown", "regime"), 3)


@query(T.with_tables("bars_user_d", then=f"""
, a AS (SELECT symbol, ts, close, volume, CASE WHEN extract(day FROM ts) = 10 THEN 2.0 ELSE 1.0 END AS split, CASE WHEN extract(day FROM ts) = 20 THEN 0.01 ELSE 0.0 END AS dividend FROM bars_user_d),
b AS (SELECT *, lag(close) OVER o AS prev FROM a {_O}),
c AS (SELECT *, CASE WHEN prev > 0 AND close > 0 THEN ln((close * split + dividend) / prev) ELSE 0 END AS step, -ln(split) + CASE WHEN close > dividend AND dividend > 0 THEN ln((close - dividend) / close) ELSE 0 END AS l FROM b)
SELECT symbol, ts, {r('first_value(close) OVER u * exp(sum(step) OVER u)', 'forward_close', 4)}, {r('volume * exp(sum(ln(split)) OVER u)', 'forward_volume', 4)},
  {r('exp(coalesce(sum(l) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0))', 'back_factor', 4)}
FROM c {_O}"""))
def adjusted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir).select("symbol", "ts", "close", "volume", F.when(F.dayofmonth("ts") == 10, 2.0).otherwise(1.0).alias("split"), F.when(F.dayofmonth("ts") == 20, 0.01).otherwise(0.0).alias("dividend"))
    ahead = ind.adjusted_forward(b).withColumnsRenamed({"adj_close": "forward_close", "adj_volume": "forward_volume"}).drop("adj_factor")
    back = ind.adjusted_backward(ahead)
    return rounded(back.select("symbol", "ts", "forward_close", "forward_volume", F.col("adj_factor").alias("back_factor")), 4)


@query(T.with_tables("bars_user_d", then=f"""
, a AS (SELECT symbol, ts, close, CASE WHEN close <= 0 OR close IS NULL THEN 'invalid_price' WHEN high < low THEN 'ohlc_error' WHEN volume = 0 THEN 'zero_volume' ELSE 'ok' END AS f, close / lag(close) OVER o - 1 AS ret FROM bars_user_d {_O})
SELECT symbol, ts, CASE WHEN f = 'ok' AND abs(ret) > 0.5 THEN 'price_spike' ELSE f END AS data_quality_flag FROM a"""))
def price_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import checks

    b = T.bars_user_d(spark, sf_dir).withColumn("data_quality_flag", checks.ohlcv_flag(F.col("open"), F.col("high"), F.col("low"), F.col("close"), F.col("volume")))
    return ind.spike_flag(b).select(*KEY, "data_quality_flag")


def _ema_sql(span: int, x: str, of: str, name: str) -> str:
    return f"{name} AS (SELECT symbol, i, ts, {x} AS y FROM {of} WHERE i = 1 UNION ALL SELECT b.symbol, b.i, b.ts, {2 / (span + 1)} * b.{x} + {1 - 2 / (span + 1)} * e.y FROM {name} e JOIN {of} b ON b.symbol = e.symbol AND b.i = e.i + 1)"


@query(T.with_tables("bars_h", then=f"""
, n AS (SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM bars_h),
{_ema_sql(12, 'close', 'n', 'f')}, {_ema_sql(26, 'close', 'n', 's')},
m AS (SELECT f.symbol, f.ts, f.i - 25 AS i, f.y - s.y AS macd FROM f JOIN s USING (symbol, i) WHERE f.i >= 26),
{_ema_sql(9, 'macd', 'm', 'g')}
SELECT n.symbol, n.ts, {r('CASE WHEN n.i >= 12 THEN f.y END', 'ema_12')}, {r('CASE WHEN n.i >= 26 THEN s.y END', 'ema_26')}, {r('m.macd', 'macd')}, {r('CASE WHEN g.i >= 9 THEN g.y END', 'macd_signal')}, {r('CASE WHEN g.i >= 9 THEN m.macd - g.y END', 'macd_hist')}
FROM n JOIN f ON n.symbol = f.symbol AND n.i = f.i JOIN s ON n.symbol = s.symbol AND n.i = s.i LEFT JOIN m ON n.symbol = m.symbol AND n.ts = m.ts LEFT JOIN g ON n.symbol = g.symbol AND n.ts = g.ts""").replace("WITH ", "WITH RECURSIVE ", 1))
def ema_macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ind.macd(T.bars_h(spark, sf_dir)).select(*KEY, "ema_12", "ema_26", "macd", "macd_signal", "macd_hist"))


@query(T.with_tables("bars_h", then=f"""
, x0 AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS x FROM bars_h), x AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM x0 WHERE x IS NOT NULL),
s AS (SELECT a.symbol, a.ts, sum(pow(59 / 61, a.i - b.i)) AS w, sum(pow(59 / 61, 2 * (a.i - b.i))) AS w2, sum(pow(59 / 61, a.i - b.i) * b.x) AS wx, sum(pow(59 / 61, a.i - b.i) * b.x * b.x) AS wxx FROM x a JOIN x b ON a.symbol = b.symbol AND b.i <= a.i GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT symbol, ts, {r('sqrt(greatest(wxx / w - pow(wx / w, 2), 0) * w * w / (w * w - w2))', 'ewma_vol')} FROM x0 LEFT JOIN s USING (symbol, ts)"""))
def ewma_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_h(spark, sf_dir).withColumn("return_1", W.returns(F.col("close"), ind.DEFAULT))
    return rounded(ind.ewm(b, "return_1", {"ewma_vol": 60}, kind="std").select(*KEY, "ewma_vol"))


@query(T.with_tables("bars_user_d", then=f"""
, a AS (SELECT *, close < lag(close) OVER o AS bad FROM bars_user_d {_O}),
b AS (SELECT *, row_number() OVER o - row_number() OVER (PARTITION BY symbol, coalesce(bad, false) ORDER BY ts) AS g FROM a {_O}),
c AS (SELECT symbol, g, count(*) AS n FROM b WHERE bad GROUP BY ALL)
SELECT symbol, max(n) AS longest, {r('avg(n)', 'mean_length')} FROM c GROUP BY symbol"""))
def losing_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir)
    return rounded(ind.streaks(b, F.col("close") < W.lag(F.col("close"), ind.DEFAULT)))


@query(T.with_tables("trades", then=f"""
, e AS (SELECT event_type AS category, event_id, ts, value, CAST(ts AS DATE) AS d FROM events)
SELECT event_id, {r('CASE WHEN count(*) OVER c >= 10 THEN avg(value) OVER c ELSE avg(value) OVER g END', 'target_enc')}, {r('count(*) OVER c / nullif(count(*) OVER g, 0)', 'freq_enc')}
FROM e WINDOW c AS (PARTITION BY category ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), g AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""))
def expanding_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("category"), "event_id", "ts", "value", F.to_date("ts").alias("day"))
    return rounded(ind.target_encoding(e, "category", "value", ["ts", "event_id"], "day").select("event_id", "target_enc", "freq_enc"))


@query(T.with_tables("bars_user_d", then=f"""
SELECT symbol, ts, {r('lag(close) OVER o', 'close_lag1')}, {r('lead(close, 5) OVER o / close - 1', 'forward_5')}, {r(sma('volume', 20, 'avg', 5), 'adv_20')}, {r('sum(volume) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)', 'flow_5')},
  {r('close - lag(close) OVER o', 'change')}, {r('(close - lag(close) OVER o) / lag(close) OVER o', 'change_pct')}
FROM bars_user_d {_O}"""))
def lags_and_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, v, f = F.col("close"), F.col("volume"), ind.DEFAULT
    b = T.bars_user_d(spark, sf_dir)
    return rounded(b.select(*KEY, W.lag(c, f).alias("close_lag1"), W.forward_returns(c, f, 5).alias("forward_5"), W.rolling(F.avg, v, f, 20, 5).alias("adv_20"), F.sum(v).over(f.rows(5)).alias("flow_5"), (c - W.lag(c, f)).alias("change"), W.ratio(c - W.lag(c, f), W.lag(c, f)).alias("change_pct")))


_W10 = "OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"


@query(T.with_tables("bars_supp_d", then=f"""
, a AS (SELECT *, count(close) {_W10} AS n, min(close) {_W10} AS lo, max(close) {_W10} AS hi, avg(close) {_W10} AS m, stddev_samp(close) {_W10} AS s, list(close) {_W10} AS xs FROM bars_supp_d)
SELECT symbol, ts, {r('CASE WHEN n >= 5 THEN (close - lo) / nullif(hi - lo, 0) END', 'minmax')}, {r('CASE WHEN n >= 5 THEN (len(list_filter(xs, lambda x: x < close)) + (len(list_filter(xs, lambda x: x = close)) + 1) / 2) / n END', 'percentile')}, {r('CASE WHEN n >= 5 THEN greatest(least((close - m) / nullif(s, 0), 3), -3) END', 'winsorized')}
FROM a"""))
def signal_normalisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min-max, percentile of the last value and winsorised z of closes over ten rows."""
    b = T.bars_supp_d(spark, sf_dir)
    for how in ("minmax", "percentile", "winsorized"):
        b = ind.normalized(b, ["close"], k=10, m=5, how=how).withColumnRenamed("close_n", how)
    return rounded(b.select(*KEY, "minmax", "percentile", "winsorized"))


@query(T.with_tables("bars_supp_d", then=f"""
, a AS (SELECT *, list(close) {_W20} AS xs, count(close) {_W20} AS n FROM bars_supp_d), b AS (SELECT *, CASE WHEN n >= 10 THEN list_median(xs) END AS med FROM a),
z AS (SELECT *, abs(0.6745 * (close - med)) / nullif(list_median(list_transform(xs, lambda x: abs(x - med))), 0) AS z FROM b), q AS (SELECT symbol, quantile_cont(close, 0.01) AS lo, quantile_cont(close, 0.99) AS hi FROM bars_supp_d GROUP BY 1)
SELECT symbol, ts, {r('CASE WHEN NOT coalesce(z > 4, false) THEN greatest(least(close, hi), lo) END', 'close_clean', 4)} FROM z JOIN q USING (symbol)"""))
def cleaned_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes drawn into their series' quantiles; outliers of the last 20 rows become null."""
    return rounded(ind.cleaned(T.bars_supp_d(spark, sf_dir), "close", k=20, limit=4.0).select(*KEY, "close_clean"), 4)


@query(T.with_tables("bars_user_d", then=f"""
, a AS (SELECT symbol, ts, lag(close, 2) OVER o AS close, lag(volume, 2) OVER o AS volume, CASE WHEN symbol % 3 > 0 OR volume > 2 THEN close / open END AS label FROM bars_user_d WINDOW o AS (PARTITION BY symbol ORDER BY ts))
SELECT symbol, ts, {r('close', 'close')}, {r('volume', 'volume')}, {r('label', 'label')} FROM a WHERE close IS NOT NULL AND volume IS NOT NULL AND label IS NOT NULL"""))
def aligned_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes and volumes of two rows before beside the day's move; incomplete rows are dropped."""
    b = T.bars_user_d(spark, sf_dir).withColumn("label", F.when((F.col("symbol") % 3 > 0) | (F.col("volume") > 2), W.ratio(F.col("close"), F.col("open"))))
    return rounded(ind.aligned(b, ["close", "volume"], "label", horizon=2))


@query(f"""
SELECT o_orderkey, {r('avg(o_totalprice) OVER g', 'o_totalprice_mean', 4)}, {r('(rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2) / count(*) OVER g', 'o_totalprice_rank', 4)}, {r('(o_totalprice - avg(o_totalprice) OVER g) / nullif(stddev_samp(o_totalprice) OVER g, 0)', 'o_totalprice_z', 4)}
FROM orders WINDOW g AS (PARTITION BY o_orderpriority)""")
def group_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, percentile rank and z of an order's price within its priority."""
    made = ind.group_scores(T.table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice")
    return rounded(made.select("o_orderkey", "o_totalprice_mean", "o_totalprice_rank", "o_totalprice_z"), 4)
