"""Queries on trade rules and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import indicators as ind
from ..operators import rules
from ..sources import tables as T
from ._common import r, rounded
from .evaluation import _RET, returns
from .registry import oracle_sql, query
from .windows import sma


@query(T.with_tables("bars_user_d", then=f"""
, k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS n FROM bars_user_d WHERE ts <= DATE '2024-01-25'), s AS (SELECT symbol, arg_max(close, ts) AS price, max(ts) AS last, avg(volume) AS v, count(*) AS c FROM k WHERE n <= 20 GROUP BY symbol),
x AS (SELECT DISTINCT b.symbol, price, v, b.symbol % 6 <> 0 AS a1, DATE '2024-01-25' - last <= 1 AS a2, price >= 5 AS a3, c >= 20 AND v >= 2 AS a4, price <= 200 AS a5 FROM bars_user_d b LEFT JOIN s USING (symbol))
SELECT symbol, {r('price', 'price')}, {r('v', 'mean_volume')}, concat_ws(',', CASE WHEN NOT a1 THEN 'not_held' END, CASE WHEN NOT coalesce(a2, false) THEN 'fresh' END, CASE WHEN NOT coalesce(a3, false) THEN 'price' END, CASE WHEN NOT coalesce(a4, false) THEN 'volume' END, CASE WHEN NOT coalesce(a5, false) THEN 'cash' END) AS reasons,
  a1 AND coalesce(a2, false) AND coalesce(a3, false) AND coalesce(a4, false) AND coalesce(a5, false) AS passed FROM x"""))
def pre_trade_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir)
    names = b.select("symbol").distinct()
    return rounded(rules.pre_trade(names, b, names.where("symbol % 6 = 0"), "2024-01-25", ind.DEFAULT, 200.0, 1, 5.0, 2.0))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, a AS (SELECT symbol, ts, ret, close / max(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS dd, sum(CASE WHEN coalesce(ret, 0) >= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY ts) AS g FROM ret),
b AS (SELECT *, CASE WHEN dd <= -0.15 THEN 'RED' WHEN dd <= -0.10 THEN 'ORANGE' WHEN dd <= -0.05 THEN 'YELLOW' ELSE 'GREEN' END AS level, CAST(sum(CASE WHEN ret < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, g ORDER BY ts) AS BIGINT) AS loss_streak FROM a),
c AS (SELECT *, coalesce(ts - max(CASE WHEN level = 'RED' THEN ts END) OVER (PARTITION BY symbol ORDER BY ts) <= 2, false) AS cooldown FROM b)
SELECT symbol, ts, {r('dd', 'drawdown')}, level, loss_streak, cooldown, level IN ('GREEN', 'YELLOW') AND NOT cooldown AND loss_streak < 4 AND coalesce(ret, 0) >= -0.02 AS can_open FROM c"""))
def risk_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = rules.risk_state(returns(spark, sf_dir), ["symbol"], "ts", "close", "ret", 2)
    return rounded(got.select("symbol", "ts", "drawdown", "level", "loss_streak", "cooldown", "can_open"))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, q AS (SELECT *, max(close) OVER (PARTITION BY symbol ORDER BY ts) AS peak, CASE WHEN count(close) OVER w >= 3 THEN avg(close) OVER w END AS ma FROM ret WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
g AS (SELECT symbol, CASE WHEN round(close - ma, 9) < 0 OR (close - peak) / peak < -0.2 THEN 'bear' WHEN round(close - ma, 9) > 0 AND (close - peak) / peak > -0.1 THEN 'bull' ELSE 'flat' END AS regime, ret FROM q WHERE ret IS NOT NULL)
SELECT symbol, regime, count(*) AS n, {r('avg(ret) * 252', 'mean')}, {r('stddev_samp(ret) * sqrt(252)', 'volatility')}, {r('avg(ret) * 252 / nullif(stddev_samp(ret) * sqrt(252), 0)', 'sharpe')} FROM g GROUP BY 1, 2"""))
def regime_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = ind.regime(returns(spark, sf_dir), ind.DEFAULT, 5, 3, digits=9)
    return rounded(rules.regime_performance(rr, ["symbol"]))


@query(T.with_tables("bars_user_d", then=f"""
, l AS (SELECT 'open' AS feature, open AS x, abs(high - low) AS e FROM bars_user_d UNION ALL SELECT 'volume', volume, abs(high - low) FROM bars_user_d), m AS (SELECT feature, quantile_cont(x, 0.5) AS m FROM l GROUP BY 1), g AS (SELECT feature, avg(CASE WHEN x > m THEN e END) AS above, avg(CASE WHEN x <= m THEN e END) AS below FROM l JOIN m USING (feature) GROUP BY 1)
SELECT feature, {r('above', 'above')}, {r('below', 'below')}, {r('greatest(above, below) / nullif(least(above, below), 0)', 'ratio')}, coalesce(greatest(above, below) / nullif(least(above, below), 0) > 1.5, false) AS drifted FROM g"""))
def concept_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir).select("open", "volume", F.abs(F.col("high") - F.col("low")).alias("e"))
    return rounded(rules.concept_drift(b, ["open", "volume"], "e"))


@query(f"""
WITH t AS (SELECT o_custkey AS k, sum(o_totalprice) AS gross, sum(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE -o_totalprice END) AS net FROM orders WHERE o_orderkey % 10 <> 0 GROUP BY 1), o AS (SELECT o_orderkey AS id, o_custkey AS k, CASE WHEN o_orderkey % 20 = 0 THEN o_totalprice ELSE -o_totalprice END AS notional FROM orders WHERE o_orderkey % 10 = 0),
j AS (SELECT o.*, coalesce(gross, 0) AS gross, coalesce(net, 0) AS net FROM o LEFT JOIN t USING (k)), w AS (SELECT id, k, notional, CASE WHEN abs(notional) > 400000 THEN 'order_size' WHEN gross + abs(notional) > 3000000 THEN 'gross' WHEN abs(net + notional) > 900000 THEN 'net' WHEN (gross + abs(notional)) / 1000000 > 2.5 THEN 'leverage' END AS reason FROM j)
SELECT id, k, notional, reason, reason IS NULL AS allowed FROM w""")
def order_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the orders is proposed, all others are what is held: every order is in one of the two parts."""
    o, k, p = T.table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_totalprice")
    totals = o.where(k % 10 != 0).groupBy(F.col("o_custkey").alias("k")).agg(F.sum(p).alias("gross"), F.sum(F.when(k % 2 == 0, p).otherwise(-p)).alias("net"))
    orders = o.where(k % 10 == 0).select(k.alias("id"), F.col("o_custkey").alias("k"), F.when(k % 20 == 0, p).otherwise(-p).alias("notional"))
    got = rules.order_audit(orders, totals, "k", {"order": 4e5, "gross": 3e6, "net": 9e5, "leverage": 2.5}, 1e6)
    return got


@query(T.with_tables("bars_supp_d", then=f"""
, t AS (SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY ts) AS pc FROM bars_supp_d)),
b AS MATERIALIZED (SELECT *, {sma('tr', 14)} AS atr, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i, count(*) OVER (PARTITION BY symbol) AS n, min(ts) OVER (PARTITION BY symbol ORDER BY ts RANGE BETWEEN INTERVAL 20 DAYS FOLLOWING AND UNBOUNDED FOLLOWING) AS late FROM t),
p AS MATERIALIZED (SELECT p.symbol, p.ts AS entry_date, p.close AS entry, unnest(generate_series(p.i + 1, coalesce(l.i, p.n))) AS i FROM b p LEFT JOIN b l ON l.symbol = p.symbol AND l.ts = p.late),
j AS (SELECT p.*, b.ts AS d, b.high, b.low, b.atr, max(b.high) OVER (PARTITION BY p.symbol, p.entry_date ORDER BY p.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM p JOIN b ON b.symbol = p.symbol AND b.i = p.i),
w AS (SELECT *, CASE WHEN low <= entry * 0.5 THEN 'stop' WHEN low + 2 * atr <= greatest(coalesce(top, entry), entry) THEN 'trailing' WHEN high >= entry * 1.5 THEN 'target' WHEN d - entry_date >= 20 THEN 'time' END AS why FROM j), f AS (SELECT symbol, entry_date, min(d) AS exit_date, arg_min(why, d) AS reason FROM w WHERE why IS NOT NULL GROUP BY 1, 2)
SELECT concat_ws('|', b.symbol, b.ts) AS id, b.symbol, b.ts AS entry_date, exit_date, reason FROM b LEFT JOIN f ON f.symbol = b.symbol AND f.entry_date = b.ts"""))
def position_exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A position is entered at the close of every bar; its path ends at the first bar 20 days later or more."""
    b = ind.technical(T.bars_supp_d(spark, sf_dir, together=True).withColumn("open", F.col("close")))
    c = F.col("close")
    got = rules.exits_at_bars(b.withColumn("atr", F.col("atr_14")), c, c * 0.5, c * 1.5)
    return got.select(F.concat_ws("|", "symbol", "entry_date").alias("id"), "symbol", "entry_date", "exit_date", "reason")


@query(T.with_tables("bars_h", then=f"""
, w AS (SELECT symbol, ts, sum(close - open) OVER o AS realised FROM bars_h WINDOW o AS (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts)), p AS (SELECT *, greatest(max(realised + 1000) OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts), 1000) AS peak FROM w),
d AS (SELECT *, (realised + 1000) / peak - 1 AS dd FROM p), s AS (SELECT *, CASE WHEN round(dd, 12) <= -0.1 OR realised <= -160 THEN 'shutdown' WHEN round(dd, 12) <= -0.05 OR realised <= -80 THEN 'throttle' ELSE 'ok' END AS state FROM d)
SELECT symbol, ts, {r('realised', 'realised')}, {r('dd', 'drawdown')}, state, bool_or(state = 'shutdown') OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts) AS halted FROM s"""))
def intraday_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A session is a symbol's day; each hour's move is its profit or loss on a value of 1,000."""
    b = T.bars_h(spark, sf_dir).select("symbol", "ts", F.to_date("ts").alias("day"), (F.col("close") - F.col("open")).alias("delta"))
    return rounded(rules.intraday_state(b, ["symbol", "day"], ["ts"], "delta", 1000.0, 0.05, 80.0).drop("day", "delta"))


@query(f"SELECT symbol, price, mean_volume, CAST(row_number() OVER (ORDER BY mean_volume DESC, symbol) AS INTEGER) AS rank FROM ({oracle_sql()['pre_trade_checks']}) WHERE passed")
def filtered_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates that pass all pre-trade checks, by volume."""
    got = pre_trade_checks(spark, sf_dir).where("passed")
    return rules.ranked(got, "mean_volume", "symbol").select("symbol", "price", "mean_volume", "rank")
