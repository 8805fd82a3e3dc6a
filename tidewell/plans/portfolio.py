"""Queries on universes, scores, outcomes, exposure, stress, snapshots and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import asof, evaluate, modeling, portfolio, snapshots
from ..operators import indicators as ind
from ..sources import tables as T
from ._common import r, rounded
from .evaluation import _RET, _signal, returns
from .pit import _DAYS, days
from .registry import oracle_sql, query
from .windows import _O, sma


@query(T.with_tables("bars_user_d", then=f"""
, k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS n FROM bars_user_d), g AS (SELECT symbol, arg_max(close, ts) AS price, count(*) AS c, avg(volume) AS v FROM k WHERE n <= 20 GROUP BY symbol)
SELECT symbol, {r('price', 'price')}, {r('CASE WHEN c >= 20 THEN v ELSE 0 END', 'adv')}, {r('CASE WHEN c >= 20 THEN v ELSE 0 END * price', 'adv_value')} FROM g WHERE price BETWEEN 5 AND 300"""))
def universe_from_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.universe_from_prices(T.bars_user_d(spark, sf_dir), 5, 300, ind.DEFAULT))


@query(T.with_tables("bars_supp_d", then="""
, u AS (SELECT symbol, min(ts) AS s, CASE WHEN (SELECT max(ts) FROM bars_supp_d) - max(ts) > 30 THEN max(ts) END AS e FROM bars_supp_d GROUP BY symbol), d AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 3 MONTH)) AS DATE) AS as_of)
SELECT as_of, count(*) AS total, count(*) FILTER (WHERE s <= as_of AND (e IS NULL OR e >= as_of)) AS active, count(*) FILTER (WHERE e < as_of) AS delisted FROM u, d GROUP BY as_of"""))
def universe_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = spark.sql("SELECT explode(sequence(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 3 MONTH)) AS as_of")
    return portfolio.universe_counts(asof.delisted(T.bars_supp_d(spark, sf_dir)), dates)


_PRED = "p AS (SELECT row_number() OVER (ORDER BY symbol, ts) AS id, symbol, ts AS entry_date, close AS entry, close * 1.5 AS target, close * 0.5 AS stop FROM bars_user_d)"
_OUT = f"""{_PRED}, j AS (SELECT p.*, b.ts AS d, b.open, b.close, CASE WHEN b.high >= target AND b.low <= stop THEN CASE WHEN abs(b.open - target) <= abs(b.open - stop) THEN 'target' ELSE 'stop' END WHEN b.high >= target THEN 'target' WHEN b.low <= stop THEN 'stop' END AS hit
  FROM p JOIN bars_user_d b ON b.symbol = p.symbol AND b.ts > entry_date AND b.ts <= entry_date + 5),
f AS (SELECT symbol, entry_date, min(CASE WHEN hit IS NOT NULL THEN d END) AS fd, arg_min(hit, CASE WHEN hit IS NOT NULL THEN d END) AS hit, max(d) AS ed, arg_max(close, d) AS ec FROM j GROUP BY 1, 2),
o AS (SELECT p.symbol, p.entry_date, coalesce(f.hit, CASE WHEN ed IS NULL THEN 'open' ELSE 'expired' END) AS outcome, coalesce(fd, ed) AS exit_date, (CASE f.hit WHEN 'target' THEN target WHEN 'stop' THEN stop ELSE ec END / entry - 1) * 100 AS pnl_pct FROM p LEFT JOIN f USING (symbol, entry_date))"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir)
    c = F.col("close")
    p = b.select(F.concat_ws("|", F.col("symbol").cast("string"), F.col("ts").cast("string")).alias("id"), "symbol", F.col("ts").alias("entry_date"), c.alias("entry"), (c * 1.5).alias("target"), (c * 0.5).alias("stop"))
    return portfolio.resolve(p, b, 5)


@query(T.with_tables("bars_user_d", then=f", {_OUT} SELECT symbol, entry_date, outcome, exit_date, {r('pnl_pct', 'pnl_pct')} FROM o"))
def target_stop_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_outcomes(spark, sf_dir).drop("id"))


@query(T.with_tables("bars_user_d", then=f"""
, {_OUT} SELECT symbol, count(*) AS n, {r('avg(CASE WHEN pnl_pct > 0 THEN 1.0 WHEN pnl_pct <= 0 THEN 0 END)', 'win_rate')}, {r('avg(pnl_pct)', 'mean_pnl')}, {r('avg(CASE WHEN pnl_pct > 0 THEN pnl_pct END)', 'mean_win')}, {r('avg(CASE WHEN pnl_pct <= 0 THEN pnl_pct END)', 'mean_loss')},
  count(*) FILTER (WHERE outcome = 'target') AS n_target, count(*) FILTER (WHERE outcome = 'stop') AS n_stop, count(*) FILTER (WHERE outcome = 'expired') AS n_expired FROM o GROUP BY ROLLUP (symbol)"""))
def prediction_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.scorecard(_outcomes(spark, sf_dir)))


@query(T.with_tables("holdings", then=f"""
, v AS (SELECT filer, quarter, CASE WHEN asset % 3 = 0 THEN -value ELSE value END AS v, c_acctbal + 1000000 AS nav FROM holdings JOIN customer ON c_custkey = filer)
SELECT filer, quarter, {r('sum(greatest(v, 0))', 'long', 2)}, {r('sum(least(v, 0))', 'short', 2)}, {r('sum(abs(v))', 'gross', 2)}, {r('sum(v)', 'net', 2)}, {r('sum(abs(v)) / max(nav)', 'leverage', 2)}, {r('max(abs(v)) / sum(abs(v))', 'largest', 2)} FROM v GROUP BY 1, 2"""))
def portfolio_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = T.holdings(spark, sf_dir).join(T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("filer"), "c_acctbal"), "filer")
    v = F.when(F.col("asset") % 3 == 0, -F.col("value")).otherwise(F.col("value"))
    return rounded(portfolio.exposure(h, ["filer", "quarter"], v, F.col("c_acctbal") + 1000000), 2)


@query(T.with_tables("holdings", then=f"""
, s AS (SELECT * FROM (VALUES ('crash', -0.2, 0.01), ('rally', 0.1, 0.0), ('drift', -0.05, 0.002)) t(shock, move, spread))
SELECT quarter, shock, {r('sum(value * CAST(move AS DOUBLE) - abs(value) * CAST(spread AS DOUBLE))', 'pnl', 5)} FROM holdings, s GROUP BY 1, 2"""))
def shock_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.shock_losses(T.holdings(spark, sf_dir), F.col("value"), {"crash": (-0.2, 0.01), "rally": (0.1, 0.0), "drift": (-0.05, 0.002)}, ["quarter"]), 5)


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, w AS (SELECT * FROM (VALUES ('early', DATE '2024-01-01', DATE '2024-01-15'), ('late', DATE '2024-01-10', DATE '2024-01-30')) t(scenario, a, b)), q AS (SELECT symbol, scenario, ret FROM ret JOIN w ON ts BETWEEN a AND b WHERE ret IS NOT NULL),
c AS (SELECT symbol, scenario, quantile_cont(ret, 0.05) AS v FROM q GROUP BY 1, 2)
SELECT symbol, scenario, {r('max(v)', 'var_5')}, count(*) AS n, {r('avg(CASE WHEN ret <= v THEN ret END)', 'shortfall')}, {r('exp(sum(ln(1 + ret))) - 1', 'total_return')} FROM q JOIN c USING (symbol, scenario) GROUP BY 1, 2"""))
def scenario_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.scenario_metrics(returns(spark, sf_dir), {"early": ("2024-01-01", "2024-01-15"), "late": ("2024-01-10", "2024-01-30")}, ["symbol"]))


@query(T.with_tables("bars_user_d", then=f"""
, w AS (SELECT symbol, ts, greatest(coalesce(close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1, 0), 0) AS s FROM bars_user_d), c AS (SELECT symbol, ts, least(coalesce(s / nullif(sum(s) OVER (PARTITION BY ts), 0), 0), 0.05) AS w FROM w)
SELECT symbol, ts, {r('w * CASE WHEN sum(w) OVER (PARTITION BY ts) > 0.8 THEN 0.8 / sum(w) OVER (PARTITION BY ts) ELSE 1 END', 'weight')} FROM c"""))
def signal_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(portfolio.equal_or_scaled_weights(returns(spark, sf_dir), "ts", F.col("ret"), 0.05, 0.8).select("symbol", "ts", "weight"))


@query(T.with_tables("trades", then=f"""
, q AS (SELECT contract_id AS symbol, ts, price AS mid, size / 100 + 0.01 AS spread, lead(price, 5) OVER (PARTITION BY contract_id ORDER BY ts) AS later FROM trades), f AS (SELECT trade_id AS id, contract_id AS symbol, ts + INTERVAL 1 SECOND AS ts, side, price FROM trades WHERE side IS NOT NULL)
SELECT id, f.symbol, side, {r("CASE WHEN side = 'buy' THEN 1 ELSE -1 END * (later - price)", 'mark_out')}, {r("CASE WHEN side = 'buy' THEN 1 ELSE -1 END * (later - price) / spread", 'mark_out_spreads')} FROM f ASOF JOIN q ON f.symbol = q.symbol AND f.ts >= q.ts"""))
def post_fill_mark_outs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.trades(spark, sf_dir)
    quotes = t.select(F.col("contract_id").alias("symbol"), "ts", F.col("price").alias("mid"), (F.col("size") / 100 + 0.01).alias("spread"))
    fills = t.where("side IS NOT NULL").select(F.col("trade_id").alias("id"), F.col("contract_id").alias("symbol"), (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("ts"), "side", "price")
    return rounded(portfolio.mark_outs(fills, quotes))


@query(T.with_tables("bars_user_d", then=f"""
, a AS (SELECT symbol, ts, close, floor(volume * 10) AS shares, avg(volume * 1000) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS adv FROM bars_user_d),
b AS (SELECT *, shares - coalesce(lag(shares) OVER o, 0) AS ch, coalesce(lag(shares) OVER o * (close - lag(close) OVER o), 0) AS profit FROM a WINDOW o AS (PARTITION BY symbol ORDER BY ts)),
c AS (SELECT ts, sum(shares * close) AS value, sum(abs(ch) * close * 5.0 / 2 / 10000 + CASE WHEN abs(ch) > 0 THEN greatest(abs(ch) * 0.005, 1.0) ELSE 0 END + abs(ch) * close * 0.02 * 0.1 * sqrt(abs(ch) / adv)) AS cost, sum(profit) AS profit FROM b GROUP BY ts)
SELECT ts, {r('value', 'value', 4)}, {r('cost', 'cost', 4)}, {r('profit', 'profit', 4)}, {r('profit / lag(value) OVER (ORDER BY ts)', 'gross_return', 4)}, {r('cost / lag(value) OVER (ORDER BY ts)', 'drag', 4)}, {r('profit / lag(value) OVER (ORDER BY ts) - cost / lag(value) OVER (ORDER BY ts)', 'net_return', 4)} FROM c"""))
def net_of_cost_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir)
    p = b.select("symbol", "ts", "close", F.floor(F.col("volume") * 10).cast("double").alias("shares"), F.avg(F.col("volume") * 1000).over(ind.DEFAULT.rows(20)).alias("adv"))
    return rounded(portfolio.net_of_costs(p, ind.DEFAULT), 4)


@query(T.with_tables("trades", then=f"""
, c AS (SELECT DISTINCT contract_id, asof_ts FROM trades, ({_DAYS})),
k AS (SELECT c.*, t.ts, t.price, row_number() OVER (PARTITION BY c.contract_id, c.asof_ts ORDER BY t.ts DESC, t.trade_id DESC) AS n FROM c JOIN trades t ON t.contract_id = c.contract_id AND t.available_time <= c.asof_ts),
w AS (SELECT c.contract_id, c.asof_ts, count(price) AS n_trades, sum(size) AS volume, stddev_samp(price) AS price_std, (sum(CASE WHEN side = 'buy' THEN size ELSE 0 END) - sum(CASE WHEN side = 'sell' THEN size ELSE 0 END)) / nullif(sum(CASE WHEN side IN ('buy', 'sell') THEN size ELSE 0 END), 0) AS imbalance
  FROM c JOIN trades t ON t.contract_id = c.contract_id AND t.ts BETWEEN c.asof_ts - INTERVAL 24 HOUR AND c.asof_ts AND t.available_time <= c.asof_ts GROUP BY 1, 2),
h AS (SELECT c.*, price FROM c JOIN trades t ON t.contract_id = c.contract_id AND t.ts BETWEEN c.asof_ts - INTERVAL 30 DAY AND c.asof_ts AND t.available_time <= c.asof_ts),
m AS (SELECT contract_id, asof_ts, quantile_cont(price, 0.5) AS med, count(price) AS cnt FROM h GROUP BY 1, 2), d AS (SELECT contract_id, asof_ts, med, cnt, quantile_cont(abs(price - med), 0.5) AS mad FROM h JOIN m USING (contract_id, asof_ts) GROUP BY 1, 2, 3, 4),
s AS (SELECT k.contract_id, k.asof_ts, price, date_diff('second', date_trunc('second', k.ts), k.asof_ts) / 3600 AS age, coalesce(n_trades, 0) AS n_trades, coalesce(volume, 0) AS volume, price_std, imbalance, CASE WHEN cnt >= 10 AND mad > 0 THEN 0.6745 * abs(price - med) / mad END AS score FROM k LEFT JOIN w USING (contract_id, asof_ts) LEFT JOIN d USING (contract_id, asof_ts) WHERE n = 1)
SELECT contract_id, asof_ts, {r('price', 'price')}, {r('age', 'price_age_hours')}, n_trades, {r('volume', 'volume')}, {r('price_std', 'price_std')}, {r('imbalance', 'imbalance')}, {r('score', 'outlier_score')},
  {r('greatest(100 - CASE WHEN age > 1 THEN least(30, 5 * (age - 1)) ELSE 0 END - CASE WHEN score > 3.5 THEN 20 ELSE 0 END - CASE WHEN n_trades > 0 THEN 0 ELSE 10 END, 0)', 'quality_score')} FROM s"""))
def contract_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.trades(spark, sf_dir)
    cells = t.select("contract_id").distinct().crossJoin(F.broadcast(days(spark)))
    return rounded(snapshots.contracts(cells, t))


@query(T.with_tables("bars_user_d", then=f"""
, b AS (SELECT symbol, CAST(ts AS TIMESTAMP) AS ts, close, volume FROM bars_user_d), c AS (SELECT DISTINCT symbol, asof_ts FROM b, ({_DAYS})),
s AS (SELECT c.symbol, c.asof_ts, b.ts, close, volume FROM c JOIN b ON b.symbol = c.symbol AND b.ts BETWEEN c.asof_ts - INTERVAL 60 DAY AND c.asof_ts AND b.ts + INTERVAL 16 HOUR <= c.asof_ts),
w AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol, asof_ts ORDER BY ts) - 1 AS ret, lag(close, 7) OVER (PARTITION BY symbol, asof_ts ORDER BY ts) AS before, row_number() OVER (PARTITION BY symbol, asof_ts ORDER BY ts DESC) AS k FROM s),
q AS (SELECT symbol, asof_ts, quantile_cont(ret, 0.01) AS lo, quantile_cont(ret, 0.99) AS hi, quantile_cont(volume, 0.01) AS vl, quantile_cont(volume, 0.99) AS vh FROM w GROUP BY 1, 2),
z AS (SELECT w.*, lo, hi, CASE WHEN ret IS NOT NULL THEN greatest(least(ret, hi), lo) END AS wr, greatest(least(volume, vh), vl) AS wv FROM w JOIN q USING (symbol, asof_ts) WHERE k <= 20),
m AS (SELECT symbol, asof_ts, quantile_cont(wr, 0.5) AS med FROM z GROUP BY 1, 2), d AS (SELECT symbol, asof_ts, quantile_cont(abs(wr - med), 0.5) AS mad, avg(wv) AS v FROM z JOIN m USING (symbol, asof_ts) GROUP BY 1, 2)
SELECT symbol, asof_ts, {r('close', 'price')}, {r('wr', 'return_1')}, {r('CASE WHEN before IS NOT NULL THEN greatest(least(close / before - 1, hi), lo) END', 'change_7')}, {r('1.4826 * mad', 'volatility')}, {r('v', 'volume_20')} FROM z JOIN d USING (symbol, asof_ts) WHERE k = 1"""))
def symbol_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir).select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), (F.col("ts").cast("timestamp_ntz") + F.expr("INTERVAL 16 HOURS")).alias("available_time"), "close", "volume")
    cells = b.select("symbol").distinct().crossJoin(F.broadcast(days(spark)))
    return rounded(snapshots.symbols(cells, b))


_EV = "ev AS (SELECT ts, ts + INTERVAL 6 HOUR AS known, value AS tone, event_type, user_id, event_id FROM events)"
_SEEN = "known <= asof_ts AND ts BETWEEN asof_ts - INTERVAL {h} HOUR AND asof_ts"


@query(f"""
WITH {_EV}, c AS ({_DAYS})
SELECT asof_ts, count(*) FILTER (WHERE {_SEEN.format(h=24)} AND event_type <> 'view') AS event_count, {r(f"coalesce(avg(CASE WHEN {_SEEN.format(h=24)} AND event_type <> 'view' THEN tone END), 0)", 'event_tone')},
  {", ".join(f"count(*) FILTER (WHERE {_SEEN.format(h=h)} AND event_type = 'view') AS news_{h}h" for h in (1, 24, 168))} FROM c, ev GROUP BY asof_ts""")
def event_and_news_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views stand for news, all other events for world events."""
    e = T.table(spark, sf_dir, "events").select("ts", (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("available_time"), F.col("value").alias("tone"), "event_type")
    return rounded(snapshots.event_counts(days(spark), e.where("event_type <> 'view'"), e.where("event_type = 'view'")))


@query(f"""
WITH {_EV}, c AS (SELECT DISTINCT user_id AS symbol, asof_ts FROM events, ({_DAYS}))
SELECT symbol, asof_ts, {r("coalesce(sum(CASE event_type WHEN 'purchase' THEN tone WHEN 'error' THEN -tone END), 0)", 'net_shares')}, count(*) FILTER (WHERE event_type = 'purchase') AS buy_count
FROM c LEFT JOIN ev ON user_id = symbol AND {_SEEN.format(h=2160)} GROUP BY 1, 2""")
def insider_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases stand for code P, errors for S, values for shares."""
    t = F.col("event_type")
    e = T.table(spark, sf_dir, "events").select(F.col("user_id").alias("symbol"), "ts", (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("available_time"), F.when(t == "purchase", "P").when(t == "error", "S").otherwise(t).alias("code"), F.col("value").alias("shares"))
    cells = e.select("symbol").distinct().crossJoin(F.broadcast(days(spark)))
    return rounded(snapshots.insider_activity(cells, e))


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """World events, news and insider filings, as in event_and_news_counts and insider_activity."""
    t = F.col("event_type")
    e = T.table(spark, sf_dir, "events").withColumn("available_time", F.col("ts") + F.expr("INTERVAL 6 HOURS"))
    counted = e.select("ts", "available_time", F.col("value").alias("tone"), "event_type")
    filed = e.select(F.col("user_id").alias("symbol"), "ts", "available_time", F.when(t == "purchase", "P").when(t == "error", "S").otherwise(t).alias("code"), F.col("value").alias("shares"))
    return counted.where(t != "view"), counted.where(t == "view"), filed


_COUNTS = "event_count, event_tone, news_1h, news_24h, news_168h"


@query(f"SELECT s.*, net_shares, buy_count, {_COUNTS} FROM ({oracle_sql()['symbol_snapshots']}) s LEFT JOIN ({oracle_sql()['insider_activity']}) i USING (symbol, asof_ts) LEFT JOIN ({oracle_sql()['event_and_news_counts']}) e USING (asof_ts)")
def full_symbol_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol snapshots with event and news counts and insider activity."""
    b = T.bars_user_d(spark, sf_dir).select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), (F.col("ts").cast("timestamp_ntz") + F.expr("INTERVAL 16 HOURS")).alias("available_time"), "close", "volume")
    cells = b.select("symbol").distinct().crossJoin(F.broadcast(days(spark)))
    events, news, filed = _facts(spark, sf_dir)
    return rounded(snapshots.full_symbols(cells, b, filed, days(spark), events, news))


@query(f"SELECT s.*, {_COUNTS} FROM ({oracle_sql()['contract_snapshots']}) s LEFT JOIN ({oracle_sql()['event_and_news_counts']}) e USING (asof_ts)")
def full_contract_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract snapshots with event and news counts."""
    t = T.trades(spark, sf_dir)
    events, news, _ = _facts(spark, sf_dir)
    cells = t.select("contract_id").distinct().crossJoin(F.broadcast(days(spark)))
    return rounded(snapshots.full_contracts(cells, t, days(spark), events, news))


@query(T.with_tables("bars_user_d", then=f"""
SELECT symbol, ts, CAST(isodow(ts) - 1 AS INTEGER) AS dow, CAST(month(ts) AS INTEGER) AS month, CAST(quarter(ts) AS INTEGER) AS quarter, CAST(weekofyear(ts) AS INTEGER) AS week, CAST(dayofyear(ts) AS INTEGER) AS doy, last_day(ts) = ts AS month_end, last_day(ts) = ts AND month(ts) % 3 = 0 AS quarter_end, month(ts) = 1 AND day(ts) <= 5 AS year_start,
  CAST(ts + CASE isodow(ts) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS next_business_day, {r('open * close', 'open_x_close', 4)}, {r('open / nullif(close, 0)', 'open_over_close', 4)}, {r('open - close', 'open_minus_close', 4)} FROM bars_user_d"""))
def calendar_and_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir)
    made = {**scalars.calendar(F.col("ts")), "next_business_day": scalars.next_business_day(F.col("ts")), **scalars.interactions(["open", "close"])}
    return rounded(b.select("symbol", "ts", *[c.alias(n) for n, c in made.items()]), 4)


@query()
def calibrated_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(modeling.calibrated(T.probs(spark, sf_dir)))


@query()
def walk_forward_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _signal(spark, sf_dir).withColumn("level", F.ln("close"))
    folds = evaluate.walk_forward(s.where("fwd IS NOT NULL AND signal IS NOT NULL"), "ts", 8, 4, 4, 1)
    return modeling.walk_forward_ridge(folds, ["signal", "level"], "fwd").select("symbol", "ts", "fold", "fwd", "prediction")


@query(f"""
WITH t AS (SELECT unnest(list_distinct(list_filter(regexp_extract_all(text, '[A-Za-z]+'), lambda x: regexp_full_match(x, '[A-Z]{{2,5}}')))) AS ticker FROM documents)
SELECT ticker, count(*) AS documents FROM t WHERE ticker NOT IN ({", ".join(f"'{w}'" for w in scalars.STOP_WORDS)}) GROUP BY ticker""")
def post_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.explode(scalars.tickers(F.col("text"))).alias("ticker")).groupBy("ticker").agg(F.count("*").alias("documents"))




_PTS = {"trend_pts": "CASE WHEN close > slow THEN 15.0 ELSE 0 END + CASE WHEN fast > slow THEN 15 ELSE 0 END + CASE WHEN slope > 0 THEN 10 ELSE 0 END", "pullback_pts": "CASE WHEN rsi BETWEEN 30 AND 50 THEN 15.0 ELSE 0 END + CASE WHEN pb < 0.4 THEN 15 ELSE 0 END", "volume_pts": "CASE WHEN vr > 1 THEN 10.0 ELSE 0 END + CASE WHEN vr > 1.5 THEN 5 ELSE 0 END", "volatility_pts": "CASE WHEN ap BETWEEN 0.01 AND 0.06 THEN 15.0 ELSE 0 END"}


@query(T.with_tables("bars_h", then=f"""
, a AS (SELECT *, close - lag(close) OVER o AS d, lag(close) OVER o AS pc, max(close) OVER u AS peak FROM bars_h {_O}), b AS (SELECT *, CASE WHEN d > 0 THEN d ELSE 0 END AS up, CASE WHEN d < 0 THEN -d ELSE 0 END AS down, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, (close - peak) / nullif(peak, 0) AS dd FROM a),
t AS (SELECT symbol, ts, close, dd, {sma('close', 20, m=5)} AS ma, {sma('close', 5)} AS fast, {sma('close', 10)} AS slow, (close - lag(close, 5) OVER o) / 5 AS slope, 100 - 100 / (1 + {sma('up', 14)} / nullif({sma('down', 14)}, 0)) AS rsi, (close - {sma('close', 20)} + 2 * {sma('close', 20, 'stddev_samp')}) / nullif(4 * {sma('close', 20, 'stddev_samp')}, 0) AS pb, volume / nullif({sma('volume', 10)}, 0) AS vr, {sma('tr', 14)} AS atr FROM b {_O}),
p AS (SELECT *, CASE WHEN close < ma OR dd < -0.2 THEN 'bear' WHEN close > ma AND dd > -0.1 THEN 'bull' ELSE 'flat' END AS regime, atr / nullif(close, 0) AS ap FROM t), q AS (SELECT *, {", ".join(f"{e} AS {n}" for n, e in _PTS.items())} FROM p), s AS (SELECT *, trend_pts + pullback_pts + volume_pts + volatility_pts AS score FROM q)
SELECT symbol, ts, regime, {", ".join(r(n, n) for n in (*_PTS, 'score'))}, coalesce(trend_pts >= 25 AND pullback_pts > 0 AND score >= CASE regime WHEN 'bull' THEN 60 WHEN 'flat' THEN 70 END, false) AS eligible, CASE WHEN score >= 80 THEN 'HIGH' WHEN score >= 70 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
  {r('close', 'close', 4)}, {r('round(close - 1.5 * atr + 1e-9, 2)', 'stop_price', 4)}, {r('round(close + 2 * atr + 1e-9, 2)', 'target_1', 4)}, {r('round(close + 3 * atr + 1e-9, 2)', 'target_2', 4)} FROM s"""))
def rule_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jobs

    return rounded(jobs.signals(T.bars_h(spark, sf_dir)), 4)


@query(f"""
WITH s AS ({oracle_sql()['scenario_metrics']}), k AS ({oracle_sql()['shock_losses']})
SELECT 'scenario' AS kind, scenario AS name, CAST(symbol AS VARCHAR) AS portfolio, unnest(['var_5', 'shortfall', 'total_return', 'n']) AS metric, unnest([var_5, shortfall, total_return, n]) AS value FROM s
UNION ALL SELECT 'shock', shock, CAST(quarter AS VARCHAR), 'pnl', pnl FROM k""")
def stress_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenarios of the symbols' returns and shocks to the holdings of each quarter in one report."""
    return rounded(portfolio.stress_bundle(scenario_metrics(spark, sf_dir), shock_losses(spark, sf_dir), ["symbol"], ["quarter"]))
