"""Queries on curated tables, flags, universes, fallbacks and small reads. Events stand for trades and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import asof, checks, curated, evaluate, modeling, portfolio
from ..sources import ingest
from ..sources import tables as T
from ..streaming import jobs as streams
from ._common import r, rounded
from .evaluation import _RET, _signal, returns
from .registry import query

_RAW = "raw AS (SELECT 'U' || symbol AS ticker, ts AS date, CASE WHEN symbol % 11 = 0 THEN -open ELSE open END AS open, high, CASE WHEN symbol % 13 = 0 THEN high + 1 ELSE low END AS low, close, CAST(volume AS BIGINT) AS volume, CASE WHEN symbol % 5 = 0 THEN '2:1' END AS split_ratio, CASE WHEN symbol % 7 = 0 THEN 0.5 ELSE 0 END AS dividend FROM bars_user_d)"


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars as raw rows, some with broken fields."""
    s = F.col("symbol")
    return T.bars_user_d(spark, sf_dir).select(F.concat(F.lit("U"), s).alias("ticker"), F.col("ts").alias("date"), F.when(s % 11 == 0, -F.col("open")).otherwise(F.col("open")).alias("open"), "high", F.when(s % 13 == 0, F.col("high") + 1).otherwise(F.col("low")).alias("low"), "close", F.col("close").alias("adj_close"), F.col("volume").cast("bigint").alias("volume"), F.when(s % 5 == 0, "2:1").alias("split_ratio"), F.when(s % 7 == 0, 0.5).otherwise(0.0).alias("dividend"), F.lit("").alias("raw_data"), F.lit(None).cast("timestamp").alias("extracted_at"))


@query(T.with_tables("bars_user_d", then=f"""
, {_RAW} SELECT sha256(ticker) AS symbol_id, date, {r('close', 'close')}, date + INTERVAL 21 HOUR AS event_time, date + INTERVAL 21 HOUR + INTERVAL 15 MINUTE AS available_time, 'assumed' AS time_quality,
  CASE WHEN coalesce(open < 0, false) OR coalesce(high < 0, false) OR coalesce(low < 0, false) OR coalesce(close < 0, false) THEN 'negative_price' WHEN coalesce(high < low OR high < greatest(open, close) OR low > least(open, close), false) THEN 'ohlc_error' WHEN volume < 0 THEN 'negative_volume' WHEN close IS NULL OR close <= 0 THEN 'invalid_price' WHEN volume = 0 THEN 'zero_volume' ELSE 'ok' END AS data_quality_flag FROM raw"""))
def curated_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bar rules only: spikes are the query price_spikes."""
    raw = raw_prices(spark, sf_dir)
    flag = checks.ohlcv_flag(*[F.col(c) for c in ("open", "high", "low", "close", "volume")])
    got = curated.prices(raw).withColumn("data_quality_flag", flag)
    utc = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return rounded(got.select("symbol_id", "date", "close", utc("event_time"), utc("available_time"), "time_quality", "data_quality_flag"))


@query(T.with_tables("bars_user_d", then=f"""
, {_RAW} SELECT sha256(ticker) AS symbol_id, date AS action_date, 'split' AS kind, 2.0::DOUBLE AS amount FROM raw WHERE split_ratio IS NOT NULL UNION ALL SELECT sha256(ticker), date, 'dividend', dividend::DOUBLE FROM raw WHERE dividend > 0"""))
def corporate_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(curated.corporate_actions(raw_prices(spark, sf_dir)).select("symbol_id", "action_date", "kind", "amount"))


@query(f"""
SELECT sha256(CAST(user_id AS VARCHAR)) AS contract_id, CAST(event_id AS VARCHAR) AS trade_id, {r('value - 20', 'price')}, ts AS event_time, ts + INTERVAL 2 MINUTE AS available_time,
  CASE WHEN value - 20 < 0 THEN 'invalid_price' WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) <= 0 THEN 'invalid_size' ELSE 'ok' END AS data_quality_flag FROM events""")
def curated_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.table(spark, sf_dir, "events")
    raw = e.select(F.col("user_id").cast("string").alias("venue_market_id"), F.col("event_id").cast("string").alias("trade_id"), "ts", (F.col("value") - 20).alias("price"), F.get_json_object("props", "$.k").cast("double").alias("size"), F.col("event_type").alias("side"))
    got = curated.contract_trades(raw)
    utc = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return rounded(got.select("contract_id", "trade_id", "price", utc("event_time"), utc("available_time"), "data_quality_flag"))


@query(f"""
SELECT sha256(CAST(user_id AS VARCHAR)) AS contract_id, ts, {r('CASE WHEN value > 1 THEN value / 100 ELSE value END', 'price_normalized')}, CASE WHEN value IS NULL THEN 'missing_price' WHEN CASE WHEN value > 1 THEN value / 100 ELSE value END > 1 THEN 'out_of_range' WHEN value < 0 THEN 'out_of_range' ELSE 'ok' END AS data_quality_flag FROM events""")
def curated_contract_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("venue_market_id"), "ts", F.col("event_type").alias("outcome"), F.col("value").alias("price"))
    return rounded(curated.contract_prices(raw).select("contract_id", "ts", "price_normalized", "data_quality_flag"))


@query(T.with_tables("holdings", then=f"""
, t AS (SELECT filer, quarter, asset, value, value / sum(value) OVER (PARTITION BY filer, quarter) AS w FROM holdings)
SELECT filer, quarter AS report_date, sha256('T' || asset) AS symbol_id, {r('w', 'portfolio_weight')}, quarter + INTERVAL 45 DAY + INTERVAL 1 HOUR AS available_time FROM t WHERE asset % 3 <> 0"""))
def curated_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three suppliers have a known ticker; the others still count in the filer's total."""
    h = T.holdings(spark, sf_dir)
    raw = h.select("filer", F.col("quarter").alias("report_date"), F.col("asset").cast("string").alias("cusip"), F.lit(1).alias("shares"), F.col("value").alias("market_value"), F.date_add("quarter", 45).alias("filing_date"))
    names = T.table(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").cast("string").alias("cusip"), F.concat(F.lit("T"), "s_suppkey").alias("ticker"))
    got = curated.holdings(raw, names)
    return rounded(got.select("filer", "report_date", "symbol_id", "portfolio_weight", F.col("available_time").cast("timestamp_ntz").alias("available_time")))


_OK = {"ticker_length": "length(ticker) BETWEEN 1 AND 20", "low_le_high": "low <= high", "open_in_range": "low <= open AND open <= high", "close_in_range": "low <= close AND close <= high", "non_negative": "low >= 0 AND volume >= 0"}


@query(T.with_tables("bars_user_d", then=f"""
, {_RAW}, v AS (SELECT ticker, date, array_to_string(list_filter([{", ".join(f"CASE WHEN NOT coalesce({e}, false) THEN '{n}' END" for n, e in _OK.items())}], lambda x: x IS NOT NULL), ',') AS violations FROM raw)
SELECT ticker, date, violations FROM v WHERE violations <> ''"""))
def invalid_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = checks.split_valid(raw_prices(spark, sf_dir), checks.price_rules())[1]
    return bad.select("ticker", "date", F.array_join("violations", ",").alias("violations"))


@query("SELECT count(*) FILTER (WHERE o_custkey IS NULL) AS null_keys, count(*) FILTER (WHERE o_orderpriority IS NOT NULL) AS bad_dates, count(*) FILTER (WHERE o_totalprice IS NOT NULL) AS valid_values, count(*) FILTER (WHERE o_totalprice IS NULL) AS null_values FROM orders")
def observation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities stand for dates that cannot be read."""
    rows = T.table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("d"), F.col("o_totalprice").cast("string").alias("v"))
    return checks.observation_report(rows, "o_custkey", "d", "v")


@query(f"SELECT s_suppkey AS symbol, s_nationkey, {r('s_acctbal', 's_acctbal')} FROM supplier WHERE s_nationkey NOT IN (3, 4) AND s_acctbal >= 1000")
def eligible_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("symbol"), "s_nationkey", "s_acctbal")
    return rounded(portfolio.eligible(s, deny=(3, 4), key="s_nationkey", s_acctbal=1000.0))


_UNI = "u AS (SELECT symbol, min(ts) AS s, CASE WHEN (SELECT max(ts) FROM bars_supp_d) - max(ts) > 30 THEN max(ts) END AS e FROM bars_supp_d GROUP BY symbol), d AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 3 MONTH)) AS DATE) AS as_of)"


@query(T.with_tables("bars_supp_d", then=f", {_UNI} SELECT as_of, symbol FROM u, d WHERE s <= as_of AND (e IS NULL OR e >= as_of)"))
def active_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = spark.sql("SELECT explode(sequence(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 3 MONTH)) AS as_of")
    return portfolio.active_on(asof.delisted(T.bars_supp_d(spark, sf_dir)), dates).select("as_of", "symbol")


@query(T.with_tables("bars_supp_d", then=f", {_UNI} SELECT b.symbol, b.ts, {r('close', 'close', 3)} FROM bars_supp_d b JOIN u USING (symbol) WHERE u.s <= DATE '1997-06-30' AND (e IS NULL OR e >= DATE '1997-06-30') AND b.ts <= DATE '1997-06-30'"))
def universe_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_supp_d(spark, sf_dir)
    return rounded(portfolio.universe_prices(b, asof.delisted(b), "1997-06-30").select("symbol", "ts", "close"), 3)


@query(f"""
WITH s AS (SELECT event_type AS source, CAST(ts AS DATE) AS computed_at, count(*) AS n, max(value) AS p90 FROM events GROUP BY 1, 2), l AS (SELECT source, arg_max(p90, computed_at) AS p90, arg_max(n, computed_at) AS n, max(computed_at) AS last FROM s GROUP BY 1)
SELECT source, {r("CASE WHEN n >= 20 AND date_diff('second', CAST(last AS TIMESTAMP), TIMESTAMP '2024-01-31 00:00:00') <= 86400 THEN p90 ELSE 15.0 END", 'latency_min')} FROM l""")
def latency_or_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily maxima stand for measured percentiles."""
    s = T.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("computed_at")).agg(F.count("*").alias("n"), F.max("value").alias("p90"))
    return rounded(checks.latency_or(s, 15.0, "2024-01-31 00:00:00", least=20))


@query("SELECT c_custkey AS ticker, 'primary' AS origin FROM customer WHERE c_acctbal > 0 UNION ALL SELECT c_custkey, 'secondary' FROM customer WHERE c_acctbal <= 0 OR c_acctbal IS NULL")
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a positive balance are in the first source, all are in the second."""
    c = T.table(spark, sf_dir, "customer")
    side = lambda rows, name: rows.select(F.col("c_custkey").alias("ticker"), F.lit(name).alias("origin"))
    return ingest.first_available(side(c.where("c_acctbal > 0"), "primary"), side(c, "secondary"))


@query("SELECT user_id, count(*) FILTER (WHERE ts + INTERVAL 6 HOUR <= TIMESTAMP '2024-01-15 00:00:00') AS known FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE ts + INTERVAL 6 HOUR <= TIMESTAMP '2024-01-15 00:00:00') > 0")
def known_by_then(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.trades(spark, sf_dir)
    return asof.available(t, F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).groupBy(F.col("contract_id").alias("user_id")).agg(F.count("*").alias("known"))


@query("""
WITH p AS (SELECT user_id, event_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY value, event_id) AS prev FROM events), s AS (SELECT *, value + event_id * 1e-9 AS seq FROM p)
SELECT user_id, count(*) FILTER (WHERE prev > ts) AS unsorted, count(ts) - count(DISTINCT ts) AS repeated, arg_max(event_id % 2 = 0, seq) AS last_has_target FROM s GROUP BY 1""")
def future_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the order of their values, with ids to break ties; every second row has a target."""
    e = T.table(spark, sf_dir, "events").select("user_id", "ts", (F.col("value") + F.col("event_id") * 1e-9).alias("seq"), F.when(F.col("event_id") % 2 == 0, 1).alias("target"))
    return checks.future_data(e, ["user_id"], "seq", "ts", "target")


@query(f"""
SELECT o_orderkey, {r('o_totalprice - 150000', 'surprise')}, {r('(o_totalprice - 150000) / 150000', 'surprise_pct')}, CASE WHEN o_totalprice / 4000 >= 80 THEN 'HIGH' WHEN o_totalprice / 4000 >= 70 THEN 'MEDIUM' ELSE 'LOW' END AS confidence, {r("CASE o_orderkey % 4 WHEN 0 THEN 2.0 WHEN 1 THEN 1.5 ELSE 1 END", 'ratio')} FROM orders""")
def scalar_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surprises, confidence labels and split ratios ('4:2', '1.5', '0:3' and no number)."""
    o, k = T.table(spark, sf_dir, "orders"), F.col("o_orderkey") % 4
    diff, part = scalars.surprise(F.col("o_totalprice"), F.lit(150000.0))
    text = F.when(k == 0, "4:2").when(k == 1, "1.5").when(k == 2, "0:3").otherwise("none")
    return rounded(o.select("o_orderkey", diff.alias("surprise"), part.alias("surprise_pct"), scalars.confidence(F.col("o_totalprice") / 4000).alias("confidence"), scalars.split_ratio(text).alias("ratio")))


_CHAIN = "ch AS (SELECT l_suppkey AS ticker, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS quote_date, CAST(date_trunc('quarter', l_shipdate) AS DATE) + CAST(l_partkey % 120 AS INTEGER) AS expiration, CASE WHEN l_linenumber % 2 = 0 THEN 'call' ELSE 'put' END AS option_type, l_extendedprice / l_quantity AS strike, CAST(l_quantity AS BIGINT) AS volume, CAST(l_quantity * 3 AS BIGINT) AS open_interest, 0.1 + l_discount + l_tax AS implied_volatility FROM lineitem), cl AS (SELECT ticker, quote_date, avg(strike) AS close FROM ch GROUP BY 1, 2)"


@query(f"""
WITH {_CHAIN}, j AS (SELECT ch.*, close, expiration - quote_date AS dte, option_type = 'call' AS c FROM ch JOIN cl USING (ticker, quote_date)),
g AS (SELECT ticker, quote_date, count(*) AS n, sum(CASE WHEN c THEN volume ELSE 0 END) AS call_volume, sum(CASE WHEN NOT c THEN volume ELSE 0 END) AS put_volume, avg(CASE WHEN dte BETWEEN 20 AND 40 THEN implied_volatility END) AS i30, count(CASE WHEN dte BETWEEN 20 AND 40 THEN 1 END) AS n30, avg(CASE WHEN dte BETWEEN 75 AND 105 THEN implied_volatility END) AS i90, count(CASE WHEN dte BETWEEN 75 AND 105 THEN 1 END) AS n90 FROM j GROUP BY 1, 2)
SELECT ticker, quote_date, n, CAST(call_volume AS BIGINT) AS call_volume, CAST(put_volume AS BIGINT) AS put_volume, {r('CASE WHEN call_volume > 0 THEN put_volume / call_volume END', 'pc_volume')}, {r('CASE WHEN n30 >= 2 THEN i30 END', 'iv_30')}, {r('CASE WHEN n90 >= 2 THEN i90 END', 'iv_90')}, {r('(CASE WHEN n90 >= 2 THEN i90 END - CASE WHEN n30 >= 2 THEN i30 END) / 60', 'slope')}, CASE WHEN n < 10 THEN 'thin_chain' ELSE 'ok' END AS data_quality_flag FROM g""")
def option_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items stand for options of their supplier: unit prices are strikes, discounts and taxes make volatilities."""
    q = F.trunc("l_shipdate", "quarter")
    ch = T.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("ticker"), q.alias("quote_date"), F.date_add(q, (F.col("l_partkey") % 120).cast("int")).alias("expiration"), F.when(F.col("l_linenumber") % 2 == 0, "call").otherwise("put").alias("option_type"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("strike"), F.col("l_quantity").cast("bigint").alias("volume"), (F.col("l_quantity") * 3).cast("bigint").alias("open_interest"), (0.1 + F.col("l_discount") + F.col("l_tax")).alias("implied_volatility"))
    closes = ch.groupBy("ticker", "quote_date").agg(F.avg("strike").alias("close"))
    return rounded(portfolio.option_summary(ch, closes).select("ticker", "quote_date", "n", "call_volume", "put_volume", "pc_volume", "iv_30", "iv_90", "slope", "data_quality_flag"))


@query(f"""
WITH h AS (SELECT event_type AS contract_id, date_trunc('hour', ts) AS start, count(*) AS n, sum(value) AS volume FROM events GROUP BY 1, 2), s AS (SELECT contract_id, unnest(generate_series(min(start), max(start), INTERVAL 1 HOUR)) AS start FROM h GROUP BY 1),
f AS (SELECT contract_id, start, coalesce(n, 0) AS n, coalesce(volume, 0) AS volume FROM s LEFT JOIN h USING (contract_id, start))
SELECT contract_id, start, n, {r('volume', 'volume', 4)}, {", ".join(f"CAST(sum(n) OVER (PARTITION BY contract_id ORDER BY start RANGE BETWEEN INTERVAL {k - 1} HOUR PRECEDING AND CURRENT ROW) AS BIGINT) AS n_{k}h, {r(f'sum(volume) OVER (PARTITION BY contract_id ORDER BY start RANGE BETWEEN INTERVAL {k - 1} HOUR PRECEDING AND CURRENT ROW)', f'volume_{k}h', 4)}" for k in (1, 6, 24))} FROM f""")
def hourly_liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = T.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("contract_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("start")).agg(F.count("*").alias("n"), F.sum("value").alias("volume"))
    return rounded(streams.rolling_liquidity(h), 4)


@query(T.with_tables("bars_user_d", then=f", {_RET} SELECT DISTINCT symbol FROM ret WHERE ts = (SELECT min(ts) FROM ret) INTERSECT SELECT DISTINCT symbol FROM ret WHERE ts = (SELECT max(ts) FROM ret)"))
def common_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols with a bar on the first and on the last day."""
    rr = returns(spark, sf_dir)
    ends = rr.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    on = lambda c: rr.join(F.broadcast(ends), F.col("ts") == F.col(c)).select("symbol")
    return on("a").intersect(on("b"))


@query("SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 3")
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three latest events of each user (a report of the latest predictions or journal entries of a key)."""
    return asof.recent(T.table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], 3)


@query("SELECT event_id, user_id, ts FROM events ORDER BY md5('0:' || event_id), event_id LIMIT 100")
def snapshot_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred events chosen by a seeded hash of their id (a sampling operator)."""
    return asof.sampled(T.table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "event_id", 100)


def _model_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _signal(spark, sf_dir).withColumn("level", F.ln("close"))
    return evaluate.walk_forward(s.where("fwd IS NOT NULL AND signal IS NOT NULL"), "ts", 8, 8, 8, 1)


@query()
def model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ridge and lasso part of the grid, on walk-forward folds of five-day returns."""
    linear = {k: m for k, m in modeling.grid("fwd").items() if "_" in k}
    return modeling.best_model(modeling.model_search(_model_folds(spark, sf_dir), ["signal", "level"], "fwd", linear))


@query()
def ensemble_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signal, its negative and the level as three predictions of five-day returns."""
    folds = _model_folds(spark, sf_dir).withColumns({"p1": F.col("signal"), "p2": -F.col("signal"), "p3": F.col("level")})
    return modeling.ensemble_search(folds, ["p1", "p2", "p3"], "fwd")


@query()
def raw_against_calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.raw_against_calibrated(T.probs(spark, sf_dir))


@query()
def optimised_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.optimised_weights(_model_folds(spark, sf_dir), ["signal", "level"], "fwd")
