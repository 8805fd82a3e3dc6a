"""Queries on point-in-time reads, keys and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import windows as W
from ..functions.windows import Frame
from ..operators import asof, checks
from ..operators import indicators as ind
from ..sources import tables as T
from ._common import r, rounded
from .registry import query

_DAYS = "SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS TIMESTAMP) AS asof_ts"


def days(spark: SparkSession) -> DataFrame:
    return asof.spine("2024-01-02 00:00:00", "2024-01-30 00:00:00", "1 DAY", spark)


@query(T.with_tables("bars_h", then=f"""
, f AS (SELECT symbol, ts, ts + INTERVAL 6 HOUR AS available_time, close, CASE WHEN count(close) OVER w >= 20 THEN avg(close) OVER w END AS sma_20, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS return_1
  FROM bars_h WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
c AS (SELECT DISTINCT symbol, asof_ts FROM bars_h, ({_DAYS})),
k AS (SELECT c.symbol, c.asof_ts, f.ts, f.close, f.sma_20, f.return_1, row_number() OVER (PARTITION BY c.symbol, c.asof_ts ORDER BY f.ts DESC) AS n FROM c LEFT JOIN f ON f.symbol = c.symbol AND f.available_time <= c.asof_ts)
SELECT symbol, asof_ts, ts, {r('close', 'close')}, {r('sma_20', 'sma_20')}, {r('return_1', 'return_1')} FROM k WHERE n = 1"""))
def asof_latest_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, f = T.bars_h(spark, sf_dir), ind.DEFAULT
    facts = b.select("symbol", "ts", (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("available_time"), "close", W.sma(F.col("close"), f, 20).alias("sma_20"), W.returns(F.col("close"), f).alias("return_1"))
    cells = b.select("symbol").distinct().crossJoin(F.broadcast(days(spark)))
    return rounded(asof.latest(cells, facts, "symbol", ["ts"], ["ts", "close", "sma_20", "return_1"]))


@query(T.with_tables("trades", then=f"""
, c AS (SELECT DISTINCT contract_id, asof_ts FROM trades, ({_DAYS})),
k AS (SELECT c.*, t.trade_id, t.price, row_number() OVER (PARTITION BY c.contract_id, c.asof_ts ORDER BY t.price DESC, t.trade_id DESC) AS n FROM c LEFT JOIN trades t ON t.contract_id = c.contract_id AND t.available_time <= c.asof_ts)
SELECT contract_id, asof_ts, trade_id, price FROM k WHERE n = 1"""))
def asof_latest_by_other_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest price known at each time: ordered by another column than the one that limits."""
    t = T.trades(spark, sf_dir)
    cells = t.select("contract_id").distinct().crossJoin(F.broadcast(days(spark)))
    return asof.latest(cells, t, "contract_id", ["price", "trade_id"], ["trade_id", "price"])


_Q = "SELECT CAST(unnest(generate_series(TIMESTAMP '1995-06-01', TIMESTAMP '2001-06-01', INTERVAL 6 MONTH)) AS TIMESTAMP) AS asof_ts"


def halves(spark: SparkSession) -> DataFrame:
    return asof.spine("1995-06-01 00:00:00", "2001-06-01 00:00:00", "6 MONTH", spark)


@query(T.with_tables("filings", then=f"""
, c AS (SELECT DISTINCT entity, asof_ts FROM filings, ({_Q})),
p AS (SELECT c.entity, c.asof_ts, max(period) AS period FROM c JOIN filings f ON f.entity = c.entity AND f.filed <= c.asof_ts GROUP BY ALL)
SELECT p.entity, p.asof_ts, p.period, CAST(count(*) AS BIGINT) AS n, count(DISTINCT metric) AS metrics, {r('sum(value)', 'total', 2)} FROM p JOIN filings f ON f.entity = p.entity AND f.period = p.period AND f.filed <= p.asof_ts GROUP BY ALL"""))
def asof_latest_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = T.filings(spark, sf_dir).withColumn("available_time", F.col("filed").cast("timestamp_ntz"))
    cells = f.select("entity").distinct().crossJoin(F.broadcast(halves(spark)))
    got = asof.latest_group(cells, f, "entity", "period")
    return rounded(got.groupBy("entity", "asof_ts", "period").agg(F.count("*").alias("n"), F.count_distinct("metric").alias("metrics"), F.sum("value").alias("total")), 2)


@query(T.with_tables("filings", then=f"""
, m AS (SELECT metric, period, filed, avg(value) AS value FROM filings GROUP BY ALL),
k AS (SELECT q.asof_ts, m.metric, m.value, row_number() OVER (PARTITION BY q.asof_ts, m.metric ORDER BY period DESC, filed DESC) AS n FROM ({_Q}) q JOIN m ON m.filed <= q.asof_ts)
SELECT asof_ts, metric, {r('value', 'value', 2)} FROM k WHERE n = 1"""))
def asof_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = T.filings(spark, sf_dir).groupBy("metric", "period", "filed").agg(F.avg("value").alias("value")).withColumn("available_time", F.col("filed").cast("timestamp_ntz"))
    got = asof.panel(halves(spark), m, "metric", "period", "value")
    return rounded(got.select("asof_ts", F.explode("panel").alias("metric", "value")), 2)


@query(T.with_tables("trades", then=f"""
, c AS (SELECT DISTINCT contract_id, asof_ts FROM trades, ({_DAYS}))
SELECT c.contract_id, c.asof_ts, count(*) AS n, {r("sum(CASE WHEN side = 'buy' THEN size ELSE 0 END)", 'buy')}, {r("sum(CASE WHEN side = 'sell' THEN size ELSE 0 END)", 'sell')}, {r('avg(price)', 'avg_price')},
  {r("(sum(CASE WHEN side = 'buy' THEN size ELSE 0 END) - sum(CASE WHEN side = 'sell' THEN size ELSE 0 END)) / nullif(sum(CASE WHEN side IN ('buy', 'sell') THEN size ELSE 0 END), 0)", 'imbalance')}
FROM c JOIN trades t ON t.contract_id = c.contract_id AND t.ts BETWEEN c.asof_ts - INTERVAL 24 HOUR AND c.asof_ts AND t.available_time <= c.asof_ts GROUP BY ALL"""))
def look_back_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.trades(spark, sf_dir)
    cells = t.select("contract_id").distinct().crossJoin(F.broadcast(days(spark)))
    got = asof.look_back(cells, t, "contract_id", 24 * 3600)
    side = lambda s: F.sum(F.when(F.col("side") == s, F.col("size")).otherwise(0.0))
    return rounded(got.groupBy("contract_id", "asof_ts").agg(F.count("*").alias("n"), side("buy").alias("buy"), side("sell").alias("sell"), F.avg("price").alias("avg_price"), F.try_divide(side("buy") - side("sell"), side("buy") + side("sell")).alias("imbalance")))


@query(T.with_tables("trades", then=f"""
, c AS (SELECT DISTINCT contract_id, asof_ts FROM trades, ({_DAYS})),
j AS (SELECT c.contract_id, c.asof_ts, t.trade_id, t.price, t.size, t.side FROM c JOIN trades t ON t.contract_id = c.contract_id AND t.ts BETWEEN c.asof_ts - INTERVAL 72 HOUR AND c.asof_ts AND t.available_time <= c.asof_ts),
m AS (SELECT contract_id, asof_ts, count(price) AS n, sum(size) AS volume, stddev_samp(price) AS std, quantile_cont(price, 0.5) AS med, avg(size) AS avg_size, stddev_samp(size) AS std_size FROM j GROUP BY ALL),
d AS (SELECT m.contract_id, m.asof_ts, quantile_cont(abs(price - med), 0.5) AS mad FROM m JOIN j USING (contract_id, asof_ts) GROUP BY ALL)
SELECT m.contract_id, m.asof_ts, n, {r('volume', 'volume')}, {r('std', 'std')}, {r('1.4826 * mad', 'robust_std')}, {r('avg_size', 'avg_size')}, {r('std_size', 'std_size')},
  {r('(SELECT avg(CASE WHEN round(abs(0.6745 * (price - med) / nullif(d.mad, 0)), 9) > 4 THEN 1.0 ELSE 0 END) FROM j WHERE j.contract_id = m.contract_id AND j.asof_ts = m.asof_ts)', 'outlier_share')}
FROM m JOIN d USING (contract_id, asof_ts)"""))
def trade_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.trades(spark, sf_dir)
    cells = t.select("contract_id").distinct().crossJoin(F.broadcast(days(spark)))
    j, k = asof.look_back(cells, t, "contract_id", 72 * 3600), ["contract_id", "asof_ts"]
    m = j.groupBy(*k).agg(F.count("price").alias("n"), F.sum("size").alias("volume"), F.stddev_samp("price").alias("std"), F.percentile("price", F.lit(0.5)).alias("med"), F.avg("size").alias("avg_size"), F.stddev_samp("size").alias("std_size"))
    dev = j.join(m, k).withColumn("dev", F.abs(F.col("price") - F.col("med")))
    d = dev.groupBy(*k).agg(F.percentile("dev", F.lit(0.5)).alias("mad"))
    out = dev.join(d, k).groupBy(*k, "n", "volume", "std", "avg_size", "std_size", "mad").agg(F.avg(F.when(F.round(F.try_divide(0.6745 * F.col("dev"), F.col("mad")), 9) > 4, 1.0).otherwise(0.0)).alias("outlier_share"))
    return rounded(out.select(*k, "n", "volume", "std", (1.4826 * F.col("mad")).alias("robust_std"), "avg_size", "std_size", "outlier_share"))


@query(T.with_tables("filings", then=f"""
, c AS (SELECT DISTINCT entity, asof_ts FROM filings, ({_Q}))
SELECT c.entity, c.asof_ts, min(f.filed) AS next_date, CAST(min(f.filed) - CAST(c.asof_ts AS DATE) AS INTEGER) AS days_until FROM c LEFT JOIN filings f ON f.entity = c.entity AND f.filed > c.asof_ts GROUP BY c.entity, c.asof_ts"""))
def asof_next_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = T.filings(spark, sf_dir)
    cells = f.select("entity").distinct().crossJoin(F.broadcast(halves(spark)))
    return asof.next_after(cells, f, "entity", "filed")


@query(T.with_tables("filings", then=f"""
, k AS (SELECT *, row_number() OVER (PARTITION BY entity, metric, period ORDER BY filed DESC, filing_id DESC) AS n, row_number() OVER (PARTITION BY entity, metric, period ORDER BY filed, filing_id) AS filing_sequence, count(*) OVER (PARTITION BY entity, metric, period) AS filings FROM filings)
SELECT entity, metric, period, filing_id, filed, value, filing_sequence FROM k WHERE n = 1 AND filings > 1"""))
def latest_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = T.filings(spark, sf_dir)
    k = Frame(["entity", "metric", "period"], ["filed", "filing_id"])
    seq = f.withColumn("filing_sequence", F.row_number().over(k.spec).cast("long")).withColumn("filings", F.count("*").over(Window.partitionBy(*k.keys)))
    return seq.where("filing_sequence = filings and filings > 1").drop("filings")


@query("""
WITH old AS (SELECT o_custkey % 500 AS k, max(o_orderkey) AS v, 'old' AS side FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), new AS (SELECT o_custkey % 700 AS k, max(o_orderkey) AS v, 'new' AS side FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT k, v, side, 'upsert' AS how FROM new UNION ALL SELECT k, v, side, 'upsert' FROM old WHERE k NOT IN (SELECT k FROM new)
UNION ALL SELECT k, v, side, 'ignore' FROM old UNION ALL SELECT k, v, side, 'ignore' FROM new WHERE k NOT IN (SELECT k FROM old)""")
def upsert_and_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.table(spark, sf_dir, "orders")
    side = lambda status, mod, name: o.where(F.col("o_orderstatus") == status).groupBy((F.col("o_custkey") % mod).alias("k")).agg(F.max("o_orderkey").alias("v")).withColumn("side", F.lit(name))
    old, new = side("F", 500, "old"), side("O", 700, "new")
    return asof.upsert(old, new, ["k"]).withColumn("how", F.lit("upsert")).unionByName(asof.insert_ignore(old, new, ["k"]).withColumn("how", F.lit("ignore")))


@query("""
SELECT c_mktsegment, c_nationkey, sha256(concat_ws('|', c_mktsegment, c_nationkey)) AS segment_id FROM customer GROUP BY 1, 2""")
def dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of some nations are known before; those of all customers are asked for."""
    c = T.table(spark, sf_dir, "customer")
    natural = ["c_mktsegment", "c_nationkey"]
    known = c.where("c_nationkey < 10").select(*natural).distinct().withColumn("segment_id", F.sha2(F.concat_ws("|", *[F.col(n).cast("string") for n in natural]), 256))
    return asof.dimension(known, c, natural, "segment_id")


@query(T.with_tables("bars_supp_d", then="""
, p AS (SELECT symbol, min(ts) AS start_date, max(ts) AS l FROM bars_supp_d GROUP BY 1)
SELECT symbol, start_date, (SELECT max(ts) FROM bars_supp_d) - l > 30 AS is_delisted, CASE WHEN (SELECT max(ts) FROM bars_supp_d) - l > 30 THEN l END AS end_date FROM p"""))
def delisting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof.delisted(T.bars_supp_d(spark, sf_dir))


@query("""
WITH s AS (SELECT s_suppkey AS symbol, s_acctbal AS qty FROM supplier WHERE s_suppkey % 7 <> 0), b AS (SELECT s_suppkey AS symbol, CASE WHEN s_suppkey % 5 = 0 THEN -s_acctbal WHEN s_suppkey % 3 = 0 THEN s_acctbal + 0.5 ELSE s_acctbal END AS qty FROM supplier WHERE s_suppkey % 11 <> 0),
j AS (SELECT symbol, s.qty AS system_qty, b.qty AS broker_qty FROM s FULL JOIN b USING (symbol))
SELECT symbol, 'MISSING_IN_SYSTEM' AS issue, 'CRITICAL' AS severity, system_qty, broker_qty FROM j WHERE system_qty IS NULL
UNION ALL SELECT symbol, 'MISSING_IN_BROKER', 'CRITICAL', system_qty, broker_qty FROM j WHERE broker_qty IS NULL
UNION ALL SELECT symbol, 'QTY_MISMATCH', CASE WHEN abs(system_qty - broker_qty) > 1 THEN 'CRITICAL' ELSE 'WARNING' END, system_qty, broker_qty FROM j WHERE abs(system_qty - broker_qty) > 1e-6
UNION ALL SELECT symbol, 'SIDE_MISMATCH', 'CRITICAL', system_qty, broker_qty FROM j WHERE sign(system_qty) * sign(broker_qty) < 0""")
def position_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = T.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("symbol"), F.col("s_acctbal").alias("qty"))
    b = s.where("symbol % 11 <> 0").withColumn("qty", F.when(F.col("symbol") % 5 == 0, -F.col("qty")).when(F.col("symbol") % 3 == 0, F.col("qty") + 0.5).otherwise(F.col("qty")))
    return asof.reconcile(s.where("symbol % 7 <> 0"), b)


@query("""
WITH RECURSIVE e AS (SELECT p_partkey AS old, p_partkey + 100 AS new, 1 + p_size / 100.0 AS f FROM part WHERE p_partkey % 3 <> 0),
c AS (SELECT old AS ticker, new AS current, 1 AS steps, f AS factor FROM e UNION ALL SELECT c.ticker, e.new, c.steps + 1, c.factor * e.f FROM c JOIN e ON e.old = c.current)
SELECT ticker, arg_max(current, steps) AS current, max(steps) AS steps, round(arg_max(factor, steps) + 3.3e-9, 6) + 0.0 AS factor FROM c GROUP BY ticker""")
def rename_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("old"), (F.col("p_partkey") + 100).alias("new"), (1 + F.col("p_size") / 100.0).cast("double").alias("factor"))
    return rounded(asof.resolve_renames(p))


@query(T.with_tables("bars_user_d", then=f"""
, a AS (SELECT symbol, ts AS d, CAST(ts AS TIMESTAMP) + INTERVAL 16 HOUR AS available_time, close FROM bars_user_d),
x AS (SELECT user_id AS symbol, CAST(ts AS DATE) AS d, ts AS available_time, CASE WHEN event_type = 'signup' THEN 'split' ELSE 'dividend' END AS kind, value AS amount FROM events WHERE event_type IN ('signup', 'purchase'))
SELECT a.symbol, a.d, a.available_time, a.close, {r("max(CASE WHEN kind = 'split' THEN amount END)", 'split')}, {r("sum(CASE WHEN kind = 'dividend' THEN amount END)", 'dividend')} FROM a LEFT JOIN x ON x.symbol = a.symbol AND x.d = a.d AND x.available_time <= a.available_time GROUP BY ALL"""))
def lateral_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir).select("symbol", F.col("ts").alias("d"), (F.col("ts").cast("timestamp_ntz") + F.expr("INTERVAL 16 HOURS")).alias("available_time"), "close")
    e = T.table(spark, sf_dir, "events").where("event_type in ('signup', 'purchase')").select(F.col("user_id").alias("symbol"), F.to_date("ts").alias("d"), F.col("ts").alias("available_time"), F.when(F.col("event_type") == "signup", "split").otherwise("dividend").alias("kind"), F.col("value").alias("amount"))
    return rounded(asof.lateral_actions(b, e, ["symbol", "d"]))


@query(f"""
SELECT event_type, count(*) AS n, {r("avg(date_diff('second', CAST(ts AS DATE) + INTERVAL 8 HOUR, date_trunc('second', ts)) / 60)", 'mean_min')}, {r("stddev_samp(date_diff('second', CAST(ts AS DATE) + INTERVAL 8 HOUR, date_trunc('second', ts)) / 60)", 'std_min')},
  {r("quantile_cont(date_diff('second', CAST(ts AS DATE) + INTERVAL 8 HOUR, date_trunc('second', ts)) / 60, 0.5)", 'p50')}, {r("quantile_cont(date_diff('second', CAST(ts AS DATE) + INTERVAL 8 HOUR, date_trunc('second', ts)) / 60, 0.9)", 'p90')}, {r("quantile_cont(date_diff('second', CAST(ts AS DATE) + INTERVAL 8 HOUR, date_trunc('second', ts)) / 60, 0.95)", 'p95')}
FROM events WHERE date_trunc('second', ts) >= CAST(ts AS DATE) + INTERVAL 8 HOUR GROUP BY event_type""")
def latency_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.table(spark, sf_dir, "events").withColumn("event", F.to_date("ts").cast("timestamp_ntz") + F.expr("INTERVAL 8 HOURS"))
    return rounded(checks.latency_stats(e, ["event_type"], "event", "ts"))


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT 'duplicate_keys' AS check_name, 'lineitem' AS table_name, CASE WHEN count(*) > 0 THEN 'warning' ELSE 'ok' END AS severity, concat(count(*), ' keys, ', coalesce(sum(n), 0), ' rows') AS message FROM d
UNION ALL SELECT 'orphans', 'lineitem', CASE WHEN count(*) > 0 THEN 'error' ELSE 'ok' END, concat(count(*), ' keys') FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'time_order', 'filings', CASE WHEN count(*) FILTER (WHERE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 5 AS INTEGER) < CAST(o_orderdate AS DATE)) > 0 THEN 'critical' ELSE 'ok' END, concat(count(*) FILTER (WHERE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 5 AS INTEGER) < CAST(o_orderdate AS DATE)), ' of ', count(*)) FROM orders
UNION ALL SELECT 'coverage', 'events', CASE WHEN count(*) FILTER (WHERE value > 1) > 0 THEN 'warning' ELSE 'ok' END, concat(count(*) FILTER (WHERE value < 0), ' negative, ', count(*) FILTER (WHERE NOT value BETWEEN 0 AND 1), ' outside') FROM events""")
def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four checks over whole tables; parts stand for keys of orders, so that some may be orphans."""
    li, o, e = (T.table(spark, sf_dir, n) for n in ("lineitem", "orders", "events"))
    text = lambda *c: F.concat(*[x.cast("string") if not isinstance(x, str) else F.lit(x) for x in c])
    level = lambda bad, name: F.when(bad > 0, name).otherwise("ok")
    dup = checks.duplicate_keys(li, ["l_orderkey", "l_linenumber"]).agg(F.count("*").alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    orphan = checks.orphans(li.select(F.col("l_partkey").alias("k")), o.select(F.col("o_orderkey").alias("k")), "k").agg(F.count("*").alias("k"))
    late = checks.time_order(o.select(F.to_date("o_orderdate").alias("event_time"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 60 - 5).cast("int")).alias("available_time")))
    cover = checks.coverage_sanity(e, "value", "value")
    return checks.suite([
        dup.select(*checks.alert("duplicate_keys", "lineitem", level(F.col("k"), "warning"), text(F.col("k"), " keys, ", F.col("n"), " rows"))),
        orphan.select(*checks.alert("orphans", "lineitem", level(F.col("k"), "error"), text(F.col("k"), " keys"))),
        late.select(*checks.alert("time_order", "filings", level(F.col("violations"), "critical"), text(F.col("violations"), " of ", F.col("rows")))),
        cover.select(*checks.alert("coverage", "events", level(F.col("outside_unit"), "warning"), text(F.col("negative_price"), " negative, ", F.col("outside_unit"), " outside"))),
    ])


@query(f"""
WITH m AS (SELECT event_type, quantile_cont(value, 0.5) AS med FROM events GROUP BY 1 HAVING count(*) >= 20), d AS (SELECT event_id, event_type, value, med, abs(value - med) AS dev FROM events JOIN m USING (event_type)), a AS (SELECT event_type, quantile_cont(dev, 0.5) AS mad FROM d GROUP BY 1)
SELECT event_type, event_id, value, {r('med', 'med')}, {r('mad', 'mad')}, {r('0.6745 * dev / mad', 'score')} FROM d JOIN a USING (event_type) WHERE mad > 0 AND 0.6745 * dev / mad > 4 ORDER BY score DESC, event_id LIMIT 10""")
def mad_anomalies_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = T.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return rounded(checks.mad_anomalies(e, ["event_type"], "value")).orderBy(F.desc("score"), "event_id").limit(10)


@query(T.with_tables("bars_user_d", then=f"""
SELECT symbol, count(*) AS rows, count(*) FILTER (WHERE high < low OR high < open OR high < close OR low > open OR low > close) AS logic_violations, count(*) FILTER (WHERE open < 0 OR high < 0 OR low < 0 OR close < 0) AS negative_prices, count(*) FILTER (WHERE volume < 0) AS negative_volume, {r('avg(volume)', 'avg_volume')}, {r('max(high) - min(low)', 'price_range')} FROM bars_user_d GROUP BY symbol"""))
def ohlc_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(checks.ohlc_report(T.bars_user_d(spark, sf_dir), ["symbol"]))


@query(f"""
WITH c AS (SELECT avg(CASE WHEN text IS NULL THEN 0.0 ELSE 1 END) AS text, avg(CASE WHEN lang = 'en' THEN NULL ELSE 1.0 END) AS lang0, avg(CASE WHEN nullif(lang, 'en') IS NULL THEN 0.0 ELSE 1 END) AS lang, avg(CASE WHEN n_chars > 100 THEN 1.0 ELSE 0 END) AS n_chars FROM documents)
SELECT 'text' AS column_name, {r('text', 'completeness')}, text < 0.95 AS flagged FROM c UNION ALL SELECT 'lang', {r('lang', 'completeness')}, lang < 0.95 FROM c UNION ALL SELECT 'n_chars', {r('n_chars', 'completeness')}, n_chars < 0.95 FROM c""")
def completeness_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.table(spark, sf_dir, "documents").select("text", F.nullif("lang", F.lit("en")).alias("lang"), F.when(F.col("n_chars") > 100, F.col("n_chars")).alias("n_chars"))
    return rounded(checks.completeness(d, ["text", "lang", "n_chars"]))


@query(f"""
SELECT user_id, {r("date_diff('second', max(date_trunc('second', ts)), TIMESTAMP '2024-02-01') / 3600", 'age_hours')}, CASE WHEN date_diff('second', max(date_trunc('second', ts)), TIMESTAMP '2024-02-01') / 3600 > 96 THEN 'critical' WHEN date_diff('second', max(date_trunc('second', ts)), TIMESTAMP '2024-02-01') / 3600 > 48 THEN 'warning' ELSE 'ok' END AS severity FROM events GROUP BY user_id""")
def staleness_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(checks.staleness(T.table(spark, sf_dir, "events"), "ts", "2024-02-01 00:00:00", 48, ["user_id"]))


@query(T.with_tables("trades", then="""
, s AS (SELECT DISTINCT contract_id, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS asof_ts FROM trades)
SELECT contract_id, asof_ts FROM s WHERE EXISTS (SELECT 1 FROM trades t WHERE t.contract_id = s.contract_id AND t.ts <= s.asof_ts AND t.available_time > s.asof_ts)"""))
def look_ahead_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.trades(spark, sf_dir)
    snaps = t.select("contract_id", F.date_add(F.to_date("ts"), 1).cast("timestamp_ntz").alias("asof_ts")).distinct()
    return checks.look_ahead(snaps, t, "contract_id")


@query(f"""
SELECT event_type, count(*) AS n, {r('avg(CASE WHEN value > 100 THEN 1.0 ELSE 0 END)', 'count_share')}, {r('sum(CASE WHEN value > 100 THEN value ELSE 0 END) / sum(value)', 'volume_share')} FROM events GROUP BY event_type""")
def coverage_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(checks.coverage_metrics(T.table(spark, sf_dir, "events"), F.col("value") > 100, F.col("value"), ["event_type"]))


@query("""
SELECT 'orders' AS table_name, count(*) AS rows, strftime(min(o_orderdate), '%Y-%m-%d') AS first, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders
UNION ALL SELECT 'lineitem', count(*), strftime(min(l_shipdate), '%Y-%m-%d'), strftime(max(l_shipdate), '%Y-%m-%d') FROM lineitem""")
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    li = T.table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate"))
    return checks.suite([checks.table_stats(o, "orders", "d"), checks.table_stats(li, "lineitem", "d")])


@query()
def table_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.content_hash(T.table(spark, sf_dir, "orders"), ["o_orderstatus"])


@query(T.with_tables("filings", then=f"""
, q AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 3 MONTH)) AS DATE) AS as_of), k AS (SELECT as_of, filings.*, row_number() OVER (PARTITION BY as_of, entity, metric ORDER BY filed DESC, filing_id DESC) AS n FROM filings JOIN q ON filed <= as_of)
SELECT as_of, entity, metric, filing_id, filed, period, {r('value', 'value')} FROM k WHERE n = 1"""))
def filings_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filing of each entity and metric in force at each quarter's first day."""
    dates = spark.sql("SELECT explode(sequence(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 3 MONTH)) AS as_of")
    got = asof.point_in_time(T.filings(spark, sf_dir), dates, ["entity", "metric"], "filed", ["filing_id"])
    return rounded(got.select("as_of", "entity", "metric", "filing_id", "filed", "period", "value"))


@query("""
SELECT event_type AS table_name, count(*) FILTER (event_id % 5 > 0 AND event_id % 3 = 0) AS critical_alerts, count(*) FILTER (event_id % 5 > 0 AND event_id % 3 = 1) AS error_alerts, count(*) FILTER (event_id % 5 > 0 AND event_id % 3 = 2) AS warning_alerts, max(ts) FILTER (event_id % 5 > 0) AS latest_alert_at
FROM events GROUP BY 1""")
def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stand for alerts on their type's table; every fifth is resolved."""
    k = F.col("event_id")
    rows = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("table_name"), F.element_at(F.array(*map(F.lit, ("critical", "error", "warning"))), (k % 3 + 1).cast("int")).alias("severity"), F.col("ts").alias("created_at"), F.when(k % 5 == 0, F.col("ts")).alias("resolved_at"))
    return checks.alert_summary(rows)


@query(f"""
WITH s AS (SELECT user_id AS table_name, CAST(ts AS DATE) AS checked_at, event_id, value AS staleness_hours, 10.0 AS threshold_hours FROM events)
SELECT table_name, event_id, checked_at, {r('staleness_hours', 'staleness_hours')}, CASE WHEN staleness_hours > 20 THEN 'CRITICAL' WHEN staleness_hours > 10 THEN 'WARNING' ELSE 'OK' END AS status FROM s WHERE checked_at = (SELECT max(t.checked_at) FROM s t WHERE t.table_name = s.table_name)""")
def staleness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stand for staleness checks of their user's table; those of the table's last day are its current ones."""
    rows = T.table(spark, sf_dir, "events").select(F.col("user_id").alias("table_name"), F.to_date("ts").alias("checked_at"), "event_id", F.col("value").alias("staleness_hours"), F.lit(10.0).alias("threshold_hours"))
    return rounded(checks.staleness_summary(rows).drop("threshold_hours"))


@query("""
WITH l AS (SELECT event_type AS source, max(ts) AS last_updated FROM events WHERE event_type <> 'error' GROUP BY 1), s AS (SELECT DISTINCT event_type AS source, length(event_type) * 3600 AS sla_seconds FROM events),
j AS (SELECT source, sla_seconds, CAST(floor(epoch(TIMESTAMP '2024-01-31 05:00:00')) - floor(epoch(last_updated)) AS BIGINT) AS age_s FROM s LEFT JOIN l USING (source))
SELECT source, CAST(sla_seconds AS BIGINT) AS sla_seconds, age_s FROM j WHERE age_s IS NULL OR age_s > sla_seconds""")
def late_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types stand for sources, an hour of grace for each letter of their name; one has no rows."""
    e = T.table(spark, sf_dir, "events")
    last = e.where("event_type <> 'error'").groupBy(F.col("event_type").alias("source")).agg(F.max("ts").alias("last_updated"))
    slas = e.select(F.col("event_type").alias("source")).distinct().withColumn("sla_seconds", F.length("source") * F.lit(3600).cast("long"))
    return checks.freshness(last, slas, "2024-01-31 05:00:00").select("source", "sla_seconds", "age_s")
