"""Queries on vendor payloads: each order's line items are written as one document in a vendor's layout (JSON or XML, at most
a few entries each), which the flatteners of sources.ingest read back. SQL takes the same rows from the line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import checks, curated
from ..sources import ingest
from ..sources import tables as T
from ._common import r, rounded
from .registry import query

_SHIP = "CAST(l_shipdate AS DATE)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "lineitem").withColumn("day", F.date_format("l_shipdate", "yyyy-MM-dd"))


def _documents(lines: DataFrame, entry: Column) -> DataFrame:
    """ticker (the order), entries: what the order's lines hold, by line number."""
    got = lines.groupBy(F.col("l_orderkey").alias("ticker")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", entry.alias("e")))).alias("x"))
    return got.select("ticker", F.col("x.e").alias("entries"))


def _every(n: int, value: Column, other: Column | None = None) -> Column:
    """value where the part number is a multiple of n, else other."""
    return F.when(F.col("l_partkey") % n == 0, value).otherwise(other)


@query(f"SELECT l_orderkey AS series_code, {_SHIP} AS date, CASE WHEN l_partkey % 4 > 0 THEN l_extendedprice END AS value, {_SHIP} + 10 AS realtime_start, CASE WHEN l_partkey % 3 > 0 THEN {_SHIP} + 40 END AS realtime_end FROM lineitem")
def flattened_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with text values, some of them a full stop, and vintages without an end."""
    later = lambda n: F.date_add("l_shipdate", n).cast("string")
    entry = F.struct(F.col("day").alias("date"), _every(4, F.lit("."), F.col("l_extendedprice").cast("string")).alias("value"), later(10).alias("realtime_start"), _every(3, F.lit(None), later(40)).alias("realtime_end"))
    docs = _documents(_lines(spark, sf_dir), entry)
    return ingest.observations_from_json(docs.withColumn("payload", F.to_json(F.struct(F.col("entries").alias("observations")))), "ticker")


@query("SELECT l_orderkey AS filer, 'Part ' || l_partkey AS issuer, lpad(CAST(l_suppkey AS VARCHAR), 9, 'X') AS cusip, CASE WHEN l_partkey % 17 > 0 THEN CAST(floor(l_extendedprice) AS BIGINT) * 1000 END AS market_value, CAST(l_quantity AS BIGINT) AS shares FROM lineitem")
def flattened_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Information tables; every other order has a namespace prefix, some values are no number."""
    tag = lambda name, inner: F.concat(F.lit("<"), F.col("p"), F.lit(f"{name}>"), inner, F.lit("</"), F.col("p"), F.lit(f"{name}>"))
    lines = _lines(spark, sf_dir).withColumn("p", F.when(F.col("l_orderkey") % 2 == 0, "n1:").otherwise(""))
    value = _every(17, F.lit("n/a"), F.floor("l_extendedprice").cast("string"))
    entry = tag("infoTable", F.concat(tag("nameOfIssuer", F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))), tag("cusip", F.lpad(F.col("l_suppkey").cast("string"), 9, "X")), tag("value", value), tag("shrsOrPrnAmt", tag("sshPrnamt", F.col("l_quantity").cast("bigint").cast("string")))))
    docs = _documents(lines, entry).withColumn("p", F.when(F.col("ticker") % 2 == 0, "n1:").otherwise(""))
    return ingest.holdings_from_xml(docs.withColumn("payload", tag("informationTable", F.array_join("entries", ""))), "ticker")


@query(f"SELECT l_orderkey AS ticker, {_SHIP} AS transaction_date, ['purchase', 'sale', 'grant', 'X'][l_linenumber % 4 + 1] AS transaction_type, l_quantity AS shares, CASE WHEN l_partkey % 7 > 0 THEN l_extendedprice END AS price FROM lineitem WHERE l_partkey % 13 > 0 AND l_partkey % 11 > 0")
def flattened_insiders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ownership forms; transactions without a date or a number of shares are dropped, codes without a name stay codes."""
    tag = lambda name, inner: F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))
    held = lambda name, value: tag(name, tag("value", value))
    code = F.element_at(F.array(*map(F.lit, "PSAX")), F.col("l_linenumber") % 4 + 1)
    price = _every(7, F.lit(""), held("transactionPricePerShare", F.col("l_extendedprice").cast("string")))
    shares = held("transactionShares", _every(11, F.lit("none"), F.col("l_quantity").cast("string")))
    entry = tag("nonDerivativeTransaction", F.concat(held("transactionDate", _every(13, F.lit("unknown"), F.col("day"))), tag("transactionCoding", tag("transactionCode", code)), tag("transactionAmounts", F.concat(shares, price))))
    docs = _documents(_lines(spark, sf_dir), entry)
    return ingest.insider_from_xml(docs.withColumn("payload", tag("ownershipDocument", tag("nonDerivativeTable", F.array_join("entries", "")))))


@query(f"SELECT l_orderkey AS ticker, min({_SHIP}) OVER o AS quote_date, max({_SHIP}) OVER o AS expiration, CASE WHEN l_linenumber % 2 = 1 THEN 'call' ELSE 'put' END AS option_type, l_extendedprice AS strike, CASE WHEN l_partkey % 5 > 0 THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS volume, CASE WHEN l_partkey % 3 > 0 THEN 2 * CAST(l_quantity AS INTEGER) ELSE 0 END AS open_interest, l_discount AS implied_volatility FROM lineitem WINDOW o AS (PARTITION BY l_orderkey)")
def flattened_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of one expiration with calls and puts; missing volumes and open interest are 0."""
    n = F.col("l_quantity").cast("int")
    leg = F.struct(F.col("l_extendedprice").alias("strike"), _every(5, F.lit(None), n).alias("volume"), _every(3, F.lit(None), n * 2).alias("openInterest"), F.col("l_discount").alias("impliedVolatility"))
    side = lambda k: F.collect_list(F.when(F.col("l_linenumber") % 2 == k, leg))
    docs = _lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("ticker")).agg(F.to_date(F.min("l_shipdate")).alias("quote_date"), F.unix_timestamp(F.max("day"), "yyyy-MM-dd").alias("at"), side(1).alias("calls"), side(0).alias("puts"))
    payload = F.to_json(F.array(F.struct(F.col("at").alias("expirationDate"), "calls", "puts")))
    return ingest.options_from_json(docs.withColumn("payload", payload))


@query(f"""SELECT l_orderkey AS ticker, 'metric ' || l_linenumber % 3 AS metric_name, 'USD' AS units, {_SHIP} AS fiscal_period_end, l_extendedprice AS metric_value, 'a' || l_linenumber AS accession_number,
['10-Q', '10-K', '10-K/A', '8-K'][l_partkey % 4 + 1] AS form_type, {_SHIP} + 30 AS filing_date, l_partkey % 4 = 2 AS is_amendment FROM lineitem WHERE l_partkey % 4 < 3 AND l_partkey % 9 > 0""")
def flattened_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company facts by metric and unit; other forms and entries without a filing date are dropped, amendments are marked."""
    form = F.element_at(F.array(*map(F.lit, ("10-Q", "10-K", "10-K/A", "8-K"))), (F.col("l_partkey") % 4 + 1).cast("int"))
    entry = F.struct(F.col("day").alias("end"), F.col("l_extendedprice").alias("val"), F.concat(F.lit("a"), "l_linenumber").alias("accn"), form.alias("form"), _every(9, F.lit(None), F.date_add("l_shipdate", 30).cast("string")).alias("filed"))
    docs = _documents(_lines(spark, sf_dir), F.struct(F.concat(F.lit("metric "), F.col("l_linenumber") % 3).alias("metric"), entry.alias("fact")))
    facts = lambda m: F.transform(F.filter("entries", lambda e: e["metric"] == m), lambda e: e["fact"])
    by_metric = F.transform(F.array_distinct("entries.metric"), lambda m: F.struct(m, F.struct(F.create_map(F.lit("USD"), facts(m)).alias("units"))))
    return ingest.fundamentals_from_json(docs.withColumn("payload", F.to_json(F.map_from_entries(by_metric))))


_QUARTER = "quarter(o_orderdate) || 'Q' || year(o_orderdate)"


@query(f"""SELECT o_orderkey AS ticker, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE {_QUARTER} END AS report_date, CASE WHEN o_orderkey % 35 > 0 THEN {_QUARTER} END AS fiscal_quarter_end, o_totalprice AS eps_estimate, CASE WHEN o_orderkey % 4 > 0 THEN o_totalprice + 1 END AS eps_actual,
1.0 AS eps_surprise, 0.5 * 100 AS eps_surprise_pct, CASE WHEN o_custkey % 3 > 0 AND o_orderkey % 35 > 0 THEN o_totalprice * 2 END AS revenue_actual FROM orders WHERE o_orderkey % 35 > 0""")
def flattened_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earnings histories; the date falls back to the period, entries without either are dropped, revenue comes from the quarter
    of that name."""
    o = T.table(spark, sf_dir, "orders")
    key, period = F.col("o_orderkey"), F.concat(F.quarter("o_orderdate"), F.lit("Q"), F.year("o_orderdate"))
    raw = lambda v: F.struct(v.cast("double").alias("raw"))
    entry = F.struct(F.when(key % 5 > 0, F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("fmt"))).alias("quarter"), F.when(key % 35 > 0, F.struct(period.alias("fmt"))).alias("period"), raw(F.col("o_totalprice")).alias("epsEstimate"), F.when(key % 4 > 0, raw(F.col("o_totalprice") + 1)).alias("epsActual"), raw(F.lit(1)).alias("epsDifference"), raw(F.lit(0.5)).alias("surprisePercent"))
    named = lambda name, value: F.struct(name.alias("date"), raw(value).alias("revenue"))
    quarters = F.array(named(F.lit("0Q1900"), F.lit(7.0)), named(F.when(F.col("o_custkey") % 3 > 0, period).otherwise("other"), F.col("o_totalprice") * 2))
    payload = F.to_json(F.struct(F.struct(F.array(entry).alias("history")).alias("earningsHistory"), F.struct(F.struct(quarters.alias("quarterly")).alias("financialsChart")).alias("earnings")))
    return ingest.earnings_from_json(o.select(key.alias("ticker"), payload.alias("payload")))


@query(f"""
WITH l AS (SELECT *, {_SHIP} AS d FROM lineitem), s AS (SELECT DISTINCT l_orderkey, d FROM l WHERE l_linenumber = 1 AND l_partkey % 2 = 0), v AS (SELECT DISTINCT l_orderkey, d FROM l WHERE l_linenumber = 2)
SELECT l.l_orderkey AS ticker, l.d AS date, l_extendedprice AS open, l_extendedprice + 1 AS high, l_extendedprice - 1 AS low, l_extendedprice AS close, CASE WHEN l_partkey % 3 > 0 THEN l_extendedprice / 2 ELSE l_extendedprice END AS adj_close, CAST(l_quantity AS BIGINT) AS volume,
  CASE WHEN s.d IS NOT NULL THEN '2:1' END AS split_ratio, CASE WHEN v.d IS NOT NULL THEN 0.25 ELSE 0.0 END::DOUBLE AS dividend
FROM l LEFT JOIN s ON s.l_orderkey = l.l_orderkey AND s.d = l.d LEFT JOIN v ON v.l_orderkey = l.l_orderkey AND v.d = l.d WHERE l_partkey % 19 > 0""")
def flattened_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart payloads: parallel arrays with gaps, and maps of splits and dividends whose events go to all bars of their date."""
    price = _every(19, F.lit(None), F.col("l_extendedprice"))
    entry = F.struct(F.unix_timestamp("day", "yyyy-MM-dd").alias("t"), F.col("l_extendedprice").alias("o"), (F.col("l_extendedprice") + 1).alias("h"), (F.col("l_extendedprice") - 1).alias("l"), price.alias("c"), F.col("l_quantity").cast("bigint").alias("v"), _every(3, F.lit(None), F.col("l_extendedprice") / 2).alias("a"), F.col("l_linenumber").alias("n"), (F.col("l_partkey") % 2 == 0).alias("even"))
    docs = _documents(_lines(spark, sf_dir), entry)
    events = lambda keep, value: F.map_from_entries(F.transform(F.array_distinct(F.transform(F.filter("entries", keep), lambda e: e["t"])), lambda t: F.struct(t.cast("string"), value)))
    splits = events(lambda e: (e["n"] == 1) & e["even"], F.struct(F.lit("2:1").alias("splitRatio")))
    dividends = events(lambda e: e["n"] == 2, F.struct(F.lit(0.25).alias("amount")))
    at = lambda name, field: F.col(f"entries.{field}").alias(name)
    quote = F.array(F.struct(at("open", "o"), at("high", "h"), at("low", "l"), at("close", "c"), at("volume", "v")))
    indicators = F.struct(quote.alias("quote"), F.array(F.struct(at("adjclose", "a"))).alias("adjclose"))
    result = F.struct(at("timestamp", "t"), indicators.alias("indicators"), F.struct(splits.alias("splits"), dividends.alias("dividends")).alias("events"))
    return ingest.bars_with_events(docs.withColumn("payload", F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")))))


@query("""SELECT c_custkey AS ticker, CASE WHEN c_custkey % 4 > 0 THEN DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) ELSE DATE '2024-06-30' END AS settlement_date, CAST(trunc(c_acctbal) AS BIGINT) AS short_interest, CASE WHEN c_custkey % 5 > 0 THEN c_custkey * 10 ELSE 77 END AS avg_daily_volume,
c_acctbal / 8 AS days_to_cover, CAST(NULL AS DOUBLE) AS short_pct_float, c_custkey * 100 AS float_shares FROM customer WHERE c_custkey % 6 > 0""")
def flattened_short_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key statistics of customers; the date falls back to today, a volume of 0 to the longer average; rows without short
    interest are dropped."""
    return ingest.short_interest_from_json(_summaries(spark, sf_dir), F.lit("2024-06-30").cast("date"))


@query("SELECT c_custkey AS ticker, CASE WHEN c_custkey % 4 > 0 THEN c_acctbal ELSE c_acctbal * 2 END AS total_assets, CASE WHEN c_custkey % 3 > 0 THEN 5.0 ELSE 6.5 END AS nav FROM customer WHERE c_custkey % 28 > 0")
def flattened_fund_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets from the summary, else the key statistics; the value falls back to the previous close; no assets, no row."""
    return ingest.fund_profile_from_json(_summaries(spark, sf_dir))


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, b = F.col("c_custkey"), F.col("c_acctbal")
    raw = lambda v, keep: F.when(keep, F.struct(v.cast("double").alias("raw")))
    yes = F.lit(True)
    day = F.unix_timestamp(F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")).cast("string"), "yyyy-MM-dd")
    stats = F.struct(raw(b, k % 6 > 0).alias("sharesShort"), raw(day, k % 4 > 0).alias("dateShortInterest"), raw(F.when(k % 5 > 0, k * 10).otherwise(0), yes).alias("averageDailyVolume10Day"), raw(F.lit(77), yes).alias("averageVolume"), raw(k * 100, yes).alias("floatShares"), raw(b / 8, yes).alias("shortRatio"), raw(b * 2, k % 7 > 0).alias("totalAssets"))
    detail = F.struct(raw(b, k % 4 > 0).alias("totalAssets"), raw(F.lit(5.0), k % 3 > 0).alias("navPrice"), raw(F.lit(6.5), yes).alias("previousClose"))
    return T.table(spark, sf_dir, "customer").select(k.alias("ticker"), F.to_json(F.struct(stats.alias("defaultKeyStatistics"), detail.alias("summaryDetail"))).alias("payload"))


@query("SELECT event_id, CASE WHEN event_id % 9 > 0 THEN CAST(ts AS DATE) END AS event_date, CASE WHEN event_id % 4 = 0 THEN date_trunc('hour', ts) WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) END AS date_added, event_type, CASE WHEN event_id % 5 > 0 THEN value END AS tone, value / 2 AS lat, CAST(NULL AS DOUBLE) AS lon FROM events")
def flattened_world_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text fields: bad dates, stamps cut after the hour, tones that are no number, no longitude."""
    e = T.table(spark, sf_dir, "events")
    k, ts = F.col("event_id"), F.col("ts")
    raw = e.select(k, F.when(k % 9 > 0, F.date_format(ts, "yyyyMMdd")).otherwise("unknown").alias("sql_date"), F.when(k % 4 == 0, F.date_format(ts, "yyyyMMddHH")).when(k % 7 == 0, "soon").otherwise(F.date_format(ts, "yyyyMMddHHmmss")).alias("date_added"), "event_type", F.when(k % 5 > 0, F.col("value").cast("string")).otherwise("-").alias("tone"), (F.col("value") / 2).cast("string").alias("lat"))
    return ingest.world_events(raw).withColumn("date_added", F.col("date_added").cast("timestamp_ntz"))


@query("SELECT user_id AS market_id, date_trunc('second', ts) AS ts, value AS price, CASE WHEN event_id % 6 > 0 THEN value * 2 END AS size FROM events WHERE event_id % 11 > 0 AND date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'")
def market_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades with text fields from one time to another; a price that is no number drops the trade."""
    e = T.table(spark, sf_dir, "events")
    k = F.col("event_id")
    raw = e.select(F.col("user_id").alias("market_id"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string").alias("timestamp"), F.when(k % 11 > 0, F.col("value").cast("string")).otherwise("?").alias("price"), F.when(k % 6 > 0, (F.col("value") * 2).cast("string")).alias("size"))
    return ingest.price_history(raw, "2024-01-05", "2024-01-20").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 25")
def top_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 suppliers of largest balance (a top-k selection)."""
    return ingest.top_markets(T.table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal", "s_suppkey", 25)


@query("""
WITH o AS (SELECT CASE WHEN o_orderkey % 10 > 0 THEN o_custkey END AS ticker, CASE WHEN o_orderkey % 15 > 0 THEN o_orderdate END AS date FROM orders)
SELECT 'missing_fields' AS error_type, 'Missing required fields: ' || CASE WHEN ticker IS NULL AND date IS NULL THEN 'ticker, date' WHEN ticker IS NULL THEN 'ticker' ELSE 'date' END AS error_message, count(*) AS n, count(ticker) AS with_ticker FROM o WHERE ticker IS NULL OR date IS NULL GROUP BY ALL
UNION ALL SELECT 'kept', 'kept', count(*), count(ticker) FROM o WHERE ticker IS NOT NULL AND date IS NOT NULL""")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept and quarantined by missing field; records are whole rows."""
    k = F.col("o_orderkey")
    o = T.table(spark, sf_dir, "orders").select(F.when(k % 10 > 0, F.col("o_custkey")).alias("ticker"), F.when(k % 15 > 0, F.col("o_orderdate")).alias("date"))
    good, bad = ingest.split_required(o, ["ticker", "date"])
    rejected = bad.groupBy("error_type", "error_message").agg(F.count("*").alias("n"), F.count(F.get_json_object("record", "$.ticker")).alias("with_ticker"))
    return rejected.unionByName(good.agg(F.lit("kept").alias("error_type"), F.lit("kept").alias("error_message"), F.count("*").alias("n"), F.count("ticker").alias("with_ticker")))


@query(f"""
WITH l AS (SELECT l_orderkey AS book, l_linenumber % 2 = 0 AS bid, l_extendedprice AS p, l_quantity AS q, row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 2 ORDER BY CASE WHEN l_linenumber % 2 = 0 THEN -l_extendedprice ELSE l_extendedprice END, l_quantity) AS n FROM lineitem),
g AS (SELECT book, max(p) FILTER (bid) AS best_bid, min(p) FILTER (NOT bid) AS best_ask, coalesce(sum(q) FILTER (bid), 0) AS bid_depth, coalesce(sum(q) FILTER (NOT bid), 0) AS ask_depth, coalesce(sum(q) FILTER (bid AND n <= 3), 0) AS b3, coalesce(sum(q) FILTER (NOT bid AND n <= 3), 0) AS a3, coalesce(sum(q) FILTER (bid AND n <= 5), 0) AS b5, coalesce(sum(q) FILTER (NOT bid AND n <= 5), 0) AS a5 FROM l GROUP BY 1)
SELECT book, {r('best_bid', 'best_bid')}, {r('best_ask', 'best_ask')}, {r('best_ask - best_bid', 'spread')}, {r('(best_bid + best_ask) / 2', 'mid')}, {r('bid_depth', 'bid_depth')}, {r('ask_depth', 'ask_depth')}, {r('(b3 - a3) / nullif(b3 + a3, 0)', 'imbalance_3')}, {r('b5 / nullif(a5, 0)', 'depth_ratio_5')} FROM g""")
def order_book_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items stand for price levels of their order's book: even lines bid, odd ones ask."""
    li = T.table(spark, sf_dir, "lineitem")
    level = lambda k, sign: F.array_sort(F.collect_list(F.when(F.col("l_linenumber") % 2 == k, F.struct((F.col("l_extendedprice") * sign).alias("o"), F.col("l_quantity").alias("q")))))
    books = li.groupBy(F.col("l_orderkey").alias("book")).agg(level(0, -1.0).alias("bids"), level(1, 1.0).alias("asks"))
    pairs = lambda c, sign: F.transform(c, lambda x: F.array(x["o"] * sign, x["q"]))
    books = books.select("book", pairs("bids", -1.0).alias("bids"), pairs("asks", 1.0).alias("asks"))
    return rounded(books.select("book", *[c.alias(n) for n, c in scalars.book_summary(F.col("bids"), F.col("asks")).items()]))


@query(f"""
WITH f AS (SELECT l_orderkey, sum(CASE WHEN l_linenumber = 1 THEN l_discount END) AS diluted, sum(CASE WHEN l_linenumber = 2 THEN l_tax END) AS basic, sum(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS equity, sum(CASE WHEN l_linenumber = 4 THEN l_quantity - 10 END) AS shares, sum(CASE WHEN l_linenumber = 5 THEN l_extendedprice END) AS debt, sum(CASE WHEN l_linenumber = 6 THEN l_extendedprice END) AS income FROM lineitem GROUP BY 1)
SELECT o_orderkey AS ticker, {r('o_totalprice / coalesce(nullif(diluted, 0), nullif(basic, 0))', 'pe')}, {r('o_totalprice / nullif(equity / nullif(shares, 0), 0)', 'pb')}, {r('debt / nullif(equity, 0)', 'debt_to_equity')}, {r('income / nullif(equity, 0)', 'roe')} FROM orders LEFT JOIN f ON l_orderkey = o_orderkey""")
def fundamental_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics by line number of an order; zero earnings fall through to basic ones, missing metrics give nulls."""
    metric = {"diluted": (1, F.col("l_discount")), "basic": (2, F.col("l_tax")), "equity": (3, F.col("l_extendedprice")), "shares": (4, F.col("l_quantity") - 10), "debt": (5, F.col("l_extendedprice")), "income": (6, F.col("l_extendedprice"))}
    facts = T.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.sum(F.when(F.col("l_linenumber") == n, c)).alias(name) for name, (n, c) in metric.items()])
    o = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice").join(facts, "l_orderkey", "left")
    ratios = scalars.fundamental_ratios(F.col("o_totalprice"), *[F.col(c) for c in metric])
    return rounded(o.select(F.col("l_orderkey").alias("ticker"), *[c.alias(n) for n, c in ratios.items()]))


@query(f"""
SELECT o_orderkey, timezone('UTC', timezone('America/New_York', o_orderdate + INTERVAL 16 HOUR)) AS closes, timezone('UTC', timezone('America/New_York', o_orderdate + INTERVAL 570 MINUTE)) AS opens,
  CASE WHEN o_orderkey % 8 > 0 THEN o_orderdate + INTERVAL 1 HOUR * CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 14 END END AS stamp, CASE WHEN o_custkey % 10 = 0 THEN 'missing_value' WHEN o_totalprice < 50000 OR o_totalprice > 400000 THEN 'out_of_range' ELSE 'ok' END AS flag,
  {r('CASE WHEN o_totalprice > 200000 THEN o_totalprice / 20000000 ELSE o_totalprice / 200000 END', 'price')} FROM orders""")
def session_times_and_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local opens and closes in UTC, stamps of 8 or 10 digits filled to 14, range flags and prices given in percent."""
    o = T.table(spark, sf_dir, "orders")
    k, day, value = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_totalprice")
    o = o.withColumn("digits", F.when(k % 8 == 0, "no date").when(k % 3 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("14"))))
    utc = lambda time: scalars.local_to_utc(day, time).cast("timestamp_ntz")
    flag = checks.range_flag(F.when(F.col("o_custkey") % 10 > 0, value), 50000, 400000)
    return rounded(o.select("o_orderkey", utc("16:00:00").alias("closes"), utc("09:30:00").alias("opens"), scalars.padded_timestamp(F.col("digits")).alias("stamp"), flag.alias("flag"), checks.normalized_price(value / 200000).alias("price")))


@query(f"""SELECT o_custkey AS trader, o_orderkey, {r('o_totalprice - 150000', 'net_positions')}, {r('CASE WHEN o_orderkey % 9 > 0 THEN (o_totalprice - 150000) / (o_orderkey % 9 * 1000.0) END', 'net_pct_oi')}, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 91 HOUR + INTERVAL 30 MINUTE AS available_time,
CASE WHEN o_orderkey % 9 = 0 THEN 'missing_value' ELSE 'ok' END AS data_quality_flag FROM orders""")
def curated_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for position reports; without open interest there is no share of it."""
    k = F.col("o_orderkey")
    raw = T.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("trader"), k, F.to_date("o_orderdate").alias("report_date"), F.col("o_totalprice").alias("long_positions"), F.lit(150000.0).alias("short_positions"), F.when(k % 9 > 0, k % 9 * 1000.0).alias("open_interest"))
    made = curated.positions(raw)
    return rounded(made.select("trader", "o_orderkey", "net_positions", "net_pct_oi", F.col("available_time").cast("timestamp_ntz").alias("available_time"), "data_quality_flag"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'binary' ELSE 'multi' END AS outcome_type, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate ELSE TIMESTAMP '2024-01-01' END AS event_time FROM orders")
def curated_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for contracts: outcomes Yes and No are binary; without a creation time the time of the load counts."""
    k = F.col("o_orderkey")
    names = lambda *xs: F.array(*map(F.lit, xs))
    outcomes = F.when(k % 2 == 0, names("No", "Yes")).when(k % 3 == 0, names("Yes", "Maybe")).otherwise(names("A", "B", "No"))
    raw = T.table(spark, sf_dir, "orders").select(k, F.lit("v").alias("venue"), k.cast("string").alias("venue_market_id"), outcomes.alias("outcomes"), F.when(k % 5 > 0, F.col("o_orderdate").cast("timestamp")).alias("created_time"))
    return curated.contracts(raw, F.lit("2024-01-01").cast("timestamp")).select("o_orderkey", "outcome_type", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


@query("""
WITH b AS (SELECT CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderkey % 4 > 0 THEN 'C' || o_custkey ELSE '' END AS ticker, CASE WHEN o_orderkey % 2 = 0 THEN 'SHORT' ELSE 'LONG' END AS direction, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice ELSE 0 END AS score, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS entry_price, o_orderkey AS shares FROM orders)
SELECT date, ticker, direction, score, entry_price, shares FROM b WHERE ticker <> '' AND entry_price > 0""")
def parsed_blotters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blotter rows as text: padded lower-case tickers, missing directions, scores and prices that are no number."""
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("string")
    raw = T.table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.when(k % 4 > 0, F.concat(F.lit(" c"), "o_custkey")).otherwise("  ").alias("ticker"), F.when(k % 2 == 0, "short").alias("direction"), F.when(k % 5 > 0, price).otherwise("high").alias("score"), F.when(k % 7 > 0, price).otherwise("-").alias("entry_price"), k.cast("string").alias("shares"))
    return ingest.parse_blotter(raw).select("date", "ticker", "direction", "score", "entry_price", "shares")
