"""Curated tables: typed rows with event time, available time, time quality, quality flag and a deterministic key.

Each function takes a raw frame (see sources.ingest.SOURCES) and returns curated rows; asof.upsert stores them. The rules
for the time at which a fact could be known are one per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.windows import Frame
from . import asof, checks
from . import indicators as ind

ZONE = "America/New_York"


def minutes(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n if isinstance(n, Column) else F.lit(n), F.lit(0).cast("decimal(18,6)"))


def days(n: int, hours: int = 0, mins: int = 0) -> Column:
    return F.make_dt_interval(F.lit(n), F.lit(hours), F.lit(mins), F.lit(0).cast("decimal(18,6)"))


def envelope(df: DataFrame, event: Column, available: Column, flag: Column, quality: str = "assumed") -> DataFrame:
    """Adds the five bitemporal columns; a fact is never available before it happens."""
    return df.withColumns({"event_time": event.cast("timestamp"), "available_time": F.greatest(available.cast("timestamp"), event.cast("timestamp")), "time_quality": F.lit(quality), "ingested_at": F.current_timestamp(), "data_quality_flag": flag})


def entity_id(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def market_close(date: Column) -> Column:
    return scalars.local_to_utc(date, "16:00:00", ZONE)


def prices(raw: DataFrame, latency_min: float = 15) -> DataFrame:
    """Daily bars: known max(15, measured latency) minutes after the close; flagged by the bar rules and for spikes."""
    c = F.col
    rows = raw.withColumn("symbol_id", entity_id(c("ticker")))
    close = market_close(c("date"))
    rows = envelope(rows.drop("raw_data", "extracted_at"), close, close + minutes(int(max(15, latency_min))), checks.ohlcv_flag(c("open"), c("high"), c("low"), c("close"), c("volume")))
    return ind.spike_flag(rows, Frame(["symbol_id"], ["date"]))


def corporate_actions(raw: DataFrame, latency_min: float = 15) -> DataFrame:
    """Splits (ratio not 1) and dividends (above 0) of daily bars, one row each."""
    ratio = scalars.split_ratio(F.col("split_ratio"), None)
    made = F.array(F.when(ratio.isNotNull() & (ratio != 1), F.struct(F.lit("split").alias("kind"), ratio.alias("amount"))), F.when(F.col("dividend") > 0, F.struct(F.lit("dividend").alias("kind"), F.col("dividend").alias("amount"))))
    rows = raw.select(entity_id(F.col("ticker")).alias("symbol_id"), F.col("date").alias("action_date"), F.explode(F.filter(made, lambda x: x.isNotNull())).alias("a")).select("symbol_id", "action_date", "a.kind", "a.amount")
    close = market_close(F.col("action_date"))
    return envelope(rows, close, close + minutes(int(max(15, latency_min))), F.lit("ok"))


def adjusted(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Forward total-return prices from curated bars and the actions known by each bar's available time."""
    a = actions.select("symbol_id", F.col("action_date").alias("date"), "kind", "amount", "available_time")
    joined = asof.lateral_actions(bars.select("symbol_id", "date", "close", "volume", "available_time"), a, ["symbol_id", "date"])
    return ind.adjusted_forward(joined, Frame(["symbol_id"], ["date"]))


def macro(raw: DataFrame) -> DataFrame:
    """Vintages: known at noon New York on the day of publication and an hour; else when extracted."""
    known = F.coalesce(scalars.local_to_utc(F.col("realtime_start"), "12:00:00", ZONE) + minutes(60), F.col("extracted_at"))
    rows = raw.select(entity_id(F.col("series_code")).alias("series_id"), F.col("date").alias("period_end"), F.coalesce(F.col("realtime_start").cast("string"), F.lit("latest")).alias("revision_id"), "value", "realtime_start", "extracted_at")
    return envelope(rows, F.col("period_end"), known, checks.range_flag(F.col("value")), "confirmed").drop("realtime_start", "extracted_at")


def contract_prices(raw: DataFrame, latency_min: int = 2) -> DataFrame:
    p = checks.normalized_price(F.col("price"))
    rows = raw.select(entity_id(F.col("venue_market_id")).alias("contract_id"), "ts", "outcome", F.col("price").alias("price_raw"), p.alias("price_normalized"))
    return envelope(rows, F.col("ts"), F.col("ts") + minutes(latency_min), checks.range_flag(F.col("price_normalized"), 0, 1, "missing_price", "out_of_range"))


def contract_trades(raw: DataFrame, latency_min: int = 2) -> DataFrame:
    flag = F.when(F.col("price").isNull() | (F.col("price") < 0), "invalid_price").when(F.col("size").isNull() | (F.col("size") <= 0), "invalid_size").otherwise("ok")
    rows = raw.select(entity_id(F.col("venue_market_id")).alias("contract_id"), "trade_id", "ts", "price", "size", F.lower("side").alias("side"))
    return envelope(rows, F.col("ts"), F.col("ts") + minutes(latency_min), flag)


def order_books(raw: DataFrame) -> DataFrame:
    rows = raw.select(entity_id(F.col("venue_market_id")).alias("contract_id"), "ts", *[c.alias(n) for n, c in scalars.book_summary(F.col("bids"), F.col("asks")).items()], "bids", "asks")
    return envelope(rows, F.col("ts"), F.col("ts"), F.when(F.col("spread") < 0, "crossed").otherwise("ok"), "confirmed")


def factors(raw: DataFrame, jitter_min: int = 0) -> DataFrame:
    """Known on the next business day at 09:30 New York."""
    return envelope(raw, F.col("date"), scalars.local_to_utc(scalars.next_business_day(F.col("date")), "09:30:00", ZONE) + minutes(jitter_min), checks.range_flag(F.col("mkt_rf")))


def fundamentals(raw: DataFrame, latency_min: float = 60) -> DataFrame:
    """The latest filing of each metric and period; known max(60, latency) minutes after the day of filing."""
    w = Window.partitionBy("ticker", "metric_name", "fiscal_period_end").orderBy(F.desc("filing_date"), F.desc_nulls_last("filing_sequence"))
    rows = raw.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n").withColumn("symbol_id", entity_id(F.col("ticker")))
    return envelope(rows, F.col("fiscal_period_end"), F.col("filing_date").cast("timestamp") + minutes(int(max(60, latency_min))), checks.range_flag(F.col("metric_value")), "confirmed")


def insider(raw: DataFrame, latency_min: float = 60) -> DataFrame:
    flag = F.when(F.col("shares").isNull() | (F.col("shares") <= 0), "invalid_shares").when(F.col("price") < 0, "negative_price").otherwise("ok")
    rows = raw.withColumns({"symbol_id": entity_id(F.col("ticker")), "transaction_type": scalars.coded(F.col("code")), "total_value": F.col("shares") * F.col("price")})
    return envelope(rows, F.col("transaction_date"), F.col("filing_date").cast("timestamp") + minutes(int(max(60, latency_min))), flag, "confirmed")


def holdings(raw: DataFrame, cusips: DataFrame, latency_min: float = 60) -> DataFrame:
    """Holdings of mapped securities with their share of the filer's total at the report date. cusips: cusip, ticker."""
    total = F.sum("market_value").over(Window.partitionBy("filer", "report_date"))
    rows = raw.withColumn("portfolio_weight", F.when(total > 0, F.col("market_value") / total)).join(cusips, "cusip").withColumn("symbol_id", entity_id(F.col("ticker")))
    return envelope(rows, F.col("report_date"), F.col("filing_date").cast("timestamp") + minutes(int(max(60, latency_min))), checks.range_flag(F.col("market_value"), 0), "confirmed")


def earnings(raw: DataFrame) -> DataFrame:
    """Before the open: 09:30 local; after the close: the close; else the close and 15 minutes."""
    d, close = F.col("report_date"), market_close(F.col("report_date"))
    known = F.when(F.col("time_of_day") == "bmo", scalars.local_to_utc(d, "09:30:00", ZONE)).when(F.col("time_of_day") == "amc", close).otherwise(close + minutes(15))
    diff, part = scalars.surprise(F.col("eps_actual"), F.col("eps_estimate"))
    rows = raw.withColumns({"symbol_id": entity_id(F.col("ticker")), "surprise": diff, "surprise_pct": part})
    return envelope(rows, d, known, checks.range_flag(F.col("eps_actual"), missing="not_reported"))


def short_interest(raw: DataFrame) -> DataFrame:
    """Change over the previous report; known 14 days after settlement."""
    f = Frame(["ticker"], ["settlement_date"])
    prev = F.lag("short_interest").over(f.spec)
    rows = raw.withColumns({"symbol_id": entity_id(F.col("ticker")), "change": F.col("short_interest") - prev, "change_pct": F.try_divide(F.col("short_interest") - prev, prev), "percent_of_float": scalars.guarded_ratio(F.col("short_interest"), F.col("shares_float"))})
    return envelope(rows, F.col("settlement_date"), F.col("settlement_date").cast("timestamp") + days(14), checks.range_flag(F.col("short_interest"), 0))


def etf_flows(raw: DataFrame) -> DataFrame:
    """Sums of 5 and 20 rows and the share of assets; known the next day."""
    f = Frame(["ticker"], ["date"])
    rows = raw.withColumns({"symbol_id": entity_id(F.col("ticker")), "flow_5": F.sum("flow").over(f.rows(5)), "flow_20": F.sum("flow").over(f.rows(20)), "flow_pct_aum": scalars.guarded_ratio(F.col("flow"), F.col("aum"))})
    return envelope(rows, F.col("date"), F.col("date").cast("timestamp") + days(1), checks.range_flag(F.col("flow")))


def positions(raw: DataFrame) -> DataFrame:
    """Net positions and their share of open interest; known three days, 19 hours and 30 minutes after the report date."""
    net = F.col("long_positions") - F.col("short_positions")
    rows = raw.withColumns({"net_positions": net, "net_pct_oi": scalars.guarded_ratio(net, F.col("open_interest"))})
    return envelope(rows, F.col("report_date"), F.col("report_date").cast("timestamp") + days(3, 19, 30), checks.range_flag(F.col("open_interest"), 0))


def world_events(raw: DataFrame, extracted: Column, latency_min: int = 15) -> DataFrame:
    """raw: as returned by sources.ingest.world_events. Known when added, or latency minutes after it happened."""
    event = F.coalesce(F.col("event_date").cast("timestamp"), extracted)
    rows = raw.withColumn("location", F.struct("lat", "lon")).drop("lat", "lon")
    return envelope(rows, event, F.greatest(F.col("date_added"), event + minutes(latency_min)), checks.range_flag(F.col("tone"), missing="missing_tone"))


def contracts(raw: DataFrame, now: Column) -> DataFrame:
    """Contracts by venue and market id: binary if the outcomes hold Yes and No, else multi."""
    kind = F.when(F.array_contains("outcomes", "Yes") & F.array_contains("outcomes", "No"), "binary").otherwise("multi")
    rows = raw.withColumns({"contract_id": entity_id(F.col("venue"), F.col("venue_market_id")), "outcome_type": kind})
    return envelope(rows, F.coalesce("created_time", now), F.coalesce("created_time", now), F.lit("ok"))


def contract_days(rows: DataFrame, now: Column) -> DataFrame:
    """One row a day from a contract's creation to its resolution (resolved, else now)."""
    span = F.sequence(F.to_date("created_time"), F.to_date(F.coalesce("resolved", now)))
    return rows.where(F.col("created_time").isNotNull()).select("contract_id", F.explode(span).alias("day"), "available_time").withColumn("available_time", F.greatest("available_time", F.col("day").cast("timestamp")))
