"""Reads raw files into tables with fixed schemas: quarantine, required fields, flatteners.

Files are only read by Spark's readers, with explicit schemas. Rows or files that cannot be used go to a quarantine
table with a reason; the rest of the load goes on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import scalars
from ..operators import asof


@dataclass(frozen=True)
class Source:
    """schema: of the files; key: natural key of the raw table; required: fields that must not be null."""

    schema: str
    key: tuple[str, ...]
    required: tuple[str, ...]


# The raw tables by source.
SOURCES = {
    "macro": Source("series_code string, date date, value double, realtime_start date, realtime_end date", ("series_code", "date", "realtime_start"), ("series_code", "date")),
    "prices": Source("ticker string, date date, open double, high double, low double, close double, adj_close double, volume bigint, split_ratio string, dividend double", ("ticker", "date"), ("ticker", "date")),
    "factors": Source("date date, mkt_rf double, smb double, hml double, rmw double, cma double, mom double, rf double", ("date",), ("date",)),
    "fundamentals": Source("ticker string, metric_name string, fiscal_period_end date, form_type string, accession_number string, metric_value double, filing_date date, is_amendment boolean, filing_sequence int", ("ticker", "metric_name", "fiscal_period_end", "accession_number"), ("ticker", "metric_name", "fiscal_period_end")),
    "insider": Source("ticker string, insider string, transaction_date date, code string, shares double, price double, filing_date date, accession_number string", ("ticker", "accession_number", "insider", "transaction_date", "code", "shares"), ("ticker", "transaction_date")),
    "holdings": Source("filer string, report_date date, cusip string, shares bigint, market_value double, filing_date date", ("filer", "report_date", "cusip"), ("filer", "report_date", "cusip")),
    "options": Source("ticker string, quote_date date, expiration date, strike double, option_type string, volume int, open_interest int, implied_volatility double", ("ticker", "quote_date", "expiration", "strike", "option_type"), ("ticker", "quote_date", "expiration", "strike")),
    "earnings": Source("ticker string, report_date date, eps_estimate double, eps_actual double, time_of_day string", ("ticker", "report_date"), ("ticker", "report_date")),
    "short_interest": Source("ticker string, settlement_date date, short_interest bigint, shares_float bigint", ("ticker", "settlement_date"), ("ticker", "settlement_date")),
    "etf_flows": Source("ticker string, date date, flow double, aum double", ("ticker", "date"), ("ticker", "date")),
    "cot": Source("commodity_code string, report_date date, long_positions bigint, short_positions bigint, open_interest bigint", ("commodity_code", "report_date"), ("commodity_code", "report_date")),
    "world_events": Source("event_id string, sql_date string, date_added string, event_type string, tone double, lat string, lon string", ("event_id",), ("event_id",)),
    "contracts": Source("venue string, venue_market_id string, title string, outcomes array<string>, status string, created_time timestamp", ("venue", "venue_market_id"), ("venue", "venue_market_id")),
    "contract_prices": Source("venue_market_id string, ts timestamp, outcome string, price double", ("venue_market_id", "ts", "outcome"), ("venue_market_id", "ts")),
    "contract_trades": Source("venue_market_id string, trade_id string, ts timestamp, price double, size double, side string", ("trade_id",), ("trade_id", "ts")),
    "order_books": Source("venue_market_id string, ts timestamp, bids array<array<double>>, asks array<array<double>>", ("venue_market_id", "ts"), ("venue_market_id", "ts")),
    "posts": Source("post_id string, created timestamp, title string, body string, score int", ("post_id",), ("post_id",)),
}


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have all required fields, and a quarantine record (record, error_type, error_message) of the others."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    judged = df.withColumn("__missing", missing)
    bad = judged.where(F.size("__missing") > 0)
    record = F.to_json(F.struct(*df.columns))  # whole: it is the only copy of the row
    return judged.where(F.size("__missing") == 0).drop("__missing"), bad.select(record.alias("record"), F.lit("missing_fields").alias("error_type"), F.concat(F.lit("Missing required fields: "), F.array_join("__missing", ", ")).alias("error_message"))


def read_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All parquet files below a folder by one schema; unreadable files are skipped. Column file names the file."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(path).withColumn("file", F.col("_metadata.file_path"))


def unreadable_files(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Files below the folder from which no row was read: corrupt, cut short or empty."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select(F.col("path").alias("file"), "length")
    return listed.join(rows.select("file").distinct(), "file", "left_anti").select("file", F.lit("unreadable_file").alias("error_type"), F.col("length").alias("bytes"))


def load(spark: SparkSession, source: str, path: str, existing: DataFrame | None = None, now: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The raw table after upserting a folder's files, and the quarantine of its rows.

    raw_data holds the row as JSON; extracted_at is now. Rows of one load with the same key: the last by content wins.
    """
    s = SOURCES[source]
    rows = read_files(spark, path, s.schema).drop("file")
    good, bad = split_required(rows, s.required)
    stamp = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    made = good.withColumns({"raw_data": F.to_json(F.struct(*good.columns)), "extracted_at": stamp})
    start = existing if existing is not None else made.where("false")
    return asof.upsert(start, made, list(s.key)), bad


def quarantine(bad: DataFrame, path: str, source: str, run_id: str, at: str) -> None:
    """Writes a run's quarantine records as JSON lines under its source and run. Records of other runs stay; what another run
    of the source has quarantined already is not written again, and a run that is done again replaces its own."""
    spark = bad.sparkSession
    stamped = bad.withColumns({"source": F.lit(source), "run_id": F.lit(run_id), "at": F.lit(at).cast("timestamp")})
    try:
        known = quarantined(spark, path).where((F.col("source") == source) & (F.col("run_id") != run_id))
        mark = lambda: [F.sha2(F.coalesce("record", F.lit("")), 256).alias("__d"), F.col("error_type").alias("__e")]
        stamped = stamped.withColumns({c: v for c, v in zip(("__d", "__e"), mark(), strict=True)}).join(known.select(*mark()).distinct(), ["__d", "__e"], "left_anti").drop("__d", "__e")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "run_id").json(path)


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("record string, error_type string, error_message string, at timestamp, source string, run_id string").json(path)


def quarantine_summary(bad: DataFrame) -> DataFrame:
    """n by error_type, and by source where there is such a column."""
    return bad.groupBy(*[c for c in ("source", "error_type") if c in bad.columns]).agg(F.count("*").alias("n"))


def events_from_tsv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Headerless tab-separated world events: dates of 8 digits, stamps of up to 14, lenient numbers."""
    raw = spark.read.csv(path, sep="\t", schema=", ".join(f"`{n}` string" for n in names))
    return world_events(raw)


def world_events(raw: DataFrame) -> DataFrame:
    c = raw.columns
    number = lambda n: F.col(n).try_cast("double").alias(n) if n in c else F.lit(None).cast("double").alias(n)
    return raw.select("event_id", F.expr("try_to_timestamp(sql_date, 'yyyyMMdd')").cast("date").alias("event_date"), F.expr("try_to_timestamp(rpad(date_added, 14, '0'), 'yyyyMMddHHmmss')").alias("date_added"), "event_type", number("tone"), number("lat"), number("lon"))


def positions_from_csv(spark: SparkSession, path: str, names: dict[str, str], codes: Sequence[str], start: str, end: str) -> DataFrame:
    """Positions of configured codes in a date range; headers are trimmed and renamed, numbers lenient."""
    raw = spark.read.csv(path, header=True)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    kept = raw.select(*[F.trim(F.col(f"`{a}`")).alias(b) for a, b in names.items()])
    numbers = [b for b in names.values() if b not in ("commodity_code", "report_date")]
    kept = kept.withColumn("report_date", F.expr("try_to_timestamp(report_date, 'yyyy-MM-dd')").cast("date")).where(F.col("commodity_code").isin(*codes) & F.col("report_date").between(start, end))
    return kept.withColumns({n: F.col(n).try_cast("bigint") for n in numbers})


def factors_from_text(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Lines whose first field is an 8-digit date; percent becomes a fraction; incomplete rows are dropped."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\s*\d{8}\s*,"))
    parts = F.split("value", r"\s*,\s*")
    made = lines.select(F.to_date(F.trim(parts[0]), "yyyyMMdd").alias("date"), *[(F.get(parts, F.lit(i + 1)).try_cast("double") / 100).alias(n) for i, n in enumerate(names)])
    return made.dropna()


FACTS = "map<string, struct<units: map<string, array<struct<`end`: string, val: double, accn: string, form: string, filed: string>>>>>"


def fundamentals_from_json(df: DataFrame, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """Company facts: concept -> unit -> entries, base forms 10-Q and 10-K; amendments are forms that end in /A."""
    facts = df.select(F.col(ticker).alias("ticker"), F.explode(F.from_json(payload, FACTS)).alias("metric_name", "f"))
    units = facts.select("ticker", "metric_name", F.explode("f.units").alias("units", "e"))
    rows = units.select("ticker", "metric_name", "units", F.explode("e").alias("e"))
    rows = rows.select("ticker", "metric_name", "units", F.to_date("e.end").alias("fiscal_period_end"), F.col("e.val").alias("metric_value"), F.col("e.accn").alias("accession_number"), F.col("e.form").alias("form_type"), F.to_date("e.filed").alias("filing_date"))
    base = F.regexp_replace("form_type", "/A$", "")
    return rows.where(base.isin("10-Q", "10-K") & F.col("filing_date").isNotNull() & F.col("fiscal_period_end").isNotNull() & F.col("metric_value").isNotNull()).withColumn("is_amendment", F.col("form_type").endswith("/A"))


def insider_from_xml(df: DataFrame, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """Transactions of an ownership form; date and numeric shares are required, codes become names."""
    schema = "nonDerivativeTable struct<nonDerivativeTransaction: array<struct<transactionDate: struct<value: string>, transactionCoding: struct<transactionCode: string>, transactionAmounts: struct<transactionShares: struct<value: string>, transactionPricePerShare: struct<value: string>>>>>"
    t = df.select(F.col(ticker).alias("ticker"), F.explode(F.from_xml(F.col(payload), schema)["nonDerivativeTable"]["nonDerivativeTransaction"]).alias("t"))
    rows = t.select("ticker", F.expr("try_to_timestamp(t.transactionDate.value, 'yyyy-MM-dd')").cast("date").alias("transaction_date"), scalars.coded(F.col("t.transactionCoding.transactionCode")).alias("transaction_type"), F.col("t.transactionAmounts.transactionShares.value").try_cast("double").alias("shares"), F.col("t.transactionAmounts.transactionPricePerShare.value").try_cast("double").alias("price"))
    return rows.where(F.col("transaction_date").isNotNull() & F.col("shares").isNotNull())


def holdings_from_xml(df: DataFrame, filer: str = "filer", payload: str = "payload") -> DataFrame:
    """Information tables with or without a namespace prefix; values are in thousands."""
    schema = "infoTable array<struct<nameOfIssuer: string, cusip: string, value: string, shrsOrPrnAmt: struct<sshPrnamt: string>>>"
    plain = F.regexp_replace(payload, r"(</?)[A-Za-z0-9]+:", "$1")
    t = df.select(F.col(filer).alias("filer"), F.explode(F.from_xml(plain, schema)["infoTable"]).alias("t"))
    return t.select("filer", F.col("t.nameOfIssuer").alias("issuer"), F.col("t.cusip").alias("cusip"), (F.col("t.value").try_cast("bigint") * 1000).alias("market_value"), F.col("t.shrsOrPrnAmt.sshPrnamt").try_cast("bigint").alias("shares"))


_LEG = "array<struct<strike: double, volume: int, openInterest: int, impliedVolatility: double>>"


def options_from_json(df: DataFrame, ticker: str = "ticker", quote_date: str = "quote_date", payload: str = "payload") -> DataFrame:
    """Chains: expirations with calls and puts -> rows; null volume and open interest are 0; epochs become dates."""
    chain = df.select(F.col(ticker).alias("ticker"), F.col(quote_date).alias("quote_date"), F.explode(F.from_json(payload, f"array<struct<expirationDate: bigint, calls: {_LEG}, puts: {_LEG}>>")).alias("c"))
    side = lambda name, kind: chain.select("ticker", "quote_date", F.to_date(F.timestamp_seconds("c.expirationDate")).alias("expiration"), F.lit(kind).alias("option_type"), F.explode(f"c.{name}").alias("o"))
    both = side("calls", "call").unionByName(side("puts", "put"))
    return both.select("ticker", "quote_date", "expiration", "option_type", "o.strike", F.coalesce("o.volume", F.lit(0)).alias("volume"), F.coalesce("o.openInterest", F.lit(0)).alias("open_interest"), F.col("o.impliedVolatility").alias("implied_volatility"))


def observations_from_json(df: DataFrame, series: str = "series_code", payload: str = "payload") -> DataFrame:
    """Macro observations; a value that is no number (such as .) is null."""
    rows = df.select(F.col(series).alias("series_code"), F.explode(F.from_json(payload, "struct<observations: array<struct<date: string, value: string, realtime_start: string, realtime_end: string>>>")["observations"]).alias("o"))
    date = lambda n: F.expr(f"try_to_timestamp(o.{n}, 'yyyy-MM-dd')").cast("date").alias(n)
    return rows.select("series_code", date("date"), F.col("o.value").try_cast("double").alias("value"), date("realtime_start"), date("realtime_end"))


def bars_from_arrays(df: DataFrame, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """Parallel arrays (timestamp, open, high, low, close, volume) -> one row a day; rows with a null price are dropped."""
    schema = "struct<timestamp: array<bigint>, open: array<double>, high: array<double>, low: array<double>, close: array<double>, volume: array<bigint>, adjclose: array<double>>"
    p = df.select(F.col(ticker).alias("ticker"), F.from_json(payload, schema).alias("p"))
    names = ["timestamp", "open", "high", "low", "close", "volume", "adjclose"]
    kinds = {"timestamp": "bigint", "volume": "bigint"}
    p = p.select("ticker", *[F.coalesce(F.col(f"p.{n}"), F.array().cast(f"array<{kinds.get(n, 'double')}>")).alias(n) for n in names])
    rows = p.select("ticker", F.explode(F.arrays_zip(*names)).alias("b"))
    made = rows.select("ticker", F.to_date(F.timestamp_seconds("b.timestamp")).alias("date"), *[F.col(f"b.{c}").alias(c) for c in ("open", "high", "low", "close")], F.coalesce("b.adjclose", "b.close").alias("adj_close"), F.col("b.volume").alias("volume"), F.lit(None).cast("string").alias("split_ratio"), F.lit(0.0).alias("dividend"))
    return made.dropna(subset=["open", "high", "low", "close"])


def bars_with_events(df: DataFrame, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """The bar schema from a chart payload: parallel arrays of quotes, and maps of splits and dividends by time stamp.

    An event belongs to the bar of its date; of several on one date the last one of the map counts. Maps are lined up with the
    bars inside the row, so there is no join. A split without a ratio is '1:1', a dividend without an amount 0; bars without an
    event have no ratio and dividend 0. Rows with a null price are dropped; payloads without time stamps or quotes give none.
    """
    series = ("open", "high", "low", "close")
    quote = "struct<open: array<double>, high: array<double>, low: array<double>, close: array<double>, volume: array<bigint>>"
    schema = f"struct<chart: struct<result: array<struct<timestamp: array<bigint>, indicators: struct<quote: array<{quote}>, adjclose: array<struct<adjclose: array<double>>>>, events: struct<splits: map<string, struct<splitRatio: string>>, dividends: map<string, struct<amount: double>>>>>>>"
    p = df.select(F.col(ticker).alias("ticker"), F.get(F.from_json(payload, schema)["chart"]["result"], F.lit(0)).alias("p"))
    day = lambda seconds: F.to_date(F.timestamp_seconds(seconds))
    entries = lambda name, field, missing: F.transform(F.coalesce(F.map_entries(F.col(f"p.events.{name}")), F.expr("array()")), lambda e: F.struct(day(e["key"].try_cast("bigint")).alias("d"), F.coalesce(e["value"][field], F.lit(missing)).alias("v")))
    p = p.withColumns({"q": F.get("p.indicators.quote", F.lit(0)), "adj": F.get("p.indicators.adjclose", F.lit(0))["adjclose"]})
    p = p.where(F.col("p.timestamp").isNotNull() & F.col("q").isNotNull())
    p = p.withColumns({"splits": F.when(F.col("p.events.splits").isNotNull(), entries("splits", "splitRatio", "1:1")), "dividends": F.when(F.col("p.events.dividends").isNotNull(), entries("dividends", "amount", 0.0))})
    rows = p.select("ticker", "q", "adj", "splits", "dividends", F.posexplode("p.timestamp").alias("i", "t")).withColumn("date", day(F.col("t")))
    at = lambda c: F.get(c, F.col("i"))
    event = lambda c: F.try_element_at(F.filter(c, lambda e: e["d"] == F.col("date")), F.lit(-1))["v"]
    made = rows.select("ticker", "date", *[at(F.col(f"q.{c}")).alias(c) for c in series], F.coalesce(at(F.col("adj")), at(F.col("q.close"))).alias("adj_close"), at(F.col("q.volume")).alias("volume"), event("splits").alias("split_ratio"), F.coalesce(event("dividends"), F.lit(0.0)).alias("dividend"))
    return made.dropna(subset=list(series))


def first_available(primary: DataFrame, secondary: DataFrame, key: str = "ticker") -> DataFrame:
    """The primary's rows, and the secondary's for keys that the primary lacks."""
    return primary.unionByName(secondary.join(primary.select(key).distinct(), key, "left_anti"))


def top_markets(df: DataFrame, volume: str, key: str, n: int | None = None, chosen: Sequence[str] | None = None) -> DataFrame:
    """The n markets of largest volume (ties by key), all of them, or those listed."""
    if chosen is not None:
        return df.where(F.col(key).isin(*chosen))
    return df if n is None else df.orderBy(F.desc(volume), key).limit(n)


def write_partitioned(df: DataFrame, path: str, date: str, by: Sequence[str] = ("year",), mode: str = "append") -> None:
    """Parquet partitioned by year, or year and month, of a date column."""
    parts = {"year": F.year(date), "month": F.month(date)}
    df.withColumns({b: parts[b] for b in by}).write.mode(mode).partitionBy(*by).parquet(path)


def retain(df: DataFrame, ts: str, days: int, now: Column) -> DataFrame:
    """Rows of the last so many days."""
    return df.where(F.col(ts) >= now - F.make_dt_interval(F.lit(days)))


_RAW = "struct<raw: double, fmt: string>"
EARNINGS = f"struct<earningsHistory: struct<history: array<struct<quarter: {_RAW}, period: struct<fmt: string>, epsEstimate: {_RAW}, epsActual: {_RAW}, epsDifference: {_RAW}, surprisePercent: {_RAW}>>>, earnings: struct<financialsChart: struct<quarterly: array<struct<date: string, revenue: {_RAW}>>>>>"


def earnings_from_json(df: DataFrame, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """History entries: report date (quarter, else period), estimate, actual, surprise, surprise in percent, and the revenue
    of the first quarter whose name holds the period. Entries without a date are dropped."""
    p = df.select(F.col(ticker).alias("ticker"), F.from_json(payload, EARNINGS).alias("p")).select("ticker", F.col("p.earnings.financialsChart.quarterly").alias("quarters"), F.explode("p.earningsHistory.history").alias("h"))
    period = F.col("h.period.fmt")
    revenue = F.get(F.filter("quarters", lambda q: q["date"].contains(period) & q["revenue"]["raw"].isNotNull()), F.lit(0))["revenue"]["raw"]
    made = p.select("ticker", F.coalesce("h.quarter.fmt", period).alias("report_date"), period.alias("fiscal_quarter_end"), F.col("h.epsEstimate.raw").alias("eps_estimate"), F.col("h.epsActual.raw").alias("eps_actual"), F.col("h.epsDifference.raw").alias("eps_surprise"), (F.col("h.surprisePercent.raw") * 100).alias("eps_surprise_pct"), revenue.alias("revenue_actual"))
    return made.where(F.col("report_date").isNotNull())


def price_history(trades: DataFrame, start: str, end: str) -> DataFrame:
    """market_id, ts, price, size of trades (market_id, timestamp in epoch seconds, price and size as text) from start to end."""
    rows = trades.select("market_id", F.timestamp_seconds(F.col("timestamp").try_cast("bigint")).alias("ts"), F.col("price").try_cast("double").alias("price"), F.col("size").try_cast("double").alias("size"))
    return rows.where(F.col("ts").between(start, end) & F.col("price").isNotNull())


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet files by their extension, anything else as CSV with a header (types inferred unless given)."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    return spark.read.csv(path, header=True, schema=schema) if schema else spark.read.csv(path, header=True, inferSchema=True)


BLOTTER = {"date": "date", "ticker": "string", "direction": "string", "score": "double", "confidence": "string", "entry_price": "double", "stop_price": "double", "target_1": "double", "target_2": "double", "shares": "bigint", "regime": "string"}


def write_blotter(signals: DataFrame, path: str) -> None:
    """Signals as CSV by date, in the column order of BLOTTER; a date that is written again is replaced."""
    rows = signals.select(*[(F.col(c) if c in signals.columns else F.lit(None)).cast(t).alias(c) for c, t in BLOTTER.items()])
    rows.withColumn("day", F.date_format("date", "yyyyMMdd")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).partitionBy("day").csv(path)


def parse_blotter(rows: DataFrame) -> DataFrame:
    """Rows of a blotter read as text: casts, upper-case tickers, defaults (LONG, score 0); rows without a ticker or a
    positive entry price are dropped; best score first within a date."""
    typed = rows.select(*[(F.col(c).try_cast(t) if c in rows.columns else F.lit(None).cast(t)).alias(c) for c, t in BLOTTER.items()])
    made = typed.withColumns({"ticker": F.upper(F.trim("ticker")), "direction": F.coalesce(F.upper("direction"), F.lit("LONG")), "score": F.coalesce("score", F.lit(0.0))})
    return made.where((F.length("ticker") > 0) & (F.col("entry_price") > 0)).orderBy("date", F.desc("score"), "ticker")


SUMMARY = f"struct<defaultKeyStatistics: struct<sharesShort: {_RAW}, dateShortInterest: {_RAW}, averageDailyVolume10Day: {_RAW}, averageVolume: {_RAW}, floatShares: {_RAW}, shortRatio: {_RAW}, shortPercentOfFloat: {_RAW}, totalAssets: {_RAW}, navPrice: {_RAW}>, summaryDetail: struct<totalAssets: {_RAW}, navPrice: {_RAW}, previousClose: {_RAW}>>"


def short_interest_from_json(df: DataFrame, today, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """Key statistics -> settlement date (else today), short interest, volume, days to cover, shares; rows without short
    interest are dropped."""
    s = F.col("s")
    rows = df.select(F.col(ticker).alias("ticker"), F.from_json(payload, SUMMARY)["defaultKeyStatistics"].alias("s")).where(s["sharesShort"]["raw"].isNotNull())
    raw = lambda n: s[n]["raw"]
    return rows.select("ticker", F.coalesce(F.to_date(F.timestamp_seconds(raw("dateShortInterest"))), today).alias("settlement_date"), raw("sharesShort").cast("bigint").alias("short_interest"), F.coalesce(F.nullif(raw("averageDailyVolume10Day"), F.lit(0.0)), raw("averageVolume")).cast("bigint").alias("avg_daily_volume"), raw("shortRatio").alias("days_to_cover"), raw("shortPercentOfFloat").alias("short_pct_float"), raw("floatShares").cast("bigint").alias("float_shares"))


def fund_profile_from_json(df: DataFrame, ticker: str = "ticker", payload: str = "payload") -> DataFrame:
    """ticker, total_assets, nav: from the summary, else the key statistics; rows without assets are dropped."""
    p = df.select(F.col(ticker).alias("ticker"), F.from_json(payload, SUMMARY).alias("p"))
    first = lambda *xs: F.coalesce(*[F.col(f"p.{x}.raw") for x in xs])
    return p.select("ticker", first("summaryDetail.totalAssets", "defaultKeyStatistics.totalAssets").alias("total_assets"), first("summaryDetail.navPrice", "defaultKeyStatistics.navPrice", "summaryDetail.previousClose").alias("nav")).where("total_assets IS NOT NULL")


def bars_from_named(df: DataFrame, names: dict[str, str], scale: dict[str, float] | None = None) -> DataFrame:
    """The bar schema from a vendor's flat layout. names: vendor column -> ticker, date, open, ...; volume and adj_close
    are optional; scale: factors by bar column. Rows with a null price are dropped."""
    have = {b: F.col(f"`{a}`") for a, b in names.items() if a in df.columns}
    number = lambda b: have.get(b, F.lit(None)).try_cast("double") * (scale or {}).get(b, 1.0)
    made = df.select(have["ticker"].alias("ticker"), have["date"].try_cast("date").alias("date"), *[number(c).alias(c) for c in ("open", "high", "low", "close")], F.coalesce(number("adj_close"), number("close")).alias("adj_close"), number("volume").cast("bigint").alias("volume"), F.lit(None).cast("string").alias("split_ratio"), F.lit(0.0).alias("dividend"))
    return made.dropna(subset=["date", "open", "high", "low", "close"])


def bars_from_series(df: DataFrame, ticker: str = "ticker", payload: str = "payload", key: str = "Time Series (Daily)") -> DataFrame:
    """The bar schema from an object that maps dates to numbered fields ('1. open', ... '5. volume')."""
    entries = F.from_json(F.get_json_object(payload, f"$['{key}']"), "map<string, map<string, string>>")
    rows = df.select(F.col(ticker).alias("ticker"), F.explode(entries).alias("date", "f"))
    field = lambda name: F.get(F.map_values(F.map_filter("f", lambda k, v: k.endswith(f". {name}"))), F.lit(0))
    flat = rows.select("ticker", "date", *[field(n).alias(n) for n in ("open", "high", "low", "close", "adjusted close", "volume")])
    return bars_from_named(flat, {"ticker": "ticker", "date": "date", "open": "open", "high": "high", "low": "low", "close": "close", "adjusted close": "adj_close", "volume": "volume"})


def backfilled(dim: DataFrame, column: str, value) -> DataFrame:
    """dim with value where the column is null (a conditional update)."""
    return dim.withColumn(column, F.coalesce(column, value))


def seconds_of(interval: str) -> int:
    """'30s', '5m', '1h' or plain seconds; off, none and 0 are 0. For triggers of streaming jobs."""
    text = interval.strip().lower()
    if text in ("off", "none", "0"):
        return 0
    unit = {"s": 1, "m": 60, "h": 3600}.get(text[-1:])
    return int(text[:-1]) * unit if unit else int(text)
