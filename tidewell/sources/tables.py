"""The driver tables as market-style inputs: bars, trades, filings, holdings. SQL holds the same definitions as CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _priced():
    """The time of an event with a price, so that a missing price opens or closes no bar."""
    return F.when(F.col("value").isNotNull(), F.col("ts"))


def bars_h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars by event type: symbol, ts, open, high, low, close, volume."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.min_by("value", _priced()).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", _priced()).alias("close"), F.count("*").cast("double").alias("volume"))


def bars_user_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars by user: symbol, ts (date), open, high, low, close, volume."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("symbol"), F.to_date("ts").alias("ts")).agg(F.min_by("value", _priced()).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", _priced()).alias("close"), F.count("*").cast("double").alias("volume"))


def bars_supp_d(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """Daily bars by supplier: symbol, ts (date), high, low, close (average unit price), volume. Sums of three prices or more
    are rounded, so that a close whose seventh digit is an exact 5 does not hang on the order in which rows are added; a
    close is rounded in millionths, where a quotient just below such a 5 counts as one. together: lines are shuffled by
    supplier, so that neither the bars nor windows over a supplier's bars need a shuffle of their own."""
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    li = li.repartition("l_suppkey") if together else li
    price = F.when(F.count("l_extendedprice") > 2, F.round(F.sum("l_extendedprice"), 6)).otherwise(F.sum("l_extendedprice"))
    return li.groupBy(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("ts")).agg((F.round(price / F.sum("l_quantity") * 1e6) / 1e6).alias("close"), F.max(unit).alias("high"), F.min(unit).alias("low"), F.sum("l_quantity").alias("volume"))


def trades(spark: SparkSession, sf_dir: str, delay: str = "6 hours") -> DataFrame:
    """contract_id, trade_id, ts, price, size, side, available_time (ts + delay)."""
    e = table(spark, sf_dir, "events")
    side = F.when(F.col("event_type").isin("purchase", "signup"), "buy").when(F.col("event_type").isin("click", "error"), "sell")
    return e.select(F.col("user_id").alias("contract_id"), F.col("event_id").alias("trade_id"), "ts", F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("double").alias("size"), side.alias("side"), (F.col("ts") + F.expr(f"INTERVAL '{delay.split()[0]}' HOUR")).alias("available_time"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, order id, period (month), filed (date, up to 59 days later), metric, value."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("filing_id"), F.trunc("o_orderdate", "month").alias("period"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 60).cast("int")).alias("filed"), F.col("o_orderstatus").alias("metric"), F.col("o_totalprice").alias("value"))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """filer, quarter, asset, value: summed extended prices."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("o_custkey").alias("filer"), F.trunc("o_orderdate", "quarter").alias("quarter"), F.col("l_suppkey").alias("asset")).agg(F.round(F.sum("l_extendedprice"), 4).alias("value"))


def probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, y (quality label), p: a probability that is a fixed function of the id."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("y"), ((F.col("doc_id") * 37 % 101) / 101).alias("p"))


SQL = {
    "bars_h": "SELECT event_type AS symbol, date_trunc('hour', ts) AS ts, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY ALL",
    "bars_user_d": "SELECT user_id AS symbol, CAST(ts AS DATE) AS ts, arg_min(value, events.ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, events.ts) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY user_id, CAST(events.ts AS DATE)",
    "bars_supp_d": "SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS ts, round(sum(l_extendedprice) / sum(l_quantity), 6) AS close, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low, sum(l_quantity) AS volume FROM lineitem GROUP BY 1, 2",
    "trades": "SELECT user_id AS contract_id, event_id AS trade_id, ts, value AS price, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size, CASE WHEN event_type IN ('purchase', 'signup') THEN 'buy' WHEN event_type IN ('click', 'error') THEN 'sell' END AS side, ts + INTERVAL 6 HOUR AS available_time FROM events",
    "filings": "SELECT o_custkey AS entity, o_orderkey AS filing_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS filed, o_orderstatus AS metric, o_totalprice AS value FROM orders",
    "holdings": "SELECT o_custkey AS filer, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, l_suppkey AS asset, round(sum(l_extendedprice), 4) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3",
    "probs": "SELECT doc_id AS id, quality AS y, (doc_id * 37 % 101) / 101 AS p FROM labels",
}


def with_tables(*names: str, then: str) -> str:
    """SQL with the named inputs as CTEs."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n" + then.strip()
