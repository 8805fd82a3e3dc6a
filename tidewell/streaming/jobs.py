"""Structured Streaming jobs: liquidity windows, deduplication, latest quotes, inventory, upsert sinks, alerts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import asof


def parquet_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def liquidity(trades: DataFrame, key: str = "contract_id", ts: str = "ts", late: str = "1 hour", length: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Trades, volume, mean size, deviation and range of price in tumbling or sliding event-time windows."""
    window = F.window("__ts", length, slide) if slide else F.window("__ts", length)
    rows = trades.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    got = rows.groupBy(key, window.alias("w")).agg(F.count("*").alias("n"), F.sum("size").alias("volume"), F.avg("size").alias("mean_size"), F.stddev_samp("price").alias("std"), F.min("price").alias("low"), F.max("price").alias("high"))
    return got.select(key, F.col("w.start").alias("start"), "n", "volume", "mean_size", "std", "low", "high")


def bursts(trades: DataFrame, key: str = "contract_id", ts: str = "ts", gap: str = "2 hours", late: str = "1 hour") -> DataFrame:
    """Bursts of activity: sessions that end after a gap."""
    rows = trades.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return rows.groupBy(key, F.session_window("__ts", gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_by_id(trades: DataFrame, key: str = "trade_id", ts: str = "ts", late: str = "1 day") -> DataFrame:
    """Each id once, as long as repeats come within the watermark."""
    return trades.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late).dropDuplicatesWithinWatermark([key]).drop("__ts")


QUOTE = "symbol string, ts timestamp, price double, bid double, ask double, high double, low double"


def latest_quotes(ticks: DataFrame) -> DataFrame:
    """The latest quote of each symbol after each micro-batch. ticks: symbol, ts, kind (trade or quote), price, bid, ask.

    Trades set the price and extend high and low; quotes set bid and ask and keep the price, or the mid if there is none.
    The state is one quote of each symbol.
    """
    state = "ts timestamp, price double, bid double, ask double, high double, low double"

    def update(key: tuple, batches: Iterator[pd.DataFrame], store) -> Iterator[pd.DataFrame]:
        ts, price, bid, ask, high, low = store.get if store.exists else (None,) * 6
        rows = pd.concat(list(batches)).sort_values("ts", kind="stable")
        for r in rows.itertuples():
            if ts is not None and r.ts < ts:
                continue
            ts = r.ts
            if r.kind == "trade":
                price = float(r.price)
                high, low = max(price, high if high is not None else price), min(price, low if low is not None else price)
            else:
                bid, ask = float(r.bid), float(r.ask)
                price = price if price is not None else (bid + ask) / 2
        store.update((ts, price, bid, ask, high, low))
        yield pd.DataFrame([(key[0], ts, price, bid, ask, high, low)], columns=["symbol", "ts", "price", "bid", "ask", "high", "low"])

    return ticks.groupBy("symbol").applyInPandasWithState(update, QUOTE, state, "update", "NoTimeout")


def fold_inventory(position: float, cost: float, realised: float, fills: Iterator[tuple[float, float]]) -> tuple[float, float, float]:
    """Position, average cost and realised profit after signed fills (quantity, price): same side averages the cost,
    the other side realises, crossing zero starts anew at the fill's price."""
    for q, p in fills:
        if position * q >= 0:
            total = position + q
            cost = (position * cost + q * p) / total if total else 0.0
            position = total
        else:
            closed = min(abs(q), abs(position)) * (1 if position > 0 else -1)
            realised += closed * (p - cost)
            position += q
            if position * (position - q) <= 0:
                cost = p if position else 0.0
    return position, cost, realised


INVENTORY = "symbol string, position double, cost double, realised double"


def inventory_stream(fills: DataFrame) -> DataFrame:
    """Running inventory by symbol. fills: symbol, ts, quantity (signed), price, in order within each micro-batch."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], store) -> Iterator[pd.DataFrame]:
        was = store.get if store.exists else (0.0, 0.0, 0.0)
        rows = pd.concat(list(batches)).sort_values("ts", kind="stable")
        now = fold_inventory(*was, zip(rows["quantity"], rows["price"], strict=True))
        store.update(now)
        yield pd.DataFrame([(key[0], *now)], columns=["symbol", "position", "cost", "realised"])

    return fills.groupBy("symbol").applyInPandasWithState(update, INVENTORY, "position double, cost double, realised double", "update", "NoTimeout")


def inventory(fills: DataFrame) -> DataFrame:
    """The batch twin of inventory_stream: each symbol's fills in time order."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("ts", kind="stable")
        return pd.DataFrame([(g["symbol"].iloc[0], *fold_inventory(0.0, 0.0, 0.0, zip(g["quantity"], g["price"], strict=True)))], columns=["symbol", "position", "cost", "realised"])

    return fills.groupBy("symbol").applyInPandas(run, INVENTORY)


def rolling_liquidity(hourly: DataFrame, key: str = "contract_id", hours: Sequence[int] = (1, 6, 24)) -> DataFrame:
    """hourly (key, start, n, volume) with empty hours between the first and last of each key, and n and volume over the
    last so many hours. For the table that the liquidity stream has written."""
    at = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    span = hourly.groupBy(key).agg(F.min("start").alias("a"), F.max("start").alias("b"))
    every = span.select(key, F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("start"))
    rows = every.join(hourly.select(key, "start", "n", "volume"), [key, "start"], "left").fillna(0, ["n"]).fillna(0.0, ["volume"])
    back = lambda h: Window.partitionBy(key).orderBy(at("start")).rangeBetween(-(h - 1) * 3600, 0)
    return rows.withColumns({f"{c}_{h}h": F.sum(c).over(back(h)) for h in hours for c in ("n", "volume")})


STALE = "symbol string, last timestamp, stale boolean"


def stale_quotes(ticks: DataFrame, seconds: int) -> DataFrame:
    """(symbol, last, stale): fresh after each batch with ticks of the symbol, stale once none came for so many seconds of
    processing time. The state is one time of each symbol.

    For a running query: with time-outs by processing time, run_available would wait for them for ever.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], store) -> Iterator[pd.DataFrame]:
        last = store.get[0] if store.exists else None
        if store.hasTimedOut:
            yield pd.DataFrame([(key[0], last, True)], columns=["symbol", "last", "stale"])
            return
        newest = max(b["ts"].max() for b in batches)
        last = newest if last is None else max(last, newest)
        store.update((last,))
        store.setTimeoutDuration(seconds * 1000)
        yield pd.DataFrame([(key[0], last, False)], columns=["symbol", "last", "stale"])

    return ticks.groupBy("symbol").applyInPandasWithState(update, STALE, "last timestamp", "update", "ProcessingTimeTimeout")


def stale_at(quotes: DataFrame, now: str, seconds: int) -> DataFrame:
    """The batch twin: each symbol's latest time and whether it is older than so many seconds at now."""
    last = quotes.groupBy("symbol").agg(F.max("ts").alias("last"))
    return last.withColumn("stale", F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("last").cast("timestamp")) > seconds)


def books_into(path: str, days: int) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends curated order books (contract_id, ts, bids, asks) by day and removes days that
    are more than so many before the newest one. A batch that is run again replaces its own files."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("contract_id", "ts", *[c.alias(n) for n, c in scalars.book_summary(F.col("bids"), F.col("asks")).items()])
        rows.withColumns({"day": F.to_date("ts"), "batch": F.lit(number)}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)
        kept = spark.read.parquet(path).select("day").distinct().collect()  # one row a day of the retention
        newest = max((r.day for r in kept), default=None)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for r in kept:
            if (newest - r.day).days > days:
                old = place(f"{path}/day={r.day}")
                old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    return write


def facts_into(path: str, now: Callable[[], str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends facts (ts, available_time, ...) to a bitemporal table. None is dropped for being
    late: a fact is available when it says, but not before the batch that brought it, so as-of reads of earlier times do not see it."""

    def write(batch: DataFrame, number: int) -> None:
        known = F.greatest(F.col("available_time").cast("timestamp"), F.lit(now()).cast("timestamp"))
        batch.withColumns({"available_time": known, "batch": F.lit(number)}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    return write


def upsert_into(path: str, key: Sequence[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that upserts each micro-batch into a parquet table of key buckets (read it with upserted).

    Only the buckets that a batch touches are written, as a new version under the batch's number, so what is written grows
    with the batch, and a batch that is run again gives the same. Versions stay for as-of reads; where they should not, or
    where batches are small against the table, use delta.DeltaTable.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("bucket", bucket)
        old = new.where("false")
        if number:
            before = upserted(spark, path, number - 1, keep=True)
            old = before.join(F.broadcast(new.select("bucket").distinct()), "bucket", "left_semi").select(*new.columns)
        rows = asof.upsert(old.drop("bucket"), batch, key).withColumns({"bucket": bucket, "version": F.lit(number)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "bucket").parquet(path)

    return write


def upserted(spark: SparkSession, path: str, upto: int | None = None, keep: bool = False) -> DataFrame:
    """The table that upsert_into has written: of each bucket the latest version, or the latest up to a batch."""
    rows = spark.read.parquet(path)
    if upto is not None:
        rows = rows.where(F.col("version") <= upto)
    last = rows.select("bucket", "version").distinct().groupBy("bucket").agg(F.max("version").alias("version"))  # at most one row a bucket
    got = rows.join(F.broadcast(last), ["bucket", "version"], "left_semi").drop("version")
    return got if keep else got.drop("bucket")


def alerts_into(path: str, slas: DataFrame, now: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends freshness violations of a batch of (source, last_updated)."""
    from ..operators import checks

    def write(batch: DataFrame, number: int) -> None:
        latest = batch.groupBy("source").agg(F.max("last_updated").alias("last_updated"))
        checks.freshness(latest, slas, now).withColumn("batch", F.lit(number)).write.mode("append").parquet(path)

    return write


def run_available(df: DataFrame, checkpoint: str, name: str | None = None, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Processes all that is available and stops: into a memory table or through each."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = (w.foreachBatch(each) if each else w.format("memory").queryName(name)).start()
    q.awaitTermination()
