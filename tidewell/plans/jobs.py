"""Jobs that compose operators: load, curate, snapshot and check; signals for one day or for all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import windows as W
from ..operators import asof, checks, curated, lineage, portfolio, snapshots
from ..operators import indicators as ind
from ..sources import ingest


def daily_prices(spark: SparkSession, raw_dir: str, out_dir: str, run_id: str, now: str, start: str, end: str) -> DataFrame:
    """Loads price files, writes raw, curated, actions and adjusted tables and symbol snapshots, and returns the alerts.

    A critical alert stops the job before snapshots are written; rows with missing fields go to quarantine. Running it
    again with the same files gives the same tables.
    """
    log = f"{out_dir}/runs"
    lineage.log_run(spark, log, run_id, "daily_prices", "started", now)
    raw, bad = ingest.load(spark, "prices", raw_dir, now=now)
    raw.write.mode("overwrite").parquet(f"{out_dir}/raw_prices")
    ingest.quarantine(bad, f"{out_dir}/quarantine", "prices", run_id, now)
    raw = spark.read.parquet(f"{out_dir}/raw_prices")
    curated.prices(raw).drop("ingested_at").write.mode("overwrite").parquet(f"{out_dir}/cur_prices")
    prices = spark.read.parquet(f"{out_dir}/cur_prices")
    actions = curated.corporate_actions(raw)
    curated.adjusted(prices, actions).write.mode("overwrite").parquet(f"{out_dir}/cur_adjusted")
    late = checks.time_order(prices)
    double = checks.duplicate_keys(prices, ["symbol_id", "date"]).agg(F.count("*").alias("n"))
    text = lambda n: F.concat(F.col(n).cast("string"), F.lit(" rows"))
    alerts = checks.suite([late.select(*checks.alert("time_order", "cur_prices", F.when(F.col("violations") > 0, "critical").otherwise("ok"), text("violations"))), double.select(*checks.alert("duplicate_keys", "cur_prices", F.when(F.col("n") > 0, "critical").otherwise("ok"), text("n")))])
    try:
        checks.gate(alerts)
    except ValueError as stop:
        lineage.log_run(spark, log, run_id, "daily_prices", "failed", now, str(stop))
        raise
    bars = prices.select(F.col("symbol_id").alias("symbol"), F.col("date").cast("timestamp_ntz").alias("ts"), F.col("available_time").cast("timestamp_ntz").alias("available_time"), "close", F.col("volume").cast("double").alias("volume"))
    cells = bars.select("symbol").distinct().crossJoin(F.broadcast(asof.spine(f"{start} 00:00:00", f"{end} 00:00:00", "1 DAY", spark)))
    snapshots.symbols(cells, bars).write.mode("overwrite").parquet(f"{out_dir}/snap_symbol")
    lineage.log_run(spark, log, run_id, "daily_prices", "finished", now)
    return alerts


def signals(bars: DataFrame, fast: int = 5, slow: int = 10) -> DataFrame:
    """Scored, eligible signals with levels for every day of every symbol; filter by ts for one day.

    bars: symbol, ts, open, high, low, close, volume. Scoring is windowed, so a back-fill is the same plan.
    """
    f, c = ind.DEFAULT, F.col("close")
    t = ind.regime(ind.technical(bars, f), f, 20, 5)
    t = t.withColumns({"sma_fast": W.sma(c, f, fast), "sma_slow": W.sma(c, f, slow), "slope": F.col("slope_5"), "rsi": F.col("rsi_14"), "percent_b": F.col("bb_position"), "volume_ratio": F.try_divide("volume", W.rolling(F.avg, F.col("volume"), f, slow)), "atr_pct": F.try_divide("atr_14", "close")})
    return portfolio.levels(portfolio.rule_score(t), c, F.col("atr_14")).select("symbol", "ts", "regime", "trend_pts", "pullback_pts", "volume_pts", "volatility_pts", "score", "eligible", "confidence", "close", "stop_price", "target_1", "target_2")


def signal_run(spark: SparkSession, bars: DataFrame, out_dir: str, run_id: str, now: str, first: str, last: str | None = None, least_score: float = 0.0, top: int | None = None, strategy: str = "rules") -> DataFrame:
    """The filtered signals of a day, or of a range of days (a back-fill), written as blotters by date and returned.

    Scores of a day see the bars up to it alone, so a day gives the same alone or in a range. A date that is run again is
    replaced; dates without signals are left as they are. The run is logged with its end or its error.
    """
    log = f"{out_dir}/runs"
    lineage.log_run(spark, log, run_id, "signals", "started", now, f"{first} to {last or first}")
    try:
        rows = signals(bars).withColumn("date", F.to_date("ts")).where(F.col("date").between(F.lit(first).cast("date"), F.lit(last or first).cast("date")))
        chosen = portfolio.filtered_signals(rows, least_score, top=top, date="date")
        blotter = chosen.select("date", F.col("symbol").cast("string").alias("ticker"), F.lit("LONG").alias("direction"), "score", "trend_pts", "pullback_pts", "volume_pts", "volatility_pts", F.col("close").alias("entry_price"), "stop_price", "target_1", "target_2", "regime", "confidence", F.lit(strategy).alias("strategy_id"))
        ingest.write_blotter(blotter, f"{out_dir}/signals")
    except Exception as stop:
        lineage.log_run(spark, log, run_id, "signals", "failed", now, str(stop).split("\n")[0])
        raise
    lineage.log_run(spark, log, run_id, "signals", "finished", now)
    return blotter
