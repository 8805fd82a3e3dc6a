"""Quality flags, validators and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import asof, ranks


def ohlcv_flag(o: Column, h: Column, lo: Column, c: Column, v: Column) -> Column:
    """The first that holds: negative_price, ohlc_error, negative_volume, invalid_price, zero_volume; else ok."""
    negative = reduce(Column.__or__, [F.coalesce(x < 0, F.lit(False)) for x in (o, h, lo, c)])
    broken = F.coalesce((h < lo) | (h < F.greatest(o, c)) | (lo > F.least(o, c)), F.lit(False))
    return F.when(negative, "negative_price").when(broken, "ohlc_error").when(v < 0, "negative_volume").when(c.isNull() | (c <= 0), "invalid_price").when(v == 0, "zero_volume").otherwise("ok")


def range_flag(x: Column, low: float | None = None, high: float | None = None, missing: str = "missing_value", out: str = "out_of_range") -> Column:
    """missing, out of range or ok: the flag rule of most curated tables."""
    flag = F.when(x.isNull(), missing)
    if low is not None:
        flag = flag.when(x < low, out)
    if high is not None:
        flag = flag.when(x > high, out)
    return flag.otherwise("ok")


def normalized_price(price: Column) -> Column:
    """Prices above 1 are percentages."""
    return F.when(price > 1, price / 100).otherwise(price)


def violations(rules: dict[str, Column]) -> Column:
    """Names of the rules that do not hold; a rule that is null does not hold."""
    named = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    return F.filter(named, lambda v: v.isNotNull())


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with their violations."""
    judged = df.withColumn("violations", violations(rules))
    return judged.where(F.size("violations") == 0).drop("violations"), judged.where(F.size("violations") > 0)


def price_rules() -> dict[str, Column]:
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return {"ticker_length": F.length(F.col("ticker")).between(1, 20), "low_le_high": lo <= h, "open_in_range": (lo <= o) & (o <= h), "close_in_range": (lo <= c) & (c <= h), "non_negative": (lo >= 0) & (F.col("volume") >= 0)}


def ohlc_report(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of broken bars and totals, by keys or for the whole table."""
    o, h, lo, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    n = lambda x, name: F.count_if(x).alias(name)
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), n((h < lo) | (h < o) | (h < c) | (lo > o) | (lo > c), "logic_violations"), n((o < 0) | (h < 0) | (lo < 0) | (c < 0), "negative_prices"), n(v < 0, "negative_volume"), F.avg(v).alias("avg_volume"), (F.max(h) - F.min(lo)).alias("price_range"))


def observation_report(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Null keys, dates that are no date, valid and null values of a text table."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"), F.count_if(F.expr(f"try_to_timestamp({date}) IS NULL")).alias("bad_dates"), F.count_if(F.col(value).try_cast("double").isNotNull()).alias("valid_values"), F.count_if(F.col(value).try_cast("double").isNull()).alias("null_values"))


def alert(check: str, table: str, severity: Column, message: Column) -> list[Column]:
    return [F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), severity.alias("severity"), message.alias("message")]


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of facts that the dimension lacks."""
    return facts.select(key).where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti").distinct()


def time_order(df: DataFrame, event: str = "event_time", available: str = "available_time") -> DataFrame:
    """Rows, and those that are available before they happen."""
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col(available) < F.col(event)).alias("violations"))


def coverage_sanity(df: DataFrame, price: str, volume: str) -> DataFrame:
    return df.agg(F.count_if(F.col(volume) < 0).alias("negative_volume"), F.count_if(F.col(price) < 0).alias("negative_price"), F.count_if(~F.col(price).between(0, 1)).alias("outside_unit"))


def look_ahead(snapshots: DataFrame, facts: DataFrame, key: str, seen: str = "asof_ts") -> DataFrame:
    """Snapshots with a fact of the same key that had happened but was not available: ts <= asof < available_time."""
    cells = snapshots.select(key, seen).distinct()
    last = asof.latest(cells, facts, key, ["available_time"], ["available_time"], t=seen, known="ts")
    return snapshots.join(last.where(F.col("available_time") > F.col(seen)).select(key, seen), [key, seen], "left_semi").select(*snapshots.columns)


def staleness(df: DataFrame, ts: str, now: str, limit_hours: float, keys: Sequence[str] = ()) -> DataFrame:
    """Hours since the latest row and a severity: critical over twice the limit, warning over it, error without rows."""
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.max(ts).cast("timestamp"))) / 3600
    return df.groupBy(*keys).agg(age.alias("age_hours")).withColumn("severity", F.when(F.col("age_hours").isNull(), "error").when(F.col("age_hours") > 2 * limit_hours, "critical").when(F.col("age_hours") > limit_hours, "warning").otherwise("ok"))


def completeness(df: DataFrame, columns: Sequence[str], least: float = 0.95) -> DataFrame:
    """One row for each column: its share of non-null values and whether that is below least."""
    got = df.agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    return got.unpivot([], list(columns), "column_name", "completeness").withColumn("flagged", F.col("completeness") < least)


def mad_anomalies(df: DataFrame, keys: Sequence[str], value: str, least: int = 20, limit: float = 4.0) -> DataFrame:
    """Rows whose modified z-score (0.6745 |x - median| / MAD) within their keys' group is over the limit."""
    first = ranks.quantiles(df, keys, value, {"med": 0.5}).where(F.col("n") >= least)
    dev = df.join(first, list(keys)).withColumn("dev", F.abs(F.col(value) - F.col("med")))
    second = ranks.quantiles(dev, keys, "dev", {"mad": 0.5}).where("mad > 0").drop("n")
    return dev.join(second, list(keys)).withColumn("score", 0.6745 * F.col("dev") / F.col("mad")).where(F.col("score") > limit).drop("dev", "n")


def latency_stats(df: DataFrame, keys: Sequence[str], event: str, available: str) -> DataFrame:
    """Lag in minutes (lags of at least 0): count, mean, deviation, median, 90th and 95th percentile."""
    lag = (F.unix_timestamp(F.col(available).cast("timestamp")) - F.unix_timestamp(F.col(event).cast("timestamp"))) / 60
    rows = df.withColumn("lag", lag).where("lag >= 0")
    got = rows.groupBy(*keys).agg(F.avg("lag").alias("mean_min"), F.stddev_samp("lag").alias("std_min"))
    q = ranks.quantiles(rows, keys, "lag", {"p50": 0.5, "p90": 0.9, "p95": 0.95})
    both = got.join(q, list(keys)) if keys else got.crossJoin(F.broadcast(q))
    return both.select(*keys, "n", "mean_min", "std_min", "p50", "p90", "p95")


def latency_or(stats: DataFrame, fallback: float, now: str, least: int = 500, hours: int = 24, column: str = "p90") -> DataFrame:
    """The latest statistic of each source, or the fallback if it has too few rows or is too old."""
    last = stats.groupBy("source").agg(F.max_by(F.struct(column, "n", "computed_at"), "computed_at").alias("s"))
    fresh = (F.col("s.n") >= least) & (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("s.computed_at").cast("timestamp")) <= hours * 3600)
    return last.select("source", F.when(fresh, F.col(f"s.{column}")).otherwise(fallback).alias("latency_min"))


def coverage_metrics(df: DataFrame, chosen: Column, volume: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows and of volume that is chosen."""
    v = F.coalesce(volume, F.lit(0.0))
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(chosen.cast("double")).alias("count_share"), F.try_divide(F.sum(F.when(chosen, v).otherwise(0.0)), F.sum(v)).alias("volume_share"))


def freshness(latest: DataFrame, slas: DataFrame, now: str) -> DataFrame:
    """Sources (source, last_updated) older than their limit (source, sla_seconds, action); both small by nature."""
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.col("last_updated").cast("timestamp"))
    return slas.join(latest, "source", "left").withColumn("age_s", age).where(F.col("age_s").isNull() | (F.col("age_s") > F.col("sla_seconds")))


def future_data(df: DataFrame, keys: Sequence[str], seq: str, ts: str, target: str) -> DataFrame:
    """By keys: rows out of time order along seq, repeated times, and whether the last row has a target already."""
    w = Window.partitionBy(*keys).orderBy(seq)
    return df.withColumn("__prev", F.lag(ts).over(w)).groupBy(*keys).agg(F.count_if(F.col("__prev") > F.col(ts)).alias("unsorted"), (F.count(ts) - F.count_distinct(ts)).alias("repeated"), F.max_by(F.col(target).isNotNull(), seq).alias("last_has_target"))


def content_hash(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A hash of the rows without regard to their order: row count and the sum of row hashes. Grows by adding tables."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).cast("decimal(38,0)").alias("content_hash"))


def table_stats(df: DataFrame, name: str, date: str) -> DataFrame:
    return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"), F.min(date).cast("string").alias("first"), F.max(date).cast("string").alias("last"))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """By table: open critical, error and warning alerts and the time of the latest open one. alerts: table_name, severity,
    created_at, resolved_at (null while open)."""
    still = F.col("resolved_at").isNull()
    return alerts.groupBy("table_name").agg(*[F.count_if(still & (F.col("severity") == s)).alias(f"{s}_alerts") for s in ("critical", "error", "warning")], F.max(F.when(still, F.col("created_at"))).alias("latest_alert_at"))


def staleness_summary(rows: DataFrame) -> DataFrame:
    """The checks of each table's latest checked_at (all, if several), with status CRITICAL above twice the threshold, WARNING above
    it, else OK. The latest times are aggregated first, so a long history of one table stays spread out."""
    last = rows.groupBy("table_name").agg(F.max("checked_at").alias("checked_at"))
    hours, limit = F.col("staleness_hours"), F.col("threshold_hours")
    return rows.join(last, ["table_name", "checked_at"], "left_semi").withColumn("status", F.when(hours > limit * 2, "CRITICAL").when(hours > limit, "WARNING").otherwise("OK"))


def suite(parts: Sequence[DataFrame]) -> DataFrame:
    """All checks as rows (check_name, table_name, severity, message)."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def gate(alerts: DataFrame) -> None:
    """Raises if any alert is critical."""
    worst = alerts.where("severity = 'critical'").limit(1).collect()
    if worst:
        raise ValueError(f"critical data-quality alert: {worst[0]['check_name']} on {worst[0]['table_name']}: {worst[0]['message']}")
