"""Point-in-time reads: as-of latest, groups and panels, look-back ranges, next events.

As-of reads at a time t see only facts with available_time <= t. They are planned as one union of spine and facts with a
running maximum by key, so facts and spine are shuffled once by key and never joined by inequality alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def available(df: DataFrame, t) -> DataFrame:
    """Rows available at a fixed time or column t."""
    return df.where(F.col("available_time") <= t)


def spine(start: str, end: str, step: str, spark) -> DataFrame:
    """asof_ts from start to end (inclusive) by a step such as '1 day'."""
    return spark.sql(f"SELECT explode(sequence(TIMESTAMP_NTZ '{start}', TIMESTAMP_NTZ '{end}', INTERVAL {step})) AS asof_ts")


def latest(cells: DataFrame, facts: DataFrame, key: str, order: Sequence[str], values: Sequence[str], t: str = "asof_ts", known: str = "available_time") -> DataFrame:
    """cells (key, t) with the values of the fact that is greatest by order among those known at t; null if none.

    Ties in order are broken by the values. Facts with a null key or known time are never seen; repeated cells stay.
    """
    names = [f"__o{i}" for i in range(len(order))]
    best = F.struct(*[F.col(c).alias(n) for c, n in zip(order, names, strict=True)], *values)
    right = facts.where(F.col(key).isNotNull() & F.col(known).isNotNull()).select(F.col(key), F.col(known).alias("__t"), best.alias("__best"))
    left = cells.select(F.col(key), F.col(t).alias("__t"), F.lit(True).alias("__cell"))
    both = left.unionByName(right, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("__best", F.max("__best").over(w)).where("__cell")
    return seen.select(key, F.col("__t").alias(t), *[F.col(f"__best.{v}").alias(v) for v in values])


def latest_group(cells: DataFrame, facts: DataFrame, key: str, period: str, t: str = "asof_ts", known: str = "available_time") -> DataFrame:
    """cells with every fact of the key's latest period known at t (rows that were known at t only)."""
    at = latest(cells, facts, key, [period], [period], t, known)
    rows = facts.withColumnRenamed(known, "__known")
    return at.join(rows, [key, period]).where(F.col("__known") <= F.col(t)).drop("__known")


def panel(times: DataFrame, facts: DataFrame, series: str, period: str, value: str, t: str = "asof_ts", known: str = "available_time") -> DataFrame:
    """(t, panel): a map from each series to its value of the latest period known at t; later vintages win ties.

    A row holds all series: for a short list of macro series. Where there are many, use latest and keep long rows.
    """
    cells = times.crossJoin(facts.select(series).distinct())
    got = latest(cells, facts.withColumn("__v", F.col(known)), series, [period, "__v"], [value], t, known)
    return got.where(F.col(value).isNotNull()).groupBy(t).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(series).cast("string"), value)))).alias("panel"))


def look_back(cells: DataFrame, facts: DataFrame, key: str | None, seconds: int, event: str = "ts", t: str = "asof_ts", known: str = "available_time") -> DataFrame:
    """Pairs of a cell and a fact of its key with t - seconds <= event <= t and known <= t.

    Facts are put in buckets of the window's length; a cell looks in the two buckets that its window touches.
    """
    epoch = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    bucket = lambda e: F.floor(e / seconds)
    left = cells.withColumn("__b", F.explode(F.array_distinct(F.array(bucket(epoch(t)), bucket(epoch(t) - seconds)))))
    right = facts.withColumn("__b", bucket(epoch(event)))
    on = ["__b"] + ([key] if key else [])
    lower = F.col(t) - F.expr(f"make_dt_interval(0, 0, 0, {seconds})")
    return left.join(right, on).where((F.col(event) <= F.col(t)) & (F.col(event) >= lower) & (F.col(known) <= F.col(t))).drop("__b")


def next_after(cells: DataFrame, facts: DataFrame, key: str, date: str, t: str = "asof_ts") -> DataFrame:
    """cells with the first date after t of their key (no availability rule) and the days until then. A date of t itself comes
    behind the cell in the order of the rows, however they arrive."""
    right = facts.select(F.col(key), F.col(date).cast("timestamp_ntz").alias("__t"), F.col(date).alias("__d"))
    left = cells.select(F.col(key), F.col(t).cast("timestamp_ntz").alias("__t"), F.col(t), F.lit(True).alias("__cell"))
    both = left.unionByName(right, allowMissingColumns=True)
    seen = both.withColumn("next_date", F.min(F.when(F.col("__d").isNotNull(), F.col("__d"))).over(Window.partitionBy(key).orderBy(F.col("__t").desc(), F.col("__cell").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)))
    return seen.where("__cell").select(key, t, F.when(F.col("next_date") > F.to_date(t), F.col("next_date")).alias("next_date")).withColumn("days_until", F.datediff("next_date", F.to_date(t)))


def point_in_time(facts: DataFrame, dates: DataFrame, keys: Sequence[str], filed: str, sequence: Sequence[str], date: str = "as_of") -> DataFrame:
    """For each date the latest filing on or before it of each key (last by filed and sequence)."""
    rows = facts.withColumn("__key", F.struct(*keys))
    cells = rows.select("__key").distinct().crossJoin(F.broadcast(dates.select(date).distinct()))
    values = [c for c in facts.columns if c not in keys]
    got = latest(cells, rows, "__key", [filed, *sequence], values, t=date, known=filed)
    return got.where(F.col(filed).isNotNull()).select(date, *[F.col(f"__key.{k}").alias(k) for k in keys], *values)


def lateral_actions(prices: DataFrame, actions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """prices with the largest split and the summed dividends of the same keys that were available by then."""
    a = actions.select(*keys, F.col("available_time").alias("__a"), "kind", "amount")
    known = F.col("__a") <= F.col("available_time")
    joined = prices.join(a, list(keys), "left")
    group = [c for c in prices.columns]
    return joined.groupBy(*group).agg(F.max(F.when(known & (F.col("kind") == "split"), F.col("amount"))).alias("split"), F.sum(F.when(known & (F.col("kind") == "dividend"), F.col("amount"))).alias("dividend"))


def resolve_renames(edges: DataFrame, depth: int = 16) -> DataFrame:
    """edges (old, new, factor) -> (ticker, current, steps, factor): each old name's current name, cycles cut.

    Doubling joins: each round composes all paths with themselves, so depth grows as a power of two.
    """
    paths = edges.select(F.col("old").alias("ticker"), F.col("new").alias("current"), F.lit(1).alias("steps"), F.coalesce("factor", F.lit(1.0)).alias("factor"))
    for _ in range(max(1, depth.bit_length())):
        nxt = paths.select(F.col("ticker").alias("current"), F.col("current").alias("__c"), F.col("steps").alias("__s"), F.col("factor").alias("__f"))
        go = F.col("__c").isNotNull() & (F.col("__c") != F.col("ticker"))
        paths = paths.join(nxt, "current", "left").select("ticker", F.when(go, F.col("__c")).otherwise(F.col("current")).alias("current"), F.when(go, F.col("steps") + F.col("__s")).otherwise(F.col("steps")).alias("steps"), F.when(go, F.col("factor") * F.col("__f")).otherwise(F.col("factor")).alias("factor"))
    return paths


def reconcile(system: DataFrame, broker: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(symbol, issue, severity, system_qty, broker_qty): differences of two position tables (symbol, qty)."""
    j = system.select("symbol", F.col("qty").alias("system_qty")).join(broker.select("symbol", F.col("qty").alias("broker_qty")), "symbol", "full_outer")
    gap = F.abs(F.col("system_qty") - F.col("broker_qty"))
    issue = lambda name, severity: F.struct(F.lit(name).alias("issue"), severity.alias("severity"))
    size = F.when(gap > 1, "CRITICAL").otherwise("WARNING")
    found = F.array(F.when(F.col("system_qty").isNull(), issue("MISSING_IN_SYSTEM", F.lit("CRITICAL"))), F.when(F.col("broker_qty").isNull(), issue("MISSING_IN_BROKER", F.lit("CRITICAL"))), F.when(gap > tolerance, issue("QTY_MISMATCH", size)), F.when(F.signum("system_qty") * F.signum("broker_qty") < 0, issue("SIDE_MISMATCH", F.lit("CRITICAL"))))
    return j.withColumn("x", F.explode(F.filter(found, lambda v: v.isNotNull()))).select("symbol", "x.issue", "x.severity", "system_qty", "broker_qty")


def upsert(existing: DataFrame, new: DataFrame, key: Sequence[str], version: Column | None = None) -> DataFrame:
    """Last writer wins: one row for each key, from new if it has the key. version orders rows of the same side."""
    order = [F.desc("__side")] + ([version.desc_nulls_last()] if version is not None else [])
    both = existing.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(*order, *[F.desc(c) for c in existing.columns if c not in key])
    return both.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__side")


def insert_ignore(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The existing row wins; repeated new keys go in once."""
    return existing.unionByName(new.join(existing, list(key), "left_anti").dropDuplicates(list(key)))


def dimension(existing: DataFrame, rows: DataFrame, natural: Sequence[str], id_name: str) -> DataFrame:
    """Get-or-create: existing rows and one for each new natural key; the id is a hash of that key."""
    fresh = rows.select(*natural).distinct().join(existing, list(natural), "left_anti")
    made = fresh.withColumn(id_name, F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in natural]), 256))
    return existing.unionByName(made, allowMissingColumns=True)


def delisted(bars: DataFrame, key: str = "symbol", date: str = "ts", days: int = 30) -> DataFrame:
    """First and last date of each key, and whether the last is more than so many days before the table's last."""
    per = bars.groupBy(key).agg(F.min(date).alias("start_date"), F.max(date).alias("last_date"))
    end = bars.agg(F.max(date).alias("__end"))
    gone = F.datediff("__end", "last_date") > days
    return per.crossJoin(F.broadcast(end)).select(key, "start_date", gone.alias("is_delisted"), F.when(gone, F.col("last_date")).alias("end_date"))


def recent(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The n last rows of each key by order (all columns of order descending)."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def sampled(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in the order of the MD5 of seed and key (as text): the same rows on every run and in any engine."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
