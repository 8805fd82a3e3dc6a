"""Long series over many tasks: row numbers, as-of reads and first hits without one task for a hot series.

A series with more than its share of all rows is dealt into ranges of its order; what a range needs of those before it (a
count, a best value) is one row a range. First hits go through blocks of rows with their extremes, level over level, so that a
search reads a few blocks instead of all later rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dealt(df: DataFrame, keys: Sequence[str], order: str, tasks: int | None = None, name: str = "__b") -> DataFrame:
    """df with the number of each row's range (by order) within its series: 0 for series of at most a share of 1 / tasks of
    all rows, which are not split.

    Fewer than `tasks` series are larger than that, and their edges (at most `tasks` numbers each) are broadcast. Rows that are
    equal in order are in one range. tasks is twice the number of shuffle partitions by default.
    """
    tasks = tasks or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    total = per.agg(F.sum("__n")).first()[0] or 0
    hot = per.where(F.col("__n") > total / tasks).select(*keys)  # fewer than tasks rows
    cuts = F.percentile_approx(order, F.array(*[F.lit(i / tasks) for i in range(1, tasks)]), F.lit(20 * tasks))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = lambda side: df.alias("a").join(F.broadcast(side.alias("b")), same, "left")
    mine = df.alias("a").join(F.broadcast(hot.alias("b")), same, "left_semi")
    edges = mine.groupBy(*keys).agg(F.array_distinct(cuts).alias("__e"))
    at = F.coalesce(F.size(F.filter("b.__e", lambda e: e < F.col(f"a.{order}"))), F.lit(0))
    return both(edges).select("a.*", F.when(F.col("b.__e").isNull(), 0).otherwise(at).alias(name))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "i", tasks: int | None = None, sums: dict[str, Column] | None = None) -> DataFrame:
    """df with the row's number (long, from 0) in its series by order, and for each of sums the running sum of a column up to
    and with the row (nulls add nothing). The first column of order deals out hot series."""
    sums = sums or {}
    rows = dealt(df.withColumns({f"__s_{k}": c for k, c in sums.items()}) if sums else df, keys, order[0], tasks)
    own = [*keys, "__b"]
    ahead = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*own).agg(F.count("*").alias("__n"), *[F.sum(f"__s_{k}").alias(f"__s_{k}") for k in sums])
    before = before.select(*own, *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(c) for c in ("__n", *(f"__s_{k}" for k in sums))])
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"o.{k}")) for k in own]
    w = Window.partitionBy(*[F.col(f"a.{k}") for k in own]).orderBy(*[F.col(f"a.{c}") for c in order])
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    running = [(F.col(f"o.__s_{k}") + F.coalesce(F.sum(f"a.__s_{k}").over(upto), F.lit(0))).alias(k) for k in sums]
    return rows.alias("a").join(before.alias("o"), same).select(*[F.col(f"a.{c}") for c in df.columns], (F.col("o.__n") + F.row_number().over(w) - 1).alias(name), *running)


def latest(cells: DataFrame, facts: DataFrame, key: str, order: Sequence[str], values: Sequence[str], t: str = "asof_ts", known: str = "available_time", tasks: int | None = None) -> DataFrame:
    """asof.latest with hot series dealt into ranges of time: each range hands its best fact to those after it."""
    names = [f"__o{i}" for i in range(len(order))]
    best = F.struct(*[F.col(c).alias(n) for c, n in zip(order, names, strict=True)], *values)
    right = facts.where(F.col(key).isNotNull() & F.col(known).isNotNull()).select(F.col(key), F.col(known).alias("__t"), best.alias("__best"))
    left = cells.select(F.col(key), F.col(t).alias("__t"), F.lit(True).alias("__cell"))
    rows = dealt(left.unionByName(right, allowMissingColumns=True), [key], "__t", tasks)
    ahead = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(key, "__b").agg(F.max("__best").alias("__last")).select(key, "__b", F.max("__last").over(ahead).alias("__carry"))
    w = Window.partitionBy(key, "__b").orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("__best", F.max("__best").over(w)).where("__cell")
    got = seen.alias("s").join(carry.alias("c"), F.col(f"s.{key}").eqNullSafe(F.col(f"c.{key}")) & (F.col("s.__b") == F.col("c.__b")), "left")
    got = got.select(F.col(f"s.{key}"), F.col("s.__t").alias(t), F.greatest("s.__best", "c.__carry").alias("__best"))
    return got.select(key, t, *[F.col(f"__best.{v}").alias(v) for v in values])


def first_hit(queries: DataFrame, points: DataFrame, keys: Sequence[str], level: str, x: str = "x", at: str = "i", name: str = "hit", block: int = 32) -> DataFrame:
    """queries with the number of the first later row of their series whose x is at least the query's level; null if none.

    points: keys, at (row numbers 0, 1, ... without gaps), x. Rows are put in blocks of `block`, these in blocks of blocks and
    so on; each block lists its parts' largest x. A query looks to the right in its own block, then in its block's block, until
    a part reaches its level, and from there down to the row: two joins a level, each by series and block. Null x and null
    levels are never hit.
    """
    top = points.agg(F.max(at)).first()[0]
    names = [f"__k{i}" for i in range(len(keys))]
    level_rows = points.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(at).cast("long").alias("__p"), F.col(x).cast("double").alias("__x"))
    levels = []
    while top is not None:
        parts = level_rows.groupBy(*names, F.floor(F.col("__p") / block).alias("__q")).agg(F.sort_array(F.collect_list(F.struct("__p", "__x"))).alias("__a"))  # block parts at most
        levels.append(parts.withColumn("__a", F.transform("__a", lambda s: F.coalesce(s["__x"], F.lit(float("-inf"))))))
        level_rows = levels[-1].select(*names, F.col("__q").alias("__p"), F.array_max("__a").alias("__x"))
        top = top // block
        if not top:
            break
    # __c: the next row, then block, to look at; __f: the level at which the search turned down, or null
    rows = queries.withColumns({"__c": F.col(at).cast("long") + 1, "__l": F.col(level).cast("double"), "__f": F.lit(None).cast("int")})

    def probe(rows: DataFrame, parts: DataFrame, active: Column, q: Column, first: Column) -> DataFrame:
        """rows with __hit: the first part of block q, from `first` on, that reaches the level; null for the inactive."""
        rows = rows.withColumns({"__q": F.when(active, q).otherwise(-1 - F.col("__c")), "__k": first})  # the others spread over no block
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"p.{n}")) for k, n in zip(keys, names, strict=True)] + [F.col("r.__q") == F.col("p.__q")]
        place = F.array_position(F.transform("p.__a", lambda v, k: (k >= F.col("r.__k")) & (v >= F.col("r.__l"))), F.lit(True))
        return rows.alias("r").join(parts.alias("p"), same, "left").select("r.*", F.when(place > 0, F.col("r.__q") * block + place - 1).alias("__hit"))

    for n, parts in enumerate(levels):
        up, here = F.col("__f").isNull(), F.floor(F.col("__c") / block)
        j = probe(rows, parts, up, here, F.col("__c") % block)
        took = F.col("__hit").isNotNull()
        rows = j.select(*queries.columns, "__l", F.when(took, F.col("__hit")).when(up, here + 1).otherwise(F.col("__c")).alias("__c"), F.when(took, n).otherwise(F.col("__f")).alias("__f"))
    for n in range(len(levels) - 2, -1, -1):
        j = probe(rows, levels[n], F.coalesce(F.col("__f") > n, F.lit(False)), F.col("__c"), F.lit(0))
        rows = j.select(*queries.columns, "__l", "__f", F.coalesce("__hit", "__c").alias("__c"))
    return rows.select(*queries.columns, F.when(F.col("__f").isNotNull(), F.col("__c")).alias(name))


def first_from(cells: DataFrame, facts: DataFrame, keys: Sequence[str], start: str, at: str, value: str, tasks: int | None = None) -> DataFrame:
    """cells (keys, start) with the least value of their series' facts with at >= start; null if none. Hot series are dealt
    into ranges, and each range hands its least value to those before it."""
    left = cells.select(*keys, F.col(start).cast("long").alias("__t"), F.lit(True).alias("__cell"))
    rows = dealt(left.unionByName(facts.select(*keys, F.col(at).cast("long").alias("__t"), F.col(value).alias("__v")), allowMissingColumns=True), keys, "__t", tasks)
    own = [*keys, "__b"]
    behind = Window.partitionBy(*keys).orderBy("__b").rowsBetween(1, Window.unboundedFollowing)
    carry = rows.groupBy(*own).agg(F.min("__v").alias("__m")).select(*own, F.min("__m").over(behind).alias("__carry"))
    w = Window.partitionBy(*own).orderBy("__t").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    seen = rows.withColumn("__v", F.min("__v").over(w)).where("__cell")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in own]
    return seen.alias("s").join(carry.alias("c"), same, "left").select(*[F.col(f"s.{k}") for k in keys], F.col("s.__t").alias(start), F.least("s.__v", "c.__carry").alias(value))
