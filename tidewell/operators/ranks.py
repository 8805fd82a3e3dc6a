"""Order statistics of skewed and of large groups: prefix sums over distinct values, exact quantiles.

Values are counted first (combined in each task), then dealt into ranges of about equally many distinct values by a mergeable
sketch of each group, so that no task sorts a whole group, however large or skewed it is. Counts are written once and read
for edges, offsets and rows; where they are few, a plain window does the same in one step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import shared

#: Largest number of rows that may be sorted in one task.
FEW = 500_000


def prefix(counts: DataFrame, keys: Sequence[str], x: str, values: Sequence[str], ranges: int = 64, few: int = FEW) -> DataFrame:
    """counts (keys, x: one row for each value, values) with before_<v>: the sum of v over smaller x of the same keys."""
    counts = shared.pinned(counts)
    if counts.count() <= few:
        before = Window.partitionBy(*keys).orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumns({f"before_{v}": F.coalesce(F.sum(v).over(before), F.lit(0)) for v in values})
    # read twice: a second evaluation of the sketch may give other edges
    edges = shared.pinned(counts.groupBy(*keys).agg(F.array_distinct(F.percentile_approx(x, F.array(*[F.lit(i / ranges) for i in range(1, ranges)]), F.lit(1000))).alias("__e")))
    rows = counts.join(edges, list(keys)) if keys else counts.crossJoin(F.broadcast(edges))
    rows = rows.withColumn("__b", F.size(F.filter("__e", lambda e: e < F.col(x)))).drop("__e")
    own = [*keys, "__b"]
    ahead = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*own).agg(*[F.sum(v).alias(f"__{v}") for v in values]).select(*own, *[F.coalesce(F.sum(f"__{v}").over(ahead), F.lit(0)).alias(f"__{v}") for v in values])
    inside = Window.partitionBy(*own).orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(offsets, own)
    return rows.withColumns({f"before_{v}": F.col(f"__{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}).drop("__b", *[f"__{v}" for v in values])


def quantiles(df: DataFrame, keys: Sequence[str], x: str, shares: dict[str, float]) -> DataFrame:
    """keys, n (non-null values) and for each name the quantile of that share, interpolated between neighbours; exact."""
    counts = df.where(F.col(x).isNotNull()).groupBy(*keys, F.col(x).alias("__x")).agg(F.count("*").alias("t"))
    rows = prefix(counts, keys, "__x", ["t"])
    total = rows.groupBy(*keys).agg(F.sum("t").alias("n"))
    rows = rows.join(total, list(keys)) if keys else rows.crossJoin(F.broadcast(total))
    at = lambda i: F.max(F.when((F.col("before_t") <= i) & (i < F.col("before_t") + F.col("t")), F.col("__x")))
    place = {name: (F.col("n") - 1) * p for name, p in shares.items()}
    got = rows.groupBy(*keys, "n").agg(*[c for name, h in place.items() for c in (at(F.floor(h)).alias(f"__a_{name}"), at(F.ceil(h)).alias(f"__b_{name}"))])
    return got.select(*keys, "n", *[(F.col(f"__a_{name}") + (F.col(f"__b_{name}") - F.col(f"__a_{name}")) * (h - F.floor(h))).alias(name) for name, h in place.items()])
