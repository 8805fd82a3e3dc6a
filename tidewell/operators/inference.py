"""Inference on series: robust standard errors, bootstrap, permutation tests, stability of selection, mean correlation."""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, lgamma, log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import shared
from ..functions import windows as W
from ..functions.scalars import mixed
from . import evaluate, series


def t_tail(t: float, df: float) -> float:
    """Two-sided p of Student's t: the incomplete beta function by its continued fraction."""
    x, a, b = df / (df + t * t), df / 2, 0.5
    if not 0 < x < 1:
        return 1.0 if x >= 1 else 0.0
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x))

    def fraction(a: float, b: float, x: float) -> float:
        value = 1.0
        for m in range(300, 0, -1):
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
            value = 1 + odd / (1 + even / value)
        return 1 / value

    return front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


def lag_count(n: Column) -> Column:
    """Lags of the long-run covariance: floor(4 (n / 100) ** (2 / 9)); the ninth root of an exact power is not cut."""
    return F.floor(F.round(4 * F.pow(n / 100, 2 / 9), 9)).cast("int")


def newey_west(df: DataFrame, keys: Sequence[str], order: str, y: str, xs: Sequence[str], least: int = 20) -> DataFrame:
    """keys, term, beta, se, t, p, r2, n, lags: least squares with an intercept and standard errors that allow for
    heteroskedasticity and autocorrelation (Bartlett weights up to lag_count lags); up to `least` rows classical ones (lags 0).

    Coefficients come from one aggregate of products. With g = x e at each row (e: the residual), the long-run covariance is
    the sum of g g' and of g h' + h g', where h is the weighted sum of the earlier g: all lags are offsets of one window, and
    again one aggregate. Rows with a null in y or xs are left out before lags are taken; groups without more rows than terms,
    or with collinear terms, give none.
    """
    import numpy as np
    import pandas as pd

    names = ["alpha", *xs]
    k = len(names)
    rows = df.dropna(subset=[y, *xs]).select(*keys, order, y, *xs)
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in xs]]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col(y) * F.col(y)).alias("yy"), *[F.sum(x[i] * x[j]).alias(f"x{i}_{j}") for i, j in pairs], *[F.sum(x[i] * F.col(y)).alias(f"y{i}") for i in range(k)])
    symmetric = lambda row, tag: np.array([[row[f"{tag}{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float)

    def solve(batches):
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                a, v = symmetric(row, "x"), np.array([row[f"y{i}"] for i in range(k)], float)
                if row["n"] > k and np.linalg.matrix_rank(a) == k:
                    beta = np.linalg.solve(a, v)
                    sst = row["yy"] - v[0] ** 2 / row["n"]
                    out.append([*(row[c] for c in keys), row["n"], beta.tolist(), np.linalg.inv(a).ravel().tolist(), sst])
            yield pd.DataFrame(out, columns=[*keys, "n", "beta", "inv", "sst"])

    types = dict(rows.dtypes)
    key_types = "".join(f"`{c}` {types[c]}, " for c in keys)
    fitted = shared.pinned(sums.mapInPandas(solve, f"{key_types}n long, beta array<double>, inv array<double>, sst double"))
    fitted = fitted.withColumn("lags", F.when(F.col("n") > least, lag_count(F.col("n"))).otherwise(0))
    most = fitted.agg(F.max("lags")).first()[0] or 0
    one = fitted.select(*[F.col(c).alias(f"__key_{c}") for c in keys], "n", "beta", "lags")
    same = [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in keys]
    r = (rows.join(one, same) if keys else rows.crossJoin(F.broadcast(one))).withColumn("__e", F.col(y) - sum(F.col("beta")[i] * x[i] for i in range(k)))
    r = r.withColumns({f"__g{i}": x[i] * F.col("__e") for i in range(k)})
    w = Window.partitionBy(*keys).orderBy(order)
    weight = lambda lag: F.when(F.col("lags") >= lag, 1 - lag / (F.col("lags") + 1)).otherwise(0.0)
    r = r.withColumns({f"__h{i}": sum((weight(lag) * F.coalesce(F.lag(f"__g{i}", lag).over(w), F.lit(0.0)) for lag in range(1, most + 1)), F.lit(0.0)) for i in range(k)})
    g, h = (lambda i: F.col(f"__g{i}")), (lambda i: F.col(f"__h{i}"))
    moments = r.groupBy(*keys).agg(F.sum(F.col("__e") * F.col("__e")).alias("sse"), *[F.sum(g(i) * g(j) + g(i) * h(j) + h(i) * g(j)).alias(f"s{i}_{j}") for i, j in pairs])
    again = fitted.select(*[F.col(c).alias(f"__key_{c}") for c in keys], "n", "beta", "inv", "sst", "lags")
    both = moments.join(again, same) if keys else moments.crossJoin(F.broadcast(again))

    def errors(batches):
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                inv, beta, free = np.array(row["inv"], float).reshape(k, k), np.array(row["beta"], float), max(row["n"] - k, 1)
                cov = inv @ symmetric(row, "s") @ inv if row["n"] > least else inv * row["sse"] / free
                se = np.sqrt(np.abs(np.diag(cov)))
                for i, name in enumerate(names):
                    t = float(beta[i] / se[i]) if se[i] > 0 else None
                    out.append([*(row[c] for c in keys), name, beta[i], se[i], t, t_tail(t, free) if t is not None else None, 1 - row["sse"] / row["sst"] if row["sst"] > 0 else None, row["n"], row["lags"]])
            yield pd.DataFrame(out, columns=[*keys, "term", "beta", "se", "t", "p", "r2", "n", "lags"])

    return both.select(*keys, "n", "beta", "inv", "sst", "lags", "sse", *[f"s{i}_{j}" for i, j in pairs]).mapInPandas(errors, f"{key_types}term string, beta double, se double, t double, p double, r2 double, n long, lags int")


def bootstrap(df: DataFrame, keys: Sequence[str], order: str, ret: str = "ret", replicates: int = 500, block: int = 21, alpha: float = 0.05, seed: int = 0) -> DataFrame:
    """keys, replicates, low, high: percentiles (alpha, 1 - alpha) of the yearly Sharpe ratio over circular block-bootstrap
    replicates; block 1 draws single rows.

    A replicate is n / block blocks, the last one cut to n rows in all. Only the ends of blocks meet the series: with running
    sums of returns and of squares, a block's sums are differences of two of them (three where it wraps), so the work of a
    replicate is its number of blocks. Starts come from a seeded hash of replicate and block, the same for every series.
    """
    r = F.col(ret).cast("double")
    at = series.numbered(df.where(r.isNotNull()).select(*keys, order, ret), keys, [order], "__i", sums={"__a": r, "__b2": r * r})
    at = shared.pinned(at.select(*[F.col(c).alias(f"__key_{c}") for c in keys], (F.col("__i") + 1).alias("__p"), "__a", "__b2"))
    sizes = at.groupBy(*[f"__key_{c}" for c in keys]).agg(F.max("__p").alias("__n")).select(*[F.col(f"__key_{c}").alias(c) for c in keys], "__n")
    n = F.col("__n")
    grid = sizes.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / block))))
    start = mixed(F.col("rep"), F.col("blk"), F.lit(seed)) % n
    grid = grid.withColumns({"__start": start, "__end": start + F.least(F.lit(block).cast("long"), n - F.col("blk") * block)})
    end = lambda p, sign: F.struct(p.alias("p"), F.lit(sign).alias("s"))
    # a block may wrap more than once in a series shorter than a block: whole rounds count the series' last sums
    rounds = F.floor(F.col("__end") / n)
    ends = F.array(end(F.col("__start"), -1.0), F.struct(F.pmod("__end", n).alias("p"), F.lit(1.0).alias("s")), F.struct(n.alias("p"), rounds.cast("double").alias("s")))
    ends = grid.select(*keys, "__n", "rep", F.explode(ends).alias("e")).select(*keys, "__n", "rep", "e.p", "e.s").where("p > 0 AND s <> 0")
    same = [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in keys] + [F.col("p") == F.col("__p")]
    sums = ends.join(at.hint("shuffle_hash"), same).groupBy(*keys, "__n", "rep").agg(F.sum(F.col("s") * F.col("__a")).alias("__s1"), F.sum(F.col("s") * F.col("__b2")).alias("__s2"))
    mean = F.col("__s1") / n
    spread = F.sqrt(F.greatest((F.col("__s2") - F.col("__s1") * mean) / F.when(n > 1, n - 1), F.lit(0.0)))
    draws = sums.withColumn("s", F.when(spread > 1e-12, mean / spread * sqrt(W.YEAR)))
    return draws.groupBy(*keys).agg(F.count("*").alias("replicates"), F.percentile("s", F.lit(alpha)).alias("low"), F.percentile("s", F.lit(1 - alpha)).alias("high"))


def robustness_summary(df: DataFrame, keys: Sequence[str], order: str, ret: str = "ret", trials: int = 1, replicates: int = 500, block: int = 21) -> DataFrame:
    """keys, n, sharpe, deflated (the chance to beat the best of so many unskilled trials), low and high (bootstrap bounds) and
    robust: deflated over 0.95 and low over 0."""
    core = evaluate.deflated(evaluate.moments(df.where(F.col(ret).isNotNull()), keys, ret), trials).select(*keys, "n", "sharpe", "deflated")
    bounds = bootstrap(df, keys, order, ret, replicates, block).drop("replicates")
    got = core.join(bounds, list(keys), "left")
    return got.withColumn("robust", F.coalesce((F.col("deflated") > 0.95) & (F.col("low") > 0), F.lit(False)))


def permuted(df: DataFrame, at: str, n: str, salts: Sequence[str], name: str = "j", rounds: int = 6) -> DataFrame:
    """df with at (0 <= at < n) under a permutation of 0 .. n - 1 that is keyed by the salts (one or two columns of numbers).

    A Feistel network on the a x b grid with a = ceil(sqrt(n)) columns: in turn a function of the row moves the column and one
    of the column the row. What falls on a cell outside 0 .. n - 1 goes through again until it is inside, which keeps the map a
    permutation; fewer than a cells are outside.
    """
    side = F.ceil(F.sqrt(F.col(n))).cast("long")
    keyed = [F.col(c) for c in salts]
    rows = df.withColumn("__a", F.when(F.col(n) > 0, side)).withColumn("__b", F.ceil(F.col(n) / F.col("__a")).cast("long"))
    a, b = F.col("__a"), F.col("__b")

    def moved(v: Column) -> Column:
        cell = F.struct((v % a).alias("x"), F.floor(v / a).alias("y"))

        def one(s: Column, r: Column) -> Column:
            even = r % 2 == 0
            return F.struct(F.when(even, (s["x"] + mixed(s["y"], r, *keyed)) % a).otherwise(s["x"]).alias("x"), F.when(even, s["y"]).otherwise((s["y"] + mixed(s["x"], r, *keyed)) % b).alias("y"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), cell, one, lambda s: s["y"] * a + s["x"])

    # fewer than 64 cells are outside for n up to 4000; beyond, 64 misses in a row have a chance below 64 ** -64
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.col("__v"), lambda v, _: F.when(v < F.col(n), v).otherwise(moved(v)))
    # the first walk round by round, which is compiled; only what is still outside goes through the interpreted loop
    rows = rows.withColumns({"__x": F.col(at) % a, "__y": F.floor(F.col(at) / a)})
    for r in range(rounds):
        x, y, size = ("__x", "__y", a) if r % 2 == 0 else ("__y", "__x", b)
        rows = rows.withColumn(x, (F.col(x) + mixed(F.col(y), F.lit(r), *keyed)) % size)
    rows = rows.withColumn("__v", F.col("__y") * a + F.col("__x"))
    return rows.withColumn(name, F.when(F.col("__v") < F.col(n), F.col("__v")).otherwise(walked)).drop("__a", "__b", "__x", "__y", "__v")


def shuffle_test(df: DataFrame, keys: Sequence[str], order: str, signal: str, ret: str, replicates: int = 100, seed: int = 0) -> DataFrame:
    """keys, real, mean, std, z, p: mean of signal times return against replicates in which a series' returns are permuted;
    p counts replicates at least as good (to 12 digits).

    Rows are numbered once. Each replicate's permutation is a keyed bijection of the numbers, so nothing is sorted: signals go
    to the rows whose returns they get by a hash join. Rows with a null signal or return are left out first.
    """
    rows = series.numbered(df.where(F.col(signal).isNotNull() & F.col(ret).isNotNull()).select(*keys, order, signal, ret), keys, [order], "__i")
    rows = shared.pinned(rows.select(*keys, "__i", F.col(signal).alias("__s"), F.col(ret).alias("__r")))
    real = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.avg(F.col("__s") * F.col("__r")).alias("real"))
    side = real.select(*[F.col(c).alias(f"__key_{c}") for c in keys], "__n", "real")
    same = [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in keys]
    grid = (rows.join(side, same) if keys else rows.crossJoin(F.broadcast(side))).select(*keys, "__i", "__s", "__n", "real", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("rep"))
    made = permuted(grid.withColumn("__seed", F.lit(seed)), "__i", "__n", ["rep", "__seed"], "__j")
    other = rows.select(*[F.col(c).alias(f"__key_{c}") for c in keys], F.col("__i").alias("__k"), F.col("__r"))
    # a left join: for an inner one the optimiser would evaluate the permutation once more, in a filter on __j
    made = made.join(other.hint("shuffle_hash"), [*same, F.col("__j") == F.col("__k")], "left").groupBy(*keys, "rep").agg(F.avg(F.col("__s") * F.col("__r")).alias("m"), F.max("real").alias("real"))
    got = made.groupBy(*keys).agg(F.max("real").alias("real"), F.avg("m").alias("mean"), F.stddev_samp("m").alias("std"), ((F.count_if(F.round(F.col("m") - F.col("real"), 12) >= 0) + 1) / (F.count("*") + 1)).alias("p"))
    return got.withColumn("z", F.try_divide(F.col("real") - F.col("mean"), F.col("std")))


def stability_selection(df: DataFrame, row: str, y: str, xs: Sequence[str], top: int = 2, subsamples: int = 50, share: float = 0.5, seed: int = 0, keys: Sequence[str] = ()) -> DataFrame:
    """keys, feature, importance, selected, stable: the feature's absolute correlation with y over all rows, the share of
    subsamples in which it is among the `top` largest (ties: first by name), and whether that is at least one half.

    A row is in a subsample if a hash of its number (column row) and the subsample says so. All subsamples are one aggregate
    of sums of products, combined in each task; rows are not shuffled. Rows with a null in y or xs are left out.
    """
    inside = mixed(F.col(row), F.col("__s"), F.lit(seed)) % 1000 < int(round(share * 1000))
    rows = df.dropna(subset=[row, y, *xs]).withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(subsamples)))).where((F.col("__s") == 0) | inside)
    wide = rows.groupBy(*keys, "__s").agg(*[W.correlation(F.col(c).cast("double"), F.col(y).cast("double")).alias(f"__c{i}") for i, c in enumerate(xs)])
    each = wide.select(*keys, "__s", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.abs(F.col(f"__c{i}")), F.lit(0.0)).alias("c")) for i, c in enumerate(xs)])).alias("f")).select(*keys, "__s", "f.*")
    rank = F.row_number().over(Window.partitionBy(*keys, "__s").orderBy(F.desc(F.round("c", 9)), "feature"))
    got = each.withColumn("__in", (rank <= top).cast("double")).groupBy(*keys, "feature").agg(F.max(F.when(F.col("__s") == 0, F.col("c"))).alias("importance"), F.avg(F.when(F.col("__s") > 0, F.col("__in"))).alias("selected"))
    return got.withColumn("stable", F.coalesce(F.col("selected") >= 0.5, F.lit(False)))


def mean_correlation(df: DataFrame, name: str, date: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, name, mean_corr, market_corr: each series' mean correlation with the others, and the mean over all pairs.

    No pair is formed: with u the series less its mean, over the root of its sum of squares, and S the sum of all u of a date,
    the sum of u S over a series' dates is 1 plus its correlations with all others. A date that a series lacks counts as its
    mean; where all have the same dates, these are the usual correlations. Series that do not vary take no part; a single
    series has nulls. Names and dates have one row each.
    """
    group = Window.partitionBy(*keys, name)
    rows = df.where(F.col(x).isNotNull()).withColumn("__d", F.col(x) - F.avg(x).over(group)).withColumn("__q", F.sqrt(F.sum(F.col("__d") * F.col("__d")).over(group)))
    rows = rows.where("__q > 1e-12").select(*keys, name, date, (F.col("__d") / F.col("__q")).alias("__u"))
    total = rows.groupBy(*keys, date).agg(F.sum("__u").alias("__all"))
    each = rows.join(total, [*keys, date]).groupBy(*keys, name).agg(F.sum(F.col("__u") * F.col("__all")).alias("__p"))
    n = F.count("*").over(Window.partitionBy(*keys)) if keys else None
    if n is None:
        size = each.agg(F.count("*").alias("__n"), F.sum("__p").alias("__t"))
        each = each.crossJoin(F.broadcast(size))  # one row
    else:
        each = each.withColumns({"__n": n, "__t": F.sum("__p").over(Window.partitionBy(*keys))})
    others = F.when(F.col("__n") > 1, F.col("__n") - 1)
    return each.select(*keys, name, ((F.col("__p") - 1) / others).alias("mean_corr"), ((F.col("__t") - F.col("__n")) / (others * F.col("__n"))).alias("market_corr"))
