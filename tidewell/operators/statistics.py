"""Statistics of series and tables that need more than one pass."""

from __future__ import annotations

from collections.abc import Sequence
from math import log, pi, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows as W
from ..functions.windows import Frame
from .evaluate import bounded, erf_cdf
from .ranks import prefix


def hurst(df: DataFrame, x: Column, f: Frame, longest: int = 100, least: int = 5) -> DataFrame:
    """hurst by key: slope of ln(population deviation of x[t] - x[t - L]) on ln L over L = 2..longest.

    Lags are offsets of one window, so the series is sorted once; a lag needs two differences and a positive deviation.
    """
    lags = range(2, longest + 1)
    cols = [(x - F.lag(x, n).over(f.spec)).alias(f"d{n}") for n in lags]
    dev = df.select(*f.keys, *cols).groupBy(*f.keys).agg(*[F.when(F.count(f"d{n}") > 1, F.stddev_pop(f"d{n}")).alias(f"d{n}") for n in lags])
    long = dev.unpivot(list(f.keys), [f"d{n}" for n in lags], "lag", "dev").where("dev > 0")
    n = F.regexp_replace("lag", "d", "").cast("double")
    return long.groupBy(*f.keys).agg(F.count("*").alias("n_lags"), F.regr_slope(F.ln("dev"), F.ln(n)).alias("slope")).select(*f.keys, "n_lags", F.when(F.col("n_lags") >= least, F.col("slope")).alias("hurst"))


def ewm_correlation(df: DataFrame, a: str, b: str, f: Frame, span: int = 60) -> DataFrame:
    """corr by key of the last row: exponentially weighted (span), from weighted moments by the row's age."""
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    age = F.row_number().over(Window.partitionBy(*f.keys).orderBy(*[F.desc(c) for c in f.order])) - 1
    w = F.pow(F.lit(1 - 2 / (span + 1)), age.cast("double"))
    s = rows.withColumns({"__w": w}).groupBy(*f.keys).agg(F.sum("__w").alias("w"), *[F.sum(F.col("__w") * e).alias(n) for n, e in (("x", F.col(a)), ("y", F.col(b)), ("xx", F.col(a) * F.col(a)), ("yy", F.col(b) * F.col(b)), ("xy", F.col(a) * F.col(b)))])
    m = lambda n: F.col(n) / F.col("w")
    cov, vx, vy = m("xy") - m("x") * m("y"), m("xx") - m("x") * m("x"), m("yy") - m("y") * m("y")
    return s.select(*f.keys, F.when((vx > 0) & (vy > 0), cov / F.sqrt(vx * vy)).alias("corr"))


def chi2_tail(x: Column, df: Column) -> Column:
    """P(X > x) of a chi-square variable with df = 1, 2, ... degrees of freedom; null for none. Terms go by logarithms."""
    half, odd = F.greatest(x, F.lit(0.0)) / 2, df % 2 == 1
    first = F.when(odd, F.log(half) / 2 - 0.5 * log(pi / 4)).otherwise(F.lit(0.0))
    step = lambda i: F.log(half) - F.log(i + F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0)))
    start = F.struct(first.alias("t"), F.when(odd & (df < 3), F.lit(0.0)).otherwise(F.exp(first - half)).alias("s"))
    more = F.when(df >= 4, F.sequence(F.lit(1), (F.floor(df / 2) - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    added = F.aggregate(more, start, lambda a, i: F.struct((a["t"] + step(i)).alias("t"), (a["s"] + F.exp(a["t"] + step(i) - half)).alias("s")), lambda a: a["s"])
    tail = added + F.when(odd, 2 * (1 - erf_cdf(F.sqrt(2 * half)))).otherwise(F.lit(0.0))
    return F.when(x.isNotNull() & (df >= 1), F.when(half > 0, tail).otherwise(F.lit(1.0)))


def kruskal(df: DataFrame, group: str, x: str, keys: Sequence[str] = (), least: int = 5) -> DataFrame:
    """Kruskal-Wallis H over groups of at least so many values, with tie correction, and its chi-square p.

    Ranks come from counts of distinct values in ranges (ranks.prefix), so no task sorts all values of a key.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(group).isNotNull())
    big = rows.groupBy(*keys, group).agg(F.count("*").alias("__c")).where(F.col("__c") >= least).select(*keys, group)
    rows = rows.join(big, [*keys, group], "left_semi")
    counts = rows.groupBy(*keys, x).agg(F.count("*").alias("t"))
    ranked = prefix(counts, keys, x, ["t"]).withColumn("rank", F.col("before_t") + (F.col("t") + 1) / 2).drop("before_t")
    ties = ranked.groupBy(*keys).agg(F.sum("t").alias("N"), F.sum(F.pow("t", 3) - F.col("t")).alias("ties"))
    per = rows.join(ranked.drop("t"), [*keys, x]).groupBy(*keys, group).agg(F.count("*").alias("n"), F.sum("rank").alias("r"))
    per = per.groupBy(*keys).agg(F.count("*").alias("groups"), F.sum(F.col("r") * F.col("r") / F.col("n")).alias("rr"))
    j = per.join(ties.withColumnRenamed("N", "total"), list(keys)) if keys else per.crossJoin(F.broadcast(ties.withColumnRenamed("N", "total")))
    n = F.col("total")
    h = (12 / (n * (n + 1)) * F.col("rr") - 3 * (n + 1)) / F.nullif(1 - F.col("ties") / (F.pow(n, 3) - n), F.lit(0.0))
    j = j.select(*keys, "groups", h.alias("h"))
    return j.withColumn("p", chi2_tail(F.col("h"), F.col("groups") - 1))


def shrunk_covariance(df: DataFrame, date: str, symbol: str, x: str) -> DataFrame:
    """a, b, cov: covariance (by n) of at most 5,000 names (else an error), shrunk to a scaled identity with the estimated
    intensity.

    Only dates on which every symbol has a value count, as in a complete panel.
    """
    bounded(df, symbol, 5000)
    rows = df.where(F.col(x).isNotNull()).select(F.col(date).alias("d"), F.col(symbol).alias("s"), F.col(x).alias("x"))
    k = rows.agg(F.count_distinct("s").alias("k"))
    full = rows.join(rows.groupBy("d").agg(F.count("*").alias("c")).join(F.broadcast(k), F.col("c") == F.col("k")).select("d"), "d", "left_semi")
    means = full.groupBy("s").agg(F.avg("x").alias("m"))
    c = full.join(F.broadcast(means), "s").select("d", "s", (F.col("x") - F.col("m")).alias("x"))
    o = c.select("d", F.col("s").alias("b"), F.col("x").alias("y"))
    pair = c.withColumnRenamed("s", "a").join(o, "d").groupBy("a", "b").agg(F.avg(F.col("x") * F.col("y")).alias("s"), F.avg(F.pow(F.col("x") * F.col("y"), 2)).alias("q"), F.count("*").alias("n"))
    tot = pair.agg(F.avg(F.when(F.col("a") == F.col("b"), F.col("s"))).alias("mu"), F.sum(F.col("q") - F.col("s") * F.col("s")).alias("phi"), F.max("n").alias("nn"), F.sum(F.col("s") * F.col("s")).alias("ss"), F.count_if(F.col("a") == F.col("b")).alias("k"))
    delta = F.col("ss") - F.col("k") * F.col("mu") * F.col("mu")
    tot = tot.withColumn("z", F.greatest(F.least(F.coalesce(F.try_divide(F.try_divide(F.col("phi"), delta), F.col("nn").cast("double")), F.lit(0.0)), F.lit(1.0)), F.lit(0.0)))
    target = F.when(F.col("a") == F.col("b"), F.col("mu")).otherwise(0.0)
    return pair.crossJoin(F.broadcast(tot)).select("a", "b", (F.col("z") * target + (1 - F.col("z")) * F.col("s")).alias("cov"), F.col("z").alias("intensity"))


def feature_report(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """feature, missing, variance, corr: one pass over all features."""
    got = df.agg(*[F.struct(F.avg(F.col(c).isNull().cast("double")).alias("missing"), F.var_samp(c).alias("variance"), W.correlation(c, target).alias("corr")).alias(c) for c in features])
    return got.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}.missing").alias("missing"), F.col(f"{c}.variance").alias("variance"), F.col(f"{c}.corr").alias("corr")) for c in features])).alias("f")).select("f.*")


def selected_features(report: DataFrame, k: int, most_missing: float = 0.5, least_variance: float = 1e-8) -> DataFrame:
    """The k features of largest |corr| among those with few nulls and some variance."""
    return report.where((F.col("missing") <= most_missing) & (F.col("variance") > least_variance)).orderBy(F.desc(F.abs("corr")), "feature").limit(k)


def interim(df: DataFrame, test: str, group: str, value: str, looks: int, look: int, alpha: float = 0.05) -> DataFrame:
    """Two-group interim analysis by test: means, pooled standard error, z, p and whether z passes z_alpha / sqrt(look / looks)."""
    from statistics import NormalDist

    a = lambda g, e: F.avg(F.when(F.col(group) == g, e))
    x = F.col(value)
    got = df.groupBy(test).agg(a("A", x).alias("mean_a"), a("B", x).alias("mean_b"), F.var_samp(F.when(F.col(group) == "A", x)).alias("va"), F.var_samp(F.when(F.col(group) == "B", x)).alias("vb"), F.count(F.when(F.col(group) == "A", x)).alias("n_a"), F.count(F.when(F.col(group) == "B", x)).alias("n_b"))
    se = F.sqrt(F.try_divide(F.col("va"), F.col("n_a")) + F.try_divide(F.col("vb"), F.col("n_b")))
    z = F.try_divide(F.col("mean_b") - F.col("mean_a"), se)
    bound = NormalDist().inv_cdf(1 - alpha / 2) / sqrt(look / looks)
    return got.select(test, "mean_a", "mean_b", "n_a", "n_b", z.alias("z"), (2 * (1 - erf_cdf(F.abs(z)))).alias("p"), F.coalesce(F.abs(z) >= bound, F.lit(False)).alias("stop"))


def fill_analytics(fills: DataFrame, width: float, by: Column, pnl: Column, keys: Sequence[str] = ()) -> DataFrame:
    """By bins of a column's value: fills, share, total and mean profit, mean, median, 95th and 99th percentile of size."""
    rows = fills.withColumns({"bin": F.floor(by / width), "__p": pnl})
    got = rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.sum("__p").alias("pnl"), F.avg("__p").alias("mean_pnl"), F.avg("size").alias("mean_size"), F.percentile("size", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("__q"))
    total = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return got.withColumn("share", F.col("n") / F.sum("n").over(total)).select(*keys, "bin", "n", "share", "pnl", "mean_pnl", "mean_size", F.col("__q")[0].alias("p50"), F.col("__q")[1].alias("p95"), F.col("__q")[2].alias("p99"))


#: Floors of the edge monitor by metric, and how far the hit rate may fall against all trades.
FLOORS = {"win_rate": 0.45, "profit_factor": 1.0, "sharpe": 0.0, "winner_loser": 1.0, "hurst": 0.45}
HIT_DECAY = 0.2


def edge_monitor(trades: DataFrame, keys: Sequence[str], order: Sequence[str], pnl: str, hit: str, equity: DataFrame, value: str, at: Sequence[str], window: int = 60, least: int = 10, least_returns: int = 20, least_equity: int = 100) -> DataFrame:
    """keys, n, win_rate_all (of all trades), win_rate, profit_factor, sharpe (least_returns trades or more, yearly, population deviation), hit_rate and hit_decay
    against all trades, winner_loser (mean gain over mean loss, no gain counts as loss), hurst of the last 252 equity values
    (least_equity or more), breaches (names) and level of one evaluation: YELLOW from one breach, ORANGE from two; see edge_levels for RED.

    trades: keys, order, pnl, hit (boolean), the last `window` count; below `least` of them all else is null and GREEN. equity: keys,
    at, value. Ratios without a loss are infinite.
    """
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])) <= window
    rows = trades.where(F.col(pnl).isNotNull()).withColumn("__in", last)
    p, inside = F.when(F.col("__in"), F.col(pnl)), F.col("__in")
    hits = F.coalesce(F.col(hit), F.lit(False)).cast("double")
    got = rows.groupBy(*keys).agg(F.count(p).alias("n"), F.avg((F.col(pnl) > 0).cast("double")).alias("win_rate_all"), F.avg((p > 0).cast("double")).alias("win_rate"), F.coalesce(F.sum(F.when(p > 0, p)), F.lit(0.0)).alias("__up"), F.coalesce(F.sum(F.when(p <= 0, -p)), F.lit(0.0)).alias("__down"), F.count_if(p > 0).alias("__w"), F.count_if(p <= 0).alias("__l"), F.avg(p).alias("__m"), F.stddev_pop(p).alias("__s"), F.avg(F.when(inside, hits)).alias("hit_rate"), F.avg(hits).alias("__all"))
    tail = equity.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in at]))).where("__k <= 252")
    long = tail.groupBy(*keys).agg(F.count(value).alias("__q"))
    h = hurst(tail, F.col(value), Frame(keys, at)).select(*keys, "hurst").join(long, list(keys)).select(*keys, F.when(F.col("__q") >= least_equity, F.col("hurst")).alias("hurst"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(float("inf"))
    mean_win, mean_loss = F.coalesce(F.try_divide(F.col("__up"), F.col("__w")), F.lit(0.0)), F.coalesce(F.try_divide(F.col("__down"), F.col("__l")), F.lit(0.0))
    got = got.join(h, list(keys), "left").withColumns({"profit_factor": ratio(F.col("__up"), F.col("__down")), "sharpe": F.when(F.col("n") >= least_returns, F.when(F.col("__s") > 0, F.col("__m") / F.col("__s") * sqrt(W.YEAR)).otherwise(0.0)), "winner_loser": ratio(mean_win, mean_loss), "hit_decay": F.when(F.col("__all") > 0, (F.col("__all") - F.col("hit_rate")) / F.col("__all"))})
    enough = F.col("n") >= least
    names = ("win_rate", "profit_factor", "sharpe", "hit_rate", "hit_decay", "winner_loser", "hurst")
    got = got.select(*keys, "n", "win_rate_all", *[F.when(enough, F.col(c)).alias(c) for c in names])
    low = [F.when(F.round(c, 12) < floor, F.lit(c)) for c, floor in FLOORS.items()]
    low.insert(3, F.when(F.round("hit_decay", 12) > HIT_DECAY, F.lit("hit_rate")))
    got = got.withColumn("breaches", F.filter(F.array(*low), lambda c: c.isNotNull()))
    k = F.size("breaches")
    return got.withColumn("level", F.when(k >= 2, "ORANGE").when(k == 1, "YELLOW").otherwise("GREEN"))


def edge_levels(history: DataFrame, keys: Sequence[str], order: str, breaches: str = "n_breaches", months: int = 3) -> DataFrame:
    """history (one evaluation a row) with level: RED where this and the evaluations before it, `months` in all, each have three
    breaches or more; else ORANGE from two breaches, YELLOW from one."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(months - 1), 0)
    b = F.col(breaches)
    red = F.count_if(b >= 3).over(w) >= months
    return history.withColumn("level", F.when(red, "RED").when(b >= 2, "ORANGE").when(b == 1, "YELLOW").otherwise("GREEN"))


def capacity(returns: DataFrame, keys: Sequence[str], levels: Sequence[float], price: float, adv: float, turnover: float = 12.0, sigma: float = 0.02, eta: float = 0.1, spread: float = 0.0005, ret: str = "ret") -> DataFrame:
    """Net yearly return and Sharpe at each capital level (a short list): impact, spread and turnover against moments."""
    m = returns.groupBy(*keys).agg(F.avg(ret).alias("__m"), F.stddev_samp(ret).alias("__s"))
    grid = m.withColumn("capital", F.explode(F.array(*map(F.lit, levels))))
    cost = (sigma * eta * F.sqrt(F.col("capital") / price / adv) + spread) * turnover
    net = F.col("__m") * W.YEAR - cost
    return grid.select(*keys, "capital", net.alias("net_return"), F.try_divide(net, F.col("__s") * sqrt(W.YEAR)).alias("net_sharpe"))
