"""Research on signals, strategies, ensembles and experiments: decay, gates, fold metrics, leaderboards, bias tests.

Each takes long tables of many series, horizons, folds or models and is one aggregate plan over all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from math import sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows as W
from . import evaluate as ev
from . import ranks

HORIZONS = (1, 5, 10, 21, 63)


def forward_long(bars: DataFrame, signal: Column, f: W.Frame, horizons: Sequence[int] = HORIZONS, close: str = "close") -> DataFrame:
    """Keys, order, horizon, signal, fwd: a row for each horizon with the return over so many later rows."""
    wide = bars.withColumn("signal", signal).withColumn("__h", F.array(*[F.struct(F.lit(h).alias("horizon"), W.forward_returns(F.col(close), f, h).alias("fwd")) for h in horizons]))
    return wide.select(*f.keys, *f.order, "signal", F.explode("__h").alias("__h")).select(*f.keys, *f.order, "signal", "__h.horizon", "__h.fwd")


def ic_by(df: DataFrame, keys: Sequence[str], signal: str = "signal", forward: str = "fwd", least: int = 3) -> DataFrame:
    """Rank correlation (average ties) of signal and forward return for each combination of keys: n, ic."""
    rows = df.where(F.col(signal).isNotNull() & F.col(forward).isNotNull())
    rows = rows.withColumns({"__a": W.cross_rank(F.col(signal), list(keys)), "__b": W.cross_rank(F.col(forward), list(keys))})
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), W.correlation("__a", "__b").alias("ic")).where(F.col("n") >= least)


def ic_decay(long: DataFrame, date: str = "ts") -> DataFrame:
    """horizon, n_dates, mean_ic, std_ic, ir, best: the horizon of the largest ir (the shorter one of a tie)."""
    got = ev.ic_summary(ic_by(long, ["horizon", date]), ["horizon"])
    top = got.agg(F.max_by("horizon", F.struct(F.coalesce("ir", F.lit(float("-inf"))), -F.col("horizon"))).alias("__best"))
    return got.crossJoin(F.broadcast(top)).withColumn("best", F.col("horizon") == F.col("__best")).drop("__best")


def fold_gate(ic: DataFrame, folds: DataFrame, date: str = "ts") -> DataFrame:
    """n_folds, mean_ic, t, p, passed: mean test IC of each fold, a t statistic over folds and its two-sided p (normal).

    ic: date, ic; folds: date, fold, role (one row for each date and fold). passed: p below 0.05 and a positive mean.
    """
    means = ic.where(F.col("ic").isNotNull()).join(folds.where("role = 'test'").select(date, "fold").distinct(), date).groupBy("fold").agg(F.avg("ic").alias("m"))
    got = means.agg(F.count("m").alias("n_folds"), F.avg("m").alias("mean_ic"), F.try_divide(F.avg("m") * F.sqrt(F.count("m")), F.stddev_samp("m")).alias("t"))
    p = F.when(F.col("t").isNotNull(), 2 * (1 - ev.erf_cdf(F.abs(F.col("t")))))
    return got.withColumn("p", p).withColumn("passed", F.coalesce((F.col("p") < 0.05) & (F.col("mean_ic") > 0), F.lit(False)))


def top_share_returns(df: DataFrame, signal: str = "signal", forward: str = "fwd", least: float = 0.8, date: str = "ts") -> DataFrame:
    """date, ret, names: equal-weight forward return of names whose percentile rank of the signal is at least so high.

    Dates whose chosen names have no forward return, or without a name, count 0.
    """
    chosen = df.withColumn("__in", F.coalesce(W.cross_rank(F.col(signal), [date]) >= least, F.lit(False)))
    return chosen.groupBy(date).agg(F.coalesce(F.avg(F.when(F.col("__in"), F.col(forward))), F.lit(0.0)).alias("ret"), F.count_if(F.col("__in") & F.col(forward).isNotNull()).alias("names"))


def strategy_metrics(df: DataFrame, keys: Sequence[str], date: str = "ts", ret: str = "ret", cost: float = 0.0) -> DataFrame:
    """n, total_return, annual_return, sharpe, max_drawdown, win_rate, profit_factor of daily returns net of a daily cost.

    Returns compound as a product, so a total loss stays one. sharpe: yearly return over yearly volatility, 0 without any;
    max_drawdown: from the highest value so far (after the first day); win_rate: of days that are not 0; profit_factor: infinite
    without a loss. A single day has zeros throughout.
    """
    rows = df.where(F.col(ret).isNotNull()).withColumn("__r", F.col(ret) - cost)
    up = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__v", W.compounded(F.col("__r"), up))
    rows = rows.withColumn("__d", F.try_divide(F.col("__v"), F.max("__v").over(up)) - 1)
    r, n = F.col("__r"), F.col("n")
    got = rows.groupBy(*keys).agg(F.count("*").alias("n"), W.compounded(r).alias("__g"), F.stddev_samp(r).alias("__s"), F.min("__d").alias("__d"), F.count_if(r > 0).alias("__w"), F.count_if(r != 0).alias("__t"), F.coalesce(F.sum(F.when(r > 0, r)), F.lit(0.0)).alias("__up"), F.coalesce(F.sum(F.when(r < 0, -r)), F.lit(0.0)).alias("__down"))
    annual, vol = F.pow(F.col("__g"), W.YEAR / n) - 1, F.col("__s") * sqrt(W.YEAR)
    some = lambda c: F.when(n >= 2, c).otherwise(0.0)
    return got.select(*keys, "n", some(F.col("__g") - 1).alias("total_return"), some(annual).alias("annual_return"), some(F.when(vol > 0, annual / vol).otherwise(0.0)).alias("sharpe"), some(F.col("__d")).alias("max_drawdown"), some(F.when(F.col("__t") > 0, F.col("__w") / F.col("__t")).otherwise(0.0)).alias("win_rate"), some(F.when(F.col("__down") > 0, F.col("__up") / F.col("__down")).otherwise(float("inf"))).alias("profit_factor"))


def equity_summary(curve: DataFrame, keys: Sequence[str], ts: str = "ts", equity: str = "equity", start: str | None = None, least: int = 20) -> DataFrame:
    """total_return, cagr, sharpe, sortino, max_drawdown, avg_drawdown and calmar of equity curves by keys.

    start: a column of the initial capital (else the first equity). cagr takes years of 365.25 days and is null for a curve of one
    day or an end at or below 0; sharpe needs more than `least` returns that vary, sortino a fall (it divides by the root mean square of
    the falls). Drawdowns are against the running peak, their mean is over all days. Null equity plays no part. One shuffle by key.
    """
    e = F.col("__e")
    f = W.Frame(list(keys), [ts])
    rows = curve.where(F.col(equity).isNotNull()).withColumn("__e", F.col(equity).cast("double"))
    rows = rows.withColumns({"__r": W.returns(e, f), "__d": W.drawdown(e, f)})
    r, d = F.col("__r"), F.col("__d")
    capital = F.min_by(start, ts) if start else F.min_by("__e", ts)
    got = rows.groupBy(*keys).agg(F.count("*").alias("n"), capital.alias("__a"), F.max_by("__e", ts).alias("__b"), (F.datediff(F.max(ts), F.min(ts)) / 365.25).alias("__y"), F.count(r).alias("__n"), F.avg(r).alias("__m"), F.stddev_samp(r).alias("__s"), F.sqrt(F.avg(F.when(r < 0, r * r))).alias("__down"), F.min(d).alias("max_drawdown"), F.avg(d).alias("avg_drawdown"))
    scale = sqrt(W.YEAR)
    ratio = lambda s: F.when(F.col(s) > 0, F.col("__m") / F.col(s) * scale)
    growth = F.try_divide(F.col("__b"), F.col("__a"))
    cagr = F.when((F.col("__y") > 0) & (growth > 0), F.pow(growth, 1 / F.col("__y")) - 1)
    calmar = F.when(F.col("max_drawdown") < 0, cagr / F.abs("max_drawdown"))
    return got.select(*keys, "n", (growth - 1).alias("total_return"), cagr.alias("cagr"), F.when(F.col("__n") > least, ratio("__s")).alias("sharpe"), ratio("__down").alias("sortino"), "max_drawdown", "avg_drawdown", calmar.alias("calmar"))


def trade_summary(trades: DataFrame, keys: Sequence[str], pnl: str = "pnl_pct", opened: str = "entry_date", closed: str = "exit_date", reason: str = "outcome", reasons: Sequence[str] = ("target", "stop", "expired")) -> DataFrame:
    """Trades, hit rate, profit factor, mean win and loss, mean days held and counts of exit reasons of closed trades."""
    p = F.col(pnl)
    return trades.where(p.isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.avg((p > 0).cast("double")).alias("hit_rate"), F.try_divide(F.sum(F.when(p > 0, p)), -F.sum(F.when(p < 0, p))).alias("profit_factor"), F.avg(F.when(p > 0, p)).alias("mean_win"), F.avg(F.when(p < 0, p)).alias("mean_loss"), F.avg(F.datediff(closed, opened)).alias("mean_days"), *[F.count_if(F.col(reason) == x).alias(f"n_{x}") for x in reasons])


def same_day_hits(signals: DataFrame, returns: DataFrame, keys: Sequence[str], on: Sequence[str], signal: str = "signal", ret: str = "ret") -> DataFrame:
    """n and share of signals whose sign is that of the same day's return. on: date and symbol."""
    j = signals.join(returns, list(on)).where(F.col(signal).isNotNull() & F.col(ret).isNotNull())
    return j.groupBy(*keys).agg(F.count("*").alias("n"), F.avg((W.sign(signal) == W.sign(ret)).cast("double")).alias("hit_rate"))


def diversity(df: DataFrame, predictions: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """mean_corr and mean_disagreement over pairs of prediction columns (rows where both are there); one aggregate."""
    pairs = list(combinations(predictions, 2))
    both = lambda a, b, c: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), c)
    got = df.groupBy(*keys).agg(*[W.correlation(both(a, b, F.col(a)), both(a, b, F.col(b))).alias(f"c{i}") for i, (a, b) in enumerate(pairs)], *[F.avg(both(a, b, (W.sign(a) != W.sign(b)).cast("double"))).alias(f"d{i}") for i, (a, b) in enumerate(pairs)])

    def mean(tag: str) -> Column:
        cs = [F.col(f"{tag}{i}") for i in range(len(pairs))]
        return F.try_divide(sum((F.coalesce(F.nanvl(c, F.lit(None)), F.lit(0.0)) for c in cs), F.lit(0.0)), sum(((c.isNotNull() & ~F.isnan(c)).cast("int") for c in cs), F.lit(0)))

    return got.select(*keys, mean("c").alias("mean_corr"), mean("d").alias("mean_disagreement"))


def leaderboard(runs: DataFrame, family: str, problem: str, score: str) -> DataFrame:
    """family, n, mean, std, best, problems_won: problems on which the family has the best score (ties: first by name)."""
    s = F.col(score)
    won = runs.where(s.isNotNull()).groupBy(problem, family).agg(F.max(s).alias("b")).groupBy(problem).agg(F.min(F.struct(-F.col("b"), F.col(family).alias("f"))).alias("x")).groupBy(F.col("x.f").alias(family)).agg(F.count("*").alias("problems_won"))
    table = runs.where(s.isNotNull()).groupBy(family).agg(F.count("*").alias("n"), F.avg(s).alias("mean"), F.stddev_samp(s).alias("std"), F.max(s).alias("best"))
    return table.join(won, family, "left").fillna(0, ["problems_won"])


def improvements(runs: DataFrame, keys: Sequence[str], order: Sequence[str], score: str) -> DataFrame:
    """The runs that beat every earlier run of their keys (a running best over time)."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = runs.where(F.col(score).isNotNull()).withColumn("__b", F.max(score).over(before))
    return rows.where(F.col("__b").isNull() | (F.col(score) > F.col("__b"))).drop("__b")


def overfit_share(scores: DataFrame, train: str = "train", test: str = "test", top: float = 0.9) -> DataFrame:
    """n, chosen, overfit: share of the candidates at or above the train quantile whose test score is below the median."""
    rows = scores.where(F.col(train).isNotNull() & F.col(test).isNotNull())
    cut = ranks.quantiles(rows, [], train, {"__cut": top}).drop("n").crossJoin(ranks.quantiles(rows, [], test, {"__mid": 0.5}).drop("n"))
    return rows.crossJoin(F.broadcast(cut)).agg(F.count("*").alias("n"), F.count_if(F.col(train) >= F.col("__cut")).alias("chosen"), F.avg(F.when(F.col(train) >= F.col("__cut"), (F.col(test) < F.col("__mid")).cast("double"))).alias("overfit"))


def timers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, n, low, high, mean, p95 of recorded values."""
    got = df.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"))
    return got.join(ranks.quantiles(df, keys, value, {"p95": 0.95}), list(keys)).select(*keys, "n", "low", "high", "mean", "p95")


def block_size(df: DataFrame, f: W.Frame, x: str = "ret", most: int = 50) -> DataFrame:
    """Keys, n, block: one more than the last lag (up to n / 3) whose autocorrelation exceeds 1.96 / sqrt(n), within
    [5, sqrt(n)]; below 30 rows, n."""
    w = Window.partitionBy(*f.keys)
    rows = df.where(F.col(x).isNotNull()).select(*f.keys, *f.order, x)
    rows = rows.withColumns({"__n": F.count("*").over(w), "__c": F.col(x) - F.avg(x).over(w)})
    rows = rows.withColumns({"__v": F.col("__c") ** 2, **{f"__p{k}": F.col("__c") * F.lag("__c", k).over(f.spec) for k in range(1, most + 1)}})
    got = rows.groupBy(*f.keys).agg(F.max("__n").alias("n"), F.sum("__v").alias("__v"), *[F.sum(f"__p{k}").alias(f"__s{k}") for k in range(1, most + 1)])
    n = F.col("n")
    hit = F.greatest(F.lit(0), *[F.when((F.lit(k) <= F.floor(n / 3)) & (F.abs(F.try_divide(F.col(f"__s{k}"), F.col("__v"))) > 1.96 / F.sqrt(n)), k).otherwise(0) for k in range(1, most + 1)])
    block = F.when(n < 30, n).otherwise(F.greatest(F.least(hit + 1, F.floor(F.sqrt(n))), F.lit(5)))
    return got.select(*f.keys, "n", block.cast("long").alias("block"))


def compare(metrics: DataFrame, candidate: str, metric: str, value: str, names: Sequence[str], chosen: str) -> DataFrame:
    """A row for each candidate with a column for each metric; best marks the largest chosen metric (ties: first by name)."""
    wide = metrics.groupBy(candidate).pivot(metric, list(names)).agg(F.max(value))
    top = wide.agg(F.min(F.struct(-F.col(chosen), F.col(candidate).alias("c"))).alias("__t"))
    return wide.crossJoin(F.broadcast(top)).withColumn("best", F.col(candidate) == F.col("__t.c")).drop("__t")


def shift_test(df: DataFrame, f: W.Frame, feature: str, target: str, shifts: Sequence[int] = (1, 5, 10)) -> DataFrame:
    """shift, corr, degradation, suspicious: correlation with the target of as many rows before; a loss under a tenth
    of the unshifted correlation is suspicious (the feature may know the future)."""
    rows = df.withColumn("__s", F.array(F.struct(F.lit(0).alias("shift"), F.col(target).alias("y")), *[F.struct(F.lit(k).alias("shift"), W.lag(F.col(target), f, k).alias("y")) for k in shifts]))
    long = rows.select(feature, F.explode("__s").alias("__s")).select(feature, "__s.*").where(F.col(feature).isNotNull() & F.col("y").isNotNull())
    got = long.groupBy("shift").agg(W.correlation(F.col(feature), F.col("y")).alias("corr"))
    base = got.where("shift = 0").select(F.col("corr").alias("__b"))
    loss = F.try_divide(F.abs("__b") - F.abs("corr"), F.abs("__b"))
    return got.crossJoin(F.broadcast(base)).withColumns({"degradation": loss, "suspicious": (F.col("shift") > 0) & F.coalesce(loss < 0.1, F.lit(False))}).drop("__b")


def sensitivity(df: DataFrame, grid: Sequence[float], metric, keys: Sequence[str] = (), robust: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(points, summary): metric(parameter column) as an aggregate for each value of a short grid, and over the grid its
    mean, std, coefficient of variation and whether that is below robust."""
    points = df.withColumn("parameter", F.explode(F.array(*map(F.lit, grid)))).groupBy(*keys, "parameter").agg(metric(F.col("parameter")).alias("metric"))
    summary = points.groupBy(*keys).agg(F.avg("metric").alias("mean"), F.stddev_samp("metric").alias("std"), F.abs(F.try_divide(F.stddev_samp("metric"), F.avg("metric"))).alias("cv"))
    return points, summary.withColumn("robust", F.coalesce(F.col("cv") < robust, F.lit(False)))


def drift_report(axes: DataFrame) -> DataFrame:
    """axes (axis, triggered) -> triggered, action: retrain from two triggered axes, investigate from one."""
    got = axes.agg(F.count_distinct(F.when(F.col("triggered"), F.col("axis"))).alias("triggered"))
    return got.withColumn("action", F.when(F.col("triggered") >= 2, "retrain").when(F.col("triggered") >= 1, "investigate").otherwise("none"))


def audit(runs: DataFrame, config: Sequence[str], captured: Sequence[str]) -> DataFrame:
    """runs, unique_configs, duplicate_configs, fully_captured: by a hash of the configuration columns."""
    key = F.xxhash64(*config)
    full = F.lit(True)
    for c in captured:
        full &= F.col(c).isNotNull()
    return runs.agg(F.count("*").alias("runs"), F.count_distinct(key).alias("unique_configs"), (F.count("*") - F.count_distinct(key)).alias("duplicate_configs"), F.avg(full.cast("double")).alias("fully_captured"))


def market_features(bars: DataFrame, f: W.Frame, close: str = "close", date: str = "ts", macro: DataFrame | None = None) -> DataFrame:
    """date, n, mean_return, dispersion, volatility: mean and standard deviation of all series' returns, and the standard
    deviation of their prices, at each time. macro: date and value columns (one row a date), added as macro_<name>."""
    r = W.returns(F.col(close), f)
    got = bars.withColumn("__r", r).where("__r IS NOT NULL").groupBy(date).agg(F.count("*").alias("n"), F.avg("__r").alias("mean_return"), F.stddev_samp("__r").alias("dispersion"), F.stddev_samp(close).alias("volatility"))
    if macro is None:
        return got
    return got.join(macro.select(F.col(date), *[F.col(c).alias(f"macro_{c}") for c in macro.columns if c != date]), date, "left")
