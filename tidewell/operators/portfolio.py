"""Universe rules, scores, sizing, costs, exits, exposure and stress of portfolios, for all dates at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions import windows as W
from ..functions.windows import Frame


def universe_from_prices(bars: DataFrame, low: float, high: float, f: Frame, rows: int = 20) -> DataFrame:
    """Last price within bounds, average volume of the last rows (0 if there are fewer) and its value."""
    w = Window.partitionBy(*f.keys).orderBy(*[F.desc(c) for c in f.order])
    last = bars.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= rows)
    got = last.groupBy(*f.keys).agg(F.max_by("close", F.struct(*f.order)).alias("price"), F.count("*").alias("__k"), F.avg("volume").alias("__v"))
    adv = F.when(F.col("__k") >= rows, F.col("__v")).otherwise(0.0)
    return got.where(F.col("price").between(low, high)).select(*f.keys, "price", adv.alias("adv"), (adv * F.col("price")).alias("adv_value"))


def eligible(df: DataFrame, allow: Sequence[str] | None = None, deny: Sequence[str] = (), key: str = "symbol", **least: float) -> DataFrame:
    """Rows on the allow list (if given), not on the deny list, with every named column at least its bound."""
    ok = F.lit(True)
    if allow is not None:
        ok &= F.col(key).isin(list(allow))
    if deny:
        ok &= ~F.col(key).isin(list(deny))
    for name, bound in least.items():
        ok &= F.col(name) >= bound
    return df.where(ok)


def active_on(universe: DataFrame, dates: DataFrame, date: str = "as_of") -> DataFrame:
    """(date, symbol) listed on each date: listing <= date <= delisting, null ends open. Dates are a short spine."""
    d = F.col(date)
    inside = (F.col("start_date").isNull() | (F.col("start_date") <= d)) & (F.col("end_date").isNull() | (F.col("end_date") >= d))
    return universe.join(F.broadcast(dates), inside)


def universe_counts(universe: DataFrame, dates: DataFrame, date: str = "as_of") -> DataFrame:
    """Names, active names and delisted names (before the date) by date."""
    d = F.col(date)
    gone = F.col("end_date") < d
    live = (F.col("start_date") <= d) & (F.col("end_date").isNull() | (F.col("end_date") >= d))
    return universe.crossJoin(F.broadcast(dates)).groupBy(date).agg(F.count("*").alias("total"), F.count_if(live).alias("active"), F.count_if(gone).alias("delisted"))


def rule_score(df: DataFrame, regime: str = "regime") -> DataFrame:
    """Points for trend (40), pullback (30), volume (15) and volatility (15), their sum and eligibility by regime.

    Needs close, sma_fast, sma_slow, slope, rsi, percent_b, volume_ratio, atr_pct.
    """
    c = F.col
    pts = lambda *pairs: sum((F.when(cond, float(n)).otherwise(0.0) for cond, n in pairs), F.lit(0.0))
    df = df.withColumns({
        "trend_pts": pts((c("close") > c("sma_slow"), 15), (c("sma_fast") > c("sma_slow"), 15), (c("slope") > 0, 10)),
        "pullback_pts": pts((c("rsi").between(30, 50), 15), (c("percent_b") < 0.4, 15)), "volume_pts": pts((c("volume_ratio") > 1, 10), (c("volume_ratio") > 1.5, 5)), "volatility_pts": pts((c("atr_pct").between(0.01, 0.06), 15)),
    })
    df = df.withColumn("score", c("trend_pts") + c("pullback_pts") + c("volume_pts") + c("volatility_pts"))
    floor = F.when(c(regime) == "bull", 60).when(c(regime) == "flat", 70)
    return df.withColumns({"eligible": F.coalesce((c("trend_pts") >= 25) & (c("pullback_pts") > 0) & (c("score") >= floor), F.lit(False)), "confidence": scalars.confidence(c("score"))})


def levels(df: DataFrame, price: Column, atr: Column) -> DataFrame:
    """Stop 1.5 ranges below, targets 2 and 3 ranges above, to cents (halves up, within a billionth)."""
    cents = lambda k: F.round(price + k * atr + 1e-9, 2)
    return df.withColumns({"stop_price": cents(-1.5), "target_1": cents(2), "target_2": cents(3)})


def resolve(predictions: DataFrame, bars: DataFrame, days: int) -> DataFrame:
    """The first later bar of each prediction (id, symbol, entry_date, entry, target, stop) that hits target or stop.

    If both are hit, the nearer to the bar's open wins, and a tie is the target; without a hit within the days the last
    close that is not null counts as expired; without any bar the outcome is open.
    """
    b = bars.select("symbol", F.col("ts").alias("__d"), "open", "high", "low", "close")
    j = predictions.join(b, "symbol").where((F.col("__d") > F.col("entry_date")) & (F.col("__d") <= F.date_add("entry_date", days)))
    up, down = F.col("high") >= F.col("target"), F.col("low") <= F.col("stop")
    near = F.abs(F.col("open") - F.col("target")) <= F.abs(F.col("open") - F.col("stop"))
    hit = F.when(up & down, F.when(near, "target").otherwise("stop")).when(up, "target").when(down, "stop")
    j = j.withColumn("__hit", hit)
    first = j.groupBy("id").agg(F.min(F.when(F.col("__hit").isNotNull(), F.struct(F.col("__d").alias("exit_date"), F.col("__hit").alias("outcome")))).alias("__x"), F.max(F.struct(F.col("__d").alias("exit_date"), F.lit("expired").alias("outcome"))).alias("__e"), F.max_by("close", F.when(F.col("close").isNotNull(), F.col("__d"))).alias("__price"))
    got = predictions.join(first, "id", "left")
    out = F.coalesce(F.col("__x.outcome"), F.col("__e.outcome"), F.lit("open"))
    price = F.when(out == "target", F.col("target")).when(out == "stop", F.col("stop")).otherwise(F.col("__price"))
    return got.select("id", "symbol", "entry_date", out.alias("outcome"), F.coalesce("__x.exit_date", "__e.exit_date").alias("exit_date"), ((W.ratio(price, F.col("entry")) - 1) * 100).alias("pnl_pct"))


def scorecard(outcomes: DataFrame) -> DataFrame:
    """Win rate, mean profit, mean win and loss and counts by symbol, and over all (symbol null)."""
    p = F.col("pnl_pct")
    kind = lambda o: F.count_if(F.col("outcome") == o).alias(f"n_{o}")
    return outcomes.rollup("symbol").agg(F.count("*").alias("n"), F.avg((p > 0).cast("double")).alias("win_rate"), F.avg(p).alias("mean_pnl"), F.avg(F.when(p > 0, p)).alias("mean_win"), F.avg(F.when(p <= 0, p)).alias("mean_loss"), kind("target"), kind("stop"), kind("expired"))


def exposure(positions: DataFrame, keys: Sequence[str], value: Column, nav: Column) -> DataFrame:
    """Long, short, gross and net value, leverage and the largest share by keys."""
    v = positions.withColumns({"__v": value, "__n": nav})
    return v.groupBy(*keys).agg(F.sum(F.greatest("__v", F.lit(0.0))).alias("long"), F.sum(F.least("__v", F.lit(0.0))).alias("short"), F.sum(F.abs("__v")).alias("gross"), F.sum("__v").alias("net"), F.try_divide(F.sum(F.abs("__v")), F.max("__n")).alias("leverage"), F.try_divide(F.max(F.abs("__v")), F.sum(F.abs("__v"))).alias("largest"))


def shock_losses(positions: DataFrame, value: Column, shocks: dict[str, tuple[float, float]], keys: Sequence[str]) -> DataFrame:
    """Profit of each shock (name -> (price change, extra spread)): value times change less the spread on its size."""
    grid = F.explode(F.array(*[F.struct(F.lit(n).alias("shock"), F.lit(a).alias("move"), F.lit(b).alias("spread")) for n, (a, b) in shocks.items()]))
    v = positions.withColumn("__v", value).withColumn("__s", grid)
    return v.groupBy(*keys, F.col("__s.shock").alias("shock")).agg(F.sum(F.col("__v") * F.col("__s.move") - F.abs("__v") * F.col("__s.spread")).alias("pnl"))


def scenario_metrics(returns: DataFrame, windows: dict[str, tuple[str, str]], keys: Sequence[str], date: str = "ts", ret: str = "ret") -> DataFrame:
    """Fifth percentile, expected shortfall, total return and rows of each date window (a short list) by keys."""
    grid = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(a).cast("date").alias("a"), F.lit(b).cast("date").alias("b")) for n, (a, b) in windows.items()]))
    rows = returns.where(F.col(ret).isNotNull()).withColumn("__w", grid).where(F.col(date).between(F.col("__w.a"), F.col("__w.b"))).withColumn("scenario", F.col("__w.scenario"))
    cut = rows.groupBy(*keys, "scenario").agg(F.percentile(ret, F.lit(0.05)).alias("var_5"))
    r = F.col(ret)
    return rows.join(cut, [*keys, "scenario"]).groupBy(*keys, "scenario", "var_5").agg(F.count("*").alias("n"), F.avg(F.when(r <= F.col("var_5"), r)).alias("shortfall"), (W.compounded(r) - 1).alias("total_return"))


def filtered_signals(signals: DataFrame, least_score: float = 0.0, confidence: Sequence[str] = (), symbols: Sequence[str] | None = None, top: int | None = None, date: str = "ts") -> DataFrame:
    """The eligible signals with at least a score, of the named confidences (all if none is named) and symbols, with their rank
    by score within the date (ties by symbol); at most `top` of a date if that is given."""
    rows = signals.where(F.col("eligible") & (F.col("score") >= least_score))
    rows = rows.where(F.col("confidence").isin(*confidence)) if confidence else rows
    rows = rows.where(F.col("symbol").isin(*symbols)) if symbols is not None else rows
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(date).orderBy(F.desc("score"), "symbol")))
    return rows.where(F.col("rank") <= top) if top else rows


def stress_bundle(scenarios: DataFrame, shocks: DataFrame, scenario_keys: Sequence[str], shock_keys: Sequence[str]) -> DataFrame:
    """kind, name, portfolio, metric, value: all scenario_metrics and shock_losses of any number of portfolios in one long table;
    portfolio is the keys as text, joined by |."""
    who = lambda keys: F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("portfolio")
    a = scenarios.select(F.lit("scenario").alias("kind"), F.col("scenario").alias("name"), who(scenario_keys), *[F.col(c).cast("double").alias(c) for c in ("var_5", "shortfall", "total_return", "n")])
    b = shocks.select(F.lit("shock").alias("kind"), F.col("shock").alias("name"), who(shock_keys), F.col("pnl").cast("double").alias("pnl"))
    ids = ["kind", "name", "portfolio"]
    return a.unpivot(ids, ["var_5", "shortfall", "total_return", "n"], "metric", "value").unionByName(b.unpivot(ids, ["pnl"], "metric", "value"))


def net_of_costs(positions: DataFrame, f: Frame, date: str = "ts", sigma: float = 0.02) -> DataFrame:
    """By date: gross value, costs of the changes of shares (spread, commission, impact) and returns net of them.

    Needs shares, close and adv. The first row of a series is a purchase of all its shares.
    """
    change = F.col("shares") - F.coalesce(W.lag(F.col("shares"), f), F.lit(0.0))
    cost = scalars.fixed_cost(change, F.col("close")) + F.coalesce(scalars.impact_cost(change, F.col("close"), F.col("adv"), F.lit(sigma)), F.lit(0.0))
    profit = F.coalesce(W.lag(F.col("shares"), f) * (F.col("close") - W.lag(F.col("close"), f)), F.lit(0.0))
    day = positions.withColumns({"__c": cost, "__p": profit}).groupBy(date).agg(F.sum(F.col("shares") * F.col("close")).alias("value"), F.sum("__c").alias("cost"), F.sum("__p").alias("profit"))
    prev = F.lag("value").over(Window.orderBy(date))
    return day.withColumns({"gross_return": F.try_divide(F.col("profit"), prev), "drag": F.try_divide(F.col("cost"), prev)}).withColumn("net_return", F.col("gross_return") - F.col("drag"))


def equal_or_scaled_weights(df: DataFrame, date: str, score: Column, cap: float = 0.2, gross: float = 1.0) -> DataFrame:
    """weight by date: proportional to the positive score, capped, and scaled to the gross limit where over it."""
    w = Window.partitionBy(date)
    s = df.withColumn("__s", F.greatest(F.coalesce(score, F.lit(0.0)), F.lit(0.0)))
    s = s.withColumn("__w", F.least(F.coalesce(F.try_divide(F.col("__s"), F.sum("__s").over(w)), F.lit(0.0)), F.lit(cap)))
    total = F.sum("__w").over(w)
    return s.withColumn("weight", F.col("__w") * F.when(total > gross, gross / total).otherwise(1.0)).drop("__s", "__w")


def mark_outs(fills: DataFrame, quotes: DataFrame, steps: int = 5) -> DataFrame:
    """Change of the mid between a fill and so many quotes later, signed by side and over the spread at the fill.

    fills: id, symbol, ts, side (buy or sell), price; quotes: symbol, ts, mid, spread. Quotes are numbered by symbol; the
    fill's number is that of the last quote at or before it.
    """
    f = Frame(["symbol"], ["ts"])
    q = quotes.withColumns({"__later": F.lead("mid", steps).over(f.spec)}).select("symbol", F.col("ts").alias("__t"), F.struct(F.col("ts").alias("t"), "mid", "spread", F.col("__later").alias("later")).alias("__q"))
    left = fills.select("symbol", F.col("ts").alias("__t"), F.struct("id", "side", "price").alias("__f"))
    both = q.unionByName(left, allowMissingColumns=True)
    w = Window.partitionBy("symbol").orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("__q", F.max("__q").over(w)).where(F.col("__f").isNotNull())
    sign = F.when(F.col("__f.side") == "buy", 1.0).otherwise(-1.0)
    return seen.select(F.col("__f.id").alias("id"), "symbol", F.col("__f.side").alias("side"), (sign * (F.col("__q.later") - F.col("__f.price"))).alias("mark_out"), F.try_divide(sign * (F.col("__q.later") - F.col("__f.price")), F.col("__q.spread")).alias("mark_out_spreads"))


def option_summary(chain: DataFrame, closes: DataFrame) -> DataFrame:
    """By ticker and date: call and put volume and open interest, put/call ratios, mean volatility by days to expiry
    (20-40, 45-75, 75-105; at least 2 rows), at-the-money volatilities, skew, term slope and a thin-chain flag.

    closes: ticker, quote_date, close; a missing close gives null at-the-money values.
    """
    c = chain.join(closes, ["ticker", "quote_date"], "left").withColumn("dte", F.datediff("expiration", "quote_date"))
    iv, call, near = F.col("implied_volatility"), F.col("option_type") == "call", F.col("dte").between(20, 40)
    band = lambda a, b: F.when(F.count(F.when(F.col("dte").between(a, b), iv)) >= 2, F.avg(F.when(F.col("dte").between(a, b), iv)))
    atm = lambda side: F.min_by(F.when(side & near, iv), F.when(side & near & iv.isNotNull(), F.struct(F.abs(F.col("strike") - F.col("close")), F.col("strike"))))
    total = lambda cond, col: F.sum(F.when(cond, F.col(col)).otherwise(0))
    got = c.groupBy("ticker", "quote_date").agg(
        F.count("*").alias("n"), total(call, "volume").alias("call_volume"), total(~call, "volume").alias("put_volume"), total(call, "open_interest").alias("call_oi"), total(~call, "open_interest").alias("put_oi"),
        band(20, 40).alias("iv_30"), band(45, 75).alias("iv_60"), band(75, 105).alias("iv_90"), atm(call).alias("atm_call_iv"), atm(~call).alias("atm_put_iv"), F.avg(F.when(~call & near & (F.col("strike") < 0.95 * F.col("close")), iv)).alias("__otm"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return got.withColumns({"pc_volume": ratio("put_volume", "call_volume"), "pc_oi": ratio("put_oi", "call_oi"), "skew": F.col("__otm") - F.col("atm_call_iv"), "slope": (F.col("iv_90") - F.col("iv_30")) / 60, "data_quality_flag": F.when(F.col("n") < 10, "thin_chain").otherwise("ok")}).drop("__otm")


def universe_prices(bars: DataFrame, universe: DataFrame, as_of: str) -> DataFrame:
    """bars up to a date of the names that are listed on it (survivors and later delisted ones alike)."""
    dates = bars.sparkSession.createDataFrame([(as_of,)], "as_of string").select(F.col("as_of").cast("date").alias("as_of"))
    return bars.where(F.col("ts") <= F.lit(as_of).cast("date")).join(active_on(universe, dates).select("symbol"), "symbol", "left_semi")
