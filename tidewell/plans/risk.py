"""Queries on risk: factor gates, betas, clusters, constraints, inventory, sizing, entry rules.

Portfolios are the customers' orders: an asset is a supplier, its sector a residue of its key; volatilities and volumes are
fixed functions of keys, since the tables have none.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import windows as W
from ..operators import evaluate as ev
from ..operators import indicators as ind
from ..operators import risk
from ..sources import tables as T
from ._common import cdf_sql, r, rounded
from .evaluation import _RET, returns
from .registry import query

_FACTORS = f"{_RET}, fac AS (SELECT ts, avg(ret) AS market, avg(ret * volume) AS flow, avg(volume) AS crowd FROM ret GROUP BY ts), fr AS (SELECT symbol, ts, ret, ret - market AS res, market, flow, crowd FROM ret JOIN fac USING (ts))"


def _with_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = returns(spark, sf_dir)
    fac = rr.groupBy("ts").agg(F.avg("ret").alias("market"), F.avg(F.col("ret") * F.col("volume")).alias("flow"), F.avg("volume").alias("crowd"))
    return rr.join(fac, "ts").withColumn("res", F.col("ret") - F.col("market"))


@query(T.with_tables("bars_user_d", then=f"""
, {_FACTORS}, l AS ({" UNION ALL ".join(f"SELECT symbol, '{c}' AS factor, count(CASE WHEN res IS NOT NULL AND {c} IS NOT NULL THEN 1 END) AS n, corr(res, {c}) AS corr FROM fr GROUP BY symbol" for c in ("market", "flow", "crowd"))}),
t AS (SELECT *, abs(corr) * sqrt((n - 2) / nullif(1 - corr * corr, 0)) AS t FROM l WHERE n >= 10 AND corr IS NOT NULL AND NOT isnan(corr)), p AS (SELECT *, coalesce(2 * (1 - {cdf_sql('t')}), 0) AS p FROM t),
h AS (SELECT *, least(1, (count(*) OVER (PARTITION BY symbol) - row_number() OVER (PARTITION BY symbol ORDER BY p, factor) + 1) * p) AS p_holm FROM p)
SELECT symbol, factor, n, {r('corr', 'corr')}, {r('p', 'p')}, {r('p_holm', 'p_holm')}, abs(corr) >= 0.2 AND p_holm < 0.05 AS failed FROM h"""))
def factor_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(risk.factor_gate(_with_factors(spark, sf_dir), ["symbol"], "res", ["market", "flow", "crowd"]))


@query(T.with_tables("bars_user_d", then=f"""
, {_FACTORS}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS k FROM fr WHERE ret IS NOT NULL AND market IS NOT NULL), b AS (SELECT symbol, count(*) AS n, covar_samp(ret, market) / nullif(var_samp(market), 0) AS beta FROM k WHERE k <= 20 GROUP BY symbol)
SELECT symbol, n, {r('beta', 'beta')}, coalesce(abs(beta) <= 1.5, true) AS within_limit FROM b"""))
def window_betas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(risk.window_betas(_with_factors(spark, sf_dir), ["symbol"], "ts", "ret", "market", 20))


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_h(spark, sf_dir).withColumn("ret", W.returns(F.col("close"), ind.DEFAULT))
    return risk.clusters(b.select("symbol"), ev.correlations(b), 0.05)


_GREEDY = T.with_tables("bars_h", then="""
, r AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars_h), pairs AS (SELECT x.symbol AS a, y.symbol AS b, corr(x.ret, y.ret) AS c FROM r x JOIN r y ON x.ts = y.ts AND x.symbol < y.symbol WHERE x.ret IS NOT NULL AND y.ret IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 10),
names AS (SELECT symbol, row_number() OVER (ORDER BY symbol) AS i FROM (SELECT DISTINCT symbol FROM bars_h)), near AS (SELECT symbol, i, list(a ORDER BY a) FILTER (WHERE abs(c) >= 0.05) AS nbrs FROM names LEFT JOIN pairs ON b = symbol GROUP BY 1, 2),
s AS (SELECT CAST(1 AS BIGINT) AS i, [symbol] AS leaders FROM near WHERE i = 1 UNION ALL SELECT n.i, CASE WHEN len(list_intersect(leaders, coalesce(nbrs, []))) > 0 THEN leaders ELSE list_append(leaders, n.symbol) END FROM s JOIN near n ON n.i = s.i + 1),
l AS (SELECT leaders FROM s ORDER BY i DESC LIMIT 1), g AS (SELECT symbol, CASE WHEN list_contains(leaders, symbol) THEN symbol ELSE list_min(list_intersect(leaders, nbrs)) END AS leader FROM near, l),
m AS (SELECT x.leader, avg(abs(c)) AS c FROM pairs JOIN g x ON x.symbol = a JOIN g y ON y.symbol = b WHERE x.leader = y.leader GROUP BY 1)""").replace("WITH ", "WITH RECURSIVE ", 1)


@query(_GREEDY + f" SELECT symbol, g.leader, {r('coalesce(m.c, 1)', 'mean_corr')} FROM g LEFT JOIN m ON m.leader = g.leader")
def correlation_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of event types by correlation of hourly returns; the threshold suits these nearly independent series."""
    return rounded(_clusters(spark, sf_dir))


@query(_GREEDY + f""", p AS (SELECT symbol, arg_max(close, ts) AS price, sum(volume) AS quantity FROM bars_h GROUP BY 1)
SELECT leader, count(DISTINCT g.symbol) AS names, {r('sum(coalesce(abs(quantity * price), 0))', 'notional')}, sum(coalesce(abs(quantity * price), 0)) <= 100000 AS within_limit FROM g LEFT JOIN p USING (symbol) GROUP BY leader""")
def cluster_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = T.bars_h(spark, sf_dir).groupBy("symbol").agg(F.max_by("close", "ts").alias("price"), F.sum("volume").alias("quantity"))
    return rounded(risk.cluster_limits(_clusters(spark, sf_dir), last, 100_000.0))


_LIMITS = {"position_weight": 0.3, "gross": 1.0, "net": 0.8, "portfolio_risk": 0.1, "participation": 0.1, "concentration": 0.9, "sector:2": 0.3, "country:1": 0.5, "max_drawdown": 0.15, "turnover": 0.25}
_W = "w AS (SELECT filer, quarter, asset, CASE WHEN asset % 4 = 0 THEN -1 ELSE 1 END * value / sum(value) OVER (PARTITION BY filer, quarter) AS weight, 0.05 + (asset % 7) / 50 AS volatility, (asset % 11) * 100000.0 AS adv, value / 10 AS shares, CAST(asset % 5 AS VARCHAR) AS sector, CAST(asset % 3 AS VARCHAR) AS country, (filer % 40) / 200 AS drawdown, (filer % 30) / 100 AS turnover FROM holdings)"


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    a, v = F.col("asset"), F.col("value")
    share = F.when(a % 4 == 0, -1).otherwise(1) * v / F.sum(v).over(Window.partitionBy("filer", "quarter"))
    return T.holdings(spark, sf_dir).select("filer", "quarter", a.alias("symbol"), share.alias("weight"), (0.05 + (a % 7) / 50).alias("volatility"), ((a % 11) * 100000.0).alias("adv"), (v / 10).alias("shares"), (a % 5).cast("string").alias("sector"), (a % 3).cast("string").alias("country"), (F.col("filer") % 40 / 200).alias("drawdown"), (F.col("filer") % 30 / 100).alias("turnover"))


_ACTUAL = {"position_weight": "max(abs(weight))", "gross": "sum(abs(weight))", "net": "abs(sum(weight))", "portfolio_risk": "sqrt(greatest(sum(pow(weight * volatility, 2)) + 0.5 * (pow(sum(weight * volatility), 2) - sum(pow(weight * volatility, 2))), 0))", "participation": "max(CASE WHEN adv > 0 THEN abs(shares) / adv ELSE 0 END)", "concentration": "sum(CASE WHEN k <= 5 THEN abs(weight) ELSE 0 END)", "sector:2": "sum(CASE WHEN sector = '2' THEN abs(weight) ELSE 0 END)", "country:1": "sum(CASE WHEN country = '1' THEN abs(weight) ELSE 0 END)", "max_drawdown": "max(drawdown)", "turnover": "max(turnover)"}


@query(T.with_tables("holdings", then=f"""
, {_W}, k AS (SELECT *, row_number() OVER (PARTITION BY filer, quarter ORDER BY abs(weight) DESC, asset) AS k FROM w),
g AS (SELECT filer, quarter, {", ".join(f'{e} AS x{i}' for i, e in enumerate(_ACTUAL.values()))} FROM k GROUP BY 1, 2),
l AS ({" UNION ALL ".join(f"SELECT filer, quarter, '{n}' AS \"constraint\", x{i} AS actual, {_LIMITS[n]}::DOUBLE AS bound FROM g" for i, n in enumerate(_ACTUAL))})
SELECT filer, quarter, "constraint", {r('actual', 'actual')}, {r('bound', 'bound')}, round(actual, 9) <= bound AS passed FROM l"""))
def risk_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = risk.constraints(_weights(spark, sf_dir), ["filer", "quarter"], _LIMITS, ["2"], countries=["1"])
    return rounded(got.withColumn("passed", F.round("actual", 9) <= F.col("bound")))


_SYM = "sym AS (SELECT DISTINCT symbol FROM bars_user_d), cand AS (SELECT symbol FROM sym WHERE symbol % 10 <> 0), held AS (SELECT symbol FROM sym WHERE symbol % 10 = 0)"


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, {_SYM}, j AS (SELECT a.symbol, b.symbol AS h, a.ret AS x, b.ret AS y, row_number() OVER (PARTITION BY a.symbol, b.symbol ORDER BY a.ts DESC) AS k, count(*) OVER (PARTITION BY a.symbol, b.symbol) AS n FROM ret a JOIN ret b USING (ts) WHERE a.symbol IN (FROM cand) AND b.symbol IN (FROM held) AND a.ret IS NOT NULL AND b.ret IS NOT NULL),
c AS (SELECT symbol, h, abs(corr(x, y)) AS c FROM j WHERE k <= 60 AND n >= 8 GROUP BY 1, 2), w AS (SELECT symbol, max(c) AS worst FROM c WHERE NOT isnan(c) GROUP BY 1)
SELECT symbol, {r('worst', 'worst')}, coalesce(worst <= 0.7, true) AS passed FROM cand LEFT JOIN w USING (symbol)"""))
def correlation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the symbols is held, the others are candidates; eight common days are enough in these short series."""
    rr = returns(spark, sf_dir)
    names = rr.select("symbol").distinct()
    return rounded(risk.correlated_with_held(names.where("symbol % 10 <> 0"), names.where("symbol % 10 = 0"), rr, least=8))


_INV = "inv AS (SELECT o_custkey % 25 AS desk, o_custkey AS symbol, sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END * 40.0) AS position, avg(o_totalprice) / 1000 AS average_cost, max(o_totalprice) / 1000 AS mark, sum(o_totalprice) / 1e6 AS realised FROM orders GROUP BY 1, 2)"


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_totalprice")
    o = T.table(spark, sf_dir, "orders")
    inv = o.groupBy((F.col("o_custkey") % 25).alias("desk"), F.col("o_custkey").alias("symbol")).agg(F.sum(F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1) * 40.0).alias("position"), (F.avg(p) / 1000).alias("average_cost"), (F.max(p) / 1000).alias("mark"), (F.sum(p) / 1e6).alias("realised"))
    return risk.inventory_levels(inv, 400.0)


_U = "abs(position / 400.0)"


@query(f"""
WITH {_INV} SELECT desk, symbol, {r('position', 'position')}, {r(_U, 'utilisation')}, CASE WHEN {_U} >= 1 THEN 'BREACH' WHEN {_U} >= 0.8 THEN 'CRITICAL' WHEN {_U} >= 0.5 THEN 'ELEVATED' ELSE 'NORMAL' END AS level, {r(f'CASE WHEN {_U} >= 1 THEN 0 WHEN {_U} >= 0.8 THEN 0.25 WHEN {_U} >= 0.5 THEN 1 - ({_U} - 0.5) / (0.8 - 0.5) * 0.75 ELSE 1 END', 'size_multiplier')} FROM inv""")
def inventory_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_inventory(spark, sf_dir).select("desk", "symbol", "position", "utilisation", "level", "size_multiplier"))


@query(f"""
WITH {_INV}, c AS (SELECT *, CASE WHEN average_cost > 0 THEN abs(position * average_cost) ELSE 0 END AS cost, {_U} AS u FROM inv),
g AS (SELECT desk, sum(CASE WHEN position > 0 THEN cost ELSE 0 END) AS long, sum(CASE WHEN position < 0 THEN cost ELSE 0 END) AS short, sum(realised) AS realised, sum(position * (mark - average_cost)) AS unrealised, count(*) AS names, arg_min(symbol, (-u, symbol)) AS worst_symbol, max(u) AS worst_utilisation FROM c GROUP BY desk)
SELECT desk, {r('long', 'long', 4)}, {r('short', 'short', 4)}, {r('long + short', 'gross', 4)}, {r('abs(long - short)', 'net', 4)}, {r('realised', 'realised', 4)}, {r('unrealised', 'unrealised', 4)}, names, worst_symbol, {r('worst_utilisation', 'worst_utilisation', 4)}, long + short <= 1000000 AS within_limit FROM g""")
def inventory_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(risk.inventory_report(_inventory(spark, sf_dir), ["desk"], 1_000_000.0), 4)


@query(f"""
WITH z AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, CASE WHEN count(*) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) >= 10 THEN abs((o_totalprice - avg(o_totalprice) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) / nullif(stddev_pop(o_totalprice) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) END AS z FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderkey, {r('z', 'z')}, coalesce(z > 3, false) AS anomaly FROM z""")
def profit_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = T.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return rounded(risk.profit_anomalies(o, W.Frame(["o_custkey"], ["o_orderdate", "o_orderkey"]), "o_totalprice").select("o_custkey", "o_orderkey", "z", "anomaly"))


@query(T.with_tables("bars_user_d", then=f"""
, {_RET}, p AS (SELECT c_custkey AS symbol, c_acctbal AS quantity FROM customer), x AS (SELECT DISTINCT symbol FROM bars_user_d WHERE close IS NOT NULL), m AS (SELECT count(DISTINCT symbol) AS v FROM p WHERE quantity <> 0 AND symbol NOT IN (FROM x)), n AS (SELECT count(ret) AS v FROM ret)
SELECT 'prices_available' AS "check", v = 0 AS passed, v::DOUBLE AS value FROM m UNION ALL SELECT 'returns_history_adequate', v >= 60, v::DOUBLE FROM n UNION ALL SELECT 'limits_configured', true, 50000.0 UNION ALL SELECT 'nav_positive', true, 1000000.0"""))
def pre_open_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = returns(spark, sf_dir)
    held = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("symbol"), F.col("c_acctbal").alias("quantity"))
    return risk.pre_open(held, rr.select("symbol", F.col("close").alias("price")), rr, {"daily_loss": 50_000.0, "gross": 1_000_000.0}, 1_000_000.0)


_SIZE = "b AS (SELECT symbol, ts, 150.0 + (symbol * 37) % 1200 AS equity, close / 5 AS entry, (high - low) / 100 AS atr, (volume * 23 + symbol) % 101 AS score, CASE symbol % 4 WHEN 0 THEN 'BEAR' WHEN 1 THEN 'NEUTRAL' ELSE 'BULL' END AS regime, symbol % 3 AS open_positions, (symbol % 7) * 0.005 AS open_risk FROM bars_user_d)"


@query(T.with_tables("bars_user_d", then=f"""
, {_SIZE}, a AS (SELECT *, CASE WHEN equity < 250 THEN 1.0 WHEN equity < 500 THEN 0.6 WHEN equity < 1000 THEN 0.4 ELSE 0.3 END AS top, CASE WHEN equity < 250 THEN 1 WHEN equity < 500 THEN 2 WHEN equity < 1000 THEN 3 ELSE 4 END AS most, atr * 1.5 AS each, 0.03 - open_risk AS free,
  equity * CASE WHEN equity < 500 THEN 0.02 ELSE 0.01 END * CASE WHEN score >= 80 THEN 1.0 WHEN score >= 70 THEN 0.75 ELSE 0.5 END * CASE WHEN regime = 'BULL' THEN 1.0 ELSE 0.5 END AS budget FROM b),
r AS (SELECT *, least(budget, equity * free) / nullif(each, 0) AS raw, equity * top AS room FROM a), s AS (SELECT *, least(greatest(floor(raw), 0), floor(room / nullif(entry, 0))) AS s0 FROM r), u AS (SELECT *, CASE WHEN s0 = 0 AND raw > 0 AND entry <= room AND each / equity <= free THEN 1 ELSE s0 END AS s1 FROM s),
w AS (SELECT *, CASE WHEN regime = 'BEAR' THEN 'regime' WHEN entry < 5 THEN 'price' WHEN open_positions >= most THEN 'positions' WHEN each <= 0 THEN 'range' WHEN free <= 0 THEN 'risk' WHEN coalesce(s1, 0) <= 0 THEN 'equity' END AS reject_reason FROM u), z AS (SELECT *, CAST(CASE WHEN reject_reason IS NULL THEN s1 ELSE 0 END AS BIGINT) AS shares FROM w)
SELECT symbol, ts, reject_reason, shares, {r('CASE WHEN reject_reason IS NULL THEN entry - each END', 'stop_price')}, {r('shares * each', 'total_risk')}, {r('shares * each / nullif(equity, 0)', 'risk_pct')} FROM z"""))
def risk_budget_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("symbol")
    b = T.bars_user_d(spark, sf_dir).select("symbol", "ts", ((s * 37) % 1200 + 150).cast("decimal(12,1)").alias("equity"), (F.col("close") / 5).alias("entry"), ((F.col("high") - F.col("low")) / 100).alias("atr"), ((F.col("volume") * 23 + s) % 101).alias("score"), F.when(s % 4 == 0, "BEAR").when(s % 4 == 1, "NEUTRAL").otherwise("BULL").alias("regime"), (s % 3).alias("open_positions"), ((s % 7) * F.lit(Decimal("0.005"))).cast("decimal(6,3)").alias("open_risk"))
    return rounded(risk.risk_budget_size(b).select("symbol", "ts", "reject_reason", "shares", "stop_price", "total_risk", "risk_pct"))


_SG = "g AS (SELECT symbol, ts, close / lag(close, 5) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS signal, 0.02 + volume / 20 AS volatility FROM bars_user_d), a AS (SELECT *, count(*) OVER (PARTITION BY ts) AS n, max(abs(signal)) OVER (PARTITION BY ts) AS top FROM g WHERE signal IS NOT NULL AND signal <> 0)"


def _targets(raw: str) -> str:
    return T.with_tables("bars_user_d", then=f", {_SG}, x AS (SELECT symbol, ts, least(greatest({raw}, -0.05), 0.05) AS w FROM a), y AS (SELECT *, sum(abs(w)) OVER (PARTITION BY ts) AS gr FROM x WHERE abs(w) * 1e10 >= 100000) SELECT symbol, ts, {r('w * least(1, 2 / gr)', 'weight')} FROM y")


def _sized(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    b = T.bars_user_d(spark, sf_dir)
    g = b.select("symbol", "ts", W.returns(F.col("close"), ind.DEFAULT, 5).alias("signal"), (0.02 + F.col("volume") / 20).alias("volatility"))
    return rounded(risk.target_weights(g, "ts", method).select("symbol", "ts", "weight"))


@query(_targets("sign(signal) * 0.02"))
def equal_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sized(spark, sf_dir, "equal")


@query(_targets("sign(signal) * 0.10 / (least(greatest(volatility, 0.05), 1.0) * sqrt(n)) * (0.5 + abs(signal) / top)"))
def volatility_scaled_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sized(spark, sf_dir, "volatility")


@query(T.with_tables("holdings", then=f"""
, {_W}, st AS (SELECT filer, quarter, CASE filer % 3 WHEN 0 THEN 'BEAR' WHEN 1 THEN 'BULL' ELSE 'NEUTRAL' END AS regime, count(*) AS open_positions, 0.5 - sum(abs(weight) * volatility) * 5 AS risk_left, sum(shares) AS cash FROM w GROUP BY 1, 2), se AS (SELECT filer, quarter, sector, sum(abs(weight)) AS exposure FROM w GROUP BY 1, 2, 3),
j AS (SELECT w.filer, w.quarter, w.asset, w.weight >= 0 AS r1, regime NOT IN ('BEAR') AS r2, open_positions < 12 AS r3, w.asset % 9 <> 0 AS r4, risk_left > 0 AS r5, coalesce(exposure, 0) < 0.3 AS r6, w.volatility BETWEEN 0.06 AND 0.16 AS r7, cash >= 10000 AS r8 FROM w JOIN st USING (filer, quarter) LEFT JOIN se USING (filer, quarter, sector))
SELECT filer, quarter, asset AS symbol, array_to_string(list_filter([{", ".join(f"CASE WHEN NOT coalesce(r{i + 1}, false) THEN '{n}' END" for i, n in enumerate(("threshold", "regime", "positions", "duplicate", "risk", "sector", "range", "cash")))}], lambda x: x IS NOT NULL), ',') AS reasons, r1 AND r2 AND r3 AND r4 AND r5 AND r6 AND r7 AND r8 AS passed FROM j"""))
def entry_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _weights(spark, sf_dir)
    k, f = ["filer", "quarter"], F.col("filer") % 3
    state = w.groupBy(*k).agg(F.count("*").alias("open_positions"), (0.5 - F.sum(F.abs("weight") * F.col("volatility")) * 5).alias("risk_left"), F.sum("shares").alias("cash")).withColumns({"regime": F.when(f == 0, "BEAR").when(f == 1, "BULL").otherwise("NEUTRAL"), "most_positions": F.lit(12), "least_trade": F.lit(10000.0)})
    sectors = w.groupBy(*k, "sector").agg(F.sum(F.abs("weight")).alias("exposure"))
    cand = w.select(*k, "symbol", F.col("weight").alias("signal"), "sector", F.col("volatility").alias("atr_pct"), (F.col("symbol") % 9 == 0).alias("held"))
    return risk.entry_rules(cand, state, sectors, k, band=(0.06, 0.16)).select(*k, "symbol", "reasons", "passed")
