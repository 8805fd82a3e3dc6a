"""Queries on inference: robust errors, bootstrap, permutation tests, stability of selection, mean correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import shared
from ..functions import windows as W
from ..operators import indicators as ind
from ..operators import evaluate as ev
from ..operators import inference, lineage
from ..sources import tables as T
from ._common import cdf_sql, mixed_sql, r, rounded
from .registry import oracle_sql, query

_LAGS = "CASE WHEN n > 20 THEN CAST(floor(round(4 * pow(n / 100, 2 / 9), 9)) AS INTEGER) ELSE 0 END"


@query(T.with_tables("bars_supp_d", then=f"""
, q AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS y FROM bars_supp_d), b AS (SELECT ts, avg(y) AS x FROM q GROUP BY ts), j AS (SELECT symbol, ts, y, x, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM q JOIN b USING (ts) WHERE y IS NOT NULL AND x IS NOT NULL),
o AS (SELECT symbol, count(*) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base, sum(x * x) / (count(*) * sum(x * x) - sum(x) * sum(x)) AS a, -sum(x) / (count(*) * sum(x * x) - sum(x) * sum(x)) AS c, count(*) / (count(*) * sum(x * x) - sum(x) * sum(x)) AS d, sum(y * y) - sum(y) * sum(y) / count(*) AS sst FROM j GROUP BY symbol HAVING count(*) > 2 AND var_pop(x) > 0),
e AS (SELECT symbol, i, x, y - base - slope * x AS e, {_LAGS} AS lags FROM j JOIN o USING (symbol)),
p AS (SELECT s.symbol, 1 - (s.i - t.i) / (s.lags + 1) AS w, s.e * t.e AS ee, s.x AS xs, t.x AS xt FROM e s JOIN e t ON s.symbol = t.symbol AND s.i - t.i >= 1 AND s.i - t.i <= s.lags),
g AS (SELECT symbol, sum(e * e) AS s00, sum(x * e * e) AS s01, sum(x * x * e * e) AS s11, max(lags) AS lags FROM e GROUP BY symbol), h AS (SELECT symbol, sum(w * ee) AS h00, sum(w * ee * (xs + xt)) AS h01, sum(w * ee * xs * xt) AS h11 FROM p GROUP BY symbol),
z AS (SELECT o.*, lags, s00 AS sse, s00 + 2 * coalesce(h00, 0) AS s00, s01 + coalesce(h01, 0) AS s01, s11 + 2 * coalesce(h11, 0) AS s11 FROM o JOIN g USING (symbol) LEFT JOIN h USING (symbol)),
v AS (SELECT *, sqrt(abs(CASE WHEN n > 20 THEN a * a * s00 + 2 * a * c * s01 + c * c * s11 ELSE a * sse / (n - 2) END)) AS se0, sqrt(abs(CASE WHEN n > 20 THEN c * c * s00 + 2 * c * d * s01 + d * d * s11 ELSE d * sse / (n - 2) END)) AS se1 FROM z),
u AS (SELECT symbol, 'alpha' AS term, base AS beta, se0 AS se, n, lags, 1 - sse / sst AS r2 FROM v UNION ALL SELECT symbol, 'm', slope, se1, n, lags, 1 - sse / sst FROM v)
SELECT symbol, term, {r('beta', 'beta')}, {r('se', 'se')}, {r('beta / se', 't', 5)}, {r('r2', 'r2')}, n, lags FROM u"""))
def factor_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier's exposure to the mean return of all, with autocorrelation-robust t values."""
    b = T.bars_supp_d(spark, sf_dir)
    q = b.select("symbol", "ts", W.returns(F.col("close"), ind.DEFAULT).alias("y"))
    got = inference.newey_west(q.join(q.groupBy("ts").agg(F.avg("y").alias("m")), "ts"), ["symbol"], "ts", "y", ["m"])
    return rounded(rounded(got.drop("p").withColumn("t", F.round(F.col("t") + 3.3e-9, 5))))


@query(T.with_tables("bars_h", then=f"""
, q AS (SELECT symbol, ts, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars_h), v AS MATERIALIZED (SELECT symbol, ret, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM q WHERE ret IS NOT NULL),
d AS (SELECT symbol, n, rep, unnest(generate_series(0, (n - 1) // 21)) AS blk FROM (SELECT DISTINCT symbol, n, unnest(generate_series(0, 499)) AS rep FROM v)), s AS (SELECT *, {mixed_sql('rep', 'blk', '0')} % n AS start FROM d),
o AS (SELECT symbol, n, rep, blk, start, unnest(generate_series(0, least(21, n - blk * 21) - 1)) AS off FROM s), g AS (SELECT o.symbol, rep, avg(ret) AS m, stddev_samp(ret) AS sd FROM o JOIN v ON v.symbol = o.symbol AND v.i = (start + off) % o.n GROUP BY 1, 2),
x AS (SELECT symbol, CASE WHEN sd > 1e-12 THEN m / sd * sqrt(252) END AS s FROM g)
SELECT symbol, count(*) AS replicates, {r('quantile_cont(s, 0.05)', 'low')}, {r('quantile_cont(s, 0.95)', 'high')} FROM x GROUP BY symbol"""))
def bootstrap_sharpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_h(spark, sf_dir).withColumn("ret", W.returns(F.col("close"), ind.DEFAULT))
    return rounded(inference.bootstrap(b, ["symbol"], "ts"))


def _permuted_sql(walks: int, rounds: int = 6) -> str:
    """CTEs from g(symbol, i, s, rep, n) to w(..., v): row i under the permutation of operators.inference.permuted."""
    parts, last = [], "g0"
    parts.append("g0 AS (SELECT *, i AS v, CAST(ceil(sqrt(n)) AS BIGINT) AS a, CAST(ceil(n / ceil(sqrt(n))) AS BIGINT) AS b FROM g)")
    for k in range(walks):
        parts.append(f"x{k}_0 AS (SELECT *, v % a AS x, v // a AS y FROM {last})")
        for j in range(rounds):
            x, y, a = ("x", "y", "a") if j % 2 == 0 else ("y", "x", "b")
            parts.append(f"x{k}_{j + 1} AS (SELECT * REPLACE (({x} + {mixed_sql(y, str(j), 'rep', '0')}) % {a} AS {x}) FROM x{k}_{j})")
        last = f"g{k + 1}"
        keep = "v" if k else "-1"  # every row moves once, then only what is outside
        parts.append(f"{last} AS (SELECT * EXCLUDE (x, y) REPLACE (CASE WHEN {k} > 0 AND {keep} < n THEN v ELSE y * a + x END AS v) FROM x{k}_{rounds})")
    return ",\n".join([*parts, f"w AS (SELECT * FROM {last})"])


@query(T.with_tables("bars_h", then=f"""
, q AS (SELECT symbol, ts, close / lag(close) OVER o - 1 AS s, lead(close) OVER o / close - 1 AS r FROM bars_h WINDOW o AS (PARTITION BY symbol ORDER BY ts)), k AS MATERIALIZED (SELECT symbol, s, r, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS n FROM q WHERE s IS NOT NULL AND r IS NOT NULL),
g AS (SELECT symbol, i, s, n, unnest(generate_series(1, 100)) AS rep FROM k), {_permuted_sql(6)},
m AS (SELECT w.symbol, rep, avg(w.s * k.r) AS m FROM w JOIN k ON k.symbol = w.symbol AND k.i = w.v GROUP BY 1, 2), e AS (SELECT symbol, avg(s * r) AS real FROM k GROUP BY symbol)
SELECT symbol, {r('max(real)', 'real')}, {r('avg(m)', 'mean')}, {r('stddev_samp(m)', 'std')}, {r('(count_if(round(m - real, 12) >= 0) + 1) / (count(*) + 1)', 'p')}, {r('(max(real) - avg(m)) / nullif(stddev_samp(m), 0)', 'z')} FROM m JOIN e USING (symbol) GROUP BY symbol"""))
def shuffle_bias_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = T.bars_h(spark, sf_dir)
    c = F.col("close")
    x = b.select("symbol", "ts", W.returns(c, ind.DEFAULT).alias("signal"), W.forward_returns(c, ind.DEFAULT).alias("ret"))
    return rounded(inference.shuffle_test(x, ["symbol"], "ts", "signal", "ret"))


_FEATURES = {"l_quantity": "l_quantity", "l_discount": "l_discount", "l_tax": "l_tax", "line": "l_linenumber", "supplier": "l_suppkey % 10"}


@query(f"""
WITH f AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_returnflag AS flag, l_extendedprice * (1 - l_discount) AS y, {", ".join(f"{e} AS f{i}" for i, e in enumerate(_FEATURES.values()))} FROM lineitem),
s AS (SELECT * FROM (SELECT *, unnest(generate_series(0, 50)) AS s FROM f) WHERE s = 0 OR {mixed_sql('id', 's', '0')} % 1000 < 500),
c AS (SELECT flag, s, unnest([{", ".join(f"'{n}'" for n in _FEATURES)}]) AS feature, unnest([{", ".join(f"abs(corr(f{i}, y))" for i in range(len(_FEATURES)))}]) AS c FROM s GROUP BY flag, s),
k AS (SELECT *, row_number() OVER (PARTITION BY flag, s ORDER BY round(c, 9) DESC, feature) AS k FROM c)
SELECT flag, feature, {r('max(CASE WHEN s = 0 THEN c END)', 'importance')}, {r('avg(CASE WHEN s > 0 THEN CASE WHEN k <= 2 THEN 1.0 ELSE 0 END END)', 'selected')}, avg(CASE WHEN s > 0 THEN CASE WHEN k <= 2 THEN 1.0 ELSE 0 END END) >= 0.5 AS stable FROM k GROUP BY flag, feature""")
def feature_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which features of a line explain its price, chosen on 50 half samples."""
    li = T.table(spark, sf_dir, "lineitem")
    rows = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_returnflag").alias("flag"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("y"), *[F.expr(e).alias(n) for n, e in _FEATURES.items()])
    return rounded(inference.stability_selection(rows, "id", "y", list(_FEATURES), top=2, keys=["flag"]))


@query(T.with_tables("bars_supp_d", then=f"""
, d AS (SELECT symbol, ts, volume - avg(volume) OVER (PARTITION BY symbol) AS d FROM bars_supp_d), u AS MATERIALIZED (SELECT symbol, ts, d / sqrt(sum(d * d) OVER (PARTITION BY symbol)) AS u FROM d),
p AS (SELECT x.symbol, y.symbol AS other, sum(x.u * y.u) AS c FROM u x JOIN u y ON x.ts = y.ts AND x.symbol <> y.symbol GROUP BY 1, 2), n AS (SELECT count(DISTINCT symbol) AS n FROM u), m AS (SELECT sum(c) / max(n * (n - 1)) AS m FROM p, n)
SELECT symbol, {r('sum(c) / max(n - 1)', 'mean_corr')}, {r('max(m)', 'market_corr')} FROM p, n, m GROUP BY symbol"""))
def market_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean correlation of each supplier's daily volume with all others'; the SQL forms the pairs."""
    return rounded(inference.mean_correlation(T.bars_supp_d(spark, sf_dir), "symbol", "ts", "volume"))


@query("""
WITH t AS (SELECT event_type AS name, user_id AS id, user_id % 3 AS seq, (user_id * 7919 % 1009 + 0.5) / 1009 * CASE WHEN user_id % 5 = 0 THEN 0.002 ELSE 1 END AS p FROM (SELECT DISTINCT event_type, user_id FROM events)),
u AS (SELECT p, unnest(generate_series(seq, 2)) AS upto FROM t), k AS (SELECT upto, p, row_number() OVER (PARTITION BY upto ORDER BY p) AS k, count(*) OVER (PARTITION BY upto) AS m FROM u), c AS (SELECT upto, max(p) AS cut FROM k WHERE p <= k * 0.05 / m GROUP BY upto)
SELECT 'run' || seq AS run, name, id, coalesce(p <= (SELECT cut FROM c WHERE upto = seq), false) AS rejected_then, coalesce(p <= (SELECT cut FROM c WHERE upto = 2), false) AS rejected_now FROM t""")
def trial_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of trials go into a registry, the second one twice."""
    u = F.col("user_id")
    e = T.table(spark, sf_dir, "events").select(F.col("event_type").alias("name"), u).distinct()
    trials = e.select("name", u.alias("id"), ((u * 7919 % 1009 + 0.5).cast("double") / 1009 * F.when(u % 5 == 0, 0.002).otherwise(1.0)).alias("p"), (u % 3).alias("part"))
    path = shared.scratch(spark, "trials")
    for run in (0, 1, 1, 2):
        lineage.register_trials(trials.where(F.col("part") == run).drop("part"), path, f"run{run}")
    got = lineage.trial_verdicts(lineage.registered_trials(spark, path))
    return got.select("run", "name", "id", "rejected_then", "rejected_now")


@query(T.with_tables("bars_h", then=f"""
, q AS (SELECT symbol, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars_h), m AS (SELECT symbol, count(ret) AS n, avg(ret) / nullif(stddev_samp(ret), 0) AS s, CASE WHEN count(ret) > 2 THEN skewness(ret) END AS skew, CASE WHEN count(ret) > 3 THEN kurtosis(ret) END AS kurt FROM q GROUP BY symbol),
z AS (SELECT *, CASE WHEN n > 1 THEN (s - {ev.best_of_trials(10)!r} / sqrt(n - 1)) / sqrt(greatest(1 - skew * s + (kurt + 2) / 4 * s * s, 1e-12) / (n - 1)) END AS z FROM m)
SELECT symbol, n, {r('s * sqrt(252)', 'sharpe')}, {r(cdf_sql('z'), 'deflated')}, low, high, coalesce({cdf_sql('z')} > 0.95 AND low > 0, false) AS robust FROM z LEFT JOIN ({oracle_sql()['bootstrap_sharpe']}) b USING (symbol)"""))
def robustness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly moves as returns, each series as one of ten trials."""
    b = T.bars_h(spark, sf_dir).withColumn("ret", W.returns(F.col("close"), ind.DEFAULT))
    return rounded(inference.robustness_summary(b, ["symbol"], "ts", trials=10))
