"""Models on features by date folds: search, calibration, ensembles, weights. Fits are pyspark.ml, folds and models are few:
they are looped over on the driver, each fit is a Spark job, and the rows are written once to the shared folder before them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import shared


def finite(names: Sequence[str]) -> Column:
    """Whether all the columns are numbers: not null, NaN or infinite. Others take no part in a fit."""
    return reduce(and_, [F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False)) for c in names])


def assembled(df: DataFrame, features: Sequence[str], target: str | None = None) -> DataFrame:
    """The rows with finite features (and target, if one is named) with a vector __x."""
    rows = df.where(finite([*features, target] if target else features))
    return VectorAssembler(inputCols=list(features), outputCol="__x").transform(rows)


def _fitted_folds(rows: DataFrame) -> list[int]:
    """The folds that have train rows."""
    return [r["fold"] for r in rows.where("role = 'train'").select("fold").distinct().orderBy("fold").collect()]


def walk_forward_ridge(folds: DataFrame, features: Sequence[str], target: str, ridge: float = 0.1) -> DataFrame:
    """Predictions on the test rows of each fold by a ridge fitted on its train rows of finite features and targets. Test rows
    with a feature that is not finite, or whose fold has no such train row, keep a null prediction; null targets take no part.
    folds: with fold and role."""
    rows = folds.where(F.col(target).isNotNull())
    train, test = assembled(rows.where("role = 'train'"), features, target), rows.where("role = 'test'")
    known = assembled(test, features)
    fitted = _fitted_folds(train)
    out = test.where(~finite(features) | ~F.col("fold").isin(fitted)).withColumn("prediction", F.lit(None).cast("double"))
    for fold in fitted:
        mine = F.col("fold") == fold
        model = LinearRegression(featuresCol="__x", labelCol=target, regParam=ridge, elasticNetParam=0.0, predictionCol="prediction").fit(train.where(mine))
        out = out.unionByName(model.transform(known.where(mine)).drop("__x"))
    return out


def optimised_weights(folds: DataFrame, features: Sequence[str], target: str, ridge: float = 0.1) -> DataFrame:
    """feature, weight: mean ridge coefficients over the folds' train rows of finite features and targets, divided by their summed
    sizes."""
    rows = assembled(folds.where(F.col("role") == "train"), features, target)
    found = []
    for fold in _fitted_folds(rows):
        model = LinearRegression(featuresCol="__x", labelCol=target, regParam=ridge, elasticNetParam=0.0).fit(rows.where(F.col("fold") == fold))
        found.append([float(c) for c in model.coefficients])
    means = [sum(c) / len(found) for c in zip(*found, strict=True)] if found else [0.0] * len(features)
    total = sum(map(abs, means)) or 1.0
    return folds.sparkSession.createDataFrame([(n, m / total) for n, m in zip(features, means, strict=True)], "feature string, weight double")


def calibrated(df: DataFrame, p: str = "p", y: str = "y") -> DataFrame:
    """p_platt and p_isotonic: logistic and monotone calibration of p against y, in [0, 1]."""
    x = VectorAssembler(inputCols=[p], outputCol="__x").transform(df.withColumn("__y", F.col(y).cast("double")))
    platt = LogisticRegression(featuresCol="__x", labelCol="__y", probabilityCol="__q", rawPredictionCol="__r", predictionCol="__c").fit(x).transform(x)
    iso = IsotonicRegression(featuresCol="__x", labelCol="__y", predictionCol="__i").fit(x)
    return iso.transform(platt).withColumns({"p_platt": vector_to_array("__q")[1], "p_isotonic": F.greatest(F.least("__i", F.lit(1.0)), F.lit(0.0))}).drop("__x", "__y", "__q", "__r", "__c", "__i")


def blended(df: DataFrame, predictions: dict[str, float]) -> DataFrame:
    """prediction: the weighted mean of columns; null columns drop out of both sums."""
    top = sum((F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in predictions.items()), F.lit(0.0))
    low = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(0.0) for c, w in predictions.items()), F.lit(0.0))
    return df.withColumn("prediction", F.try_divide(top, low))


def grid(target: str) -> dict[str, object]:
    """Named regressors of the search: ridge and lasso at three strengths, a forest and boosted trees (fixed seeds)."""
    own = {"featuresCol": "__x", "labelCol": target, "predictionCol": "prediction"}
    models: dict[str, object] = {}
    for strength in (0.01, 0.1, 1.0):
        models[f"ridge_{strength}"] = LinearRegression(regParam=strength, elasticNetParam=0.0, **own)
        models[f"lasso_{strength}"] = LinearRegression(regParam=strength, elasticNetParam=1.0, **own)
    return models | {"forest": RandomForestRegressor(numTrees=10, maxDepth=4, seed=1, **own), "boosted": GBTRegressor(maxIter=5, maxDepth=3, seed=1, **own)}


def model_search(folds: DataFrame, features: Sequence[str], target: str, models: dict[str, object] | None = None) -> DataFrame:
    """model, fold, n, rmse, corr on each fold's test rows. Rows with a feature or target that is not finite take no part, nor do
    folds without train rows. folds: rows with fold and role."""
    rows = shared.pinned(assembled(folds, features, target))
    out = folds.sparkSession.createDataFrame([], f"model string, fold {folds.schema['fold'].dataType.simpleString()}, n long, rmse double, corr double")
    for fold in _fitted_folds(rows):
        mine = rows.where(F.col("fold") == fold)
        for name, model in (models or grid(target)).items():
            part = model.fit(mine.where("role = 'train'")).transform(mine.where("role = 'test'"))
            got = part.agg(F.count("*").alias("n"), F.sqrt(F.avg((F.col("prediction") - F.col(target)) ** 2)).alias("rmse"), F.try_divide(F.covar_pop("prediction", target), F.stddev_pop("prediction") * F.stddev_pop(target)).alias("corr")).select(F.lit(name).alias("model"), F.lit(fold).alias("fold"), "n", "rmse", "corr")
            out = out.unionByName(got)
    return out


def classifiers(target: str) -> dict[str, object]:
    """Named classifiers of the search: logistic regression (ridge and lasso) at two strengths, a forest and boosted trees."""
    own = {"featuresCol": "__x", "labelCol": target, "probabilityCol": "__q", "rawPredictionCol": "__r", "predictionCol": "__c"}
    models: dict[str, object] = {}
    for strength in (0.01, 0.1):
        models[f"logistic_{strength}"] = LogisticRegression(regParam=strength, elasticNetParam=0.0, **own)
        models[f"sparse_logistic_{strength}"] = LogisticRegression(regParam=strength, elasticNetParam=1.0, **own)
    return models | {"forest": RandomForestClassifier(numTrees=10, maxDepth=4, seed=1, **own), "boosted": GBTClassifier(featuresCol="__x", labelCol=target, predictionCol="__c", maxIter=5, maxDepth=3, seed=1).setProbabilityCol("__q").setRawPredictionCol("__r")}


def classifier_search(folds: DataFrame, features: Sequence[str], target: str, models: dict[str, object] | None = None) -> DataFrame:
    """model, fold, n, brier, log_loss, hit_rate on each fold's test rows of a 0/1 target; rmse is the root of the Brier score
    and corr that of probability and target, so that best_model picks the least Brier score. Folds whose train rows have one
    class alone are left out; rows with a null target or a feature that is not finite take no part."""
    rows = shared.pinned(assembled(folds.where(F.col(target).isin(0, 1)).withColumn(target, F.col(target).cast("double")), features).select("fold", "role", "__x", target))
    both = rows.where("role = 'train'").groupBy("fold").agg(F.count_distinct(target).alias("k")).where("k = 2").orderBy("fold").collect()
    out = folds.sparkSession.createDataFrame([], "model string, fold long, n long, brier double, log_loss double, hit_rate double, rmse double, corr double")
    for fold in [r["fold"] for r in both]:
        mine = rows.where(F.col("fold") == fold)
        for name, model in (models or classifiers(target)).items():
            part = model.fit(mine.where("role = 'train'")).transform(mine.where("role = 'test'")).withColumn("__p", vector_to_array("__q")[1])
            q = F.greatest(F.least(F.col("__p"), F.lit(1 - 1e-12)), F.lit(1e-12))
            y = F.col(target)
            brier = F.avg((F.col("__p") - y) ** 2)
            got = part.agg(F.count("*").alias("n"), brier.alias("brier"), F.avg(-(y * F.ln(q) + (1 - y) * F.ln(1 - q))).alias("log_loss"), F.avg(((F.col("__p") > 0.5) == (y == 1)).cast("double")).alias("hit_rate"), F.sqrt(brier).alias("rmse"), F.try_divide(F.covar_pop("__p", target), F.stddev_pop("__p") * F.stddev_pop(target)).alias("corr"))
            out = out.unionByName(got.select(F.lit(name).alias("model"), F.lit(fold).cast("long").alias("fold"), "n", "brier", "log_loss", "hit_rate", "rmse", "corr"))
    return out


def best_model(search: DataFrame) -> DataFrame:
    """model, mean_rmse, mean_corr, best: the least mean error over folds (ties: first by name)."""
    means = search.groupBy("model").agg(F.avg("rmse").alias("mean_rmse"), F.avg("corr").alias("mean_corr"))
    top = means.agg(F.min(F.struct("mean_rmse", "model")).alias("__t"))
    return means.crossJoin(F.broadcast(top)).withColumn("best", F.col("model") == F.col("__t.model")).drop("__t")


def _products(df: DataFrame, predictions: Sequence[str], target: str):
    """Sums of products of the predictions and the target: all that a squared-error ensemble needs, in one aggregate."""
    import numpy as np

    names = [*predictions, target]
    row = df.dropna(subset=names).agg(F.count("*").alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"s{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if j >= i]).first()
    return row["n"], np.array([[row[f"s{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(len(names))] for i in range(len(names))], float)


def greedy_ensemble(df: DataFrame, predictions: Sequence[str], target: str, rounds: int = 10) -> dict[str, float]:
    """Weights by forward selection with replacement: each round adds the prediction that makes the mean's squared error
    least (ties: the first), and stops when none improves it."""
    import numpy as np

    n, s = _products(df, predictions, target)
    k, counts, best = len(predictions), np.zeros(len(predictions)), np.inf
    error = lambda w: w @ s[:k, :k] @ w - 2 * w @ s[:k, k] + s[k, k]
    for _ in range(rounds if n else 0):
        tried = [error((counts + np.eye(k)[i]) / (counts.sum() + 1)) for i in range(k)]
        if min(tried) >= best - 1e-12:
            break
        best = min(tried)
        counts[int(np.argmin(tried))] += 1
    total = counts.sum() or 1.0
    return {p: float(c / total) for p, c in zip(predictions, counts, strict=True) if c}


def stacked_ensemble(df: DataFrame, predictions: Sequence[str], target: str, ridge: float = 1.0) -> dict[str, float]:
    """Weights of a ridge regression of the target on the predictions, without an intercept, from their products."""
    import numpy as np

    n, s = _products(df, predictions, target)
    k = len(predictions)
    w = np.linalg.solve(s[:k, :k] + ridge * np.eye(k), s[:k, k]) if n else np.zeros(k)
    return dict(zip(predictions, map(float, w), strict=True))


def weighted(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """prediction: the sum of the columns times their weights; null where one of them is null."""
    return df.withColumn("prediction", sum((F.col(c) * w for c, w in weights.items()), F.lit(0.0)))


def ensemble_search(folds: DataFrame, predictions: Sequence[str], target: str) -> DataFrame:
    """method, n, rmse, best: mean, greedy and stacked ensembles fitted on train rows and scored on the test rows of all
    folds. Rows with a prediction or target that is not finite take no part. folds: with fold and role."""
    rows = shared.pinned(folds.where(finite([*predictions, target])))
    parts = None
    for fold in [r["fold"] for r in rows.select("fold").distinct().orderBy("fold").collect()]:
        train, test = (rows.where((F.col("fold") == fold) & (F.col("role") == role)) for role in ("train", "test"))
        for name, weights in (("mean", {p: 1 / len(predictions) for p in predictions}), ("greedy", greedy_ensemble(train, predictions, target)), ("stacked", stacked_ensemble(train, predictions, target))):
            got = weighted(test, weights).select(F.lit(name).alias("method"), "prediction", F.col(target).alias("y"))
            parts = got if parts is None else parts.unionByName(got)
    scores = parts.groupBy("method").agg(F.count("*").alias("n"), F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2)).alias("rmse"))
    top = scores.agg(F.min(F.struct("rmse", "method")).alias("__t"))
    return scores.crossJoin(F.broadcast(top)).withColumn("best", F.col("method") == F.col("__t.method")).drop("__t")


def raw_against_calibrated(df: DataFrame, p: str = "p", y: str = "y") -> DataFrame:
    """kind (raw, platt, isotonic), brier, best: in-sample Brier scores of p and of its calibrations."""
    c = calibrated(df, p, y)
    long = c.select(F.col(y).alias("__y"), F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(x).alias("q")) for n, x in (("raw", p), ("platt", "p_platt"), ("isotonic", "p_isotonic"))])).alias("x")).select("__y", "x.*")
    scores = long.groupBy("kind").agg(F.avg((F.col("q") - F.col("__y")) ** 2).alias("brier"))
    top = scores.agg(F.min(F.struct("brier", "kind")).alias("__t"))
    return scores.crossJoin(F.broadcast(top)).withColumn("best", F.col("kind") == F.col("__t.kind")).drop("__t")
