"""Model queries on tables with prices of zero, after which signals and returns are infinite."""

import math

import pytest
from test_queries import SF

from tidewell.operators import modeling
from tidewell.plans import registry


@pytest.fixture(scope="session")
def endless(tmp_path_factory):
    """The smallest tables with a value of zero in every fortieth event."""
    import duckdb

    out = tmp_path_factory.mktemp("endless")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 40 = 7 THEN 0 ELSE value END AS value) FROM '{SF}/events.parquet') TO '{out}/events.parquet' (FORMAT parquet)")
    return str(out)


def test_model_search(spark, endless):
    got = registry.queries()["model_search"](spark, endless).collect()
    assert len(got) == 6 and all(math.isfinite(r.mean_rmse) for r in got)


def test_ensemble_search(spark, endless):
    got = registry.queries()["ensemble_search"](spark, endless).collect()
    assert len(got) == 3 and all(math.isfinite(r.rmse) for r in got)


def test_optimised_weights(spark, endless):
    got = registry.queries()["optimised_weights"](spark, endless).collect()
    assert {r.feature for r in got} == {"signal", "level"}
    assert math.isclose(sum(abs(r.weight) for r in got), 1)


def test_walk_forward_predictions(spark, endless):
    got = registry.queries()["walk_forward_predictions"](spark, endless).collect()
    assert got and all(r.prediction is None or math.isfinite(r.prediction) for r in got)
    assert any(r.prediction is None for r in got) and any(r.prediction is not None for r in got)


def test_every_test_row_is_kept(spark):
    """A test row without a finite feature keeps a null prediction, one with an infinite target is predicted."""
    inf = float("inf")
    rows = [(0, "train", float(x), 2.0 * x) for x in range(9)] + [(0, "train", inf, 1.0), (0, "train", 1.0, inf), (0, "test", 3.0, inf), (0, "test", inf, 1.0), (0, "test", None, 1.0), (1, "train", inf, 1.0), (1, "test", 1.0, 1.0)]
    folds = spark.createDataFrame(rows, "fold long, role string, x double, y double")
    got = modeling.walk_forward_ridge(folds, ["x"], "y", 0.0).collect()
    assert sorted((r.fold, r.x or 0.0, r.y, r.prediction and round(r.prediction, 6)) for r in got if r.prediction is not None) == [(0, 3.0, inf, 6.0)]
    assert len(got) == 4
