"""State of the recursive forecast: pairs that stopped selling, look-backs of the feature list, history bounds."""
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from weekcast.config import ForecastConfig
from weekcast.operators import ml
from weekcast.operators.boosting import BoostedTrees
from weekcast.operators.features import build_features
from weekcast.operators.panel import panel

D = dt.date
CFG = ForecastConfig()
LAST = D(2022, 12, 26)


@pytest.fixture(scope="module")
def weekly(spark):
    rows = [(1, 1, LAST - dt.timedelta(weeks=42 + k), 50.0, 1) for k in range(3)] + [(1, 2, LAST - dt.timedelta(weeks=k), 7.0 + k, 1) for k in range(9)]
    df = spark.createDataFrame(rows, "store_id long, product_id long, week_start date, qty double, n_tx long")
    return df.withColumns({c: F.lit(1.0) for c in ("gross_value", "net_value", "discount")})


def state_row(weekly, span, feats):
    featured = build_features(panel(weekly, CFG, span), None, CFG)
    x = ml.step_features(ml.forecast_state(featured, feats, CFG, LAST), F.lit(D(2023, 1, 2)), CFG, feats)
    return {r.product_id: r for r in x.collect()}


@pytest.mark.parametrize("span", ["local", "to_global_max"])
def test_a_pair_that_stopped_weeks_ago(weekly, span):
    row = state_row(weekly, span, ml.model_features(True))[1]
    assert (row.lag_qty_1, row.zero_streak, row.weeks_since_prev_sale) == (0.0, 42, 43)
    assert row.lag_qty_26 == 0.0 and row.ma_qty_4 == 0.0 and row.n_tx_lag1 == 0 and row.weeks_since_first_sale == 45


def test_any_lag_of_the_feature_list(weekly):
    feats = ["lag_qty_1", "lag_qty_6", "lag_qty_9", "ma_qty_5", "std_qty_3", "active_share_9"]
    assert ml.state_length(feats) == 9
    row = state_row(weekly, "local", feats)[2]
    assert (row.lag_qty_1, row.lag_qty_6, row.lag_qty_9, row.ma_qty_5, row.std_qty_3) == (7.0, 12.0, 15.0, 9.0, 1.0)
    assert row.active_share_9 == 1.0


def test_history_has_to_end_before_the_target(spark, weekly):
    featured = build_features(panel(weekly, CFG, "local"), None, CFG)
    art = {"features": ["lag_qty_1"], "type": "regressor"}
    early = featured.where(F.col("week_start") < F.lit(D(2022, 12, 19)))
    with pytest.raises(ValueError, match="history has to end"):
        ml.forecast_ml(early, art, CFG)
    with pytest.raises(ValueError, match="history has to end"):
        ml.forecast_ml(featured, art, CFG.with_(target_start=D(2022, 12, 5)))


def test_best_round_with_patience():
    assert ml.best_of([3.0, 2.0, 2.5, 2.4, 1.0], patience=10) == 5
    assert ml.best_of([3.0, 2.0, 2.5, 2.4, 1.0], patience=2) == 2


def test_training_needs_rows(spark, weekly):
    featured = build_features(panel(weekly, CFG, "local"), None, CFG)
    with pytest.raises(ValueError, match="no training rows"):
        ml.train(featured.where("false"), CFG, max_iter=1)


def test_rebuilt_features_are_built_once_a_state(spark, weekly, monkeypatch):
    """Not once a feature: some hundred expressions each, seconds of the driver for a whole feature list."""
    featured = build_features(panel(weekly, CFG, "local"), None, CFG)
    calls, built = [], ml.step_columns
    monkeypatch.setattr(ml, "step_columns", lambda *a: calls.append(1) or built(*a))
    assert ml.forecast_state(featured, ml.model_features(True), CFG, LAST).count() == 2
    assert len(calls) == 1


def test_both_stages_are_fitted_at_a_time(spark, weekly, monkeypatch):
    """Each fit waits for the other to begin."""
    met = threading.Barrier(2, timeout=20)

    def fit(name):
        def run(*a, **k):
            met.wait()
            return BoostedTrees("poisson" if name == "reg" else "logistic", ["lag_qty_1"], 0.0, [])
        return run
    monkeypatch.setattr(ml, "fit_classifier", fit("clf"))
    monkeypatch.setattr(ml, "fit_regressor", fit("reg"))
    featured = build_features(panel(weekly, CFG, "to_global_max"), None, CFG)
    art = ml.train(featured, CFG, two_stage=True, features=["lag_qty_1"])
    assert (art["clf"].objective, art["reg"].objective) == ("logistic", "poisson")


def test_steps_run_together_and_the_failure_is_raised(spark):
    done = []

    def fails():
        raise ValueError("no rows")
    assert ml.together(spark, lambda: spark.range(3).count(), lambda: "b") == [3, "b"]
    with pytest.raises(ValueError, match="no rows"):
        ml.together(spark, fails, lambda: done.append(spark.range(2).count()))
    assert done == [2]


def test_a_state_made_before_gives_the_same_forecast(spark, weekly):
    featured = build_features(panel(weekly, CFG, "to_global_max"), None, CFG)
    node = {"feature": "lag_qty_1", "cut": 8.0, "left": 1, "right": 2, "value": 0.0}
    leaf = {"feature": None, "cut": None, "left": None, "right": None}
    model = BoostedTrees("poisson", ["lag_qty_1"], 1.0, [[node, leaf | {"value": 0.5}, leaf | {"value": 1.5}]])
    art = {"type": "regressor", "model": model, "features": ["lag_qty_1"]}
    own = ml.forecast_ml(featured, art, CFG, only_active=True, active_window=4).collect()
    state = ml.starting_state(featured, ["lag_qty_1"], CFG, only_active=True, active_window=4)
    assert sorted(own) == sorted(ml.forecast_ml(featured, art, CFG, state=state).collect())
    assert {r["product_id"] for r in own} == {2} and len(own) == CFG.horizon
