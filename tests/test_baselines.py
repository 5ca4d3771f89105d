"""Baselines against plain-Python recursions on toy series (brute force)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekcast.config import DEFAULT
from weekcast.operators import baselines as bl

D = dt.date
W0 = D(2022, 1, 3)


def panel(spark, series: dict):
    """series: {(store, product): [(qty, n_tx), ...]} consecutive weeks from W0."""
    rows = []
    for (s, p), vals in series.items():
        for i, (q, n) in enumerate(vals):
            rows.append((s, p, W0 + dt.timedelta(days=7 * i), float(q), int(n)))
    return spark.createDataFrame(rows, "store_id long, product_id long, week_start date, qty double, n_tx long")


def ma4_loop(hist, h=5):
    hist, out = list(hist), []
    for _ in range(h):
        w = hist[-4:]
        y = sum(w) / len(w) if w else 0.0
        out.append(max(0.0, y))
        hist.append(y)
    return out


def ewma_loop(vals, a=0.5):
    if not vals:
        return 0.0
    s = vals[0]
    for y in vals[1:]:
        s = a * y + (1 - a) * s
    return s


SERIES = {
    (1, 1): [(3, 1), (0, 0), (5, 2), (1, 1), (0, 0), (8, 1)],
    (1, 2): [(2, 1)],                      # one-row pair
    (2, 1): [(0, 0), (4, 1), (6, 1)],       # history shorter than 4
    (2, 2): [(0, 1), (0, 0), (0, 0)],       # returns-only week: observed, qty 0
}


def preds(df, col):
    out = {}
    for r in df.orderBy("week_start").collect():
        out.setdefault((r.store_id, r.product_id), []).append(getattr(r, col))
    return out


def test_ma4_recursive_matches_loop(spark):
    got = preds(bl.forecast(panel(spark, SERIES), "ma4"), "pred_ma4")
    for k, vals in SERIES.items():
        assert got[k] == pytest.approx(ma4_loop([q for q, _ in vals]))


def test_naive_last_observed(spark):
    got = preds(bl.forecast(panel(spark, SERIES), "naive"), "pred_naive")
    assert got[(1, 1)] == [8.0] * 5 and got[(2, 1)] == [6.0] * 5 and got[(2, 2)] == [0.0] * 5


def test_ewma_matches_loop(spark):
    got = preds(bl.forecast(panel(spark, SERIES), "ewma"), "pred_ewma")
    for k, vals in SERIES.items():
        obs = [q for q, n in vals if n > 0]
        assert got[k] == pytest.approx([max(0.0, ewma_loop(obs))] * 5)


def test_smart_branches(spark):
    s = dict(SERIES)
    s[(3, 1)] = [(1, 1)] + [(0, 0)] * 12          # inactive in the last 12 rows -> 0
    got = preds(bl.forecast(panel(spark, s), "smart"), "pred_smart")
    assert got[(1, 1)] == pytest.approx([(5 + 1 + 8 + 3) / 4] * 5)   # >= 4 observed: last 4 observed
    assert got[(2, 1)] == pytest.approx([max(6.0, 0.7 * 5.0)] * 5)    # 1-3 observed: blend
    assert got[(3, 1)] == [0.0] * 5


def test_smart_cold_pair_backoff(spark):
    p = panel(spark, SERIES).withColumn("store_category", F.when(F.col("store_id") == 1, "a").otherwise("b"))
    cold = spark.createDataFrame([(9, 1, "a"), (9, 7, "z")], "store_id long, product_id long, store_category string")
    st = bl.smart_state(p, DEFAULT, extra_pairs=cold)
    got = {(r.store_id, r.product_id): r.preds[0] for r in st.collect()}
    obs_cat_a_p1 = [3, 5, 1, 8]                     # product 1 in category a, observed weeks
    assert got[(9, 1)] == pytest.approx(sum(obs_cat_a_p1) / 4)
    all_obs = [q for vals in SERIES.values() for q, n in vals if n > 0]
    assert got[(9, 7)] == pytest.approx(sum(all_obs) / len(all_obs))   # unknown product -> global mean


def test_forecast_weeks_and_counts(spark):
    fc = bl.forecast(panel(spark, SERIES), "smart")
    assert fc.count() == len(SERIES) * 5
    first = fc.where("store_id = 1 AND product_id = 2").orderBy("week_start").first()
    assert first.week_start == W0 + dt.timedelta(days=7)
    assert fc.where("pred_smart < 0").count() == 0


def test_unknown_baseline_raises(spark):
    with pytest.raises(ValueError):
        bl.forecast(panel(spark, SERIES), "prophet")


def test_ewma_alpha_bounds(spark):
    p = panel(spark, SERIES)
    with pytest.raises(ValueError):
        bl.forecast(p, "ewma", alpha=1.5)
    last_only = preds(bl.forecast(p, "ewma", alpha=1.0), "pred_ewma")
    assert last_only[(1, 1)] == [8.0] * 5            # alpha 1: the last observed value
    first_only = preds(bl.forecast(p, "ewma", alpha=0.0), "pred_ewma")
    assert first_only[(1, 1)] == [3.0] * 5           # alpha 0: the first observed value
