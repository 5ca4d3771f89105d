"""The one-pass back-test against plain Python and against the summary of its own rows."""
import datetime as dt
import random
import re

import pytest

import __spark_entry__ as E
from test_baselines import ewma_loop, ma4_loop
from weekcast.config import ForecastConfig
from weekcast.operators.baselines import BASELINES, forecast_state, with_state
from weekcast.operators.evaluate import backtest, backtest_summary, bearing_rows, eval_rows, split_history, validation_horizon
from weekcast.operators.features import lag_columns

W0 = dt.date(2022, 1, 3)
CUT = W0 + dt.timedelta(weeks=20)
CFG = ForecastConfig(cutoff=CUT, valid_end=CUT + dt.timedelta(weeks=4))
SF = "/root/testdata/sf0.001"


def series(seed=3):
    """(store, product) -> {week number: (qty, n_tx)}: pairs with gaps, without history, that end early, and past the window."""
    rng = random.Random(seed)
    out = {}
    for k in range(40):
        weeks = [w for w in range(26) if rng.random() < (0.9 if k % 3 else 0.4)]
        if k % 10 == 1:
            weeks = [w for w in weeks if w >= 21]           # first seen after the cut-off
        if k % 10 == 2:
            weeks = [w for w in weeks if w < 9] + [22]      # last history week far before the cut-off: step beyond the horizon
        out[(k % 5, k)] = {w: (float(rng.randint(0, 9)), rng.randint(0, 2)) for w in weeks}
    return out


def frame(spark, data, lag=False):
    rows = [(s, p, W0 + dt.timedelta(weeks=w), q, n, (None if lag and w % 2 else 1.0)) for (s, p), d in data.items()
            for w, (q, n) in d.items()]
    return spark.createDataFrame(rows, "store_id long, product_id long, week_start date, qty double, n_tx long, lag_qty_1 double")


def smart(vals):
    """Forecast of one pair's history [(qty, n_tx)], rows in order."""
    if not any(n > 0 for _, n in vals[-12:]):
        return 0.0
    seen = [q for q, n in vals if n > 0]
    return sum(seen[-4:]) / 4 if len(seen) >= 4 else max(seen[-1], 0.7 * sum(seen) / len(seen))


def expected(data, name):
    h = len({w for d in data.values() for w in d if 20 <= w < 24})
    out = {}
    for (s, p), d in data.items():
        past = [(w, *d[w]) for w in sorted(d) if w < 20]
        vals = [(q, n) for _, q, n in past]
        seen = [q for q, n in vals if n > 0]
        for w in (w for w in d if 20 <= w < 24):
            step = w - past[-1][0] if past else 0
            pred = None
            if 1 <= step <= h:
                pred = {"ma4": lambda: ma4_loop([q for q, _ in vals], h)[step - 1],
                        "naive": lambda: seen[-1] if seen else vals[-1][0],
                        "ewma": lambda: ewma_loop(seen), "smart": lambda: smart(vals)}[name]()
            out[(s, p, W0 + dt.timedelta(weeks=w))] = (d[w][0], pred or 0.0, pred is None)
    return out


@pytest.mark.parametrize("name", BASELINES)
def test_rows_and_summary_match_plain_python(spark, name):
    data = series()
    want = expected(data, name)
    got = {(r.store_id, r.product_id, r.week_start): (r.y_true, r.y_pred, r.unseen) for r in eval_rows(frame(spark, data), name, CFG).collect()}
    assert got.keys() == want.keys()
    for k, (y, pred, unseen) in want.items():
        assert got[k] == (y, pytest.approx(pred), unseen), k
    assert {u for _, _, u in want.values()} == {True, False}
    s = backtest(frame(spark, data), name, CFG).first()
    err, tot = sum(abs(y - p) for y, p, _ in want.values()), sum(y for y, _, _ in want.values())
    pos = sum(abs(y - p) for y, p, _ in want.values() if y > 0)
    assert s.wmape_all == pytest.approx(err / tot) and s.wmape_pos == pytest.approx(pos / tot)
    assert (s.rows, s.positive_rows, s.unseen_rows, s.horizon) == (
        len(want), sum(y > 0 for y, _, _ in want.values()), sum(u for _, _, u in want.values()), 4)


@pytest.mark.parametrize("restrict", (False, True))
def test_summary_equals_summary_of_rows(spark, restrict):
    p = frame(spark, series(7), lag=True)
    horizon = validation_horizon(split_history(p, CFG)[1], CFG)
    want = backtest_summary(eval_rows(p, "ewma", CFG, restrict_lags=restrict), "week_start", horizon).first()
    got = backtest(p, "ewma", CFG, restrict_lags=restrict).first()
    assert got.asDict() == pytest.approx(want.asDict())
    assert got.rows < p.count()


@pytest.mark.parametrize("name", BASELINES)
def test_window_state_equals_grouped_state(spark, name):
    p = frame(spark, series(11))
    hist = p.week_start < CUT
    grouped = {(r.store_id, r.product_id): (r.last_week, r.preds) for r in forecast_state(p.where(hist), name, CFG, 4).collect()}
    rows = with_state(p, hist, name, CFG, 4).collect()
    assert any(r.last_week is None for r in rows)
    for r in rows:
        if r.last_week is not None:
            last, preds = grouped[(r.store_id, r.product_id)]
            assert r.last_week == last and r._preds == pytest.approx(preds[:len(r._preds)])


def test_no_validation_week_raises_and_empty_panel_too(spark):
    p = frame(spark, series()).where(f"week_start < DATE '{CUT}'")
    for df in (p, p.limit(0)):
        with pytest.raises(Exception, match="no validation weeks"):
            backtest(df, "smart", CFG).collect()


def test_backtest_reads_its_input_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in BASELINES:
            p = E.queries()[f"backtest_{name}"](spark, SF)._jdf.queryExecution().executedPlan().toString()
            above, below = p.split("Generate posexplode")             # once; the fixture itself joins a register below it
            assert "Join" not in above and "Exchange hashpartitioning(store_id" not in above, name
            assert len(re.findall(r"FileScan parquet.*lineitem\.parquet", below)) == 1, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def gapless(spark, seed=5):
    """A panel without gaps: pairs of many quiet weeks, ended before the cut-off, first seen after it, past the window."""
    rng = random.Random(seed)
    rows = []
    for k in range(30):
        first, last = (21, 25) if k % 10 == 1 else (0, 12) if k % 10 == 2 else (rng.randint(-60, 5), rng.randint(18, 26))
        for w in range(first, last + 1):
            n = 1 if w in (first, last) or rng.random() < 0.1 else 0
            rows.append((k % 5, k, W0 + dt.timedelta(weeks=w), float(rng.randint(1, 9)) if n else 0.0, n))
    return spark.createDataFrame(rows, "store_id long, product_id long, week_start date, qty double, n_tx long")


@pytest.mark.parametrize("observed", (True, False))
@pytest.mark.parametrize("name", BASELINES)
def test_filled_weeks_that_no_forecast_needs_are_not_sorted(spark, name, observed):
    p = gapless(spark) if observed else gapless(spark).drop("n_tx")
    for cfg in (CFG, CFG.with_(cutoff=CUT - dt.timedelta(days=3)))[:1 + observed]:     # a cut-off between weeks
        want = sorted(map(str, eval_rows(p, name, cfg).collect()))
        assert want == sorted(map(str, eval_rows(p, name, cfg, gapless=True).collect())) and want
        assert backtest(p, name, cfg).collect() == backtest(p, name, cfg, gapless=True).collect()
        past, kept = p.where(p.week_start < cfg.cutoff), bearing_rows(p, name, cfg).where(p.week_start < cfg.cutoff)
        if name == "ma4":
            assert kept.count() <= 4 * 30
        elif observed:
            quiet, pairs = kept.where("n_tx = 0").count(), past.select("product_id").distinct().count()
            assert kept.where("n_tx > 0").count() == past.where("n_tx > 0").count()
            assert quiet <= (12 if name == "smart" else 1) * pairs < past.where("n_tx = 0").count()


def test_lags_of_validation_rows_need_only_the_last_weeks(spark):
    lags = lag_columns(CFG, (1, 4, 12))
    p = gapless(spark)
    want = backtest(p.withColumns(lags), "smart", CFG, restrict_lags=True).first()
    kept = bearing_rows(p, "smart", CFG, 12)
    assert backtest(kept.withColumns(lags), "smart", CFG, restrict_lags=True, gapless=True).first() == want
    assert kept.count() < p.count() and 0 < want.rows


def test_backtest_queries_drop_filled_weeks_before_the_sort(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("backtest_naive", "backtest_ma4", "backtest_ewma", "backtest_smart", "backtest_restrict_lags", "eval_rows", "wmape"):
            above = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString().split("Generate posexplode")[0]
            last = above.rsplit("Sort [", 1)[1]                           # between the fill and the first sort of its rows
            assert "Filter" in last and "datediff" in last, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
