import datetime as dt

import pytest

from weekcast.config import DEFAULT
from weekcast.operators import features as ft

D = dt.date
W0 = D(2022, 1, 3)


def panel(spark, series):
    rows = []
    for (s, p), vals in series.items():
        for i, q in enumerate(vals):
            rows.append((s, p, W0 + dt.timedelta(days=7 * i), float(q), 1 if q else 0, 10.0 * q, 0.0, 0.0))
    return spark.createDataFrame(rows, "store_id long, product_id long, week_start date, qty double, n_tx long, "
                                       "net_value double, gross_value double, discount double")


def test_activity_series(spark):
    f = ft.add_pair_features(panel(spark, {(1, 1): [0, 0, 0, 5, 0]}), DEFAULT, ascoded=True).orderBy("week_start").collect()
    assert [r.zero_streak for r in f] == [0, 1, 2, 3, 0]
    assert [r.weeks_since_last_sale for r in f] == [1, 2, 3, 0, 1]           # as coded (R4)
    assert [r.weeks_since_prev_sale for r in f] == [1, 2, 3, 4, 1]           # causal
    assert [r.weeks_since_first_sale for r in f] == [0, 0, 0, 0, 1]
    assert [r.weeks_since_first_sale_ascoded for r in f] == [-3, -2, -1, 0, 0]   # back-fill (R5)
    assert f[0].active_share_8 is None and f[4].active_share_8 == pytest.approx(0.25)


def test_windows_do_not_cross_pairs(spark):
    f = ft.add_pair_features(panel(spark, {(1, 1): [9, 9, 9, 9], (1, 2): [1, 2]}), DEFAULT)
    r = f.where("product_id = 2").orderBy("week_start").collect()
    assert r[0].lag_qty_1 is None and r[0].ma_qty_4 is None      # trap R2: no leak from pair (1, 1)
    assert r[1].ma_qty_4 == 1.0 and r[1].std_qty_4 is None


def test_lags_stats_price(spark):
    f = ft.add_pair_features(panel(spark, {(1, 1): [1, 3, 0, 5, 7]}), DEFAULT).orderBy("week_start").collect()
    last = f[-1]
    assert (last.lag_qty_1, last.lag_qty_2, last.lag_qty_4) == (5.0, 0.0, 1.0)
    assert last.ma_qty_4 == pytest.approx(9 / 4)
    assert last.diff_qty_1 == 5.0 and last.ratio_qty_12 == pytest.approx(5 / 1e-6)
    assert last.price_u == 10.0 and last.price_u_ma8 == pytest.approx(10.0)
    assert f[2].price_u is None


def test_causality(spark):
    """Features at week t must not change when qty at weeks >= t changes."""
    base = [1, 0, 4, 2, 0, 3, 5]
    changed = base[:4] + [9, 9, 9]
    cols = ["lag_qty_1", "lag_qty_4", "ma_qty_4", "ma_qty_12", "std_qty_4", "price_u_ma8", "active_share_8",
            "weeks_since_prev_sale", "weeks_since_first_sale", "zero_streak", "n_tx_lag1"]
    a = ft.add_pair_features(panel(spark, {(1, 1): base}), DEFAULT).orderBy("week_start").collect()
    b = ft.add_pair_features(panel(spark, {(1, 1): changed}), DEFAULT).orderBy("week_start").collect()
    for i in range(5):          # weeks 0..4 only see weeks < 4 for causal features
        for c in cols:
            assert a[i][c] == b[i][c], (i, c)


def test_level_encodings_causal_vs_ascoded(spark):
    p = panel(spark, {(1, 1): [2, 4], (1, 2): [6, 8]})
    causal = {(r.product_id, r.week_start): r for r in ft.add_level_encodings(p, DEFAULT).collect()}
    r = causal[(2, W0 + dt.timedelta(days=7))]
    assert r.freq_store == 2 and r.avg_qty_store == pytest.approx(4.0)     # store rows of week 0: 2 and 6
    asis = {(r.product_id, r.week_start): r for r in ft.add_level_encodings_ascoded(p, DEFAULT).collect()}
    r = asis[(2, W0)]
    assert r.freq_store == 2 and r.avg_qty_store == pytest.approx(3.0)     # order (product, week): 2, 4 before


def test_level_encodings_are_causal(spark):
    """Store / product history at week t ignores weeks >= t of every pair (trap R6)."""
    base = {(1, 1): [1, 0, 4, 2, 0], (1, 2): [3, 3, 0, 1, 5], (2, 1): [0, 2, 2, 0, 1]}
    changed = {k: v[:3] + [9, 9] for k, v in base.items()}
    cols = ["freq_store", "avg_qty_store", "freq_product", "avg_qty_product"]

    def rows(series):
        out = ft.add_level_encodings(panel(spark, series), DEFAULT).collect()
        return {(r.store_id, r.product_id, r.week_start): r for r in out}

    a, b = rows(base), rows(changed)
    cutoff = W0 + dt.timedelta(days=7 * 3)
    for k, r in a.items():
        if k[2] <= cutoff:
            for c in cols:
                assert r[c] == b[k][c], (k, c)
