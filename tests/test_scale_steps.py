"""Steps that sort, shuffle or round every panel row: one sort, bounded parts, no join of the filled weeks."""
import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from weekcast.config import DEFAULT
from weekcast.operators import features as ft
from weekcast.operators.ml import latest_rows
from weekcast.operators.panel import PANEL_PARTS, enrich_panel, panel, panel_local
from weekcast.operators.weekly import weekly_sales
from weekcast.plans.queries import round6
from weekcast.session import stored

W0 = dt.date(2022, 1, 3)
SPARSE = [(1, 1, 0, 2), (1, 1, 5, 4), (1, 2, 3, 6), (1, 3, 9, 1), (1, 3, 11, 8), (2, 1, 1, 5), (2, 1, 2, 7), (2, 2, 7, 3), (3, 3, 4, 0), (3, 3, 8, 0)]


def weekly(spark, rows=SPARSE):
    return spark.createDataFrame([(s, p, W0 + dt.timedelta(days=7 * k), None if q is None else float(q)) for s, p, k, q in rows],
                                 "store_id long, product_id long, week_start date, qty double")


def static_plan(spark, make):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_panel_parts_are_given(spark):
    """Left to AQE, the few bytes of the sparse rows would make one part of them (and of the panel)."""
    p = panel_local(weekly(spark))
    p.collect()
    assert p.rdd.getNumPartitions() == PANEL_PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_features_and_latest_rows_sort_once(spark):
    """One sort for the sparse rows, one for the panel: none of the feature rows in descending order."""
    plan = static_plan(spark, lambda: latest_rows(ft.add_pair_features(panel_local(weekly(spark)), ascoded=True)))
    assert len(re.findall(r"\bSort \[", plan)) == 2 and "DESC" not in plan


def test_latest_rows_are_the_last_weeks(spark):
    got = {(r.store_id, r.product_id): r.week_start for r in latest_rows(panel_local(weekly(spark))).collect()}
    last = {}
    for s, p, k, _ in SPARSE:
        last[(s, p)] = max(last.get((s, p), W0), W0 + dt.timedelta(days=7 * k))
    assert got == last


def test_activity_equals_plain_loops(spark):
    """Unknown quantities leave the shares, as they leave a mean; the next sale comes from an ascending window."""
    ys = [0, 3, None, 0, 0, 5, 1, 0, None, 0, 2, 0]
    rows = ft.add_pair_features(weekly(spark, [(1, 1, k, y) for k, y in enumerate(ys)]), ascoded=True).orderBy("week_start").collect()
    for i, r in enumerate(rows):
        seen = [y > 0 for y in ys[max(0, i - 8):i] if y is not None]
        assert r.active_share_8 == (sum(seen) / len(seen) if seen else None), i
        ahead = [j for j in range(i, len(ys)) if ys[j] is not None and ys[j] > 0]
        assert r.weeks_since_first_sale_ascoded == (i - ahead[0] if ahead else 0), i
    plan = static_plan(spark, lambda: ft.add_pair_features(weekly(spark)).select("active_share_26", "active_share_13"))
    assert "RowFrame, -26, -1)" not in plan and "RowFrame, -13, -1)" not in plan        # no frame that is summed again for every row


def test_round6_equals_sparks_round(spark):
    xs = [0.0, -0.0, 0.5e-6, 1.5e-6, 2.5e-6, -0.5e-6, -2.5e-6, 1e-7, -1e-7, 0.1234565, 12345.678949999, 1e15 + 0.3, -1e300, 1e300,
          float("inf"), float("-inf"), float("nan"), None, 0.49999999999999994e-6, 4503599627.370497, 1 / 3, 2 / 3]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", round6("x").alias("got"), (F.round(F.col("x") * 1e6, 0) / 1e6).alias("want"))
    for r in df.collect():
        same = r.got is r.want or (r.got == r.want and math.copysign(1, r.got) == math.copysign(1, r.want)) or (r.got != r.got and r.want != r.want)
        assert same, r
    assert "round(" not in static_plan(spark, lambda: df.select("got"))


def test_registers_are_joined_before_the_fill(spark):
    """Repeated and absent register keys give the rows of the plain join of the panel."""
    wk = weekly(spark)
    stores = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "store_id long, premise string")
    products = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (9, "z"), (None, "n")], "product_id long, brand string")
    want = enrich_panel(panel_local(wk), stores, products)
    got = enrich_panel(wk, stores, products, fill=panel_local)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") < plan.index("Join LeftOuter")        # printed from the top: the joins lie under the fill


@pytest.mark.parametrize("span", ["local", "to_global_max"])
def test_history_of_many_stores_does_not_move_the_panel(spark, span, monkeypatch):
    """With more stores than are broadcast, the panel is shuffled once, by store, and the rows are the same."""
    wk = stored(weekly(spark), "weekly-test")
    want = sorted(map(str, ft.add_level_encodings(panel(wk, DEFAULT, span), DEFAULT).select(sorted(panel(wk, DEFAULT, span).columns) + ["freq_store", "freq_product", "avg_qty_store", "avg_qty_product"]).collect()))
    for limit, by in ((2_000, None), (2, ["store_id"]), (0, ["store_id"])):
        monkeypatch.setattr(ft, "BROADCAST_LEVELS", limit)
        many = weekly(spark, [(9, 1, 0, 1)]) if limit == 2 else wk
        assert ft.history_by(wk) == by or limit == 2
        got = ft.add_level_encodings(panel(wk, DEFAULT, span, by=by), DEFAULT, wk, span)
        got = got.select(sorted(panel(wk, DEFAULT, span).columns) + ["freq_store", "freq_product", "avg_qty_store", "avg_qty_product"])
        assert sorted(map(str, got.collect())) == want, limit
    monkeypatch.setattr(ft, "BROADCAST_LEVELS", 0)
    monkeypatch.setattr(ft, "_few", lambda weekly, level: level == "product_id")
    plan = static_plan(spark, lambda: ft.add_pair_features(ft.add_level_encodings(panel(wk, DEFAULT, span, by=ft.history_by(wk)), DEFAULT, wk, span)))
    assert "ShuffledHashJoin [store_id" in plan and "hashpartitioning(store_id#" in plan
    above = plan[:plan.index("Generate posexplode")]
    assert "Exchange" not in above                                        # from the fill to the features nothing is shuffled


def test_money_sums_stay_exact_with_values_beyond_the_decimal(spark):
    rows = [(1, 1, W0, 1.0, v) for v in (0.1, 0.2, 0.3)] + [(1, 2, W0, 1.0, v) for v in (1e30, 0.5)] + [(1, 3, W0, 1.0, None), (1, 4, W0, 1.0, 1e30)]
    df = spark.createDataFrame(rows, "store_id long, product_id long, txn_date date, quantity double, gross_value double")
    got = {r.product_id: r.gross_value for r in weekly_sales(df).collect()}
    assert got == {1: 0.6, 2: 1e30, 3: 0.0, 4: 1e30}
    plan = static_plan(spark, lambda: weekly_sales(df))
    assert len(re.findall(r"partial_\w+\(", plan)) == 5                   # two of units, one of rows, two of a money column
