import datetime as dt

from pyspark.sql import functions as F

from weekcast.operators.panel import panel_grid, panel_local
from weekcast.operators.weekly import weekly_sales
from tests.conftest import SCHEMA_SALES

D = dt.date


def sales(spark, rows):
    full = [r + (None,) * (9 - len(r)) for r in rows]
    return spark.createDataFrame(full, SCHEMA_SALES)


def test_weekly_drops_null_keys_and_sums_zero(spark):
    df = sales(spark, [(1, 1, D(2022, 1, 3), 2.0, None), (1, 1, D(2022, 1, 4), -1.0, None),
                       (None, 1, D(2022, 1, 3), 9.0), (1, 1, None, 9.0)])
    w = weekly_sales(df).collect()
    assert len(w) == 1
    r = w[0]
    assert (r.qty, r.qty_return, r.gross_value, r.n_tx) == (2.0, 1.0, 0.0, 2)


def test_returns_only_week_is_observed(spark):
    w = weekly_sales(sales(spark, [(1, 1, D(2022, 1, 3), -4.0)])).first()
    assert w.qty == 0.0 and w.n_tx == 1 and w.qty_return == 4.0


def test_local_gap_fill_counts_and_sums(spark):
    # gaps of 1 and 30 weeks, a one-row pair
    rows = [(1, 1, D(2022, 1, 3), 1.0), (1, 1, D(2022, 1, 17), 2.0), (1, 1, D(2022, 8, 15), 3.0),
            (2, 1, D(2022, 5, 2), 7.0)]
    wk = weekly_sales(sales(spark, rows))
    p = panel_local(wk)
    per_pair = {(r.store_id,): r.n for r in p.groupBy("store_id").agg(F.count("*").alias("n")).collect()}
    assert per_pair[(1,)] == 1 + (D(2022, 8, 15) - D(2022, 1, 3)).days // 7
    assert per_pair[(2,)] == 1
    assert p.agg(F.sum("qty")).first()[0] == 13.0
    zeros = p.where((F.col("store_id") == 1) & (F.col("week_start") == D(2022, 1, 10))).first()
    assert zeros.qty == 0.0 and zeros.n_tx == 0


def test_grid_fills_all_weeks(spark):
    rows = [(1, 1, D(2022, 1, 3), 1.0), (2, 2, D(2022, 1, 17), 2.0), (2, 2, D(2022, 1, 31), 2.0)]
    g = panel_grid(weekly_sales(sales(spark, rows)))
    assert g.count() == 2 * 3
    assert sorted(r.week_start for r in g.where("store_id = 1").collect()) == [D(2022, 1, 3), D(2022, 1, 17), D(2022, 1, 31)]


def test_span_extends_to_global_last_week(spark):
    rows = [(1, 1, D(2022, 1, 3), 1.0), (2, 2, D(2022, 1, 24), 2.0)]
    p = panel_local(weekly_sales(sales(spark, rows)), end="global_max")
    assert p.where("store_id = 1").count() == 4


def test_invariants_on_fixture(spark):
    """On the one-year fixture: panel rows = sum over pairs of 1 + weeks(max - min);
    gap fill keeps every unit; every pair gets exactly `horizon` forecasts."""
    from weekcast.operators.baselines import forecast
    from weekcast.sources.fixtures import sales_clean
    wk = weekly_sales(sales_clean(spark, "/root/testdata/sf0.001"))
    p = panel_local(wk)
    expect = wk.groupBy("store_id", "product_id").agg(
        (F.datediff(F.max("week_start"), F.min("week_start")) / 7 + 1).alias("n")).agg(F.sum("n")).first()[0]
    assert p.count() == int(expect)
    assert p.agg(F.sum("qty")).first()[0] == wk.agg(F.sum("qty")).first()[0]
    assert p.agg(F.sum("n_tx")).first()[0] == wk.agg(F.sum("n_tx")).first()[0]
    pairs = wk.select("store_id", "product_id").distinct().count()
    assert forecast(p, "smart").count() == pairs * 5
