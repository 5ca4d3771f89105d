"""The physical plans keep the shape the design promises (static plans, AQE off)."""
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plan(spark):
    def get(name):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        try:
            return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    return get


def count(p, pat):
    return len(re.findall(pat, p))


def test_weekly_is_one_shuffle_with_partial_aggregation(plan):
    p = plan("weekly_sales")
    assert count(p, r"Exchange hashpartitioning") == 1
    assert "partial_sum" in p


def test_pair_features_need_two_shuffles(plan):
    p = plan("feat_lags")            # scan -> weekly -> panel -> all pair windows
    assert count(p, r"Exchange hashpartitioning") == 2
    assert "CartesianProduct" not in p and "SortMergeJoin" not in p


def test_panel_has_no_join_back(plan):
    for name in ("panel_local", "panel_grid"):
        p = plan(name)
        assert "SortMergeJoin" not in p and "CartesianProduct" not in p
        assert count(p, r"Exchange hashpartitioning") == 2


def test_forecasters_reuse_pair_partitioning(plan):
    for name in ("fc_ma4", "fc_ewma", "fc_naive"):
        p = plan(name)
        assert count(p, r"Exchange hashpartitioning") == 2, name


def test_filters_and_columns_reach_the_scan(plan):
    p = plan("scan_sales")
    scan = [line for line in p.split("\n") if "lineitem.parquet" in line][0]
    assert "l_shipdate" not in scan.split("PushedFilters")[1].split("]")[0]     # whole table
    assert "l_orderkey" not in scan and "l_linestatus" not in scan


def test_a_date_range_reaches_the_scan(spark):
    import datetime as dt

    from weekcast.sources.fixtures import sales_clean
    p = sales_clean(spark, SF, dt.date(2000, 1, 1), dt.date(2001, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p


def test_no_cartesian_anywhere(plan):
    for name in ("backtest_smart", "forecast_month", "prepare_registers", "future_calendar", "orphan_impact"):
        assert "CartesianProduct" not in plan(name), name


def test_no_quadratic_window_frames(plan):
    """A frame from the current row to UNBOUNDED FOLLOWING is re-evaluated per row
    by Spark (quadratic per partition); none may appear on the main paths."""
    for name in ("prepare_features", "training_matrix", "fc_smart", "fc_ewma", "fc_ma4", "ml_state_step"):
        p = plan(name)
        assert not re.search(r"RowFrame, currentrow\$\(\), unboundedfollowing\$\(\)", p), name
