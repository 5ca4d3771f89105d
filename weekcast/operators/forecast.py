"""Month forecast for delivery.

Baseline rows are kept inside the target month, numbered 1..n by week
(the sorted distinct weeks of one month: at most 5 dates in one broadcast
row, bounded by the calendar), rounded half-to-even to
non-negative integers, and optionally limited to recently active pairs with
a left-semi join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from weekcast.config import DEFAULT, ForecastConfig
from weekcast.functions.scalars import export_id, export_quantity
from weekcast.operators.baselines import forecast


def active_pairs(weekly: DataFrame, start: dt.date, window_weeks: int, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """Distinct pairs with qty > 0 in [start - 7*window_weeks days, start)."""
    wk = F.col(cfg.week_col)
    lo = F.date_sub(F.lit(start), 7 * int(window_weeks))
    return (weekly.where((wk >= lo) & (wk < F.lit(start)) & (F.col(cfg.target_col) > 0))
                  .select(*cfg.keys).distinct())


def month_weeks(weekly: DataFrame, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """One row: the sorted distinct forecast weeks of the target month.

    A week's number 1..n is its position in this array (the dense rank of the
    reference).  Forecasts follow a pair's last week, so the weeks come from
    the distinct last weeks of the pairs (at most one for each calendar week).
    """
    last = weekly.groupBy(*cfg.keys).agg(F.max(cfg.week_col).alias("_l")).select("_l").distinct()
    weeks = last.select(F.explode(F.sequence(F.lit(1), F.lit(cfg.horizon))).alias("_i"), "_l").select(F.date_add("_l", F.col("_i") * 7).alias("_w"))
    in_month = (F.col("_w") >= F.lit(cfg.target_start)) & (F.col("_w") < F.lit(cfg.target_end))
    return weeks.where(in_month).agg(F.array_sort(F.collect_set("_w")).alias("_month_weeks"))


def forecast_month(weekly: DataFrame, baseline: str = "smart", cfg: ForecastConfig = DEFAULT,
                   alpha: float | None = None, only_active: bool = False, active_window: int = 13,
                   active_start: dt.date | None = None) -> DataFrame:
    """Delivery rows (week_no, store_id, product_id, quantity) for the target month.

    ``only_active`` keeps pairs sold in the ``active_window`` weeks before the
    target month (a semi join on the pair keys, after the weeks are numbered);
    the smart baseline's product and global means still use every pair.
    """
    keys, wc = cfg.keys, cfg.week_col
    fc = forecast(weekly, baseline, cfg, cfg.horizon, alpha)
    pred = f"pred_{baseline.lower()}"
    wk = F.col(wc)
    fc = fc.where((wk >= F.lit(cfg.target_start)) & (wk < F.lit(cfg.target_end)))
    # weeks are numbered over all pairs, before the active filter; the array is one row
    fc = (fc.crossJoin(F.broadcast(month_weeks(weekly, cfg)))
            .withColumn("week_no", F.array_position("_month_weeks", F.col(wc)).cast("long")))
    if only_active:
        start = active_start or cfg.target_start
        fc = fc.join(active_pairs(weekly, start, active_window, cfg), keys, "left_semi")
    return fc.select(F.col("week_no"), export_id(F.col(keys[0])).alias(keys[0]),
                     export_id(F.col(keys[1])).alias(keys[1]), export_quantity(pred).alias("quantity"))
