"""Back-test of the baselines on a validation window.

One pass: history and validation rows of a pair lie in one partition, the
state of its history is a set of windows over them (``with_state``), and each
validation row picks its forecast by its offset from the pair's last history
week.  Nothing is joined on the pair keys and the panel is exploded once.

The horizon is the number of distinct validation weeks and stays data, so the
plan needs no driver round trip.  ``eval_rows`` needs it for each row and
reads the weeks a second time (a one-row aggregate, broadcast).  ``backtest``
does not: it sums errors by week and offset with and without the forecast,
which the calendar bounds, and applies the horizon to these sums.  An empty
validation window fails the job through ``raise_error``.

On a panel without gaps (``gapless``, what ``panel_local`` writes) the history
rows that no forecast depends on leave before the windows, so these sort the
observed rows and a few weeks a pair, not every filled week (``bearing_rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weekcast.config import DEFAULT, SMART_INACTIVITY_WINDOW, WMAPE_EPS, ForecastConfig
from weekcast.functions.scalars import wmape_columns
from weekcast.operators.baselines import with_state


def validation_horizon(valid: DataFrame, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """One row ``_h``: number of distinct validation weeks; the job fails when it is 0."""
    h = F.count_distinct(cfg.week_col)
    return valid.agg(h.alias("_n")).select(_some_weeks(F.col("_n")).cast("int").alias("_h"))


def _some_weeks(n: Column) -> Column:
    return F.when(n > 0, n).otherwise(F.raise_error(F.lit("no validation weeks after the cutoff")).cast("long"))


def split_history(panel: DataFrame, cfg: ForecastConfig = DEFAULT):
    """(history before the cutoff, validation rows in [cutoff, valid_end))."""
    wk = F.col(cfg.week_col)
    hist = panel.where(wk < F.lit(cfg.cutoff))
    valid = panel.where((wk >= F.lit(cfg.cutoff)) & (wk < F.lit(cfg.valid_end)))
    return hist, valid


def bearing_rows(panel: DataFrame, baseline: str = "smart", cfg: ForecastConfig = DEFAULT, weeks: int = 0) -> DataFrame:
    """The validation rows and the history rows that their forecasts depend on, of a panel that holds every week of a pair
    from its first to its last.

    A pair with validation rows has its last history rows in the last weeks before the cut-off, so a date tells a row's
    rank from the end: MA(4) reads 4 rows; the others read the observed rows (all rows where ``n_tx`` is absent) and need
    the last one for its week, the smart back-off the last 12 for their ranks.  Pairs without validation rows are scored
    nowhere, so what is left of them does not matter.  ``weeks`` keeps that many last weeks at least (for lags).
    """
    wk, name = F.col(cfg.week_col), baseline.lower()
    depth = max({"ma4": 4, "smart": SMART_INACTIVITY_WINDOW}.get(name, 1), weeks)
    kept = (wk >= F.lit(cfg.cutoff)) | (F.datediff(F.lit(cfg.cutoff), wk) <= 7 * depth)
    if name != "ma4":
        kept = kept | ((F.col("n_tx") > 0) if "n_tx" in panel.columns else F.lit(True))
    return panel.where((wk < F.lit(cfg.valid_end)) & kept)


def _scored(panel: DataFrame, baseline: str, cfg: ForecastConfig, alpha: float | None, gapless: bool) -> DataFrame:
    """Validation rows: keys, week, ``lag_*`` columns, ``y_true``, ``_step`` (weeks after the pair's last history week; null
    for pairs without history or between the weeks) and ``_pred``, the forecast of that step whatever the horizon."""
    wc = F.col(cfg.week_col)
    lags = _lag_columns(panel, cfg)
    if gapless:
        panel = bearing_rows(panel, baseline, cfg)
    cols = [*cfg.keys, cfg.week_col, cfg.target_col, *[c for c in ("n_tx",) if c in panel.columns], *lags]
    state = with_state(panel.select(*cols).where(wc < F.lit(cfg.valid_end)), wc < F.lit(cfg.cutoff), baseline, cfg,
                       _window_steps(cfg), alpha)
    days = F.datediff(wc, F.col("last_week"))
    step = F.when((days > 0) & (days % 7 == 0), (days / 7).cast("int"))
    at = F.when(F.col("_step") <= F.size("_preds"), F.col("_step")) if baseline.lower() == "ma4" else F.when(F.col("_step").isNotNull(), 1)
    return (state.where(wc >= F.lit(cfg.cutoff)).withColumn("_step", step)
            .select(*cfg.keys, cfg.week_col, *lags, F.col(cfg.target_col).cast("double").alias("y_true"), "_step",
                    F.element_at("_preds", at).alias("_pred")))


def _window_steps(cfg: ForecastConfig) -> int:
    return max((cfg.valid_end - cfg.cutoff).days // 7 + 1, 1)


def _lag_columns(df: DataFrame, cfg: ForecastConfig) -> list[str]:
    return [c for c in df.columns if c.startswith(f"lag_{cfg.target_col}_")]


def _enough(h: Column, baseline: str, cfg: ForecastConfig) -> Column:
    """The horizon; where MA(4) was unrolled for fewer weeks, an error."""
    if baseline.lower() != "ma4":
        return h
    steps = _window_steps(cfg)
    return F.when(h <= steps, h).otherwise(F.raise_error(F.lit(f"the horizon exceeds the {steps} weeks of the validation window")).cast("long"))


def eval_rows(panel: DataFrame, baseline: str = "smart", cfg: ForecastConfig = DEFAULT,
              alpha: float | None = None, restrict_lags: bool = False, gapless: bool = False) -> DataFrame:
    """Validation rows: week_start, store_id, product_id, y_true, y_pred, abs_err, unseen.

    ``y_pred`` is 0 where the pair has no forecast for that week (pairs first
    seen after the cutoff, or forecasts that end before the week; trap R22).
    ``restrict_lags`` keeps only rows where every ``lag_qty_*`` column is present (F7).
    ``gapless``: the panel holds every week of a pair from its first to its last, so most filled weeks need no sort.
    """
    rows = _scored(panel, baseline, cfg, alpha, gapless)
    if restrict_lags:
        rows = rows.dropna(subset=_lag_columns(panel, cfg)) if _lag_columns(panel, cfg) else rows
    horizon = validation_horizon(split_history(panel, cfg)[1], cfg)
    j = rows.crossJoin(F.broadcast(horizon))
    pred = F.when(F.col("_step") <= _enough(F.col("_h").cast("long"), baseline, cfg), F.col("_pred"))
    yhat = F.coalesce(pred, F.lit(0.0))
    return j.select(F.col(cfg.week_col), *cfg.keys, "y_true", yhat.alias("y_pred"),
                    F.abs(F.col("y_true") - yhat).alias("abs_err"), pred.isNull().alias("unseen"))


def backtest_summary(rows: DataFrame, week_col: str = "week_start", horizon: DataFrame | None = None) -> DataFrame:
    """One row: WMAPE over all rows and over y > 0, row counts, unseen rows, horizon (A4, A5).

    With ``horizon`` (the one-row frame of ``validation_horizon``) the horizon
    column comes from it, so an empty validation window fails the job even
    when there are no rows to score.
    """
    m = wmape_columns("y_true", "y_pred")
    aggs = [v.alias(k) for k, v in m.items()] + [F.count_if("unseen").alias("unseen_rows")]
    if horizon is None:
        return rows.agg(*aggs, F.count_distinct(week_col).alias("horizon"))
    return rows.agg(*aggs).crossJoin(F.broadcast(horizon.select(F.col("_h").cast("long").alias("horizon"))))


def backtest(panel: DataFrame, baseline: str = "smart", cfg: ForecastConfig = DEFAULT,
             alpha: float | None = None, restrict_lags: bool = False, gapless: bool = False) -> DataFrame:
    """Summary row of the back-test from one pass over the panel; fails when no week follows the cut-off (M7).

    Equals ``backtest_summary`` of ``eval_rows`` with the horizon.  A row counts its forecast's error where its step is
    within the horizon and the error of 0 elsewhere; the horizon is known only at the end, so both are summed by
    (week, step) and chosen then.  ``gapless`` as in ``eval_rows``.
    """
    y, pred = F.col("y_true"), F.col("_pred")
    rows = _scored(panel, baseline, cfg, alpha, gapless)
    lags = _lag_columns(panel, cfg) if restrict_lags else []
    kept = F.lit(True)
    for c in lags:
        kept = kept & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    near, far = F.abs(y - F.coalesce(pred, F.lit(0.0))), F.abs(y)

    def both(when: Column, suffix: str) -> list[Column]:
        return [F.coalesce(F.sum(F.when(when, c)), F.lit(0.0)).alias(f"{n}_{suffix}") for n, c in (("near", near), ("far", far))]

    sums = rows.groupBy(cfg.week_col, "_step").agg(
        *both(kept, "all"), *both(kept & (y > 0), "pos"), F.count_if(kept).alias("rows"), F.count_if(kept & (y > 0)).alias("positive_rows"),
        F.count_if(kept & pred.isNull()).alias("unforeseen"))
    parts = [c for c in sums.columns if c != cfg.week_col]
    found = sums.agg(F.size(F.collect_set(cfg.week_col)).cast("long").alias("_n"), F.collect_list(F.struct(*parts)).alias("_sums"))
    one = found.select(_enough(_some_weeks(F.col("_n")), baseline, cfg).alias("horizon"), F.inline_outer("_sums"))
    inside = F.coalesce(F.col("_step") <= F.col("horizon"), F.lit(False))

    def error(suffix: str) -> Column:
        return F.sum(F.when(inside, F.col(f"near_{suffix}")).otherwise(F.col(f"far_{suffix}")))

    eps, n_pos = F.lit(WMAPE_EPS), F.sum("positive_rows")
    return one.groupBy("horizon").agg(
        (error("all") / F.greatest(F.sum("far_all"), eps)).alias("wmape_all"),
        F.when(n_pos > 0, error("pos") / F.greatest(F.sum("far_pos"), eps)).alias("wmape_pos"),
        F.sum("rows").alias("rows"), n_pos.alias("positive_rows"),
        F.sum(F.when(inside, F.col("unforeseen")).otherwise(F.col("rows"))).alias("unseen_rows")).select(
        "wmape_all", "wmape_pos", "rows", "positive_rows", "unseen_rows", "horizon")
