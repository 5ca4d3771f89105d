"""Baseline forecasters (M1-M5) as one window pass plus one per-pair aggregate.

Every forecaster first reduces a pair's history to a small per-pair state
(last week, a few recent values, counts), with a ``groupBy`` on the pair keys
that reuses the panel's pair partitioning (no new exchange), and then writes
the horizon with ``posexplode`` of a short array.  No Python runs per pair
and nothing is collected: the state per pair is bounded (at most 4 or 12 rows
are kept), whatever the length of the history.

``forecast_state`` returns one row per pair with ``last_week`` and a
``preds`` array (length = horizon, unclipped values already clipped at 0);
``forecast`` explodes it to (store, product, week, pred_<name>) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekcast.config import DEFAULT, SMART_BLEND, SMART_INACTIVITY_WINDOW, ForecastConfig

BASELINES = ("ma4", "naive", "ewma", "smart")


def _attach_horizon(st: DataFrame, horizon) -> tuple[DataFrame, Column]:
    """The horizon is an int or a one-row frame with column ``_h`` (a data-driven
    horizon, e.g. the number of validation weeks), broadcast to every pair."""
    if isinstance(horizon, DataFrame):
        return st.crossJoin(F.broadcast(horizon.select("_h"))), F.col("_h").cast("int")
    return st, F.lit(int(horizon))


def _repeat(value: Column, h: Column) -> Column:
    return F.array_repeat(F.greatest(value, F.lit(0.0)), h)


def _asc(cfg: ForecastConfig):
    return Window.partitionBy(*cfg.keys).orderBy(cfg.week_col)


def _whole(cfg: ForecastConfig):
    """The pair's whole series, same partition and order as ``_asc`` so Spark
    evaluates both in one Window operator over one sort."""
    return _asc(cfg).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _all_rows(hist: Column | None) -> Column:
    return F.lit(True) if hist is None else hist


def _from_end(flag: Column, cfg: ForecastConfig) -> Column:
    """1 for the pair's last row with ``flag``, 2 for the one before, ...
    (null where ``flag`` is false): a descending rank from ascending counts."""
    f = flag.cast("int")
    total = F.sum(f).over(_whole(cfg))
    upto = F.sum(f).over(_asc(cfg).rowsBetween(Window.unboundedPreceding, 0))
    return F.when(flag, total - upto + 1)


def _last_week(cfg: ForecastConfig, hist: Column) -> Column:
    return F.max(F.when(hist, F.col(cfg.week_col)))


def ma4_weights(n_values: int, steps: int) -> list[list[float]]:
    """Weights of the recursive MA(4): step k = sum_j w[k][j] * y_j over the
    pair's last ``n_values`` values (oldest first).

    The recursion is linear, so running it once on unit vectors gives every
    step's weights; they depend only on how many values the pair has (1-4)
    and are dyadic fractions, exact in floating point.
    """
    hist = [[1.0 if i == j else 0.0 for i in range(n_values)] for j in range(n_values)]
    out = []
    for _ in range(steps):
        win = hist[-4:]
        step = [sum(v[i] for v in win) / len(win) for i in range(n_values)]
        out.append(step)
        hist.append(step)
    return out


def _max_steps(horizon, cfg: ForecastConfig) -> int:
    """Upper bound of the horizon known when the plan is built: the int itself,
    or for a data-driven horizon the number of weeks in the validation window."""
    if isinstance(horizon, DataFrame):
        return max((cfg.valid_end - cfg.cutoff).days // 7 + 1, 1)
    return int(horizon)


def ma4_ranks(cfg: ForecastConfig, hist: Column | None = None) -> dict[str, Column]:
    """Columns ``_l3`` .. ``_l0`` (the values of the last four rows) and ``_rn``, 1 on the last row of the history.
    Rows of the history come first in a pair, so lags at its last row see nothing else."""
    y, w = F.col(cfg.target_col).cast("double"), _asc(cfg)
    hist = _all_rows(hist)
    return {**{f"_l{k}": F.lag(y, k).over(w) for k in (3, 2, 1)}, "_l0": y, "_rn": _from_end(hist, cfg)}


def ma4_preds(steps: int) -> list[Column]:
    """Forecasts of ``steps`` weeks from ``_l3`` .. ``_l0``, clipped at 0."""
    n = (F.lit(1) + sum(F.col(f"_l{k}").isNotNull().cast("int") for k in (1, 2, 3)))
    by_n = {m: ma4_weights(m, steps) for m in (1, 2, 3, 4)}
    preds = []
    for k in range(steps):
        expr = None
        for m in (1, 2, 3, 4):
            vals = [F.col(f"_l{j}") for j in range(m - 1, -1, -1)]      # oldest .. newest
            val = sum(F.lit(wt) * v for wt, v in zip(by_n[m][k], vals) if wt != 0.0)
            expr = F.when(n == m, val) if expr is None else expr.when(n == m, val)
        preds.append(F.greatest(expr, F.lit(0.0)))
    return preds


def ma4_state(weekly: DataFrame, cfg: ForecastConfig = DEFAULT, horizon=None) -> DataFrame:
    """Recursive MA(4) (M1): each step is the mean of the last <= 4 values of
    history plus earlier steps; the unclipped step feeds the next one.

    The last four values come from ``lag`` on the pair window at the pair's
    last row.  The recursion itself is unrolled at plan time into weights
    (``ma4_weights``), so each step is plain arithmetic inside whole-stage
    codegen; steps are clipped at 0 only on output.
    """
    horizon = cfg.horizon if horizon is None else horizon
    tail = weekly.select(*cfg.keys, cfg.week_col, *[c.alias(k) for k, c in ma4_ranks(cfg).items()]).where("_rn = 1")
    steps = _max_steps(horizon, cfg)
    tail, h = _attach_horizon(tail, horizon)
    # a data-driven horizon past the steps that were unrolled must not shorten the forecast
    enough = F.when(h <= steps, h).otherwise(F.raise_error(F.lit(f"the horizon exceeds the {steps} weeks of the validation window")).cast("int"))
    return tail.select(*cfg.keys, F.col(cfg.week_col).alias("last_week"),
                       F.slice(F.array(*ma4_preds(steps)), F.lit(1), enough).alias("preds"))


def naive_aggs(columns: list[str], cfg: ForecastConfig, hist: Column | None = None, use_last_nonzero: bool = True) -> dict[str, Column]:
    """The last value of an observed week, where asked for and known, and the last value."""
    y, wc, hist = F.col(cfg.target_col).cast("double"), F.col(cfg.week_col), _all_rows(hist)
    seen = hist & (F.col("n_tx") > 0) if use_last_nonzero and "n_tx" in columns else hist
    return {"_seen": F.max_by(y, F.when(seen, wc)), "_any": F.max_by(y, F.when(hist, wc))}


def naive_value() -> Column:
    return F.coalesce("_seen", "_any", F.lit(0.0))


def naive_state(weekly: DataFrame, cfg: ForecastConfig = DEFAULT, horizon=None, use_last_nonzero: bool = True) -> DataFrame:
    """Last value of an observed week (n_tx > 0), else the last value (M2); without ``use_last_nonzero`` the last value."""
    h = cfg.horizon if horizon is None else horizon
    aggs = naive_aggs(weekly.columns, cfg, use_last_nonzero=use_last_nonzero)
    st = weekly.groupBy(*cfg.keys).agg(F.max(cfg.week_col).alias("last_week"), *[c.alias(k) for k, c in aggs.items()])
    st, hc = _attach_horizon(st, h)
    return st.select(*cfg.keys, "last_week", _repeat(naive_value(), hc).alias("preds"))


def _alpha(cfg: ForecastConfig, alpha: float | None) -> float:
    a = cfg.alpha if alpha is None else alpha
    if not 0.0 <= float(a) <= 1.0:
        raise ValueError(f"EWMA alpha must be in [0, 1], got {a}")
    return a


def ewma_ranks(columns: list[str], cfg: ForecastConfig, hist: Column | None = None, observed_only: bool = True) -> dict[str, Column]:
    """Columns ``_obs`` (the row counts), ``_r`` (rows that count after it), ``_first`` and ``_n`` (their number)."""
    hist = _all_rows(hist)
    o = hist & (F.col("n_tx") > 0) if (observed_only and "n_tx" in columns) else hist
    return {"_obs": o, "_r": (_from_end(o, cfg) - 1).cast("double"),
            "_first": o & (F.sum(o.cast("int")).over(_asc(cfg).rowsBetween(Window.unboundedPreceding, 0)) == 1),
            "_n": F.sum(o.cast("int")).over(_whole(cfg)).cast("double")}


def ewma_sum(cfg: ForecastConfig, a: float) -> Column:
    y = F.col(cfg.target_col).cast("double")
    weight = F.when(F.col("_first"), F.pow(F.lit(1.0 - a), F.col("_n") - 1)) \
              .otherwise(F.lit(a) * F.pow(F.lit(1.0 - a), F.col("_r")))
    return F.sum(F.when(F.col("_obs"), weight * y))


def ewma_state(weekly: DataFrame, cfg: ForecastConfig = DEFAULT, horizon=None, alpha: float | None = None,
               observed_only: bool = True) -> DataFrame:
    """Exponential smoothing seeded with the first value, over observed weeks (M3).

    Closed form of ``s = a*y + (1-a)*s``: with r = rows after this one, the
    first value weighs (1-a)^(n-1) and every other a*(1-a)^r.  It is a plain
    sum per pair, so Spark aggregates it partially like any other sum.
    """
    h = cfg.horizon if horizon is None else horizon
    a = _alpha(cfg, alpha)
    ranked = weekly.withColumns(ewma_ranks(weekly.columns, cfg, observed_only=observed_only))
    st = ranked.groupBy(*cfg.keys).agg(F.max(cfg.week_col).alias("last_week"), ewma_sum(cfg, a).alias("_v"))
    st, hc = _attach_horizon(st, h)
    return st.select(*cfg.keys, "last_week", _repeat(F.coalesce("_v", F.lit(0.0)), hc).alias("preds"))


def backoff_means(weekly: DataFrame, cfg: ForecastConfig = DEFAULT, category_col: str = "store_category"):
    """Observed-week means by product x store category, by product, and global.

    Returns (by_cat or None, by_product, global_one_row).  All are aggregates
    with map-side combine; the global mean is a single row.
    """
    y, p = F.col(cfg.target_col).cast("double"), cfg.product_col
    obs = weekly.where(F.col("n_tx") > 0) if "n_tx" in weekly.columns else weekly
    by_prod = obs.groupBy(p).agg(F.avg(y).alias("_mean_prod"))
    glob = obs.agg(F.coalesce(F.avg(y), F.lit(0.0)).alias("_mean_global"))
    by_cat = None
    if category_col in weekly.columns:
        by_cat = (obs.where(F.col(category_col).isNotNull())
                     .groupBy(p, category_col).agg(F.avg(y).alias("_mean_cat")))
    return by_cat, by_prod, glob


def smart_ranks(columns: list[str], cfg: ForecastConfig, hist: Column | None = None) -> dict[str, Column]:
    """Columns ``_obs``, ``_act`` (flags of observed and active rows), ``_rn`` and ``_orn`` (ranks from the history's end)."""
    hist = _all_rows(hist)
    seen = F.col("n_tx") > 0 if "n_tx" in columns else None
    o = hist if seen is None else hist & seen
    act = F.col(cfg.target_col).cast("double") > 0 if seen is None else seen
    return {"_obs": o, "_act": act, "_rn": _from_end(hist, cfg), "_orn": _from_end(o, cfg)}


def smart_aggs(cfg: ForecastConfig, inactivity_window: int = SMART_INACTIVITY_WINDOW) -> dict[str, Column]:
    o, y = F.col("_obs"), F.col(cfg.target_col).cast("double")
    return {"_recent": F.max(((F.col("_rn") <= inactivity_window) & F.col("_act")).cast("int")),
            "_n_obs": F.sum(o.cast("long")),
            "_mean4": F.avg(F.when(o & (F.col("_orn") <= 4), y)),
            "_last_obs": F.max(F.when(o & (F.col("_orn") == 1), y)),
            "_mean_obs": F.avg(F.when(o, y))}


def smart_value(fallback: list[Column]) -> Column:
    n = F.col("_n_obs")
    return (F.when(F.col("_recent") == 0, F.lit(0.0))
             .when(n >= 4, F.col("_mean4"))
             .when(n >= 1, F.greatest(F.col("_last_obs"), F.lit(SMART_BLEND) * F.col("_mean_obs")))
             .otherwise(F.coalesce(*fallback)))


def smart_state(weekly: DataFrame, cfg: ForecastConfig = DEFAULT, horizon=None,
                inactivity_window: int = SMART_INACTIVITY_WINDOW, category_col: str = "store_category",
                extra_pairs: DataFrame | None = None) -> DataFrame:
    """Smart back-off (M4).

    * no observed week (n_tx > 0) among the pair's last ``inactivity_window``
      rows -> 0;
    * else >= 4 observed weeks -> mean of the last 4 observed;
    * else >= 1 observed -> max(last observed, 0.7 * mean observed);
    * else product x store-category mean -> product mean -> global mean
      (the documented hierarchy; trap R7).  This branch is reached by
      ``extra_pairs`` (cold pairs with no rows) or histories with no
      observed row inside an active window when ``n_tx`` is absent (trap R8).
    """
    h = cfg.horizon if horizon is None else horizon
    keys, wc = cfg.keys, cfg.week_col
    has_ntx = "n_tx" in weekly.columns
    ranked = weekly.withColumns(smart_ranks(weekly.columns, cfg))
    aggs = [F.max(wc).alias("last_week"), *[c.alias(k) for k, c in smart_aggs(cfg, inactivity_window).items()]]
    if category_col in weekly.columns:
        aggs.append(F.min(category_col).alias(category_col))
    st = ranked.groupBy(*keys).agg(*aggs)
    if extra_pairs is not None:
        cold = (extra_pairs.select(*keys).distinct().join(st.select(*keys), keys, "left_anti")
                .crossJoin(F.broadcast(weekly.agg(F.max(wc).alias("last_week")))))
        if category_col in st.columns and category_col in extra_pairs.columns:
            cats = extra_pairs.groupBy(*keys).agg(F.min(category_col).alias(category_col))
            cold = cold.join(cats, keys, "left")
        st = st.unionByName(cold.withColumns({"_recent": F.lit(1), "_n_obs": F.lit(0).cast("long")}),
                            allowMissingColumns=True)
    if has_ntx and extra_pairs is None:
        # a recent pair has an observed week then, so no row reaches the means (trap R8)
        fallback = [F.lit(0.0)]
    else:
        by_cat, by_prod, glob = backoff_means(weekly, cfg, category_col)
        st = st.join(by_prod, cfg.product_col, "left").crossJoin(F.broadcast(glob))
        fallback = [F.col("_mean_prod"), F.col("_mean_global")]
        if by_cat is not None and category_col in st.columns:
            st = st.join(by_cat, [cfg.product_col, category_col], "left")
            fallback = [F.col("_mean_cat")] + fallback
    st, hc = _attach_horizon(st, h)
    return st.select(*keys, "last_week", _repeat(smart_value(fallback), hc).alias("preds"))


STATE_BUILDERS = {"ma4": ma4_state, "naive": naive_state, "ewma": ewma_state, "smart": smart_state}


def forecast_state(weekly: DataFrame, baseline: str = "ma4", cfg: ForecastConfig = DEFAULT,
                   horizon=None, alpha: float | None = None, **options) -> DataFrame:
    """Dispatch by name (M5) with that forecaster's options (``use_last_nonzero``, ``observed_only``,
    ``inactivity_window``, ...); unknown names raise ``ValueError``."""
    name = baseline.lower()
    if name not in STATE_BUILDERS:
        raise ValueError(f"unknown baseline: {baseline}")
    if name == "ewma":
        return ewma_state(weekly, cfg, horizon, alpha, **options)
    return STATE_BUILDERS[name](weekly, cfg, horizon, **options)


def with_state(weekly: DataFrame, hist: Column, baseline: str = "ma4", cfg: ForecastConfig = DEFAULT, steps: int | None = None,
               alpha: float | None = None, use_last_nonzero: bool = True, observed_only: bool = True,
               inactivity_window: int = SMART_INACTIVITY_WINDOW) -> DataFrame:
    """Every row of ``weekly`` with its pair's state from the rows where ``hist`` holds (these must come first in a pair):
    ``last_week`` (null without any) and ``_preds``, an array of ``steps`` values (MA(4)) or of the one value
    that a constant forecaster repeats.

    Ranks and state are windows over one partitioning and one sort of the pairs, so rows after the history are
    scored without a second reading or a join (``forecast_state`` gives the same state as one row a pair).
    Without cold pairs no row reaches the smart back-off's means (trap R8).
    """
    name, cols = baseline.lower(), weekly.columns
    steps = steps or cfg.horizon
    if name == "ma4":
        ranks = ma4_ranks(cfg, hist)
        aggs = {k: F.max(F.when(F.col("_rn") == 1, F.col(k))) for k in ("_l3", "_l2", "_l1", "_l0")}
        preds = F.array(*ma4_preds(steps))
    elif name == "naive":
        ranks, aggs = {}, naive_aggs(cols, cfg, hist, use_last_nonzero)
        preds = _repeat(naive_value(), F.lit(1))
    elif name == "ewma":
        ranks, aggs = ewma_ranks(cols, cfg, hist, observed_only), {"_v": ewma_sum(cfg, _alpha(cfg, alpha))}
        preds = _repeat(F.coalesce("_v", F.lit(0.0)), F.lit(1))
    elif name == "smart":
        ranks, aggs = smart_ranks(cols, cfg, hist), smart_aggs(cfg, inactivity_window)
        preds = _repeat(smart_value([F.lit(0.0)]), F.lit(1))
    else:
        raise ValueError(f"unknown baseline: {baseline}")
    aggs = {**aggs, "last_week": _last_week(cfg, hist)}
    state = weekly.withColumns(ranks).withColumns({k: c.over(_whole(cfg)) for k, c in aggs.items()})
    return state.select(*cols, "last_week", preds.alias("_preds"))


def explode_state(state: DataFrame, cfg: ForecastConfig = DEFAULT, pred_col: str = "pred") -> DataFrame:
    """(pair, last_week, preds[]) -> one row per future week: last + 7*(i+1)."""
    return state.select(*cfg.keys, "last_week", F.posexplode("preds").alias("_i", pred_col)).select(
        *cfg.keys, F.date_add("last_week", (F.col("_i") + 1) * 7).alias(cfg.week_col), pred_col)


def forecast(weekly: DataFrame, baseline: str = "ma4", cfg: ForecastConfig = DEFAULT,
             horizon=None, alpha: float | None = None, **options) -> DataFrame:
    """Rows (store, product, week_start, pred_<baseline>) for the horizon after each pair's last week."""
    st = forecast_state(weekly, baseline, cfg, horizon, alpha, **options)
    return explode_state(st, cfg, f"pred_{baseline.lower()}")
