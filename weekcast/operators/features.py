"""Leakage-aware window features over the weekly panel.

Every per-pair feature uses one window spec, ``partitionBy(store, product)
.orderBy(week)``, so the whole feature set costs one exchange and one sort;
the frames differ but Spark evaluates them in the same Window operator.
Frames end at ``-1`` (the previous row) unless a feature is documented as
reading the current row.

Store- and product-level encodings never open a window over a whole store or
product (one store may hold a third of all rows): they aggregate to
(store, week) or (product, week) first, run a cumulative window over those
small series, and join the result back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weekcast.config import (ACTIVE_SHARE_WINDOWS, DEFAULT, FEATURE_LAGS, RATIO_EPS, ForecastConfig)
from weekcast.functions.dates import calendar_columns, holiday_table, holiday_years
from weekcast.functions.dates import week_start as week_bucket
from weekcast.functions.scalars import discount_promo

UNB = Window.unboundedPreceding
# Fixed value: the history of at most so many stores or products (a row each, a value a week) is broadcast.
BROADCAST_LEVELS = 2_000


def pair_window(cfg: ForecastConfig = DEFAULT):
    return Window.partitionBy(*cfg.keys).orderBy(cfg.week_col)


def lag_columns(cfg: ForecastConfig = DEFAULT, lags=FEATURE_LAGS) -> dict[str, Column]:
    """lag_qty_L and the moving means of the previous 4 / 12 rows."""
    w, y = pair_window(cfg), F.col(cfg.target_col)
    t = cfg.target_col
    out = {f"lag_{t}_{L}": F.lag(y, L).over(w) for L in lags}
    out[f"ma_{t}_4"] = F.avg(y).over(w.rowsBetween(-4, -1))
    out[f"ma_{t}_12"] = F.avg(y).over(w.rowsBetween(-12, -1))
    return out


def stat_columns(cfg: ForecastConfig = DEFAULT) -> dict[str, Column]:
    """Sample std of the previous 4 / 12 rows (null below 2 values), diff and ratio."""
    w, y, t = pair_window(cfg), F.col(cfg.target_col), cfg.target_col
    lag1, lag2 = F.lag(y, 1).over(w), F.lag(y, 2).over(w)
    return {
        f"std_{t}_4": F.stddev_samp(y).over(w.rowsBetween(-4, -1)),
        f"std_{t}_12": F.stddev_samp(y).over(w.rowsBetween(-12, -1)),
        f"diff_{t}_1": lag1 - lag2,
        f"ratio_{t}_12": lag1 / (F.abs(lag2) + F.lit(RATIO_EPS)),
    }


def price_columns(cfg: ForecastConfig = DEFAULT) -> dict[str, Column]:
    """Unit price (net / qty when qty > 0) and its mean over the previous 8 rows."""
    w, y = pair_window(cfg), F.col(cfg.target_col)
    price = F.when(y > 0, F.col("net_value") / y)
    return {"price_u": price, "price_u_ma8": F.avg(price).over(w.rowsBetween(-8, -1))}


def activity_columns(cfg: ForecastConfig = DEFAULT, idx: str = "_idx", ascoded: bool = False) -> dict[str, Column]:
    """Activity and recency per pair (W5-W8).  Needs the columns of ``with_row_index``: the 0-based
    row index ``idx``, and ``{idx}_on`` and ``{idx}_known``, the earlier rows with qty > 0 and with a qty.

    * ``active_share_k``: share of the previous k rows with qty > 0, from differences of the running
      counts (whole numbers, so exact): a row costs the same whatever k is.
    * ``weeks_since_last_sale``: as coded in the reference, counting the
      current row (0 when it sells; trap R4); ``idx + 1`` before any sale.
    * ``weeks_since_prev_sale``: the causal version, previous rows only.
    * ``weeks_since_first_sale``: rows since the first sale so far, 0 before it.
    * ``weeks_since_first_sale_ascoded``: the reference's back-fill, i.e.
      minus the rows until the next sale, 0 after the last one (trap R5).
    * ``zero_streak``: zero rows right before this one.
    """
    w, y = pair_window(cfg), F.col(cfg.target_col)
    i = F.col(idx)
    act_idx = F.when(y > 0, i)
    last_incl = F.last(act_idx, ignorenulls=True).over(w.rowsBetween(UNB, 0))
    last_excl = F.last(act_idx, ignorenulls=True).over(w.rowsBetween(UNB, -1))
    first_incl = F.min(act_idx).over(w.rowsBetween(UNB, 0))
    on, known = f"{idx}_on", f"{idx}_known"

    def within(c: str, k: int) -> Column:
        return F.col(c) - F.lag(c, k, 0).over(w)

    out = {f"active_share_{k}": F.try_divide(within(on, k).cast("double"), within(known, k).cast("double")) for k in ACTIVE_SHARE_WINDOWS}
    out.update({
        "weeks_since_last_sale": F.coalesce(i - last_incl, i + 1).cast("long"),
        "weeks_since_prev_sale": F.coalesce(i - last_excl, i + 1).cast("long"),
        "weeks_since_first_sale": F.coalesce(i - first_incl, F.lit(0)).cast("long"),
        "zero_streak": F.coalesce(i - 1 - last_excl, i).cast("long"),
    })
    if ascoded:
        # nearest sale at or after this row.  A frame from this row to UNBOUNDED
        # FOLLOWING is re-evaluated per row in Spark (quadratic per pair), and a
        # descending window sorts the panel a second time; so the pair's sales
        # (at most one a week) are listed once, and the one after the earlier
        # sales is picked.
        sales = F.collect_list(act_idx).over(w.rowsBetween(UNB, Window.unboundedFollowing))
        next_incl = F.get(sales, F.col(on).cast("int"))
        out["weeks_since_first_sale_ascoded"] = F.coalesce(i - next_incl, F.lit(0)).cast("long")
    return out


def with_row_index(df: DataFrame, cfg: ForecastConfig = DEFAULT, name: str = "_idx") -> DataFrame:
    """The 0-based row index of the pair, and how many earlier rows have qty > 0 and a known qty."""
    w, y = pair_window(cfg), F.col(cfg.target_col)
    before = w.rowsBetween(UNB, -1)
    return df.withColumns({name: (F.row_number().over(w) - 1).cast("long"),
                           f"{name}_on": F.count(F.when(y > 0, 1)).over(before), f"{name}_known": F.count(y).over(before)})


def add_pair_features(df: DataFrame, cfg: ForecastConfig = DEFAULT, lags=FEATURE_LAGS,
                      price: bool = True, ascoded: bool = False) -> DataFrame:
    """All per-pair window features in one Window stage.

    ``ascoded`` adds the reference's back-filled ``weeks_since_first_sale_ascoded``
    (one extra descending sort; not a model feature)."""
    cols = {}
    cols.update(lag_columns(cfg, lags))
    cols.update(stat_columns(cfg))
    if price and "net_value" in df.columns:
        cols.update(price_columns(cfg))
    cols.update(activity_columns(cfg, ascoded=ascoded))
    if "n_tx" in df.columns:
        cols["n_tx_lag1"] = F.lag("n_tx", 1).over(pair_window(cfg))
    return with_row_index(df, cfg).withColumns(cols).drop("_idx", "_idx_on", "_idx_known")


def add_discount_promo(df: DataFrame, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """Same-week discount rate and promo flag (X3) plus their lag-1 versions (trap R3)."""
    df = df.withColumns(discount_promo("discount", "gross_value"))
    w = pair_window(cfg)
    return df.withColumns({"discount_rate_lag1": F.lag("discount_rate", 1).over(w),
                           "promo_flag_lag1": F.lag("promo_flag", 1).over(w)})


def add_holiday_features(df: DataFrame, holidays: DataFrame, cfg: ForecastConfig = DEFAULT,
                         years: tuple[int, int] | None = None) -> DataFrame:
    """Holiday on the week's first day, holiday anywhere in the week, event week (X4, X5, trap R11).

    ``holidays`` is a (country, holiday_date) dimension; only the distinct dates of
    the configured country are broadcast (one row per holiday, a calendar-bounded table).
    ``years`` are the first and last year that the table knows; a week outside fails the job.
    """
    wc = cfg.week_col
    days = (holidays.where(F.upper("country") == cfg.country.upper())
                    .select(F.col("holiday_date").alias("_h")).distinct())
    weeks = days.select(week_bucket("_h", cfg.week_anchor).alias("_hw")).distinct()
    out = (df.join(F.broadcast(days.withColumn("is_holiday", F.lit(1))), F.col(wc) == F.col("_h"), "left")
             .join(F.broadcast(weeks.withColumn("is_holiday_week", F.lit(1))), F.col(wc) == F.col("_hw"), "left")
             .drop("_h", "_hw"))
    events = list(cfg.event_weeks)
    if years is not None:
        inside = F.col(wc).isNull() | F.year(wc).between(*years)
        missing = F.raise_error(F.concat(F.lit("no holidays known for week "), F.col(wc).cast("string")))
        out = out.withColumn("is_holiday", F.when(inside, F.col("is_holiday")).otherwise(missing.cast("int")))
    return out.withColumns({
        "is_holiday": F.coalesce("is_holiday", F.lit(0)),
        "is_holiday_week": F.coalesce("is_holiday_week", F.lit(0)),
        "is_bf_cm_week": F.col(wc).isin(events).cast("int") if events else F.lit(0),
    })


def _level_cumulative(df: DataFrame, level: str, cfg: ForecastConfig, prefix: str) -> DataFrame:
    """Per (level, week): rows and mean target of the level in all earlier weeks."""
    wc, t = cfg.week_col, cfg.target_col
    per_week = df.groupBy(level, wc).agg(F.sum(t).alias("_s"), F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(level).orderBy(wc).rowsBetween(UNB, -1)
    cum_c, cum_s = F.sum("_c").over(w), F.sum("_s").over(w)
    return per_week.select(level, wc,
                           F.coalesce(cum_c, F.lit(0)).cast("long").alias(f"freq_{prefix}"),
                           F.try_divide(cum_s, cum_c).alias(f"avg_{t}_{prefix}"))


def level_history(weekly: DataFrame, level: str, cfg: ForecastConfig, prefix: str, span: str = "local",
                  every_week: bool = False) -> DataFrame:
    """What ``_level_cumulative`` gives for the panel of ``weekly``, from the sparse weekly rows alone.

    A difference array over weeks: +1 in a pair's first week, -1 after its last one (of the table, for
    ``span="to_global_max"``); its running sum is the number of panel rows of the level in a week, and sums of the
    target come from observed weeks.  Between two entries the count is constant, so earlier rows grow evenly there.
    Only level x week rows (bounded by the calendar) are written out, never the panel; with ``every_week`` also the
    weeks between a level's first and last one in which no pair of it has a row.
    """
    wc, t = cfg.week_col, cfg.target_col
    bounds = weekly.groupBy(*cfg.keys).agg(F.min(wc).alias("_first"), F.max(wc).alias("_last"))
    if span == "to_global_max":
        bounds = bounds.drop("_last").crossJoin(F.broadcast(weekly.agg(F.max(wc).alias("_last"))))
    elif span != "local":
        raise ValueError(f"no level history of span {span!r} from sparse rows")
    zero = F.lit(0.0)
    entries = (weekly.select(level, wc, F.coalesce(F.col(t), zero).cast("double").alias("_s"), F.lit(0).alias("_d"))
               .unionByName(bounds.select(level, F.col("_first").alias(wc), zero.alias("_s"), F.lit(1).alias("_d")))
               .unionByName(bounds.select(level, F.date_add("_last", 7).alias(wc), zero.alias("_s"), F.lit(-1).alias("_d")))
               .groupBy(level, wc).agg(F.sum("_s").alias("_s"), F.sum("_d").alias("_d")))
    w = Window.partitionBy(level).orderBy(wc)
    before = w.rowsBetween(UNB, -1)
    steps = entries.select(level, wc, "_s", F.sum("_d").over(w.rowsBetween(UNB, 0)).alias("_rows"), F.lead(wc).over(w).alias("_next"))
    weeks = F.floor(F.datediff("_next", wc) / 7)
    steps = steps.withColumns({"_c0": F.coalesce(F.sum(F.col("_rows") * weeks).over(before), F.lit(0)),
                               "_s0": F.coalesce(F.sum("_s").over(before), zero)})
    each = (steps.where(F.col("_next").isNotNull() & (F.lit(every_week) | (F.col("_rows") > 0)))
            .select("*", F.posexplode(F.sequence(F.col(wc), F.date_sub("_next", 7), F.expr("INTERVAL 7 DAYS"))).alias("_k", "_w")))
    earlier = F.col("_c0") + F.col("_k") * F.col("_rows")
    total = F.col("_s0") + F.when(F.col("_k") > 0, F.col("_s")).otherwise(zero)
    return each.select(level, F.col("_w").alias(wc), earlier.cast("long").alias(f"freq_{prefix}"),
                       F.try_divide(total, earlier).alias(f"avg_{t}_{prefix}"))


def _few(weekly: DataFrame, level: str) -> bool:
    return weekly.select(level).distinct().limit(BROADCAST_LEVELS + 1).count() <= BROADCAST_LEVELS


def history_by(weekly: DataFrame, cfg: ForecastConfig = DEFAULT) -> list[str] | None:
    """Key columns to partition a panel by, so that ``add_level_encodings`` joins the history without moving it: None (the pair)
    where the history of stores and of products is broadcast, else the one of many values (the store, if both have many).
    A store's panel rows lie in one task then; they are at most its products times the weeks."""
    many = [c for c in cfg.keys if not _few(weekly, c)]
    return many[:1] or None


def _join_series(df: DataFrame, weekly: DataFrame, level: str, cfg: ForecastConfig, prefix: str, span: str) -> DataFrame:
    """Joins a level's history as one row a level, its weeks in arrays, and picks the row's week.

    The join is on the level alone: the side of the panel is read as it comes, neither sorted nor, where it is partitioned
    by the level (``history_by``), shuffled; few levels are broadcast.
    """
    wc, names = cfg.week_col, [f"freq_{prefix}", f"avg_{cfg.target_col}_{prefix}"]
    history = level_history(weekly, level, cfg, prefix, span, every_week=True)
    series = (history.groupBy(level).agg(F.min(wc).alias("_from"), F.array_sort(F.collect_list(F.struct(wc, *names))).alias("_weeks"))
              .select(level, "_from", *[F.col(f"_weeks.{c}").alias(f"_{c}") for c in names]))
    series = F.broadcast(series) if _few(weekly, level) else series.hint("shuffle_hash")
    days = F.datediff(F.col(wc), F.col("_from"))
    week = F.when(days % 7 == 0, (days / 7).cast("int"))
    return df.join(series, level, "left").select(*df.columns, *[F.get(f"_{c}", week).alias(c) for c in names])


def add_level_encodings(df: DataFrame, cfg: ForecastConfig = DEFAULT, weekly: DataFrame | None = None,
                        span: str = "local") -> DataFrame:
    """Causal store / product history (W9, W10): rows and mean qty in earlier weeks.

    Pre-aggregated to (store, week) and (product, week) so the window runs over
    one row per week, whatever the size of the store or product.  With the sparse ``weekly`` rows of the panel and its
    ``span`` (not for ``grid``) the panel itself is read once only, and not shuffled by (level, week): see ``_join_series``.
    ``weekly`` is read several times then, so it had better be a stored table (``session.stored``).
    """
    s, p, wc = cfg.store_col, cfg.product_col, cfg.week_col
    if weekly is not None and span != "grid":
        out = _join_series(_join_series(df, weekly, s, cfg, "store", span), weekly, p, cfg, "product", span)
        return out.select(p, wc, s, *[c for c in out.columns if c not in (s, p, wc)])
    st, pr = _level_cumulative(df, s, cfg, "store"), _level_cumulative(df, p, cfg, "product")
    return df.join(st, [s, wc], "left").join(pr, [p, wc], "left")


def level_prefix(totals: DataFrame, level: str, other: str, sums: dict[str, str], blocks: int = 1024) -> DataFrame:
    """``totals`` (a row per (level, other)) with the sums of the level's rows of smaller ``other``: a prefix sum in two steps.

    ``other`` (a whole number) is cut into ``blocks`` ranges of equal width between its exact smallest and largest value,
    so a rerun of a lost task cuts alike.  Sums run inside a (level, block), and over the at most ``blocks`` totals of a
    level: a level that holds all pairs still spreads over as many tasks.  Ranges are as even as the ids are.
    ``sums`` maps a column to the name of its prefix sum.
    """
    o = F.col(other).cast("double")
    ends = totals.agg(F.min(o).alias("_lo"), F.max(o).alias("_hi"))
    cut = F.floor((o - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1.0) * blocks)
    rows = totals.crossJoin(F.broadcast(ends)).withColumn("_block", cut).drop("_lo", "_hi")
    before = Window.partitionBy(level).orderBy("_block").rowsBetween(UNB, -1)
    starts = rows.groupBy(level, "_block").agg(*[F.sum(c).alias(f"_b_{c}") for c in sums])
    starts = starts.select(level, "_block", *[F.coalesce(F.sum(f"_b_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in sums])
    inside = Window.partitionBy(level, "_block").orderBy(other).rowsBetween(UNB, -1)
    rows = rows.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for c, n in sums.items()})
    return (rows.join(starts, [level, "_block"])
            .withColumns({n: F.col(n) + F.col(f"_b_{c}") for c, n in sums.items()})
            .drop("_block", *[f"_b_{c}" for c in sums]))


def add_level_encodings_ascoded(df: DataFrame, cfg: ForecastConfig = DEFAULT, weekly: DataFrame | None = None) -> DataFrame:
    """The reference's order (trap R6): per store, rows ordered by (product, week);
    per product, rows ordered by (store, week).  Counts and means of earlier rows.

    Written as prefix sums over pair totals (``level_prefix``) plus the running position inside the
    pair, so no window ever spans a whole store or product.  With the sparse ``weekly`` rows of a local
    panel the totals come from these.
    """
    s, p, wc, t = cfg.store_col, cfg.product_col, cfg.week_col, cfg.target_col
    w = pair_window(cfg)
    inner = df.withColumns({"_i": (F.row_number().over(w) - 1).cast("long"),
                            "_cs": F.coalesce(F.sum(t).over(w.rowsBetween(UNB, -1)), F.lit(0.0))})
    if weekly is None:
        totals = df.groupBy(s, p).agg(F.sum(t).alias("_ts"), F.count(F.lit(1)).alias("_tc"))
    else:
        totals = weekly.groupBy(s, p).agg(F.sum(t).alias("_ts"), F.floor(F.datediff(F.max(wc), F.min(wc)) / 7 + 1).alias("_tc"))
    totals = totals.withColumn("_ts", F.coalesce("_ts", F.lit(0.0)))
    out = inner
    for level, other, name in ((s, p, "store"), (p, s, "product")):
        sums = level_prefix(totals, level, other, {"_tc": f"_pc_{name}", "_ts": f"_ps_{name}"})
        out = out.join(sums.drop("_tc", "_ts"), [s, p])
    cols = {}
    for name in ("store", "product"):
        c = F.col(f"_pc_{name}") + F.col("_i")
        cols[f"freq_{name}"] = c.cast("long")
        cols[f"avg_{t}_{name}"] = F.try_divide(F.col(f"_ps_{name}") + F.col("_cs"), c)
    return out.withColumns(cols).drop("_i", "_cs", "_pc_store", "_ps_store", "_pc_product", "_ps_product")


def build_features(panel: DataFrame, holidays: DataFrame | None, cfg: ForecastConfig = DEFAULT,
                   lags=FEATURE_LAGS, weekly: DataFrame | None = None, span: str = "local") -> DataFrame:
    """The prepare feature set: store/product encodings, calendar, pair windows,
    promo, holidays (without a table those of ``holiday_table`` for the configured country).

    ``weekly`` and ``span`` are what the panel was made of (``add_level_encodings``).

    The store and product encodings are joined while the panel is still lean.
    With ``weekly`` a panel partitioned as ``history_by`` says keeps its
    partitioning through these joins and the pair windows.  Without it (and for
    ``grid``) large tables shuffle the lean rows by (store, week) and (product,
    week); that partitioning never satisfies a pair window, so Spark adds one
    more exchange by pair before the windows.  Joining after the ~40 window
    columns exist would shuffle the wide rows twice instead.
    """
    df = add_level_encodings(panel, cfg, weekly, span)
    df = df.withColumns(calendar_columns(cfg.week_col))
    df = add_pair_features(df, cfg, lags)
    if "discount" in df.columns and "gross_value" in df.columns:
        df = add_discount_promo(df, cfg)
    if holidays is None:
        return add_holiday_features(df, holiday_table(panel.sparkSession, cfg.country), cfg, holiday_years(cfg.country))
    return add_holiday_features(df, holidays, cfg)
