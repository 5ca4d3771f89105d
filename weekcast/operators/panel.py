"""Weekly panels with explicit zero weeks.

Gap filling never joins a grid back to the facts.  The sparse weekly rows
are shuffled once by (store, product); inside each pair a ``lead`` finds the
next observed week and ``posexplode(sequence(...))`` writes the observed row
followed by its zero weeks.  The work is local to each pair's partition and
the output keeps the pair partitioning for the feature windows that follow.

A pair has at most one row per week, so any pair (even one holding a third
of all transactions) is bounded by the calendar span, not by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weekcast.config import DEFAULT, ForecastConfig
from weekcast.operators.weekly import WEEKLY_MEASURES

def _seven_days():
    return F.expr("INTERVAL 7 DAYS")


# Fixed value: a sparse row stands for some fifteen panel rows, so the panel is cut into more parts than a shuffle of its sparse rows.
PANEL_PARTS = 4


def by_pair(df: DataFrame, cfg: ForecastConfig = DEFAULT, by: list[str] | None = None) -> DataFrame:
    """Hash-partition by the full pair key (or by ``by``, some of its columns).

    The pair window needs this exchange anyway, so it is free on the normal
    path (weekly aggregate -> panel).  It matters when the input was last
    shuffled by the store or the product alone (e.g. a register join): Spark
    would accept that partitioning for a pair window, and one hot store would
    then be sorted and windowed in a single task.

    The number of partitions is given.  Left to AQE, it follows the bytes of
    the sparse rows, and a task then sorts the many times larger panel of
    64 MB of them in its windows.
    """
    parts = PANEL_PARTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *(by or cfg.keys))


def _measures(df: DataFrame, cfg: ForecastConfig) -> list[str]:
    skip = set(cfg.keys) | {cfg.week_col}
    return [c for c in df.columns if c not in skip]


def _fill_from_facts(exploded: DataFrame, cfg: ForecastConfig, measures: list[str],
                     zero_cols: list[str]) -> DataFrame:
    """Measures of the observed row on position 0, zeros on filled weeks."""
    first = F.col("_pos") == 0
    out = []
    for c in measures:
        if c in zero_cols:
            out.append(F.when(first, F.coalesce(F.col(c), F.lit(0).cast(exploded.schema[c].dataType)))
                        .otherwise(F.lit(0).cast(exploded.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(c))
    return exploded.select(*cfg.keys, F.col("_week").alias(cfg.week_col), *out)


def panel_local(weekly: DataFrame, cfg: ForecastConfig = DEFAULT, end: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Per pair, every 7 days from its own first week to its last.

    ``end="global_max"`` extends every pair to the last week of the whole
    table instead (the ``to_global_max`` span, trap R9): a one-row aggregate
    is cross-joined (broadcast, one row) to every pair's last row.
    Weekly measures of filled weeks are 0; other columns (register
    attributes) carry through from the observed row.  ``by`` names the key
    columns to partition by (all of them by default).
    """
    keys, wc = cfg.keys, cfg.week_col
    w = Window.partitionBy(*keys).orderBy(wc)
    measures = _measures(weekly, cfg)
    zero_cols = [c for c in measures if c in WEEKLY_MEASURES]
    nxt = F.lead(wc).over(w)
    df = by_pair(weekly, cfg, by).withColumn("_next", nxt)
    if end == "global_max":
        gmax = weekly.agg(F.max(wc).alias("_gmax"))
        df = df.crossJoin(F.broadcast(gmax))
        stop = F.coalesce(F.date_sub(F.col("_next"), 7), F.col("_gmax"))
    elif end is None:
        stop = F.coalesce(F.date_sub(F.col("_next"), 7), F.col(wc))
    else:
        raise ValueError(f"unknown panel end: {end}")
    seq = F.sequence(F.col(wc), stop, _seven_days())
    exploded = df.select("*", F.posexplode(seq).alias("_pos", "_week"))
    return _fill_from_facts(exploded, cfg, measures, zero_cols)


def week_domain(weekly: DataFrame, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """One row: the sorted array of distinct observed weeks.

    Bounded by the calendar span (one entry per week), never by row count;
    the partial aggregate keeps at most that many values per task.
    """
    return weekly.agg(F.array_sort(F.collect_set(cfg.week_col)).alias("_domain"))


def panel_grid(weekly: DataFrame, cfg: ForecastConfig = DEFAULT) -> DataFrame:
    """Every pair x every observed week of the table (T3 = J5 + J6).

    Equal to a cross join of distinct pairs with distinct weeks followed by a
    left join of the facts, without materialising the cross product next to a
    join.  Each observed row emits the domain weeks from itself up to the next
    observed row (and a pair's first row also the weeks before it) with an
    O(1) ``slice`` of the sorted domain, located by the row's domain position.
    The domain array (one row) and the week -> position table (one row per
    calendar week) are the only broadcasts; both are bounded by the calendar.
    """
    keys, wc = cfg.keys, cfg.week_col
    w = Window.partitionBy(*keys).orderBy(wc)
    measures = _measures(weekly, cfg)
    zero_cols = [c for c in measures if c in WEEKLY_MEASURES]
    domain = week_domain(weekly, cfg)
    positions = domain.select(F.posexplode("_domain").alias("_k", "_dw")).withColumn("_k", F.col("_k") + 1)
    df = (by_pair(weekly, cfg)
          .join(F.broadcast(positions), F.col(wc) == F.col("_dw")).drop("_dw")
          .withColumns({"_knext": F.lead("_k").over(w), "_is_first": F.row_number().over(w) == 1})
          .crossJoin(F.broadcast(domain)))
    k, kn, size = F.col("_k"), F.col("_knext"), F.size("_domain")
    # domain positions k .. (next - 1), or k .. size for the pair's last row
    own = F.slice("_domain", k, F.coalesce(kn, size + 1) - k)
    lead_in = F.when(F.col("_is_first") & (k > 1), F.slice("_domain", F.lit(1), k - 1)) \
               .otherwise(F.array().cast("array<date>"))
    df = df.withColumn("_lead_in", lead_in)
    # the observed row sits at position size(_lead_in); weeks before a pair's
    # first observation and weeks after each observation are zero rows
    exploded = (df.select("*", F.posexplode(F.concat("_lead_in", own)).alias("_p", "_week"))
                  .withColumn("_pos", F.col("_p") - F.size("_lead_in")))
    return _fill_from_facts(exploded, cfg, measures, zero_cols)


def future_weeks(last_week, horizon: int):
    """Array of ``horizon`` weeks after ``last_week`` (T4): last + 7*(i+1)."""
    lw = F.col(last_week) if isinstance(last_week, str) else last_week
    return F.sequence(F.date_add(lw, 7), F.date_add(lw, 7 * horizon), _seven_days())


def panel(weekly: DataFrame, cfg: ForecastConfig = DEFAULT, span: str = "local", by: list[str] | None = None) -> DataFrame:
    """Dispatch: ``local`` (T2), ``to_global_max`` (T2 extended) or ``grid``."""
    if span == "local":
        return panel_local(weekly, cfg, by=by)
    if span == "to_global_max":
        return panel_local(weekly, cfg, end="global_max", by=by)
    if span == "grid":
        return panel_grid(weekly, cfg)
    raise ValueError(f"unknown panel span: {span}")


def _packed(register: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key of a register: the attributes of all its rows as an array."""
    return register.groupBy(key).agg(F.collect_list(F.struct(*[c for c in register.columns if c != key])).alias(name))


def enrich_panel(panel_df: DataFrame, stores: DataFrame | None, products: DataFrame | None,
                 cfg: ForecastConfig = DEFAULT, fill=None) -> DataFrame:
    """Left joins of register attributes onto the panel.

    With ``fill`` (``panel_local`` or another panel function) ``panel_df`` holds the sparse weekly
    rows: these are joined, with the register rows of a key as one array, then ``fill`` writes the
    panel and the arrays are opened.  The rows are those of the join after the fill, repeated keys
    included, but the filled weeks take part in no join.

    Registers are dimension tables; Spark broadcasts them when their size is
    under the broadcast threshold (checked by AQE at run time) and shuffles
    otherwise, so no unchecked broadcast is forced here.
    """
    out = panel_df
    if fill is not None:
        sides = [(r, k, f"_of_{k}") for r, k in ((stores, cfg.store_col), (products, cfg.product_col)) if r is not None]
        for register, key, name in sides:
            out = out.join(_packed(register, key, name), key, "left")
        out = fill(out)
        for _, key, name in sides:
            rest = [c for c in out.columns if c not in (key, name)]
            out = out.select(key, *rest, F.inline_outer(name))
        return out
    if stores is not None:
        out = out.join(stores, cfg.store_col, "left")
    if products is not None:
        out = out.join(products, cfg.product_col, "left")
    return out
