"""Weekly aggregate (T1 + X1 + A1).

One hash aggregate on (store, product, week).  Spark runs it as a partial
aggregate before the shuffle, so a hot store or product is collapsed on the
map side and only one row per (pair, week, map task) crosses the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weekcast.config import DEFAULT, ForecastConfig
from weekcast.functions.dates import week_start
from weekcast.functions.scalars import returns_split

MONEY_COLUMNS = ("gross_value", "net_value", "gross_profit", "discount", "taxes")
WEEKLY_MEASURES = ("qty", "qty_return") + MONEY_COLUMNS + ("n_tx",)


def weekly_sales(sales: DataFrame, cfg: ForecastConfig = DEFAULT, money_scale: int = 6) -> DataFrame:
    """(store, product, week) -> units, returns, money sums and transaction count.

    Rows with a null store, product or date are dropped, as a pandas groupby
    drops null keys.  Sums of all-null groups are 0; ``n_tx`` counts rows with
    a date.  Money columns are summed exactly at ``money_scale`` decimals.
    """
    keys = cfg.keys
    split = returns_split(F.col("quantity"), null_as_zero=True)
    wk = week_start(F.col(cfg.date_col), cfg.week_anchor).alias(cfg.week_col)
    money = [c for c in MONEY_COLUMNS if c in sales.columns]
    base = (sales
            .where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull() & F.col(cfg.date_col).isNotNull())
            .select(*keys, wk, split["quantity_pos"].alias("_q"), split["quantity_return"].alias("_r"),
                    *money, F.col(cfg.date_col)))
    aggs = [F.coalesce(F.sum("_q"), F.lit(0.0)).alias(cfg.target_col),
            F.coalesce(F.sum("_r"), F.lit(0.0)).alias("qty_return")]
    # Money sums are exact: each value is cast to DECIMAL(30, money_scale) and
    # summed in decimal, so the total does not depend on the order in which
    # partial sums meet (doubles would), then it is returned as a double.  Values that no
    # such decimal holds are summed apart, in doubles, and added; that sum is null in
    # nearly every group, so the shuffled rows carry one number a column.
    dec = f"decimal(30,{int(money_scale)})"
    for c in money:
        exact = F.col(c).try_cast(dec)
        lost = F.sum(F.when(exact.isNull(), F.col(c).cast("double")))
        kept = F.try_sum(exact)
        total = F.when(lost.isNull(), kept.cast("double")).otherwise(lost + F.coalesce(kept.cast("double"), F.lit(0.0)))
        aggs.append(F.coalesce(total, F.lit(0.0)).alias(c))
    aggs += [F.count(cfg.date_col).alias("n_tx")]
    return base.groupBy(*keys, cfg.week_col).agg(*aggs)
