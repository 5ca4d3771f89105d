"""DuckDB SQL for the weekly features (oracle side).

Pair features use window frames; the store/product encodings use a range
join (every earlier week of the same store) instead of the cumulative
window of the Spark code, so the two sides are computed differently.
"""

from __future__ import annotations

from weekcast.plans.sqlparts import PAIR_W, frame

LAGS = (1, 2, 3, 4, 8, 12, 26)


def pair_features_sql(src: str = "panel") -> list[tuple[str, str]]:
    lags = ",\n       ".join(f"lag(qty, {L}) OVER ({PAIR_W}) AS lag_qty_{L}" for L in LAGS)
    shares = ",\n       ".join(
        f"avg(CASE WHEN qty > 0 THEN 1 ELSE 0 END) {frame(k)} AS active_share_{k}" for k in (8, 13, 26))
    ix = f"SELECT *, (row_number() OVER ({PAIR_W}) - 1)::BIGINT AS idx, CASE WHEN qty > 0 THEN net_value / qty END AS price_u FROM {src}"
    body = f"""
SELECT *,
       {lags},
       avg(qty) {frame(4)} AS ma_qty_4, avg(qty) {frame(12)} AS ma_qty_12,
       stddev_samp(qty) {frame(4)} AS std_qty_4, stddev_samp(qty) {frame(12)} AS std_qty_12,
       avg(price_u) {frame(8)} AS price_u_ma8,
       {shares},
       max(CASE WHEN qty > 0 THEN idx END) {frame(None, 0)} AS _last_incl,
       max(CASE WHEN qty > 0 THEN idx END) {frame(None, -1)} AS _last_excl,
       min(CASE WHEN qty > 0 THEN idx END) {frame(None, 0)} AS _first_incl,
       min(CASE WHEN qty > 0 THEN idx END) OVER ({PAIR_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _next_incl,
       lag(n_tx, 1) OVER ({PAIR_W}) AS n_tx_lag1
FROM ix"""
    derived = """
SELECT *,
       lag_qty_1 - lag_qty_2 AS diff_qty_1, lag_qty_1 / (abs(lag_qty_2) + 1e-6) AS ratio_qty_12,
       COALESCE(idx - _last_incl, idx + 1)::BIGINT AS weeks_since_last_sale,
       COALESCE(idx - _last_excl, idx + 1)::BIGINT AS weeks_since_prev_sale,
       COALESCE(idx - _first_incl, 0)::BIGINT AS weeks_since_first_sale,
       COALESCE(idx - _next_incl, 0)::BIGINT AS weeks_since_first_sale_ascoded,
       COALESCE(idx - 1 - _last_excl, idx)::BIGINT AS zero_streak
FROM fw"""
    return [("ix", ix), ("fw", body), ("feat", derived)]


CALENDAR_SQL = """
SELECT store_id, product_id, week_start,
       weekofyear(week_start)::INTEGER AS week, month(week_start)::INTEGER AS month,
       quarter(week_start)::INTEGER AS quarter, year(week_start)::INTEGER AS year,
       (weekofyear(week_start) >= 51)::INTEGER AS is_year_end,
       (day(week_start) = 1)::INTEGER AS is_month_start,
       (week_start = last_day(week_start))::INTEGER AS is_month_end
FROM panel"""


def level_causal_sql(src: str = "panel") -> str:
    return f"""
SELECT p.store_id, p.product_id, p.week_start, s.freq_store, s.avg_qty_store, q.freq_product, q.avg_qty_product
FROM {src} p
JOIN (SELECT a.store_id, a.week_start, COALESCE(sum(b.c), 0)::BIGINT AS freq_store, sum(b.s) / sum(b.c) AS avg_qty_store
      FROM (SELECT DISTINCT store_id, week_start FROM {src}) a
      LEFT JOIN (SELECT store_id, week_start, sum(qty) AS s, count(*) AS c FROM {src} GROUP BY 1, 2) b
        ON b.store_id = a.store_id AND b.week_start < a.week_start
      GROUP BY 1, 2) s ON s.store_id = p.store_id AND s.week_start = p.week_start
JOIN (SELECT a.product_id, a.week_start, COALESCE(sum(b.c), 0)::BIGINT AS freq_product, sum(b.s) / sum(b.c) AS avg_qty_product
      FROM (SELECT DISTINCT product_id, week_start FROM {src}) a
      LEFT JOIN (SELECT product_id, week_start, sum(qty) AS s, count(*) AS c FROM {src} GROUP BY 1, 2) b
        ON b.product_id = a.product_id AND b.week_start < a.week_start
      GROUP BY 1, 2) q ON q.product_id = p.product_id AND q.week_start = p.week_start"""


def level_ascoded_sql(src: str = "panel") -> str:
    st = "PARTITION BY store_id ORDER BY product_id, week_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    pr = "PARTITION BY product_id ORDER BY store_id, week_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
SELECT store_id, product_id, week_start,
       count(*) OVER ({st})::BIGINT AS freq_store, avg(qty) OVER ({st}) AS avg_qty_store,
       count(*) OVER ({pr})::BIGINT AS freq_product, avg(qty) OVER ({pr}) AS avg_qty_product
FROM {src}"""


PROMO_SQL = """
SELECT store_id, product_id, week_start, discount_rate, promo_flag,
       lag(discount_rate, 1) OVER (PARTITION BY store_id, product_id ORDER BY week_start) AS discount_rate_lag1,
       lag(promo_flag, 1) OVER (PARTITION BY store_id, product_id ORDER BY week_start) AS promo_flag_lag1
FROM (SELECT *, CASE WHEN gross_value > 0 THEN LEAST(GREATEST(discount / gross_value, 0), 1) ELSE 0 END::DOUBLE AS discount_rate,
             (CASE WHEN gross_value > 0 THEN LEAST(GREATEST(discount / gross_value, 0), 1) ELSE 0 END >= 0.05)::INTEGER AS promo_flag
      FROM panel) x"""
