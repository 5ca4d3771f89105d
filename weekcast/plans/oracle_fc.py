"""DuckDB SQL for the baseline forecasters, written independently of the
Spark code: MA(4) and EWMA as recursive CTEs (the step-by-step recursion),
naive and smart back-off as plain aggregates."""

from __future__ import annotations

PARTS = "PARTITION BY store_id, product_id"


def naive_sql(src: str, h: str) -> str:
    return f"""
SELECT s.store_id, s.product_id, CAST(s.last_week + CAST(7 * t.i AS INTEGER) AS DATE) AS week_start, GREATEST(s.v, 0) AS pred
FROM (SELECT store_id, product_id, max(week_start) AS last_week,
             COALESCE(arg_max(qty, week_start) FILTER (WHERE n_tx > 0), arg_max(qty, week_start), 0)::DOUBLE AS v
      FROM {src} GROUP BY 1, 2) s,
     (SELECT unnest(generate_series(1, ({h}))) AS i) t"""


def ewma_sql(src: str, h: str, alpha: float = 0.5) -> str:
    a = repr(float(alpha))
    return f"""
SELECT p.store_id, p.product_id, CAST(p.last_week + CAST(7 * t.i AS INTEGER) AS DATE) AS week_start,
       GREATEST(COALESCE(e.s, 0), 0) AS pred
FROM (SELECT store_id, product_id, max(week_start) AS last_week FROM {src} GROUP BY 1, 2) p
LEFT JOIN (
  WITH RECURSIVE obs AS (
    SELECT store_id, product_id, qty::DOUBLE AS y, row_number() OVER ({PARTS} ORDER BY week_start) AS rn
    FROM {src} WHERE n_tx > 0),
  rec(store_id, product_id, rn, s) AS (
    SELECT store_id, product_id, rn, y FROM obs WHERE rn = 1
    UNION ALL
    SELECT o.store_id, o.product_id, o.rn, {a} * o.y + (1 - {a}) * r.s
    FROM rec r JOIN obs o ON o.store_id = r.store_id AND o.product_id = r.product_id AND o.rn = r.rn + 1)
  SELECT store_id, product_id, arg_max(s, rn) AS s FROM rec GROUP BY 1, 2) e
  ON e.store_id = p.store_id AND e.product_id = p.product_id,
  (SELECT unnest(generate_series(1, ({h}))) AS i) t"""


def ma4_sql(src: str, h: str) -> str:
    return f"""
WITH RECURSIVE tl AS (
  SELECT store_id, product_id, max(week_start) AS last_week,
         list(qty::DOUBLE ORDER BY week_start) AS l FROM {src} GROUP BY 1, 2),
rec(store_id, product_id, last_week, step, acc) AS (
  SELECT store_id, product_id, last_week, 0, list_slice(l, GREATEST(len(l) - 3, 1), len(l)) FROM tl
  UNION ALL
  SELECT store_id, product_id, last_week, step + 1,
         list_append(acc, list_avg(list_slice(acc, GREATEST(len(acc) - 3, 1), len(acc))))
  FROM rec WHERE step < ({h}))
SELECT store_id, product_id, CAST(last_week + CAST(7 * step AS INTEGER) AS DATE) AS week_start,
       GREATEST(acc[len(acc)], 0) AS pred
FROM rec WHERE step >= 1"""


def smart_sql(src: str, h: str, category: bool = False, extra: str | None = None) -> str:
    """``src`` needs store_category when ``category``; ``extra`` is a relation of
    cold pairs (store_id, product_id[, store_category]) forecast from the means."""
    cat_col = ", min(store_category) AS store_category" if category else ""
    cold = ""
    if extra:
        cat_sel = ", x.store_category" if category else ""
        cold = f"""
  UNION ALL
  SELECT x.store_id, x.product_id, (SELECT max(week_start) FROM {src}), 1, 0, NULL, NULL, NULL{cat_sel}
  FROM (SELECT DISTINCT * FROM {extra}) x
  WHERE NOT EXISTS (SELECT 1 FROM {src} s WHERE s.store_id = x.store_id AND s.product_id = x.product_id)"""
    cat_join = ""
    fallback = "pm.m, gm.g"
    if category:
        cat_join = f"""
LEFT JOIN (SELECT product_id, store_category, avg(qty) AS m FROM {src}
           WHERE n_tx > 0 AND store_category IS NOT NULL GROUP BY 1, 2) cm
  ON cm.product_id = st.product_id AND cm.store_category = st.store_category"""
        fallback = "cm.m, pm.m, gm.g"
    return f"""
WITH r AS (
  SELECT *, row_number() OVER ({PARTS} ORDER BY week_start DESC) AS rn,
         CASE WHEN n_tx > 0 THEN row_number() OVER ({PARTS}, n_tx > 0 ORDER BY week_start DESC) END AS orn
  FROM {src}),
st AS (
  SELECT store_id, product_id, max(week_start) AS last_week,
         max(CASE WHEN rn <= 12 AND n_tx > 0 THEN 1 ELSE 0 END) AS recent,
         count(*) FILTER (WHERE n_tx > 0) AS n_obs,
         avg(qty) FILTER (WHERE orn <= 4) AS mean4,
         max(qty) FILTER (WHERE orn = 1) AS last_obs,
         avg(qty) FILTER (WHERE n_tx > 0) AS mean_obs{cat_col}
  FROM r GROUP BY 1, 2{cold})
SELECT st.store_id, st.product_id, CAST(st.last_week + CAST(7 * t.i AS INTEGER) AS DATE) AS week_start,
       GREATEST(CASE WHEN recent = 0 THEN 0
                     WHEN n_obs >= 4 THEN mean4
                     WHEN n_obs >= 1 THEN GREATEST(last_obs, 0.7 * mean_obs)
                     ELSE COALESCE({fallback}) END, 0)::DOUBLE AS pred
FROM st
LEFT JOIN (SELECT product_id, avg(qty) AS m FROM {src} WHERE n_tx > 0 GROUP BY 1) pm ON pm.product_id = st.product_id
CROSS JOIN (SELECT COALESCE(avg(qty), 0) AS g FROM {src} WHERE n_tx > 0) gm{cat_join},
(SELECT unnest(generate_series(1, ({h}))) AS i) t"""


FC_SQL = {"naive": naive_sql, "ewma": ewma_sql, "ma4": ma4_sql, "smart": smart_sql}
