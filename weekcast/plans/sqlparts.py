"""SQL text for the DuckDB oracle: fixture mapping, weekly aggregate, panels.

These mirror the DataFrame code with different algorithms where possible
(the panel here is ``generate_series`` + a left join; the Spark side uses
``lead`` + ``posexplode``), so a match checks semantics, not a transcription.
"""

from __future__ import annotations

from weekcast.sources.fixtures import (SQL_HOLIDAYS, SQL_PRODUCTS, SQL_SALES_CLEAN, SQL_SALES_DENSE,
                                       SQL_SALES_DIRTY, SQL_SALES_DIRTY_TYPED, SQL_STORES,
                                       SQL_STORES_ORPHANS)

KEYS = "store_id, product_id"
MONEY = ("gross_value", "net_value", "gross_profit", "discount", "taxes")
MEASURES = ("qty", "qty_return") + MONEY + ("n_tx",)


def week_expr(col: str, anchor_day: int = 1) -> str:
    return f"CAST({col} - CAST((isodow({col}) - {anchor_day} + 7) % 7 AS INTEGER) AS DATE)"


def weekly_sql(sales: str = "sales", anchor_day: int = 1) -> str:
    money = ",\n       ".join(f"COALESCE(CAST(SUM(CAST({c} AS DECIMAL(18,6))) AS DOUBLE), 0) AS {c}" for c in MONEY)
    return f"""
SELECT store_id, product_id, {week_expr('txn_date', anchor_day)} AS week_start,
       COALESCE(SUM(GREATEST(COALESCE(quantity, 0), 0)), 0) AS qty,
       COALESCE(SUM(abs(LEAST(COALESCE(quantity, 0), 0))), 0) AS qty_return,
       {money},
       COUNT(txn_date) AS n_tx
FROM {sales}
WHERE store_id IS NOT NULL AND product_id IS NOT NULL AND txn_date IS NOT NULL
GROUP BY 1, 2, 3"""


def panel_from_bounds_sql(bounds: str, weekly: str = "weekly") -> str:
    fill = ",\n       ".join(
        f"COALESCE(w.{c}, 0){'::BIGINT' if c == 'n_tx' else '::DOUBLE'} AS {c}" for c in MEASURES)
    return f"""
SELECT g.store_id, g.product_id, g.week_start,
       {fill}
FROM (SELECT store_id, product_id, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS week_start
      FROM {bounds}) g
LEFT JOIN {weekly} w USING (store_id, product_id, week_start)"""


def panel_local_sql(weekly: str = "weekly") -> str:
    bounds = f"(SELECT store_id, product_id, min(week_start) AS a, max(week_start) AS b FROM {weekly} GROUP BY 1, 2)"
    return panel_from_bounds_sql(bounds, weekly)


def panel_span_sql(weekly: str = "weekly") -> str:
    bounds = (f"(SELECT store_id, product_id, min(week_start) AS a, (SELECT max(week_start) FROM {weekly}) AS b "
              f"FROM {weekly} GROUP BY 1, 2)")
    return panel_from_bounds_sql(bounds, weekly)


def panel_grid_sql(weekly: str = "weekly") -> str:
    fill = ",\n       ".join(
        f"COALESCE(w.{c}, 0){'::BIGINT' if c == 'n_tx' else '::DOUBLE'} AS {c}" for c in MEASURES)
    return f"""
SELECT g.store_id, g.product_id, g.week_start,
       {fill}
FROM (SELECT p.store_id, p.product_id, d.week_start
      FROM (SELECT DISTINCT store_id, product_id FROM {weekly}) p
      CROSS JOIN (SELECT DISTINCT week_start FROM {weekly}) d) g
LEFT JOIN {weekly} w USING (store_id, product_id, week_start)"""


def with_ctes(ctes: list[tuple[str, str]], select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {body}\n{select}"


def base_ctes(sales_sql: str = SQL_SALES_CLEAN, anchor_day: int = 1, span: str = "local") -> list[tuple[str, str]]:
    panel = {"local": panel_local_sql, "span": panel_span_sql, "grid": panel_grid_sql}[span]("weekly")
    return [("sales", sales_sql), ("weekly", weekly_sql("sales", anchor_day)), ("panel", panel)]


def r6(sql: str, cols) -> str:
    """Round the named double columns to 6 places (oracle determinism rule)."""
    cols = list(cols)
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) _r"


PAIR_W = "PARTITION BY store_id, product_id ORDER BY week_start"


def frame(prev: int | None, to: int | str = -1) -> str:
    """ROWS frame text relative to the current row; None = unbounded preceding."""
    start = "UNBOUNDED PRECEDING" if prev is None else f"{prev} PRECEDING"
    end = {0: "CURRENT ROW", -1: "1 PRECEDING"}.get(to, to)
    return f"OVER ({PAIR_W} ROWS BETWEEN {start} AND {end})"


__all__ = ["SQL_HOLIDAYS", "SQL_PRODUCTS", "SQL_SALES_CLEAN", "SQL_SALES_DENSE", "SQL_SALES_DIRTY",
           "SQL_SALES_DIRTY_TYPED", "SQL_STORES", "SQL_STORES_ORPHANS"]
