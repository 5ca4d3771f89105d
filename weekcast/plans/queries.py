"""Query registry: every operator of the inventory as (Spark builder, DuckDB SQL).

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over the whole fixture
tables; ``ORACLE[name]`` is the same result in SQL (absent for model
queries, which are checked on rows only).  Double columns are rounded to 6
places on both sides so float summation order cannot change the hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weekcast.config import FEATURE_LAGS
from weekcast.operators import baselines as bl
from weekcast.operators.evaluate import backtest, bearing_rows, eval_rows
from weekcast.operators.forecast import active_pairs, forecast_month
from weekcast.operators.panel import panel_grid, panel_local
from weekcast.operators.weekly import weekly_sales
from weekcast.plans import oracle_fc as ofc
from weekcast.plans.sqlparts import (SQL_SALES_CLEAN, SQL_STORES, base_ctes, r6, with_ctes)
from weekcast.sources import fixtures as fx
from weekcast.sources.fixtures import CALENDAR

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round6(c) -> F.Column:
    """round(x * 1e6) / 1e6 on the binary double: the same arithmetic as the
    oracle's ``round(x, 6)``, so ties at the 7th decimal break alike.

    Spark's ``round`` of a double goes through the text of the number; ``rint`` does not, and differs on
    exact halves only (it takes the even side), which are moved away from zero here."""
    v = F.col(c) * F.lit(1e6)
    whole = F.when(F.abs(v - F.rint(v)) == 0.5, v + F.signum(v) * 0.5).otherwise(F.rint(v))
    return (whole + F.lit(0.0)) / F.lit(1e6)


def r6df(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (same rule as the oracle SQL)."""
    cols = [round6(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


# ------------------------------------------------------------------ shared
def f1_sales(spark, d):
    return fx.sales_clean(spark, d)


def f1_weekly(spark, d, anchor="MON"):
    cfg = CALENDAR.with_(week_anchor=anchor)
    return weekly_sales(f1_sales(spark, d), cfg)


def f1_panel(spark, d, span="local"):
    wk = f1_weekly(spark, d)
    if span == "local":
        return panel_local(wk)
    if span == "span":
        return panel_local(wk, end="global_max")
    return panel_grid(wk)


MONEY = ("gross_value", "net_value", "gross_profit", "discount", "taxes")
WEEKLY_DOUBLES = ("qty", "qty_return") + MONEY
SALES_COLS = "store_id, product_id, txn_date, quantity, gross_value, net_value, gross_profit, discount, taxes"


# ------------------------------------------------------------- S1, T1, X1
@query("scan_sales", r6(f"SELECT {SALES_COLS} FROM ({SQL_SALES_CLEAN}) s", ("quantity",) + MONEY))
def q_scan_sales(spark, d):
    return r6df(f1_sales(spark, d))


@query("week_bucket", f"""
SELECT store_id, product_id, txn_date,
       CAST(txn_date - CAST((isodow(txn_date) + 6) % 7 AS INTEGER) AS DATE) AS week_mon,
       CAST(txn_date - CAST((isodow(txn_date) + 5) % 7 AS INTEGER) AS DATE) AS week_tue
FROM ({SQL_SALES_CLEAN}) s""")
def q_week_bucket(spark, d):
    from weekcast.functions.dates import week_start
    s = f1_sales(spark, d)
    return s.select("store_id", "product_id", "txn_date", week_start("txn_date", "MON").alias("week_mon"),
                    week_start("txn_date", "TUE").alias("week_tue"))


@query("returns_split", r6(f"""
SELECT store_id, product_id, txn_date, quantity,
       abs(LEAST(COALESCE(quantity, 0), 0)) AS quantity_return, GREATEST(COALESCE(quantity, 0), 0) AS quantity_pos
FROM ({SQL_SALES_CLEAN}) s""", ("quantity", "quantity_return", "quantity_pos")))
def q_returns_split(spark, d):
    from weekcast.functions.scalars import returns_split
    s = f1_sales(spark, d)
    return r6df(s.select("store_id", "product_id", "txn_date", "quantity", *[
        v.alias(k) for k, v in returns_split("quantity").items()]))


# ------------------------------------------------------------- A1, T2, T3
@query("weekly_sales", r6(with_ctes(base_ctes()[:2], "SELECT * FROM weekly"), WEEKLY_DOUBLES))
def q_weekly_sales(spark, d):
    return r6df(f1_weekly(spark, d))


@query("weekly_sales_tue", r6(with_ctes(base_ctes(anchor_day=2)[:2], "SELECT * FROM weekly"), WEEKLY_DOUBLES))
def q_weekly_sales_tue(spark, d):
    return r6df(f1_weekly(spark, d, "TUE"))


@query("panel_local", r6(with_ctes(base_ctes(), "SELECT * FROM panel"), WEEKLY_DOUBLES))
def q_panel_local(spark, d):
    return r6df(f1_panel(spark, d))


@query("panel_span", r6(with_ctes(base_ctes(span="span"), "SELECT * FROM panel"), WEEKLY_DOUBLES))
def q_panel_span(spark, d):
    return r6df(f1_panel(spark, d, "span"))


@query("panel_grid", r6(with_ctes(base_ctes(span="grid"), "SELECT * FROM panel"), WEEKLY_DOUBLES))
def q_panel_grid(spark, d):
    return r6df(f1_panel(spark, d, "grid"))


@query("pair_domain", with_ctes(base_ctes()[:2], """
SELECT store_id, product_id, min(week_start) AS first_week, max(week_start) AS last_week,
       count(*) AS observed_weeks FROM weekly GROUP BY 1, 2"""))
def q_pair_domain(spark, d):
    wk = f1_weekly(spark, d)
    return wk.groupBy("store_id", "product_id").agg(F.min("week_start").alias("first_week"),
                                                    F.max("week_start").alias("last_week"),
                                                    F.count(F.lit(1)).alias("observed_weeks"))


# ------------------------------------------------------------ M1-M4 forecasts
def _fc_query(name: str, span: str = "local"):
    pred = f"pred_{name}"

    def run(spark, d):
        return r6df(bl.forecast(f1_panel(spark, d, span), name))

    body = ofc.FC_SQL[name]("panel", "5")
    sql = r6(with_ctes(base_ctes(span=span), f"SELECT store_id, product_id, week_start, pred AS {pred} FROM ({body}) f"),
             (pred,))
    return run, sql


for _name in bl.BASELINES:
    _run, _sql = _fc_query(_name)
    query(f"fc_{_name}", _sql)(_run)
_run, _sql = _fc_query("smart", "grid")
query("fc_smart_grid", _sql)(_run)


def _cold_sql() -> str:
    ctes = base_ctes() + [
        ("hist", "SELECT p.*, s.store_category FROM panel p LEFT JOIN (" + SQL_STORES + ") s USING (store_id) "
                 "WHERE week_start < DATE '2001-10-08'"),
        ("cold", "SELECT DISTINCT p.store_id, p.product_id, s.store_category FROM panel p LEFT JOIN ("
                 + SQL_STORES + ") s USING (store_id) WHERE week_start >= DATE '2001-10-08' "
                 "AND week_start < DATE '2001-11-05'"),
    ]
    body = ofc.smart_sql("hist", "5", category=True, extra="cold")
    return r6(with_ctes(ctes, f"SELECT store_id, product_id, week_start, pred AS pred_smart FROM ({body}) f"),
              ("pred_smart",))


@query("fc_smart_cold", _cold_sql())
def q_fc_smart_cold(spark, d):
    """Smart back-off with cold-start pairs: pairs first sold after the cut-off
    get the product x store-category -> product -> global mean (trap R8)."""
    stores = fx.stores_register(spark, d).select("store_id", "store_category")
    p = f1_panel(spark, d).join(stores, "store_id", "left")
    hist = p.where(F.col("week_start") < F.lit(CALENDAR.cutoff))
    cold = p.where((F.col("week_start") >= F.lit(CALENDAR.cutoff)) & (F.col("week_start") < F.lit(CALENDAR.valid_end))) \
            .select("store_id", "product_id", "store_category")
    st = bl.smart_state(hist, CALENDAR, extra_pairs=cold)
    return r6df(bl.explode_state(st, CALENDAR, "pred_smart"))


# ------------------------------------------------------------------ M7 backtest
def _eval_sql(name: str, restrict_lags: bool = False) -> tuple[str, str]:
    """(CTE list text, rows select) for the back-test of one baseline."""
    ctes = base_ctes() + [
        ("hist", "SELECT * FROM panel WHERE week_start < DATE '2001-10-08'"),
        ("valid", "SELECT * FROM panel WHERE week_start >= DATE '2001-10-08' AND week_start < DATE '2001-11-05'"),
        ("hz", "SELECT count(DISTINCT week_start) AS h FROM valid"),
        ("preds", ofc.FC_SQL[name]("hist", "SELECT h FROM hz")),
    ]
    where = ""
    if restrict_lags:
        ctes.append(("vl", "SELECT *, lag(qty, 26) OVER (PARTITION BY store_id, product_id ORDER BY week_start) AS l26 "
                           "FROM panel"))
        where = ("WHERE EXISTS (SELECT 1 FROM vl WHERE vl.store_id = v.store_id AND vl.product_id = v.product_id "
                 "AND vl.week_start = v.week_start AND vl.l26 IS NOT NULL)")
    rows = f"""
SELECT v.week_start, v.store_id, v.product_id, v.qty::DOUBLE AS y_true, COALESCE(p.pred, 0)::DOUBLE AS y_pred,
       abs(v.qty - COALESCE(p.pred, 0))::DOUBLE AS abs_err, p.pred IS NULL AS unseen
FROM valid v LEFT JOIN preds p USING (store_id, product_id, week_start) {where}"""
    return ctes, rows


SUMMARY_SQL = """
SELECT sum(abs_err) / GREATEST(sum(abs(y_true)), 1e-9) AS wmape_all,
       CASE WHEN count(*) FILTER (WHERE y_true > 0) > 0 THEN
         sum(abs_err) FILTER (WHERE y_true > 0) / GREATEST(sum(abs(y_true)) FILTER (WHERE y_true > 0), 1e-9) END AS wmape_pos,
       count(*) AS rows, count(*) FILTER (WHERE y_true > 0) AS positive_rows,
       count(*) FILTER (WHERE unseen) AS unseen_rows, count(DISTINCT week_start) AS horizon
FROM er"""


def _backtest(name: str, restrict_lags: bool = False):
    def run(spark, d):
        p = f1_panel(spark, d)
        if restrict_lags:
            from weekcast.operators.features import lag_columns
            p = bearing_rows(p, name, CALENDAR, max(FEATURE_LAGS)).withColumns(lag_columns(CALENDAR))
        return r6df(backtest(p, name, CALENDAR, restrict_lags=restrict_lags, gapless=True))

    ctes, rows = _eval_sql(name, restrict_lags)
    sql = r6(with_ctes(ctes + [("er", rows)], SUMMARY_SQL), ("wmape_all", "wmape_pos"))
    return run, sql


for _name in bl.BASELINES:
    _run, _sql = _backtest(_name)
    query(f"backtest_{_name}", _sql)(_run)
_run, _sql = _backtest("smart", restrict_lags=True)
query("backtest_restrict_lags", _sql)(_run)


_ctes, _rows = _eval_sql("smart")


@query("eval_rows", r6(with_ctes(_ctes, f"SELECT week_start, store_id, product_id, y_true, y_pred, abs_err FROM ({_rows}) e"),
                       ("y_true", "y_pred", "abs_err")))
def q_eval_rows(spark, d):
    er = eval_rows(f1_panel(spark, d), "smart", CALENDAR, gapless=True)
    return r6df(er.drop("unseen"))


@query("wmape", r6(with_ctes(_ctes + [("er", _rows)], """
SELECT week_start, sum(abs_err) / GREATEST(sum(abs(y_true)), 1e-9) AS wmape, count(*) AS rows
FROM er GROUP BY week_start"""), ("wmape",)))
def q_wmape(spark, d):
    """WMAPE per validation week of the smart baseline (A4)."""
    er = eval_rows(f1_panel(spark, d), "smart", CALENDAR, gapless=True)
    return r6df(er.groupBy("week_start").agg(
        (F.sum("abs_err") / F.greatest(F.sum(F.abs("y_true")), F.lit(1e-9))).alias("wmape"),
        F.count(F.lit(1)).alias("rows")))


# ------------------------------------------------------------------ M6 delivery
def _month_sql(active: bool) -> str:
    ctes = base_ctes() + [("fc", ofc.smart_sql("panel", "5")),
                          ("mon", "SELECT *, dense_rank() OVER (ORDER BY week_start)::BIGINT AS week_no FROM fc "
                                  "WHERE week_start >= DATE '2001-11-05' AND week_start < DATE '2001-12-10'")]
    where = ""
    if active:
        ctes.append(("act", "SELECT DISTINCT store_id, product_id FROM panel WHERE week_start >= DATE '2001-11-05' - INTERVAL 91 DAY "
                            "AND week_start < DATE '2001-11-05' AND qty > 0"))
        where = ("WHERE EXISTS (SELECT 1 FROM act a WHERE a.store_id = m.store_id AND a.product_id = m.product_id)")
    return with_ctes(ctes, f"""
SELECT m.week_no, COALESCE(m.store_id, 0)::BIGINT AS store_id,
       COALESCE(m.product_id, 0)::BIGINT AS product_id, round_even(GREATEST(m.pred, 0), 0)::BIGINT AS quantity
FROM mon m {where}""")


@query("forecast_month", _month_sql(False))
def q_forecast_month(spark, d):
    return forecast_month(f1_panel(spark, d), "smart", CALENDAR)


@query("forecast_month_active", _month_sql(True))
def q_forecast_month_active(spark, d):
    return forecast_month(f1_panel(spark, d), "smart", CALENDAR, only_active=True, active_window=13)


@query("active_pairs", with_ctes(base_ctes(), """
SELECT DISTINCT store_id, product_id FROM panel
WHERE week_start >= DATE '2001-11-05' - INTERVAL 21 DAY AND week_start < DATE '2001-11-05' AND qty > 0"""))
def q_active_pairs(spark, d):
    """Pairs sold in the 3 weeks before the target month (the delivery recipe's window)."""
    return active_pairs(f1_panel(spark, d), CALENDAR.target_start, 3)


# ------------------------------------------------------------- quality
from weekcast.operators import quality as qa  # noqa: E402
from weekcast.plans.sqlparts import (SQL_SALES_DIRTY, SQL_SALES_DIRTY_TYPED, SQL_STORES_ORPHANS,  # noqa: E402
                                     weekly_sql, panel_grid_sql)
from weekcast.sources.normalize import consolidate_schema, canonical_rename, standardize_columns  # noqa: E402

DEDUP_SUBSET = ["store_id", "product_id", "txn_date", "gross_value", "quantity"]
TYPED_DOUBLES = ("quantity",) + MONEY
YEAR_START, YEAR_END = fx.F3_START, fx.F3_END


def f3_typed(spark, d):
    return consolidate_schema(fx.sales_dirty(spark, d))


@query("normalize_schema", """
SELECT internal_store_id AS store_id, internal_product_id AS product_id, transaction_date AS txn_date, quantity
FROM (""" + SQL_SALES_DIRTY + ") d")
def q_normalize_schema(spark, d):
    """Names stripped and lower-cased, then renamed (N1, N2); values untouched."""
    df = canonical_rename(standardize_columns(fx.sales_dirty(spark, d)))
    return df.select("store_id", "product_id", "txn_date", "quantity")


@query("coerce_types", r6(SQL_SALES_DIRTY_TYPED, TYPED_DOUBLES))
def q_coerce_types(spark, d):
    """Ids, dates and measures parsed with try-casts; bad text becomes null."""
    return r6df(f3_typed(spark, d))


@query("date_range_audit", f"""
SELECT min(txn_date) AS min_date, max(txn_date) AS max_date, count(*) AS rows,
       count(*) FILTER (WHERE txn_date >= DATE '2000-01-01' AND txn_date < DATE '2001-01-01') AS rows_in_range,
       count(*) FILTER (WHERE NOT COALESCE(txn_date >= DATE '2000-01-01' AND txn_date < DATE '2001-01-01', FALSE)) AS rows_dropped
FROM ({SQL_SALES_DIRTY_TYPED}) t""")
def q_date_range_audit(spark, d):
    return qa.date_range_audit(f3_typed(spark, d), "txn_date", YEAR_START, YEAR_END)


_DEDUP_SQL = f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id, product_id, txn_date, gross_value, quantity
                               ORDER BY net_value NULLS FIRST, gross_profit NULLS FIRST, discount NULLS FIRST,
                                        taxes NULLS FIRST) AS _rn
  FROM ({SQL_SALES_DIRTY_TYPED}) t) x WHERE _rn = 1"""


@query("dedup_sales", r6(_DEDUP_SQL, TYPED_DOUBLES))
def q_dedup_sales(spark, d):
    """Subset de-duplication of the typed dirty sales, all dates."""
    return r6df(qa.dedup(f3_typed(spark, d), DEDUP_SUBSET))


@query("dedup_counts", f"""
SELECT b.n AS rows_before, a.n AS rows_after, b.n - a.n AS removed
FROM (SELECT count(*) AS n FROM ({SQL_SALES_DIRTY_TYPED}) t) b, (SELECT count(*) AS n FROM ({_DEDUP_SQL}) u) a""")
def q_dedup_counts(spark, d):
    t = f3_typed(spark, d)
    return qa.dedup_counts(t, DEDUP_SUBSET)


_CLEAN_SALES_SQL = f"""
SELECT * FROM ({_DEDUP_SQL}) x
WHERE txn_date >= DATE '2000-01-01' AND txn_date < DATE '2001-01-01'"""


@query("clean_weekly", r6(with_ctes([("sales", _CLEAN_SALES_SQL), ("weekly", weekly_sql("sales"))],
                                    "SELECT * FROM weekly"), WEEKLY_DOUBLES))
def q_clean_weekly(spark, d):
    """Dirty sales -> types -> year filter -> dedup -> weekly aggregate (U6 cleaning path)."""
    t = qa.date_range_filter(f3_typed(spark, d), "txn_date", YEAR_START, YEAR_END)
    return r6df(weekly_sales(qa.dedup(t, DEDUP_SUBSET)))


@query("profile", f"""
SELECT min(txn_date) AS min_date, max(txn_date) AS max_date, count(*) AS rows,
       count(DISTINCT store_id) AS distinct_stores, count(DISTINCT product_id) AS distinct_products,
       count(*) FILTER (WHERE store_id IS NULL) AS nulls_store_id,
       count(*) FILTER (WHERE product_id IS NULL) AS nulls_product_id,
       count(*) FILTER (WHERE txn_date IS NULL) AS nulls_txn_date,
       count(*) FILTER (WHERE quantity IS NULL) AS nulls_quantity,
       count(*) FILTER (WHERE gross_value IS NULL) AS nulls_gross_value,
       count(*) FILTER (WHERE net_value IS NULL) AS nulls_net_value,
       count(*) FILTER (WHERE gross_profit IS NULL) AS nulls_gross_profit,
       count(*) FILTER (WHERE discount IS NULL) AS nulls_discount,
       count(*) FILTER (WHERE taxes IS NULL) AS nulls_taxes
FROM ({SQL_SALES_DIRTY_TYPED}) t""")
def q_profile(spark, d):
    return qa.profile(f3_typed(spark, d))


@query("profile_sketch", f"""
SELECT 'store_id' AS column_name, count(DISTINCT store_id) AS exact_distinct, TRUE AS within_bound FROM ({SQL_SALES_DIRTY_TYPED}) t
UNION ALL SELECT 'product_id', count(DISTINCT product_id), TRUE FROM ({SQL_SALES_DIRTY_TYPED}) t
UNION ALL SELECT 'txn_date', count(DISTINCT txn_date), TRUE FROM ({SQL_SALES_DIRTY_TYPED}) t
UNION ALL SELECT 'net_value', count(DISTINCT net_value), TRUE FROM ({SQL_SALES_DIRTY_TYPED}) t""")
def q_profile_sketch(spark, d):
    """Distinct values by sketches of months, merged, against exact counts."""
    cols = ["store_id", "product_id", "txn_date", "net_value"]
    sales = f3_typed(spark, d).select(*cols)
    approx = qa.distinct_estimates(qa.distinct_sketches(sales, [F.trunc("txn_date", "month").alias("month")], cols), cols)
    approx = approx.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"approx_{c}").alias("_approx")) for c in cols]))
                           .alias("_e")).select("_e.*")
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("_v")) for c in cols]))
    exact = (sales.select(values.alias("_e")).select("_e.*").distinct()
             .groupBy("column_name").agg(F.count("_v").alias("exact_distinct")))
    off = F.abs(F.col("_approx") - F.col("exact_distinct"))
    return (exact.join(approx, "column_name")
            .select("column_name", "exact_distinct", (off <= F.col("exact_distinct") * qa.sketch_error() + 1).alias("within_bound")))


# ------------------------------------------------------- registers (J1-J4, O)
STORE_ATTRS = ("premise", "store_category", "zipcode")


@query("enrich_left", r6(f"""
SELECT s.*, r.premise, r.store_category, r.zipcode
FROM ({SQL_SALES_CLEAN}) s LEFT JOIN ({SQL_STORES_ORPHANS}) r USING (store_id)""", ("quantity",) + MONEY))
def q_enrich_left(spark, d):
    return r6df(qa.enrich(f1_sales(spark, d), fx.stores_register(spark, d, with_orphans=True), how="left"))


@query("consolidate", r6(f"""
SELECT s.*, r.premise, r.store_category, r.zipcode
FROM ({SQL_SALES_CLEAN}) s JOIN ({SQL_STORES_ORPHANS}) r USING (store_id)""", ("quantity",) + MONEY))
def q_consolidate(spark, d):
    return r6df(qa.enrich(f1_sales(spark, d), fx.stores_register(spark, d, with_orphans=True), how="inner"))


@query("orphan_stores", f"""
SELECT DISTINCT store_id FROM ({SQL_SALES_CLEAN}) s
WHERE store_id IS NOT NULL AND store_id NOT IN (SELECT store_id FROM ({SQL_STORES_ORPHANS}) r)""")
def q_orphan_stores(spark, d):
    return qa.orphan_keys(f1_sales(spark, d), fx.stores_register(spark, d, with_orphans=True))


@query("orphan_impact", r6(f"""
WITH s AS ({SQL_SALES_CLEAN}), r AS ({SQL_STORES_ORPHANS}),
f AS (SELECT s.*, (s.store_id IS NOT NULL AND s.store_id NOT IN (SELECT store_id FROM r)) AS o FROM s)
SELECT count(DISTINCT store_id) FILTER (WHERE o) AS orphan_keys,
       COALESCE(sum(quantity) FILTER (WHERE o), 0) AS orphan_units, COALESCE(sum(quantity), 0) AS total_units,
       count(*) FILTER (WHERE o) AS orphan_rows, count(*) AS total_rows,
       100.0 * COALESCE(sum(quantity) FILTER (WHERE o), 0) / sum(quantity) AS pct_units,
       100.0 * count(*) FILTER (WHERE o) / count(*) AS pct_rows
FROM f""", ("orphan_units", "total_units", "pct_units", "pct_rows")))
def q_orphan_impact(spark, d):
    return r6df(qa.orphan_impact(f1_sales(spark, d), fx.stores_register(spark, d, with_orphans=True)))


@query("key_set_audit", f"""
SELECT (SELECT count(DISTINCT store_id) FROM ({SQL_SALES_CLEAN}) s) AS keys_in_sales,
       (SELECT count(DISTINCT store_id) FROM ({SQL_STORES_ORPHANS}) r) AS keys_in_register,
       (SELECT count(*) FROM (SELECT DISTINCT store_id FROM ({SQL_SALES_CLEAN}) s WHERE store_id IS NOT NULL
                              EXCEPT SELECT store_id FROM ({SQL_STORES_ORPHANS}) r) x) AS keys_without_register""")
def q_key_set_audit(spark, d):
    return qa.key_set_audit(f1_sales(spark, d), fx.stores_register(spark, d, with_orphans=True))


@query("union_parts", r6(f"SELECT * FROM ({SQL_SALES_CLEAN}) s", ("quantity",) + MONEY))
def q_union_parts(spark, d):
    """The sales read as two date partitions and concatenated (O1)."""
    mid = fx.dt.date(2000, 7, 1)
    first, second = fx.sales_clean(spark, d, end=mid), fx.sales_clean(spark, d, start=mid)
    return r6df(first.unionByName(second))


@query("store_attrs", f"""
SELECT store_id, m.premise, m.store_category, m.zipcode FROM (
SELECT store_id, min(struct_pack(premise := premise, store_category := store_category, zipcode := zipcode)) AS m
FROM ({SQL_SALES_CLEAN}) s JOIN ({SQL_STORES}) r USING (store_id) GROUP BY store_id) x""")
def q_store_attrs(spark, d):
    """One attribute row per store from the consolidated set."""
    cons = fx.consolidated_clean(spark, d)
    return qa.first_per_key(cons, "store_id", list(STORE_ATTRS))


@query("table_shapes", """
SELECT 'lineitem' AS table_name, count(*) AS rows, 11::BIGINT AS n_columns,
       'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate' AS columns FROM lineitem
UNION ALL SELECT 'part', count(*), 6, 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' FROM part
UNION ALL SELECT 'supplier', count(*), 4, 's_suppkey,s_name,s_nationkey,s_acctbal' FROM supplier""")
def q_table_shapes(spark, d):
    """Per input file: rows, column count and names."""
    from weekcast.sources.readers import read_table
    return qa.table_shapes({t: read_table(spark, d, t) for t in ("lineitem", "part", "supplier")})


@query("sample_10pct", r6(f"""
SELECT s.*, r.premise, r.store_category, r.zipcode FROM ({SQL_SALES_CLEAN}) s JOIN ({SQL_STORES}) r USING (store_id)
WHERE ('0x' || substr(md5('42|' || store_id || '|' || product_id || '|' || txn_date::VARCHAR), 1, 8))::BIGINT < 0.1 * 4294967296""",
                         ("quantity",) + MONEY))
def q_sample_10pct(spark, d):
    """10 % of the consolidated set by a hash of the row's key, seed 42."""
    return r6df(qa.sample_rows(fx.consolidated_clean(spark, d), ["store_id", "product_id", "txn_date"], 0.1, 42))


# ------------------------------------------------------------- splits
@query("temporal_split", r6(with_ctes(base_ctes(), """
SELECT CASE WHEN week_start < DATE '2001-10-08' THEN 'train' ELSE 'valid' END AS split,
       count(*) AS rows, sum(qty) AS qty, min(week_start) AS first_week, max(week_start) AS last_week
FROM panel GROUP BY 1"""), ("qty",)))
def q_temporal_split(spark, d):
    p = f1_panel(spark, d)
    lab = F.when(F.col("week_start") < F.lit(CALENDAR.cutoff), "train").otherwise("valid")
    return r6df(p.groupBy(lab.alias("split")).agg(F.count(F.lit(1)).alias("rows"), F.sum("qty").alias("qty"),
                                                  F.min("week_start").alias("first_week"),
                                                  F.max("week_start").alias("last_week")))


@query("split_counts", with_ctes(base_ctes(), """
SELECT count(*) FILTER (WHERE week_start < DATE '2001-10-08') AS rows_train,
       count(*) FILTER (WHERE week_start >= DATE '2001-10-08') AS rows_valid,
       count(*) FILTER (WHERE week_start >= DATE '2001-10-08' AND week_start < DATE '2001-11-05') AS rows_valid_window,
       count(*) AS rows_total FROM panel"""))
def q_split_counts(spark, d):
    p, wk = f1_panel(spark, d), F.col("week_start")
    return p.agg(F.count_if(wk < F.lit(CALENDAR.cutoff)).alias("rows_train"),
                 F.count_if(wk >= F.lit(CALENDAR.cutoff)).alias("rows_valid"),
                 F.count_if((wk >= F.lit(CALENDAR.cutoff)) & (wk < F.lit(CALENDAR.valid_end))).alias("rows_valid_window"),
                 F.count(F.lit(1)).alias("rows_total"))


# ------------------------------------------------------------- features (W, X)
from weekcast.functions.dates import calendar_columns  # noqa: E402
from weekcast.operators import features as ft  # noqa: E402
from weekcast.plans import oracle_features as ofe  # noqa: E402
from weekcast.plans.sqlparts import SQL_HOLIDAYS, SQL_PRODUCTS  # noqa: E402

PK = ["store_id", "product_id", "week_start"]


def f1_pair_features(spark, d, ascoded=False):
    return ft.add_pair_features(f1_panel(spark, d), CALENDAR, ascoded=ascoded)


def _feat_query(name: str, cols: tuple[str, ...], dbl: tuple[str, ...]):
    sql = r6(with_ctes(base_ctes() + ofe.pair_features_sql("panel"),
                       f"SELECT store_id, product_id, week_start, {', '.join(cols)} FROM feat"), dbl)

    def run(spark, d):
        ascoded = any(c.endswith("_ascoded") for c in cols)
        return r6df(f1_pair_features(spark, d, ascoded).select(*PK, *cols))
    run.__doc__ = f"Pair window features {', '.join(cols)}."
    query(name, sql)(run)


_LAGS = tuple(f"lag_qty_{L}" for L in (1, 2, 3, 4, 8, 12, 26))
_feat_query("feat_lags", _LAGS, _LAGS)
_feat_query("feat_ma", ("ma_qty_4", "ma_qty_12"), ("ma_qty_4", "ma_qty_12"))
_feat_query("feat_std", ("std_qty_4", "std_qty_12"), ("std_qty_4", "std_qty_12"))
_feat_query("feat_diff_ratio", ("diff_qty_1", "ratio_qty_12"), ("diff_qty_1", "ratio_qty_12"))
_feat_query("feat_price", ("price_u", "price_u_ma8"), ("price_u", "price_u_ma8"))
_feat_query("feat_active_share", ("active_share_8", "active_share_13", "active_share_26"),
            ("active_share_8", "active_share_13", "active_share_26"))
_feat_query("feat_recency", ("weeks_since_last_sale", "weeks_since_prev_sale", "n_tx_lag1"), ())
_feat_query("feat_first_sale", ("weeks_since_first_sale", "weeks_since_first_sale_ascoded"), ())
_feat_query("feat_zero_streak", ("zero_streak",), ())


@query("feat_calendar", with_ctes(base_ctes(), ofe.CALENDAR_SQL))
def q_feat_calendar(spark, d):
    return f1_panel(spark, d).select(*PK, *[v.alias(k) for k, v in calendar_columns("week_start").items()])


@query("feat_expanding_causal", r6(with_ctes(base_ctes(), ofe.level_causal_sql("panel")),
                                   ("avg_qty_store", "avg_qty_product")))
def q_feat_expanding_causal(spark, d):
    """Rows and mean qty of the store / product in all earlier weeks (W9, W10 causal)."""
    from weekcast.session import stored
    wk = stored(f1_weekly(spark, d), "weekly")
    out = ft.add_level_encodings(panel_local(wk, by=ft.history_by(wk)), CALENDAR, wk)
    return r6df(out.select(*PK, "freq_store", "avg_qty_store", "freq_product", "avg_qty_product"))


@query("feat_expanding_asis", r6(with_ctes(base_ctes(), f"SELECT store_id, product_id, week_start, avg_qty_store, "
                                                       f"avg_qty_product FROM ({ofe.level_ascoded_sql('panel')}) x"),
                                 ("avg_qty_store", "avg_qty_product")))
def q_feat_expanding_asis(spark, d):
    """Expanding means in the reference's (product, week) / (store, week) order (W10, trap R6)."""
    wk = f1_weekly(spark, d)
    out = ft.add_level_encodings_ascoded(panel_local(wk), CALENDAR, wk)
    return r6df(out.select(*PK, "avg_qty_store", "avg_qty_product"))


@query("feat_freq", with_ctes(base_ctes(), f"SELECT store_id, product_id, week_start, freq_store, freq_product "
                                           f"FROM ({ofe.level_ascoded_sql('panel')}) x"))
def q_feat_freq(spark, d):
    """Running row count per store and per product in the reference's order."""
    wk = f1_weekly(spark, d)
    out = ft.add_level_encodings_ascoded(panel_local(wk), CALENDAR, wk)
    return out.select(*PK, "freq_store", "freq_product")


@query("feat_promo", r6(with_ctes(base_ctes(), ofe.PROMO_SQL), ("discount_rate", "discount_rate_lag1")))
def q_feat_promo(spark, d):
    out = ft.add_discount_promo(f1_panel(spark, d), CALENDAR)
    return r6df(out.select(*PK, "discount_rate", "promo_flag", "discount_rate_lag1", "promo_flag_lag1"))


@query("feat_holiday", with_ctes(base_ctes() + [("hol", SQL_HOLIDAYS)], """
SELECT store_id, product_id, week_start,
       (week_start IN (SELECT holiday_date FROM hol WHERE country = 'US'))::INTEGER AS is_holiday,
       EXISTS (SELECT 1 FROM hol h WHERE h.country = 'US' AND h.holiday_date >= week_start
               AND h.holiday_date < week_start + 7)::INTEGER AS is_holiday_week,
       (week_start IN (DATE '2000-11-20', DATE '2000-11-27'))::INTEGER AS is_bf_cm_week
FROM panel"""))
def q_feat_holiday(spark, d):
    out = ft.add_holiday_features(f1_panel(spark, d), fx.holidays_table(spark), CALENDAR)
    return out.select(*PK, "is_holiday", "is_holiday_week", "is_bf_cm_week")


@query("panel_enriched", r6(with_ctes(base_ctes(), f"""
SELECT p.*, s.premise, s.store_category, s.zipcode, r.brand, r.category, r.maker
FROM panel p LEFT JOIN ({SQL_STORES}) s USING (store_id) LEFT JOIN ({SQL_PRODUCTS}) r USING (product_id)"""),
                            WEEKLY_DOUBLES))
def q_panel_enriched(spark, d):
    """Panel with store and product register attributes."""
    from weekcast.operators.panel import enrich_panel
    p = enrich_panel(f1_weekly(spark, d), fx.stores_register(spark, d), fx.products_register(spark, d), CALENDAR, fill=panel_local)
    return r6df(p)


@query("history_window", r6(with_ctes(base_ctes(), """
SELECT * FROM panel WHERE week_start >= DATE '2001-10-08' - INTERVAL 182 DAY AND week_start < DATE '2001-10-08'"""),
                            WEEKLY_DOUBLES))
def q_history_window(spark, d):
    """Training rows of the last 26 weeks before the cut-off."""
    from weekcast.operators.ml import history_window
    return r6df(history_window(f1_panel(spark, d), CALENDAR, 26))


@query("future_weeks", with_ctes(base_ctes(), """
SELECT store_id, product_id, CAST(max(week_start) + CAST(7 * i AS INTEGER) AS DATE) AS week_start, i::INTEGER AS step
FROM panel, (SELECT unnest(generate_series(1, 5)) AS i) t GROUP BY store_id, product_id, i"""))
def q_future_weeks(spark, d):
    """The 5 weeks after each pair's last week (T4)."""
    from weekcast.operators.panel import future_weeks
    last = f1_panel(spark, d).groupBy("store_id", "product_id").agg(F.max("week_start").alias("_last"))
    return last.select("store_id", "product_id", F.posexplode(future_weeks("_last", 5)).alias("_i", "week_start")) \
               .select("store_id", "product_id", "week_start", (F.col("_i") + 1).alias("step"))


@query("latest_state", r6(with_ctes(base_ctes() + ofe.pair_features_sql("panel"), """
SELECT store_id, product_id, week_start, qty, lag_qty_1, lag_qty_2, lag_qty_26, weeks_since_last_sale, zero_streak
FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY week_start DESC) AS rn FROM feat) x
WHERE rn = 1"""), ("qty", "lag_qty_1", "lag_qty_2", "lag_qty_26")))
def q_latest_state(spark, d):
    """Latest row of each pair with its features."""
    from weekcast.operators.ml import latest_rows
    cols = ["qty", "lag_qty_1", "lag_qty_2", "lag_qty_26", "weeks_since_last_sale", "zero_streak"]
    return r6df(latest_rows(f1_pair_features(spark, d), CALENDAR).select(*PK, *cols))


@query("backoff_means", r6(with_ctes(base_ctes() + [("pc", f"SELECT p.*, s.store_category FROM panel p LEFT JOIN ({SQL_STORES}) s USING (store_id)")], """
SELECT c.product_id, c.store_category, c.mean_cat, m.mean_prod, g.mean_global
FROM (SELECT product_id, store_category, avg(qty) AS mean_cat FROM pc WHERE n_tx > 0 GROUP BY 1, 2) c
JOIN (SELECT product_id, avg(qty) AS mean_prod FROM pc WHERE n_tx > 0 GROUP BY 1) m USING (product_id)
CROSS JOIN (SELECT COALESCE(avg(qty), 0) AS mean_global FROM pc WHERE n_tx > 0) g"""),
                           ("mean_cat", "mean_prod", "mean_global")))
def q_backoff_means(spark, d):
    """Observed-week means by product x store category, product and overall."""
    p = f1_panel(spark, d).join(fx.stores_register(spark, d).select("store_id", "store_category"), "store_id", "left")
    by_cat, by_prod, glob = bl.backoff_means(p, CALENDAR)
    out = by_cat.join(by_prod, "product_id").crossJoin(F.broadcast(glob))
    return r6df(out.select("product_id", "store_category", F.col("_mean_cat").alias("mean_cat"),
                           F.col("_mean_prod").alias("mean_prod"), F.col("_mean_global").alias("mean_global")))


@query("round_export", with_ctes(base_ctes(), f"""
SELECT store_id, product_id, week_start, round_even(GREATEST(pred, 0), 0)::BIGINT AS quantity
FROM ({ofc.ewma_sql('panel', '5')}) f"""))
def q_round_export(spark, d):
    """EWMA forecasts (many .5 values) rounded half-to-even to integers."""
    from weekcast.functions.scalars import export_quantity
    fc = bl.forecast(f1_panel(spark, d), "ewma")
    return fc.select("store_id", "product_id", "week_start", export_quantity("pred_ewma").alias("quantity"))


# ------------------------------------------------------------- learned model (L)
from weekcast.operators import ml  # noqa: E402
from weekcast.plans.sqlparts import SQL_SALES_DENSE  # noqa: E402


def f2_featured(spark, d, span="to_global_max"):
    """Dense fixture, panel extended to its last week, full feature set; its weekly rows, which training and forecast
    read many times, are stored."""
    from weekcast.operators.panel import panel as make_panel
    from weekcast.session import stored
    wk = stored(weekly_sales(fx.sales_dense(spark, d), CALENDAR), "weekly")
    return ft.build_features(make_panel(wk, CALENDAR, span, by=ft.history_by(wk)), fx.holidays_table(spark), CALENDAR, weekly=wk, span=span)


def _f2_feature_ctes() -> list[tuple[str, str]]:
    ctes = base_ctes(SQL_SALES_DENSE, span="span") + [("hol", SQL_HOLIDAYS)]
    ctes += ofe.pair_features_sql("panel")
    ctes += [
        ("cal", ofe.CALENDAR_SQL),
        ("promo", ofe.PROMO_SQL),
        ("lvl", ofe.level_causal_sql("panel")),
        ("allf", """
SELECT f.*, c.week, c.month, c.quarter, c.is_year_end, c.is_month_start, c.is_month_end,
       pr.discount_rate_lag1, pr.promo_flag_lag1, l.freq_store, l.avg_qty_store, l.freq_product, l.avg_qty_product,
       (f.week_start IN (SELECT holiday_date FROM hol WHERE country = 'US'))::INTEGER AS is_holiday,
       (f.week_start IN (DATE '2000-11-20', DATE '2000-11-27'))::INTEGER AS is_bf_cm_week
FROM feat f JOIN cal c USING (store_id, product_id, week_start) JOIN promo pr USING (store_id, product_id, week_start)
JOIN lvl l USING (store_id, product_id, week_start)"""),
    ]
    return ctes


def _training_matrix_sql() -> str:
    feats = ml.model_features(True)
    cols = ",\n       ".join(f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in feats)
    cut, end = "DATE '2001-10-08'", "DATE '2001-11-05'"
    w = (f"CASE WHEN week_start >= {cut} THEN 1.0 ELSE LEAST(GREATEST(exp(-GREATEST(date_diff('day', week_start, {cut}) / 7.0, 0) / 13.0), 1e-3), 1.0) END")
    sel = f"""
SELECT store_id, product_id, week_start, week_start >= {cut} AS is_valid, qty::DOUBLE AS label, {w} AS weight,
       {cols}
FROM allf
WHERE (week_start < {cut} AND week_start >= {cut} - INTERVAL 182 DAY) OR (week_start >= {cut} AND week_start < {end})"""
    return r6(with_ctes(_f2_feature_ctes(), sel), ["label", "weight"] + feats)


@query("training_matrix", _training_matrix_sql())
def q_training_matrix(spark, d):
    """Model rows of the dense fixture: 26 weeks of history, 13-week decay weights,
    causal features imputed with 0 (L1, N6, N7, X6)."""
    tm = ml.training_matrix(f2_featured(spark, d), CALENDAR, history_weeks=26, decay_weeks=13, causal=True)
    return r6df(tm)


@query("recency_weight", r6(with_ctes(base_ctes(), """
SELECT store_id, product_id, week_start,
       LEAST(GREATEST(exp(-GREATEST(date_diff('day', week_start, DATE '2001-10-08') / 7.0, 0) / 13.0), 1e-3), 1.0) AS weight
FROM panel WHERE week_start < DATE '2001-10-08' AND week_start >= DATE '2001-10-08' - INTERVAL 182 DAY"""), ("weight",)))
def q_recency_weight(spark, d):
    """exp(-weeks before cut-off / 13) clipped to [1e-3, 1] on the last 26 weeks."""
    from weekcast.functions.scalars import recency_weight
    h = ml.history_window(f1_panel(spark, d), CALENDAR, 26)
    return r6df(h.select(*PK, recency_weight("week_start", CALENDAR.cutoff, 13).alias("weight")))


def _state_step_sql() -> str:
    ext = """
SELECT * FROM panel0
UNION ALL
SELECT store_id, product_id, CAST(max(week_start) + 7 AS DATE), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0::BIGINT
FROM panel0 GROUP BY 1, 2"""
    ctes = base_ctes(SQL_SALES_DENSE, span="span")
    ctes = ctes[:-1] + [("panel0", ctes[-1][1]), ("panel", ext)] + ofe.pair_features_sql("panel")
    cols = ["lag_qty_1", "lag_qty_2", "lag_qty_3", "lag_qty_4", "lag_qty_8", "lag_qty_12", "lag_qty_26",
            "ma_qty_4", "ma_qty_12", "std_qty_4", "std_qty_12", "diff_qty_1", "ratio_qty_12",
            "active_share_8", "active_share_13", "active_share_26",
            "weeks_since_prev_sale", "weeks_since_first_sale", "zero_streak"]
    sel = f"""
SELECT store_id, product_id, week_start, {', '.join(cols)}
FROM (SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY week_start DESC) AS rn FROM feat) x
WHERE rn = 1"""
    dbl = [c for c in cols if not c.startswith(("weeks_", "zero_"))]
    return r6(with_ctes(ctes, sel), dbl)


STATE_STEP_COLS = ["lag_qty_1", "lag_qty_2", "lag_qty_3", "lag_qty_4", "lag_qty_8", "lag_qty_12", "lag_qty_26",
                   "ma_qty_4", "ma_qty_12", "std_qty_4", "std_qty_12", "diff_qty_1", "ratio_qty_12",
                   "active_share_8", "active_share_13", "active_share_26",
                   "weeks_since_prev_sale", "weeks_since_first_sale", "zero_streak"]


@query("ml_state_step", _state_step_sql())
def q_ml_state_step(spark, d):
    """Features of the first forecast week rebuilt from the per-pair state (arrays,
    counters) must equal the training windows evaluated one week past the
    history (L4 state rebuild, traps R13, R14, R21)."""
    return _state_step(f2_featured(spark, d))


@query("ml_state_step_local", _state_step_sql())
def q_ml_state_step_local(spark, d):
    """The same state from the local panel, whose pairs end with their last sale: zero weeks are put in (trap R16)."""
    return _state_step(f2_featured(spark, d, "local"))


def _state_step(featured):
    feats = ml.model_features(True)
    x = ml.step_features(ml.forecast_state(featured, feats, CALENDAR), F.date_add("last_week", 7), CALENDAR, feats)
    return r6df(x.select(*PK, *STATE_STEP_COLS))


def _trained(spark, d, two_stage: bool, featured: DataFrame | None = None):
    """Rounds at a rate of 0.1, ended five rounds after the best one."""
    return ml.train(f2_featured(spark, d) if featured is None else featured, CALENDAR, two_stage=two_stage, tau=0.1, history_weeks=26, decay_weeks=13, learning_rate=0.1, patience=5)


def _fitted(spark, art):
    """Rows of the fit; validation scores that are numbers of 0 or more; those that a walk of the model's node table in SQL gives too;
    and whether the training loss fell in the first rounds of each model."""
    from weekcast.operators.boosting import depth, score_sql
    y, models = F.col("y_pred"), [art[k] for k in ("model", "clf", "reg") if k in art]
    valid = art["valid"].select(*PK, "y_pred", *art["features"]).checkpoint()
    walked = valid.select(*PK, "y_pred")
    for k, m in enumerate(models):
        if m.trees:
            sql = score_sql("{rows}", PK, m.features, "{nodes}", m.start, max(map(depth, m.trees)))
            walked = walked.join(spark.sql(sql, rows=valid, nodes=m.node_table(spark)).withColumnRenamed("raw", f"raw_{k}"), PK)
        else:
            walked = walked.withColumn(f"raw_{k}", F.lit(m.start))
    if len(models) == 1:
        again = F.exp("raw_0")
    else:
        again = F.when(1 / (1 + F.exp(-F.col("raw_0"))) >= art["tau"], F.exp("raw_1")).otherwise(0.0)
    sound = F.coalesce(~F.isnan(y) & (y >= 0) & (y < F.lit(float("inf"))), F.lit(False))
    falls = all(len(m.history) > 2 and m.history[2]["loss"] < m.history[1]["loss"] < m.history[0]["loss"] for m in models)
    return walked.agg(F.lit(art["rows_train"]).cast("long").alias("rows_train"), F.count(F.lit(1)).alias("rows_valid"),
                      F.count_if(sound).alias("sound_scores"), F.count_if(F.abs(again - y) <= 1e-9 * (1 + y)).alias("walked_scores"),
                      F.lit(falls).alias("loss_falls"))


_MODEL_ROWS = """
SELECT count(*) FILTER (week_start < DATE '2001-10-08' AND week_start >= DATE '2001-10-08' - INTERVAL 182 DAY) AS rows_train,
       count(*) FILTER (week_start >= DATE '2001-10-08' AND week_start < DATE '2001-11-05') AS rows_valid,
       count(*) FILTER (week_start >= DATE '2001-10-08' AND week_start < DATE '2001-11-05') AS sound_scores FROM panel"""
_MODEL_SQL = with_ctes(base_ctes(SQL_SALES_DENSE, span="span"), "SELECT *, rows_valid AS walked_scores, TRUE AS loss_falls FROM (" + _MODEL_ROWS + ") m")


@query("ml_regressor", _MODEL_SQL)
def q_ml_regressor(spark, d):
    """Poisson boosting: rows it was fitted and scored on, scores checked against its node table, falling loss."""
    return _fitted(spark, _trained(spark, d, False))


@query("ml_regressor_scores")
def q_ml_regressor_scores(spark, d):
    """Validation rows with the Poisson model's score, and its WMAPE."""
    return _scores(_trained(spark, d, False))


@query("ml_two_stage_scores")
def q_ml_two_stage_scores(spark, d):
    """Validation rows with the two-stage model's score, and its WMAPE."""
    return _scores(_trained(spark, d, True))


def _scores(art):
    return art["valid"].select(*PK, "label", F.round("y_pred", 6).alias("y_pred"), F.round(F.lit(art["wmape"]).cast("double"), 6).alias("wmape"))


@query("ml_two_stage", _MODEL_SQL)
def q_ml_two_stage(spark, d):
    """Classifier and positive-only regressor, threshold 0.1, checked as ``ml_regressor`` (L3)."""
    return _fitted(spark, _trained(spark, d, True))


@query("ml_forecast", with_ctes(base_ctes(SQL_SALES_DENSE, span="span"), """
SELECT i::BIGINT AS week_no, store_id, product_id, TRUE AS is_count
FROM (SELECT DISTINCT store_id, product_id FROM panel
      WHERE week_start >= DATE '2001-11-05' - INTERVAL 21 DAY AND week_start < DATE '2001-11-05' AND qty > 0) a,
     (SELECT unnest(generate_series(1, 5)) AS i) t"""))
def q_ml_forecast(spark, d):
    """Recursive 5-week learned forecast for the pairs active in the last 3 weeks: every pair and week, none below 0 (L4)."""
    out = _learned_forecast(spark, d)
    return out.select("week_no", "store_id", "product_id", (F.col("quantity") >= 0).alias("is_count"))


@query("ml_forecast_quantities")
def q_ml_forecast_quantities(spark, d):
    """The quantities of the learned forecast (L4)."""
    return _learned_forecast(spark, d)


def _learned_forecast(spark, d):
    """Trained and forecast from the same featured panel, so the sales are read once; the states that the forecast starts
    from are made while the model is trained."""
    featured = f2_featured(spark, d)
    pairs = dict(only_active=True, active_window=3)
    with ml.wide_plan(spark):
        art, state = ml.together(spark, lambda: _trained(spark, d, True, featured),
                                 lambda: ml.starting_state(featured, ml.model_features(True), CALENDAR, **pairs))
    return ml.forecast_ml(featured, art, CALENDAR, fx.holidays_table(spark), **pairs, state=state)


@query("ml_save_load", with_ctes(base_ctes(SQL_SALES_DENSE, span="span"),
                                 "SELECT rows_valid AS rows, sound_scores AS equal_scores FROM (" + _MODEL_ROWS + ") m"))
def q_ml_save_load(spark, d):
    """Model saved with Spark ML persistence and loaded back scores the same."""
    from weekcast.session import shared_dir
    art = _trained(spark, d, False)
    path = shared_dir(spark, "model")
    ml.save_artefact(spark, art, path)
    back = ml.load_artefact(spark, path)
    valid = art["valid"].drop("y_pred")
    a = ml.predict_quantity(art["model"], valid, "y_saved").select(*PK, "y_saved")
    b = ml.predict_quantity(back["model"], valid, "y_loaded").select(*PK, "y_loaded")
    return a.join(b, PK).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("y_saved") == F.col("y_loaded")).alias("equal_scores"))


# ------------------------------------------------------------- round trips
def _roundtrip(spark, d, fmt):
    from weekcast.session import shared_dir
    from weekcast.sources.sinks import read_forecast, write_forecast
    path = shared_dir(spark, f"forecast-{fmt}")
    write_forecast(forecast_month(f1_panel(spark, d), "smart", CALENDAR), path, fmt)
    return read_forecast(spark, path, fmt)


@query("roundtrip_parquet", _month_sql(False))
def q_roundtrip_parquet(spark, d):
    """Delivery forecast written as snappy parquet and read back."""
    return _roundtrip(spark, d, "parquet")


@query("roundtrip_csv", _month_sql(False))
def q_roundtrip_csv(spark, d):
    """Delivery forecast written as ';' CSV without header and read back (S3)."""
    return _roundtrip(spark, d, "csv")


@query("future_calendar", with_ctes(base_ctes() + [("hol", SQL_HOLIDAYS)], """
SELECT p.store_id, p.product_id, w.week_start, weekofyear(w.week_start)::INTEGER AS week,
       month(w.week_start)::INTEGER AS month, quarter(w.week_start)::INTEGER AS quarter,
       (w.week_start IN (SELECT holiday_date FROM hol))::INTEGER AS is_holiday
FROM (SELECT DISTINCT store_id, product_id FROM panel) p
CROSS JOIN (SELECT CAST(DATE '2001-11-05' + CAST(7 * i AS INTEGER) AS DATE) AS week_start
            FROM (SELECT unnest(generate_series(0, 4)) AS i) t) w"""))
def q_future_calendar(spark, d):
    """Every pair x the 5 target weeks with their calendar and holiday flags.
    The weeks are generated per pair (``posexplode`` of a 5-element sequence);
    holiday flags come from an equi-join with the small holiday table."""
    from weekcast.operators.panel import future_weeks
    pairs = f1_panel(spark, d).select("store_id", "product_id").distinct()
    start = F.date_sub(F.lit(CALENDAR.target_start), 7)          # future_weeks starts one week later
    rows = pairs.select("store_id", "product_id", F.explode(future_weeks(start, 5)).alias("week_start"))
    rows = ft.add_holiday_features(rows, fx.holidays_table(spark), CALENDAR)
    cc = calendar_columns("week_start")
    return rows.select("store_id", "product_id", "week_start", cc["week"].alias("week"), cc["month"].alias("month"),
                       cc["quarter"].alias("quarter"), "is_holiday")


_PREPARE_DOUBLES = [*WEEKLY_DOUBLES, *_LAGS, "ma_qty_4", "ma_qty_12", "std_qty_4", "std_qty_12", "diff_qty_1", "ratio_qty_12", "price_u",
                    "price_u_ma8", "active_share_8", "active_share_13", "active_share_26", "avg_qty_store", "avg_qty_product",
                    "discount_rate", "discount_rate_lag1"]
_PREPARE_OTHERS = ["n_tx", "weeks_since_last_sale", "weeks_since_prev_sale", "weeks_since_first_sale", "zero_streak", "n_tx_lag1"]


def _prepare_sql() -> str:
    ctes = base_ctes() + [("hol", SQL_HOLIDAYS)] + ofe.pair_features_sql("panel") + [
        ("cal", ofe.CALENDAR_SQL), ("promo", ofe.PROMO_SQL), ("lvl", ofe.level_causal_sql("panel"))]
    own = [c for c in _PREPARE_DOUBLES if c not in ("avg_qty_store", "avg_qty_product", "discount_rate", "discount_rate_lag1")]
    sel = f"""
SELECT f.store_id, f.product_id, f.week_start, {", ".join("f." + c for c in [*own, *_PREPARE_OTHERS])},
       s.premise, s.store_category, s.zipcode, r.brand, r.category, r.maker,
       c.week, c.month, c.quarter, c.year, c.is_year_end, c.is_month_start, c.is_month_end,
       l.freq_store, l.avg_qty_store, l.freq_product, l.avg_qty_product,
       pr.discount_rate, pr.promo_flag, pr.discount_rate_lag1, pr.promo_flag_lag1,
       (f.week_start IN (SELECT holiday_date FROM hol))::INTEGER AS is_holiday,
       (f.week_start IN (SELECT holiday_date - (isodow(holiday_date) - 1)::INTEGER FROM hol))::INTEGER AS is_holiday_week,
       (f.week_start IN (DATE '2000-11-20', DATE '2000-11-27'))::INTEGER AS is_bf_cm_week
FROM feat f JOIN cal c USING (store_id, product_id, week_start) JOIN promo pr USING (store_id, product_id, week_start)
JOIN lvl l USING (store_id, product_id, week_start) LEFT JOIN ({SQL_STORES}) s USING (store_id)
LEFT JOIN ({SQL_PRODUCTS}) r USING (product_id)"""
    return r6(with_ctes(ctes, sel), _PREPARE_DOUBLES)


@query("prepare_features", _prepare_sql())
def q_prepare_features(spark, d):
    """The whole prepare step on the consolidated sales: weekly aggregate,
    local panel, register attributes, every feature (U1)."""
    from weekcast.plans.pipeline import prepare
    return r6df(prepare(fx.consolidated_clean(spark, d), CALENDAR, holidays=fx.holidays_table(spark),
                        products=fx.products_register(spark, d)))


_U6_COLS = ["qty", "n_tx", "premise", "store_category", "brand", "category", "week", "month", "is_year_end",
            "lag_qty_1", "lag_qty_4", "lag_qty_8", "lag_qty_12", "lag_qty_26", "ma_qty_4", "ma_qty_12"]


def _u6_sql() -> str:
    ctes = [("sales", _CLEAN_SALES_SQL), ("weekly", weekly_sql("sales")), ("panel", panel_grid_sql("weekly"))]
    ctes += ofe.pair_features_sql("panel")
    sel = f"""
SELECT f.store_id, f.product_id, f.week_start, f.qty, f.n_tx, s.premise, s.store_category, r.brand, r.category,
       weekofyear(f.week_start)::INTEGER AS week, month(f.week_start)::INTEGER AS month,
       (weekofyear(f.week_start) >= 51)::INTEGER AS is_year_end,
       f.lag_qty_1, f.lag_qty_4, f.lag_qty_8, f.lag_qty_12, f.lag_qty_26, f.ma_qty_4, f.ma_qty_12
FROM feat f LEFT JOIN ({SQL_STORES}) s USING (store_id) LEFT JOIN ({SQL_PRODUCTS}) r USING (product_id)"""
    return r6(with_ctes(ctes, sel), ["qty", "lag_qty_1", "lag_qty_4", "lag_qty_8", "lag_qty_12", "lag_qty_26",
                                     "ma_qty_4", "ma_qty_12"])


@query("prepare_registers", _u6_sql())
def q_prepare_registers(spark, d):
    """Register-based prepare (U6): dirty text sales -> names and types -> year
    filter -> subset dedup -> weekly aggregate -> store and product registers ->
    full grid panel -> calendar and lag features."""
    from weekcast.plans.pipeline import prepare
    out = prepare(fx.sales_dirty(spark, d), CALENDAR, stores=fx.stores_register(spark, d),
                  products=fx.products_register(spark, d), span="grid", dedup_subset=DEDUP_SUBSET,
                  date_range=(YEAR_START, YEAR_END))
    return r6df(out.select(*PK, *_U6_COLS))


@query("roundtrip_eval_csv", r6(with_ctes(_ctes, f"SELECT week_start, store_id, product_id, y_true, y_pred, abs_err FROM ({_rows}) e"),
                                ("y_true", "y_pred", "abs_err")))
def q_roundtrip_eval_csv(spark, d):
    """Back-test rows written as the diagnostic CSV (';', header) and read back."""
    from weekcast.session import shared_dir
    from weekcast.sources.sinks import write_eval_csv
    path = shared_dir(spark, "eval-csv")
    write_eval_csv(eval_rows(f1_panel(spark, d), "smart", CALENDAR, gapless=True), path)
    schema = "week_start date, store_id long, product_id long, y_true double, y_pred double, abs_err double"
    return r6df(spark.read.schema(schema).option("sep", ";").option("header", True).csv(path))
