"""Fixture mappings over the driver tables (FIXTURES.md).

Each fixture has a DataFrame builder (what our queries read) and the same
mapping as SQL text (what the DuckDB oracle reads), kept side by side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from weekcast.config import ForecastConfig
from weekcast.sources.readers import read_table

# Fixed values of the fixture calendar (FIXTURES.md §2 and §5).
F3_START, F3_END = dt.date(2000, 1, 1), dt.date(2000, 12, 31)  # the year that F1 and U6 keep of the dirty sales
EVENT_WEEKS = (dt.date(2000, 11, 20), dt.date(2000, 11, 27))
# US federal holidays (with observed days) of 2000 and 2001.
US_HOLIDAYS = (
    "2000-01-01", "2000-01-17", "2000-02-21", "2000-05-29", "2000-07-04", "2000-09-04",
    "2000-10-09", "2000-11-10", "2000-11-11", "2000-11-23", "2000-12-25",
    "2001-01-01", "2001-01-15", "2001-02-19", "2001-05-28", "2001-07-04", "2001-09-03",
    "2001-10-08", "2001-11-11", "2001-11-12", "2001-11-22", "2001-12-25",
)
# The sales end on 2001-11-04: the last four weeks validate, the five weeks after them are forecast.
CALENDAR = ForecastConfig(cutoff=dt.date(2001, 10, 8), valid_end=dt.date(2001, 11, 5), target_start=dt.date(2001, 11, 5),
                          target_end=dt.date(2001, 12, 10), event_weeks=EVENT_WEEKS)
ORPHAN_STORE_DIGIT = 3  # register keeps s_suppkey % 10 <> 3 for orphan tests


def _measures(qty_col, price, disc, tax) -> dict:
    net = price * (1 - disc)
    return {
        "quantity": qty_col,
        "gross_value": price,
        "net_value": net,
        "gross_profit": net * F.lit(0.3),
        "discount": price * disc,
        "taxes": net * tax,
    }


def _signed_quantity(li) -> F.Column:
    return F.when((li.l_returnflag == "R") & (li.l_linenumber == 1), -li.l_quantity).otherwise(li.l_quantity)


def _brand_id(col) -> F.Column:
    return F.expr(f"try_cast(substr({col}, 7) AS BIGINT)")


def sales_clean(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
                end: dt.date | None = None) -> DataFrame:
    """all sales, store = supplier, product = brand.

    A date range, where one is asked for, is written on the raw timestamp so it
    reaches the parquet scan as a pushed filter.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                  "l_extendedprice", "l_discount", "l_tax",
                                                  "l_returnflag", "l_shipdate"])
    # timestamp_ntz literals: independent of the session time zone
    if start is not None:
        li = li.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        li = li.where(F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz"))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    j = li.join(part, li.l_partkey == part.p_partkey)
    cols = {"store_id": F.col("l_suppkey").cast("long"), "product_id": _brand_id("p_brand"),
            "txn_date": F.col("l_shipdate").cast("date")}
    cols.update(_measures(_signed_quantity(li), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")))
    return j.select(*[v.alias(k) for k, v in cols.items()])


def sales_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all years, store = customer nation, product = brand.  Orders meet their customers first, so the lines are
    shuffled for two joins, not three."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                  "l_extendedprice", "l_discount", "l_tax",
                                                  "l_returnflag", "l_shipdate"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    nation = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "c_nationkey")
    j = (li.join(nation, li.l_orderkey == nation.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey))
    cols = {"store_id": F.col("c_nationkey").cast("long"), "product_id": _brand_id("p_brand"),
            "txn_date": F.col("l_shipdate").cast("date")}
    cols.update(_measures(_signed_quantity(li), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")))
    return j.select(*[v.alias(k) for k, v in cols.items()])


DIRTY_HEADER = "Internal_Store_Id "


def sales_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 columns as raw text with damage, all dates, duplicated rows.

    Columns carry the reference's raw names; the store id header is damaged
    (case and a trailing space) to exercise name standardisation.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                  "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                                  "l_returnflag", "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    j = li.join(part, li.l_partkey == part.p_partkey)
    m = _measures(_signed_quantity(li), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"))
    ok = F.col("l_orderkey")
    raw = j.select(
        ok.alias("_ok"),
        F.when(ok % 97 == 0, F.lit("n/a")).otherwise(F.col("l_suppkey").cast("string")).alias("internal_store_id"),
        F.substring("p_brand", 7, 16).alias("internal_product_id"),
        F.when(ok % 89 == 0, F.lit("not a date")).otherwise(F.col("l_shipdate").cast("date").cast("string"))
         .alias("transaction_date"),
        F.when(ok % 83 == 0, F.lit("x")).otherwise(m["quantity"].cast("string")).alias("quantity"),
        *[m[c].cast("string").alias(c) for c in ("gross_value", "net_value", "gross_profit", "discount", "taxes")],
    )
    dirty = raw.unionByName(raw.where(F.col("_ok") % 10 == 1)).drop("_ok")
    return dirty.withColumnRenamed("internal_store_id", DIRTY_HEADER)


def stores_register(spark: SparkSession, sf_dir: str, with_orphans: bool = False) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"])
    if with_orphans:
        s = s.where(F.col("s_suppkey") % 10 != ORPHAN_STORE_DIGIT)
    return s.select(
        F.col("s_suppkey").cast("long").alias("store_id"),
        F.when(F.col("s_acctbal") > 0, F.lit("On")).otherwise(F.lit("Off")).alias("premise"),
        F.concat(F.lit("cat"), (F.col("s_nationkey") % 5).cast("string")).alias("store_category"),
        F.col("s_nationkey").cast("string").alias("zipcode"),
    )


def products_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_brand", "p_type"])
    return (p.groupBy("p_brand").agg(F.min("p_type").alias("category"))
             .select(_brand_id("p_brand").alias("product_id"), F.col("p_brand").alias("brand"), "category")
             .withColumn("maker", F.concat(F.lit("M"), (F.col("product_id") % 5).cast("string"))))


def holidays_table(spark: SparkSession, country: str = "US") -> DataFrame:
    """Holiday dimension (country, holiday_date) — a fixed literal table."""
    rows = [(country, dt.date.fromisoformat(d)) for d in US_HOLIDAYS] if country.upper() == "US" else []
    return spark.createDataFrame(rows, "country string, holiday_date date")


def consolidated_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 sales joined to the store register (the reference's consolidated set)."""
    return sales_clean(spark, sf_dir).join(stores_register(spark, sf_dir), "store_id")


# ---------------------------------------------------------------- SQL text
SQL_MEASURES = """
       CASE WHEN l_returnflag='R' AND l_linenumber=1 THEN -l_quantity ELSE l_quantity END AS quantity,
       l_extendedprice AS gross_value, l_extendedprice*(1-l_discount) AS net_value,
       l_extendedprice*(1-l_discount)*0.3 AS gross_profit, l_extendedprice*l_discount AS discount,
       l_extendedprice*(1-l_discount)*l_tax AS taxes"""

SQL_SALES_CLEAN = f"""
SELECT l_suppkey AS store_id, CAST(substr(p_brand,7) AS BIGINT) AS product_id, CAST(l_shipdate AS DATE) AS txn_date,
{SQL_MEASURES}
FROM lineitem JOIN part ON l_partkey=p_partkey
"""

SQL_SALES_DENSE = f"""
SELECT CAST(c_nationkey AS BIGINT) AS store_id, CAST(substr(p_brand,7) AS BIGINT) AS product_id,
       CAST(l_shipdate AS DATE) AS txn_date,
{SQL_MEASURES}
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
     JOIN part ON l_partkey=p_partkey
"""

SQL_SALES_DIRTY_RAW = f"""
SELECT l_orderkey AS _ok,
       CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(l_suppkey AS VARCHAR) END AS internal_store_id,
       substr(p_brand, 7) AS internal_product_id,
       CASE WHEN l_orderkey % 89 = 0 THEN 'not a date' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS transaction_date,
       CASE WHEN l_orderkey % 83 = 0 THEN 'x'
            ELSE CAST(CASE WHEN l_returnflag='R' AND l_linenumber=1 THEN -l_quantity ELSE l_quantity END AS VARCHAR) END AS quantity,
       CAST(l_extendedprice AS VARCHAR) AS gross_value,
       CAST(l_extendedprice*(1-l_discount) AS VARCHAR) AS net_value,
       CAST(l_extendedprice*(1-l_discount)*0.3 AS VARCHAR) AS gross_profit,
       CAST(l_extendedprice*l_discount AS VARCHAR) AS discount,
       CAST(l_extendedprice*(1-l_discount)*l_tax AS VARCHAR) AS taxes
FROM lineitem JOIN part ON l_partkey=p_partkey
"""

SQL_SALES_DIRTY = f"""
SELECT * EXCLUDE (_ok) FROM (
  SELECT * FROM ({SQL_SALES_DIRTY_RAW}) r
  UNION ALL
  SELECT * FROM ({SQL_SALES_DIRTY_RAW}) r WHERE _ok % 10 = 1)
"""

# Dirty rows after name clean-up and type coercion (N1-N4 in SQL).
SQL_SALES_DIRTY_TYPED = f"""
SELECT TRY_CAST(trim(internal_store_id) AS BIGINT) AS store_id,
       TRY_CAST(trim(internal_product_id) AS BIGINT) AS product_id,
       TRY_CAST(trim(transaction_date) AS DATE) AS txn_date,
       TRY_CAST(trim(quantity) AS DOUBLE) AS quantity,
       TRY_CAST(trim(gross_value) AS DOUBLE) AS gross_value,
       TRY_CAST(trim(net_value) AS DOUBLE) AS net_value,
       TRY_CAST(trim(gross_profit) AS DOUBLE) AS gross_profit,
       TRY_CAST(trim(discount) AS DOUBLE) AS discount,
       TRY_CAST(trim(taxes) AS DOUBLE) AS taxes
FROM ({SQL_SALES_DIRTY}) d
"""

SQL_STORES = """
SELECT s_suppkey AS store_id, CASE WHEN s_acctbal > 0 THEN 'On' ELSE 'Off' END AS premise,
       CONCAT('cat', CAST(s_nationkey % 5 AS VARCHAR)) AS store_category, CAST(s_nationkey AS VARCHAR) AS zipcode
FROM supplier
"""

SQL_STORES_ORPHANS = SQL_STORES + " WHERE s_suppkey % 10 <> 3"

SQL_PRODUCTS = """
SELECT CAST(substr(p_brand,7) AS BIGINT) AS product_id, p_brand AS brand, min(p_type) AS category,
       CONCAT('M', CAST(CAST(substr(p_brand,7) AS BIGINT) % 5 AS VARCHAR)) AS maker
FROM part GROUP BY p_brand
"""

SQL_HOLIDAYS = "SELECT * FROM (VALUES " + ", ".join(
    f"('US', DATE '{d}')" for d in US_HOLIDAYS) + ") t(country, holiday_date)"
