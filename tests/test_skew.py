"""A third of all sales on one store: results stay exact and the panel stays
balanced across partitions (the hot store spreads over its pairs)."""
import duckdb
import pytest
from pyspark.sql import functions as F

from weekcast.config import DEFAULT
from weekcast.operators.baselines import forecast
from weekcast.operators.panel import panel_local
from weekcast.operators.weekly import weekly_sales
from weekcast.sources.fixtures import sales_clean

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def skewed(spark):
    s = sales_clean(spark, SF)
    hot = F.xxhash64("store_id", "product_id", "txn_date", "gross_value") % 3 == 0
    return s.withColumn("store_id", F.when(hot, F.lit(1).cast("long")).otherwise(F.col("store_id")))


def test_hot_store_is_a_third(skewed):
    share = skewed.agg(F.avg((F.col("store_id") == 1).cast("double"))).first()[0]
    assert 0.3 < share < 0.4


def test_exact_under_skew(spark, skewed):
    wk = weekly_sales(skewed)
    got = {(r.store_id, r.product_id, r.week_start): (r.qty, r.n_tx) for r in wk.collect()}
    pdf = skewed.toPandas()
    con = duckdb.connect()
    con.register("s", pdf)
    want = con.execute("""
        SELECT store_id, product_id, CAST(txn_date - CAST((isodow(txn_date) + 6) % 7 AS INTEGER) AS DATE) AS w,
               sum(GREATEST(quantity, 0)) AS q, count(*) AS n FROM s GROUP BY 1, 2, 3""").fetchall()
    assert len(got) == len(want)
    for st, pr, w, q, n in want:
        assert got[(st, pr, w)] == (q, n)
    fc = forecast(panel_local(wk), "smart")
    assert fc.count() == wk.select("store_id", "product_id").distinct().count() * DEFAULT.horizon


def test_panel_partitions_stay_balanced(spark, skewed):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = panel_local(weekly_sales(skewed))
        sizes = [r.n for r in p.groupBy(F.spark_partition_id().alias("pid")).agg(F.count("*").alias("n")).collect()]
        hot_rows = p.where("store_id = 1").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total = sum(sizes)
    assert len(sizes) >= 4
    assert max(sizes) < 2.0 * total / len(sizes)        # no partition holds the hot store
    # a third of the transactions becomes at most products x weeks panel rows
    assert hot_rows <= 25 * 358 and hot_rows < 0.05 * total
