"""Level history from sparse rows, prefix sums without a hot key, distinct sketches, panel files by size."""
import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from weekcast.config import DEFAULT
from weekcast.operators import features as ft, quality as qa
from weekcast.operators.panel import panel
from weekcast.session import shared_dir
from weekcast.sources.sinks import write_panel

W0 = dt.date(2022, 1, 3)
COLS = ["freq_store", "avg_qty_store", "freq_product", "avg_qty_product"]


def weekly(spark, rows):
    return spark.createDataFrame([(s, p, W0 + dt.timedelta(days=7 * k), float(q)) for s, p, k, q in rows],
                                 "store_id long, product_id long, week_start date, qty double")


SPARSE = [(1, 1, 0, 2), (1, 1, 5, 4), (1, 2, 3, 6), (1, 3, 9, 1), (1, 3, 11, 8), (2, 1, 1, 5), (2, 1, 2, 7), (2, 2, 7, 3), (3, 3, 4, 0)]


def rows(df):
    return {(r.store_id, r.product_id, r.week_start): [r[c] for c in COLS] for r in df.collect()}


@pytest.mark.parametrize("span", ["local", "to_global_max"])
def test_sparse_history_equals_that_of_the_panel(spark, span):
    """Gaps without any row of a level (store 1, weeks 6 to 8) included."""
    wk = weekly(spark, SPARSE)
    pn = panel(wk, DEFAULT, span)
    got, want = rows(ft.add_level_encodings(pn, DEFAULT, wk, span)), rows(ft.add_level_encodings(pn, DEFAULT))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k]), k


def test_ascoded_history_equals_plain_loops(spark):
    wk = weekly(spark, SPARSE)
    pn = panel(wk, DEFAULT, "local")
    flat = [(r.store_id, r.product_id, r.week_start, r.qty) for r in pn.collect()]
    for got in (rows(ft.add_level_encodings_ascoded(pn, DEFAULT, wk)), rows(ft.add_level_encodings_ascoded(pn, DEFAULT))):
        for s, p, w, _ in flat:
            st = [q for a, b, c, q in flat if a == s and (b, c) < (p, w)]
            pr = [q for a, b, c, q in flat if b == p and (a, c) < (s, w)]
            want = [len(st), sum(st) / len(st) if st else None, len(pr), sum(pr) / len(pr) if pr else None]
            assert got[(s, p, w)] == pytest.approx(want), (s, p, w)


def test_empty_history(spark):
    wk = weekly(spark, [(1, 1, 0, 1)]).where("qty > 5")
    pn = panel(wk, DEFAULT, "local")
    assert ft.add_level_encodings(pn, DEFAULT, wk).count() == 0
    assert ft.add_level_encodings_ascoded(pn, DEFAULT, wk).count() == 0


def test_one_store_with_all_pairs_spreads(spark):
    """The largest part of a prefix sum is a block, not the store; its sums are exact."""
    n, blocks = 20_000, 64
    totals = spark.range(n).select((F.col("id") % 1 + 1).alias("store_id"), (F.col("id") * 7).alias("product_id"), F.lit(1).cast("long").alias("_tc"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = ft.level_prefix(totals, "store_id", "product_id", {"_tc": "before"}, blocks)
        plan = out._jdf.queryExecution().executedPlan().toString()
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert out.where(F.col("before") != F.col("product_id") / 7).count() == 0 and out.count() == n
    assert re.search(r"hashpartitioning\(store_id#\d+L, _block", plan)
    assert len(sizes) >= 4 and max(sizes) < n / 2


def test_panel_is_exploded_once(spark):
    """Only the panel itself is written out by pair; the other two explosions write level x week rows."""
    wk = weekly(spark, SPARSE)

    def explosions(df):
        lines = [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Generate posexplode" in line]
        return len(lines), sum("_rows" in line or "_k" in line for line in lines)

    pn = panel(wk, DEFAULT, "local")
    assert explosions(ft.add_level_encodings(pn, DEFAULT, wk)) == (3, 2)
    assert explosions(ft.add_level_encodings(pn, DEFAULT))[1] == 0


def test_sketches_merge_within_the_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 20_011).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("b"),
                                    F.lit(None).cast("string").alias("c"), (F.col("id") % 12).alias("part"))
    sk = qa.distinct_sketches(df, ["part"], ["a", "b", "c"])
    assert sk.count() == 12
    r = qa.distinct_estimates(sk, ["a", "b", "c"]).first()
    assert r["rows"] == 60_000 and abs(r.approx_a - 20_011) <= 20_011 * qa.sketch_error() and r.approx_b == 25 and r.approx_c == 0
    empty = qa.distinct_estimates(qa.distinct_sketches(df.limit(0), ["part"], ["a"]), ["a"]).first()
    assert empty["rows"] == 0 and empty.approx_a == 0


def test_panel_files_follow_the_size_of_a_month(spark):
    """A month 200 times larger gets more files, a small one exactly one."""
    df = spark.range(201_000).select((F.col("id") % 97).alias("store_id"), F.xxhash64("id").alias("product_id"),
                                     F.when(F.col("id") < 1_000, F.lit("2022-01-03")).otherwise(F.lit("2022-02-07")).cast("date").alias("week_start"))
    path, key = shared_dir(spark, "panel-by-size"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        write_panel(df, path)
    finally:
        spark.conf.set(key, before)
    files = {m: len(glob.glob(f"{path.removeprefix('file:')}/p_year=2022/p_month={m}/*.parquet")) for m in (1, 2)}
    assert files[1] == 1 and 2 <= files[2] <= 64
    assert spark.read.parquet(path).count() == 201_000
