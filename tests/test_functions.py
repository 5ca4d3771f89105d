import datetime as dt
import math


from weekcast.functions.dates import calendar_columns, week_start
from weekcast.functions.scalars import discount_promo, export_id, export_quantity, recency_weight, returns_split

D = dt.date


def test_week_anchor_mon_and_tue(spark):
    # Sun 2022-12-04, Mon 2022-12-05, Tue 2022-12-06
    df = spark.createDataFrame([(D(2022, 12, 4),), (D(2022, 12, 5),), (D(2022, 12, 6),)], "d date")
    got = df.select("d", week_start("d", "MON").alias("mon"), week_start("d", "TUE").alias("tue")).collect()
    m = {r.d: (r.mon, r.tue) for r in got}
    assert m[D(2022, 12, 4)] == (D(2022, 11, 28), D(2022, 11, 29))
    assert m[D(2022, 12, 5)] == (D(2022, 12, 5), D(2022, 11, 29))   # W-MON period start is Tuesday (R1)
    assert m[D(2022, 12, 6)] == (D(2022, 12, 5), D(2022, 12, 6))


def test_week_start_accepts_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 12, 7, 23, 59),)], "t timestamp_ntz")
    assert df.select(week_start("t").alias("w")).first().w == D(2022, 12, 5)


def test_returns_split_and_nulls(spark):
    df = spark.createDataFrame([(-3.0,), (5.0,), (None,)], "q double")
    rs = returns_split("q")
    got = df.select("q", rs["quantity_pos"].alias("p"), rs["quantity_return"].alias("r")).collect()
    assert {(r.q, r.p, r.r) for r in got} == {(-3.0, 0.0, 3.0), (5.0, 5.0, 0.0), (None, 0.0, 0.0)}


def test_discount_rate_zero_gross_and_clip(spark):
    df = spark.createDataFrame([(0.0, 5.0), (100.0, 4.0), (100.0, 150.0), (100.0, -1.0)], "g double, d double")
    dp = discount_promo("d", "g")
    got = [(r.rate, r.flag) for r in df.select(dp["discount_rate"].alias("rate"), dp["promo_flag"].alias("flag")).collect()]
    assert got == [(0.0, 0), (0.04, 0), (1.0, 1), (0.0, 0)]


def test_export_rint_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.7,), (None,)], "x double")
    got = [r.q for r in df.select(export_quantity("x").alias("q")).collect()]
    assert got == [0, 2, 2, 0, 0]


def test_export_id_19_digits_and_bad(spark):
    df = spark.createDataFrame([("1234567890123456789",), ("n/a",), (None,)], "s string")
    got = [r.i for r in df.select(export_id("s").alias("i")).collect()]
    assert got == [1234567890123456789, 0, 0]


def test_calendar_flags(spark):
    df = spark.createDataFrame([(D(2022, 12, 26),), (D(2023, 1, 2),), (D(2022, 11, 30),), (D(2022, 8, 1),)], "w date")
    got = df.select(*[v.alias(k) for k, v in calendar_columns("w").items()]).collect()
    assert (got[0].week, got[0].is_year_end) == (52, 1)
    assert (got[1].week, got[1].year, got[1].is_year_end) == (1, 2023, 0)
    assert got[2].is_month_end == 1 and got[3].is_month_start == 1 and got[3].quarter == 3


def test_recency_weight_clips(spark):
    df = spark.createDataFrame([(D(2022, 12, 5),), (D(2022, 11, 28),), (D(2000, 1, 3),), (D(2023, 1, 2),)], "w date")
    got = [round(r.x, 6) for r in df.select(recency_weight("w", D(2022, 12, 5), 13).alias("x")).collect()]
    assert got[0] == 1.0 and abs(got[1] - math.exp(-1 / 13)) < 1e-6 and got[2] == 0.001 and got[3] == 1.0


def test_config_accepts_iso_strings():
    import pytest
    from weekcast.config import ForecastConfig
    cfg = ForecastConfig(cutoff="2022-12-05", valid_end="2023-01-01", event_weeks=("2022-11-21",))
    assert cfg.cutoff == D(2022, 12, 5) and cfg.event_weeks == (D(2022, 11, 21),)
    assert cfg.with_(target_start="2023-01-01").target_start == D(2023, 1, 1)
    with pytest.raises(ValueError):
        ForecastConfig(week_anchor="XYZ")
