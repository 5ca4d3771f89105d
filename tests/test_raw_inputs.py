"""Raw spellings of the inputs: ids, dates, NaN, registers, money of any size, holidays by rule."""
import datetime as dt

from pyspark.sql import functions as F

from weekcast.config import ForecastConfig
import pytest

from weekcast.functions.dates import easter_sunday, holiday_table, holiday_years, public_holidays, us_federal_holidays
from weekcast.operators.features import add_holiday_features
from weekcast.operators.baselines import naive_state
from weekcast.operators.weekly import weekly_sales
from weekcast.plans.pipeline import prepare
from weekcast.sources.fixtures import US_HOLIDAYS
from weekcast.sources.normalize import coerce_types, coercion_rejects

D = dt.date


def test_ids_of_any_spelling(spark):
    df = spark.createDataFrame([("7",), ("7.0",), (" 7 ",), ("1234567890123456789",), ("7.5",), ("x",), (None,)], "store_id string")
    assert [r.store_id for r in coerce_types(df).collect()] == [7, 7, 7, 1234567890123456789, None, None, None]
    assert coercion_rejects(df).first().rejected_store_id == 2
    num = spark.createDataFrame([(1.0,), (1.5,), (float("nan"),)], "store_id double")
    assert [r.store_id for r in coerce_types(num).collect()] == [1, None, None]


def test_dates_and_nan(spark):
    df = spark.createDataFrame([("2000-01-05", "1.5"), ("20000105", "nan"), ("01/05/2000", "NaN"), ("?", "x")], "txn_date string, quantity string")
    rows = coerce_types(df).collect()
    assert [r.txn_date for r in rows] == [D(2000, 1, 5)] * 3 + [None]
    assert [r.quantity for r in rows] == [1.5, None, None, None]


def test_raw_registers_with_repeated_rows(spark):
    sales = spark.createDataFrame(
        [("1.0", "10", "2022-01-03", 2.0, 5.0), ("1", "10", "2022-01-17", 3.0, 5.0)],
        "internal_store_id string, internal_product_id string, transaction_date string, quantity double, gross_value double")
    stores = spark.createDataFrame([("1", "b", "On"), ("1.0", "a", "Off"), (None, "c", "On")], "`PDV ` string, categoria_pdv string, premise string")
    products = spark.createDataFrame([("10", "beer"), ("10", "beer")], "produto string, categoria string")
    out = prepare(sales, stores=stores, products=products).orderBy("week_start").collect()
    assert [r.qty for r in out] == [2.0, 0.0, 3.0]
    assert {(r.store_category, r.premise, r.category) for r in out} == {("a", "Off", "beer")}


def test_store_category_comes_along_with_the_sales(spark):
    sales = spark.createDataFrame([(1, 10, "2022-01-03", 2.0, "a")], "store_id long, product_id long, txn_date string, quantity double, categoria_pdv string")
    (row,) = prepare(sales).collect()
    assert row.store_category == "a" and row.is_holiday == 0 and row.is_bf_cm_week == 0


def test_money_of_any_size(spark):
    sales = spark.createDataFrame([(1, 1, D(2022, 1, 3), 1.0, 1e15, 1e40), (1, 1, D(2022, 1, 4), 1.0, 0.25, 1e40)],
                                  "store_id long, product_id long, txn_date date, quantity double, gross_value double, net_value double")
    row = weekly_sales(sales).first()
    assert row.gross_value == 1e15 + 0.25 and row.net_value == 2e40


def test_holidays_by_rule(spark):
    assert [str(d) for y in (2000, 2001) for d in us_federal_holidays(y)] == sorted(US_HOLIDAYS)
    assert D(2022, 6, 20) in us_federal_holidays(2022) and D(2010, 12, 31) in us_federal_holidays(2010)
    with pytest.raises(ValueError):
        holiday_table(spark, "XX")
    with pytest.raises(ValueError):
        holiday_table(spark, "DE", 1980, 1985)


def test_easter_of_ten_years():
    """Easter Sundays."""
    assert [str(easter_sunday(y)) for y in range(2016, 2026)] == [
        "2016-03-27", "2017-04-16", "2018-04-01", "2019-04-21", "2020-04-12", "2021-04-04", "2022-04-17", "2023-04-09", "2024-03-31", "2025-04-20"]
    assert str(easter_sunday(1981)) == "1981-04-19" and str(easter_sunday(1954)) == "1954-04-18" and str(easter_sunday(2038)) == "2038-04-25"


def test_holidays_of_other_countries(spark):
    """Public holidays as published."""
    def days(country, year):
        return " ".join(f"{d:%m-%d}" for d in public_holidays(country, year))

    assert days("BR", 2023) == "01-01 04-07 04-21 05-01 09-07 10-12 11-02 11-15 12-25"
    assert days("BR", 2024) == "01-01 03-29 04-21 05-01 09-07 10-12 11-02 11-15 11-20 12-25"
    assert days("DE", 2024) == "01-01 03-29 04-01 05-01 05-09 05-20 10-03 12-25 12-26"
    assert "10-31" in days("DE", 2017) and "10-31" not in days("DE", 2018)
    assert days("fr", 2025) == "01-01 04-21 05-01 05-08 05-29 06-09 07-14 08-15 11-01 11-11 12-25"
    assert holiday_table(spark, "FR", 2024, 2025).count() == 22


def test_a_week_without_known_holidays_raises(spark):
    weeks = spark.createDataFrame([(D(2022, 1, 3),), (D(1970, 1, 5),)], "week_start date")
    table = holiday_table(spark)
    assert add_holiday_features(weeks, table).count() == 2
    with pytest.raises(Exception, match="no holidays known for week 1970-01-05"):
        add_holiday_features(weeks, table, years=holiday_years("US")).collect()


def test_default_calendar_is_december_to_january():
    cfg = ForecastConfig()
    assert (cfg.cutoff, cfg.valid_end, cfg.target_start, cfg.target_end) == (D(2022, 12, 5), D(2023, 1, 1), D(2023, 1, 1), D(2023, 2, 1))


def test_naive_takes_the_last_value_if_asked(spark):
    rows = [(1, 1, D(2022, 1, 3), 4.0, 1), (1, 1, D(2022, 1, 10), 0.0, 0)]
    df = spark.createDataFrame(rows, "store_id long, product_id long, week_start date, qty double, n_tx long")
    value = lambda **o: naive_state(df, horizon=1, **o).select(F.col("preds")[0]).first()[0]
    assert value() == 4.0 and value(use_last_nonzero=False) == 0.0
