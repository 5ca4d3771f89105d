import pytest

from weekcast.session import shared_dir
from weekcast.sources.sinks import read_forecast, write_forecast


def test_format_switch_and_roundtrip(spark):
    df = spark.createDataFrame([(1, 10, 20, 3), (2, 10, 20, 0)], "week_no long, store_id long, product_id long, quantity long")
    with pytest.raises(ValueError):
        write_forecast(df, shared_dir(spark, "bad"), "xlsx")
    p = shared_dir(spark, "csv")
    write_forecast(df, p, "csv")
    text = "".join(r.value for r in spark.read.text(p).collect())
    assert "week_no" not in text and ";" in text                 # no header, ';' separator
    assert sorted(tuple(r) for r in read_forecast(spark, p, "csv").collect()) == [(1, 10, 20, 3), (2, 10, 20, 0)]
    q = shared_dir(spark, "pq")
    write_forecast(df, q, "parquet")
    assert read_forecast(spark, q, "parquet").count() == 2


def test_read_parts_is_a_union(spark):
    from weekcast.sources.readers import read_parts
    a, b = shared_dir(spark, "part-a"), shared_dir(spark, "part-b")
    spark.range(0, 5).write.parquet(a)
    spark.range(5, 12).write.parquet(b)
    got = read_parts(spark, [a, b])
    assert got.count() == 12 and got.agg({"id": "sum"}).first()[0] == sum(range(12))
