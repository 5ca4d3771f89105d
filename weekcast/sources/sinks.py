"""Sinks: delivery files, diagnostic CSV, prepared panels.

Writers are plain DataFrame writers: every task writes its own part file,
nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DELIVERY_COLUMNS = ("week_no", "store_id", "product_id", "quantity")
EVAL_COLUMNS = ("week_start", "store_id", "product_id", "y_true", "y_pred", "abs_err")


def write_forecast(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """Delivery rows: ``csv`` is ';'-separated UTF-8 without header (S3);
    ``parquet`` is snappy-compressed (S2).  Other formats raise (S5)."""
    fmt = fmt.lower()
    out = df.select(*DELIVERY_COLUMNS)
    if fmt == "csv":
        out.write.mode(mode).option("sep", ";").option("header", False).option("encoding", "UTF-8").csv(path)
    elif fmt == "parquet":
        out.write.mode(mode).option("compression", "snappy").parquet(path)
    else:
        raise ValueError("invalid format; use 'csv' or 'parquet'")
    return path


def read_forecast(spark, path: str, fmt: str = "csv") -> DataFrame:
    """Read back what ``write_forecast`` wrote, with the delivery schema."""
    schema = "week_no long, store_id long, product_id long, quantity long"
    if fmt.lower() == "csv":
        return spark.read.schema(schema).option("sep", ";").option("header", False).csv(path)
    return spark.read.parquet(path)


def write_eval_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Diagnostic back-test rows: ';'-separated with header."""
    df.select(*EVAL_COLUMNS).write.mode(mode).option("sep", ";").option("header", True).csv(path)
    return path


def write_panel(df: DataFrame, path: str, week_col: str = "week_start", mode: str = "overwrite") -> str:
    """Prepared panel as parquet partitioned by year and month of the week, so
    later reads of a date range prune whole folders (S2).

    The ``rebalance`` hint lets AQE deal rows by month and then cut or join tasks by measured bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): a month gets as many tasks and files as its size asks for.
    With AQE off a month is one task."""
    (df.withColumns({"p_year": F.year(week_col), "p_month": F.month(week_col)})
       .hint("rebalance", "p_year", "p_month")
       .write.mode(mode).partitionBy("p_year", "p_month").parquet(path))
    return path
