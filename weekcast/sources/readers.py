"""Parquet scans.

Scans take an explicit column list so the parquet reader only decodes what
the plan needs (``ReadSchema`` in ``explain``); filters written on the
returned frame are pushed to the scan by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several files of one dataset as one frame (O1: union of partitions)."""
    return spark.read.parquet(*paths)
