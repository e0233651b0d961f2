"""Data-quality checks returning violation DataFrames (empty = pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values of ``column`` occurring more than once, with their counts."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def assert_passes(violations: DataFrame, name: str) -> None:
    """Raise if a check found violations (reads at most one row)."""
    if violations.take(1):
        raise AssertionError(f"data test {name} failed")
