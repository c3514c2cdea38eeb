"""Counts, shares and totals over small groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def share_of_total(df: DataFrame, by: Sequence[str], count: str = "n") -> DataFrame:
    """Rows per group and their percentage of all rows.

    The total is summed over the finished groups, not over the rows.
    """
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    total = F.sum(count).over(Window.partitionBy())
    percent = (F.col(count) * F.lit(100).cast("decimal(5,2)") / total).cast("decimal(5,2)")
    return grouped.withColumn("pct", percent)


def count_by_with_total(df: DataFrame, by: str) -> DataFrame:
    """Rows per value and one total row, marked by ``is_total``."""
    return df.rollup(by).agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.grouping(by).cast("int").alias("is_total")
    )


def value_counts(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """Rows per column and value, NULLs left out, in one pass over all columns.

    ``top`` keeps the most frequent values of each column; equal counts are ordered by value.
    """
    long = df.select(*(F.col(c).cast("string").alias(c) for c in columns)).unpivot(
        [], list(columns), "column", "value"
    )
    counts = (
        long.where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts if top is None else leading_values(counts, top)


def leading_values(counts: DataFrame, top: int) -> DataFrame:
    """The most frequent values of each column with their ``rank``; equal counts are ordered by value."""
    rank = F.row_number().over(
        Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    )
    return counts.withColumn("rank", rank).where(F.col("rank") <= top)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Column, rows, null rows and null percentage, from a single aggregation."""
    columns = list(columns or df.columns)
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns)
    )
    long = totals.unpivot(["_rows"], columns, "column", "null_count")
    percent = F.coalesce(
        F.try_divide(F.col("null_count").cast("double"), F.col("_rows").cast("double")) * 100,
        F.lit(0.0),
    )
    return long.select(
        "column", F.col("_rows").alias("rows"), "null_count", percent.alias("null_pct")
    )
