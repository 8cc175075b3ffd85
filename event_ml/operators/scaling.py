"""Scaling studies: strong scaling (fixed data, more partitions), weak
scaling (data grows with the scale factor), and the ideal-speed-up line."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def strong_scaling(
    df: DataFrame,
    fit_fn: Callable[[DataFrame], object],
    partitions: Sequence[int] = (8, 16, 32),
    sample_fraction: float = 1.0,
) -> DataFrame:
    """(partitions, time_s, sample_fraction, type) for one fit per count.
    ``repartition(p)`` (a coalesce cannot raise the partition count); a
    failing fit raises instead of silently retrying on less data."""
    spark = df.sparkSession
    base = df if sample_fraction >= 1.0 else df.sample(fraction=sample_fraction, seed=42)
    rows = []
    for p in partitions:
        part = base.repartition(int(p)).cache()
        part.count()
        t0 = time.perf_counter()
        fit_fn(part)
        rows.append((int(p), time.perf_counter() - t0, float(sample_fraction), "strong"))
        part.unpersist()
    return spark.createDataFrame(rows, "partitions int, time_s double, sample_fraction double, type string")


def weak_scaling(
    spark: SparkSession,
    inputs: Sequence[str],
    build_fn: Callable[[SparkSession, str], DataFrame],
    fit_fn: Callable[[DataFrame], object],
) -> DataFrame:
    """(input, rows, time_s, type) with the data growing per input."""
    rows = []
    for path in inputs:
        df = build_fn(spark, path).cache()
        n = df.count()
        t0 = time.perf_counter()
        fit_fn(df)
        rows.append((path, int(n), time.perf_counter() - t0, "weak"))
        df.unpersist()
    return spark.createDataFrame(rows, "input string, rows long, time_s double, type string")


def partition_balance(df: DataFrame, partitions: Sequence[int] = (8, 16, 32)) -> DataFrame:
    """(partitions, n_rows, n_filled, largest, ideal_rows, ideal_share, largest_share):
    how evenly ``repartition(p)`` spreads the rows for every ``p``.

    Each count is a row a partition before it is summed; the ideal line is what
    p equal parts would hold.  An empty table has rows of zeros and null shares.
    """
    found = []
    for p in partitions:
        parts = df.select(F.lit(1).alias("one")).repartition(int(p)).groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
        found.append(
            parts.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_filled"), F.coalesce(F.max("n"), F.lit(0)).alias("largest")
            ).select(F.lit(int(p)).alias("partitions"), "*")
        )
    table = reduce(DataFrame.unionByName, found)
    return table.select(
        "*", (F.col("n_rows") / F.col("partitions")).alias("ideal_rows"), (1 / F.col("partitions")).alias("ideal_share"), F.try_divide("largest", "n_rows").alias("largest_share")
    )


def ideal_line(table: DataFrame, p_col: str = "partitions", t_col: str = "time_s") -> DataFrame:
    """Adds ideal_time_s = t0 * p0 / p from the first row (smallest p).  The
    table has one row per measured configuration, so the global window is
    tiny."""
    w = Window.orderBy(p_col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first_t = F.first(t_col).over(w)
    first_p = F.first(p_col).over(w)
    return table.withColumn("ideal_time_s", first_t * first_p / F.col(p_col))
