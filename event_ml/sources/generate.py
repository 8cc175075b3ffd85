"""Synthetic event generators (tests and demos; registered plans never use
them).  Built on ``spark.range`` so rows are generated in parallel by the
executors; randomness is seeded per column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.schema import EVENT_FEATURES, LABEL


def unit_events(spark: SparkSession, n: int = 1000, seed: int = 42) -> DataFrame:
    """Unit-test fixture: label alternates 0/1, 28 features ~ N(0, 1), floats."""
    base = spark.range(n)
    cols = [(F.col("id") % 2).cast("float").alias(LABEL)]
    cols += [F.randn(seed + i).cast("float").alias(c) for i, c in enumerate(EVENT_FEATURES)]
    return base.select(*cols)


def synthetic_events(
    spark: SparkSession,
    n: int = 110_000,
    seed: int = 42,
    mean: float = 50.0,
    std: float = 20.0,
    signal: float = 0.0,
    partitions: int | None = None,
) -> DataFrame:
    """Large variant: features ~ N(mean, std) rounded to 5 decimals, label
    random 0/1.  With ``signal`` > 0 the label depends on the first two
    features (logit = signal * standardised sum), so models have something
    to learn."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    feats = [F.round(F.randn(seed + i) * std + mean, 5).alias(c) for i, c in enumerate(EVENT_FEATURES)]
    df = base.select("id", *feats)
    if signal > 0:
        z = ((F.col(EVENT_FEATURES[0]) - mean) / std + (F.col(EVENT_FEATURES[1]) - mean) / std) * signal
        p = 1 / (1 + F.exp(-z))
        label = (F.rand(seed + 1000) < p).cast("double")
    else:
        label = (F.rand(seed + 1000) < 0.5).cast("double")
    return df.select(label.alias(LABEL), *EVENT_FEATURES, F.col("id").alias("event_id"))


def range_smoke(spark: SparkSession, n: int = 100) -> DataFrame:
    """Generated range source; its count is the environment smoke check."""
    return spark.range(n)
