"""Exact, distributed quantiles of many columns at once.

Spark's ``percentile`` keeps every distinct value of a group in one task's
memory; for a global quantile of a continuous column that is the whole
column.  Here a sketch brackets each quantile first: its rank error is bounded,
so the wanted ranks lie between the sketch's values a little below and above.
One aggregate counts the rows below each bracket, only the rows inside it are
counted by value, and running counts (``ordered_prefix``) pick the ranks
``floor/ceil((n-1) q)`` among them.  Linear interpolation: v_lo + (v_hi - v_lo)
* frac, the same definition as ``quantile_cont`` / pandas ``quantile``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from event_ml.functions.columns import literal_table, nan_to_null
from event_ml.functions.prefix import ordered_prefix


def _brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int) -> list[tuple]:
    """(column, prob, n, lo, hi) with the ranks around (n - 1) * prob inside
    [lo, hi]; columns without a value are left out."""
    margin = 2.0 / accuracy
    asked = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)})
    parts = []
    for c in cols:
        x = nan_to_null(c)
        parts.append(F.struct(F.count(x), F.min(x), F.max(x), F.percentile_approx(x, asked, accuracy)).alias(c))
    out = []
    for c, (n, least, most, sketch) in zip(cols, df.agg(*parts).first()):
        for p in probs if n else ():
            # few rows: a margin of ranks is less than a row
            wide = n < 10 * accuracy
            lo = least if wide or p <= margin else sketch[asked.index(max(0.0, p - margin))]
            hi = most if wide or p >= 1 - margin else sketch[asked.index(min(1.0, p + margin))]
            out.append((c, p, n, lo, hi))
    return out


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    accuracy: int = 1000,
    n_blocks: int | None = None,
) -> DataFrame:
    """(feature, prob, value) for every column with a value and probability;
    null and NaN are passed over.  The result does not depend on ``accuracy``,
    which only sets how many rows lie inside the brackets."""
    spark = df.sparkSession
    found = _brackets(df, cols, [float(p) for p in probs], accuracy)
    if not found:
        return literal_table(spark, [], "feature string, prob double, value double").limit(0)

    def inside(i: int, c: str, lo: float, hi: float) -> Column:
        x = nan_to_null(c)
        return F.when(x.between(lo, hi), F.struct(F.lit(i).alias("target"), x.alias("value")))

    below = df.agg(*[F.count_if(nan_to_null(c) < lo).alias(str(i)) for i, (c, _, _, lo, _) in enumerate(found)]).first()
    hits = F.array_compact(F.array(*[inside(i, c, lo, hi) for i, (c, _, _, lo, hi) in enumerate(found)]))
    counts = df.select(F.explode(hits).alias("h")).groupBy("h.target", "h.value").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = ordered_prefix(counts, "value", ["cnt"], partition_cols=["target"], n_blocks=n_blocks)
    rows = []
    for i, (c, p, n, _, _) in enumerate(found):
        h = (n - 1) * p
        rows.append((i, c, p, math.floor(h) - below[i], math.ceil(h) - below[i], h - math.floor(h)))
    targets = literal_table(spark, rows, "target int, feature string, prob double, r_lo bigint, r_hi bigint, frac double")

    def holds(rank: str) -> Column:
        return (F.col("cnt_cum") - F.col("cnt") <= F.col(rank)) & (F.col(rank) < F.col("cnt_cum"))

    # one row per (column, prob)
    picked = ranked.join(F.broadcast(targets), "target").where(holds("r_lo") | holds("r_hi")).groupBy("feature", "prob").agg(
        F.max(F.when(holds("r_lo"), F.col("value"))).alias("v_lo"),
        F.max(F.when(holds("r_hi"), F.col("value"))).alias("v_hi"),
        F.first("frac").alias("frac"),
    )
    value = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac")
    return picked.select("feature", "prob", value.alias("value"))
