"""Checks of fitted models against the optimum that they look for.

* ``best_splits``: the exactly best first split of every feature, from counts of
  its distinct values in order.  A tree's root should be the best of them.
* ``logistic_certificate``: value, gradient and curvature of the penalised
  log-loss at given weights, in one aggregate pass.  At the optimum the
  gradient is zero, and a Newton step says how far away it is.
* ``second_moments``: count, sums and products of a vector column, summed as
  blocks in the tasks, and the spectrum of its covariance.

What reaches the driver has the size of the features, or of their square.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from event_ml.functions.prefix import ordered_prefix

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def best_splits(df: DataFrame, features: Sequence[str], label_col: str = "label", n_blocks: int | None = None) -> DataFrame:
    """(feature, lo, hi, gain, n_left, pos_left, n, pos): each feature's split with
    the largest decrease of the Gini impurity, between the neighbouring values
    ``lo`` and ``hi``; of equal ones the lowest.

    Labels are 0 and 1; rows with a null or NaN value or a null label are
    passed over for that feature.  A feature with fewer than two values, or an
    empty table, has no row.  All features are counted and ordered together:
    one row a distinct value, running counts across all of them.
    """
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    items = F.array(*[F.struct(F.lit(c).alias("feature"), value(c).alias("value")) for c in features])
    long = df.where(F.col(label_col).isNotNull()).select(F.explode(items).alias("i"), (F.col(label_col) == 1).cast("long").alias("y"))
    counts = long.where("i.value IS NOT NULL").groupBy("i.feature", "i.value").agg(F.count("*").alias("n"), F.sum("y").alias("pos"))
    r = ordered_prefix(counts, "value", ["n", "pos"], partition_cols=["feature"], n_blocks=n_blocks, totals=True, next_cols=["value"])
    n, pos, left, pos_left = (F.col(c).cast("double") for c in ("n_total", "pos_total", "n_cum", "pos_cum"))

    def impurity(p: Column, k: Column) -> Column:
        return F.try_divide(2 * p * (k - p), k * k)

    gain = impurity(pos, n) - left / n * impurity(pos_left, left) - (n - left) / n * impurity(pos - pos_left, n - left)
    splits = r.where("value_next IS NOT NULL").withColumn("gain", gain)
    best = F.max_by(F.struct(F.col("value").alias("lo"), F.col("value_next").alias("hi"), "gain", F.col("n_cum").alias("n_left"), F.col("pos_cum").alias("pos_left"), F.col("n_total").alias("n"), F.col("pos_total").alias("pos")), F.struct("gain", -F.col("value")))
    return splits.groupBy("feature").agg(best.alias("s")).select("feature", "s.*")


def root_split(model) -> tuple[int, float, float] | None:
    """(feature's number, threshold, gain) of a fitted tree's root; None for a leaf."""
    root = model._java_obj.rootNode()
    if root.subtreeDepth() == 0:
        return None
    return root.split().featureIndex(), float(root.split().threshold()), float(root.gain())


def logistic_certificate(df: DataFrame, features: Sequence[str | Column], label: Column, weights: Sequence[float], reg: float) -> dict:
    """{n, loss, gradient, curvature, step} of the mean log-loss plus
    ``reg / 2`` times the squared weights, at ``weights`` (the intercept last,
    not penalised), of features as they are.

    One pass sums the loss, d + 1 first and (d + 1)(d + 2) / 2 second
    derivatives.  ``step`` is the Newton step, an estimate of how far the
    weights are from the optimum.
    """
    x = [F.col(c) if isinstance(c, str) else c for c in features] + [F.lit(1.0)]
    names = [f"x{i}" for i in range(len(x))]
    rows = df.select(*[c.cast("double").alias(name) for c, name in zip(x, names, strict=True)], label.cast("double").alias("y"))
    z = sum((F.col(c) * float(w) for c, w in zip(names, weights, strict=True)), F.lit(0.0))
    rows = rows.withColumn("z", z).withColumn("p", 1 / (1 + F.exp(-F.col("z"))))
    # log(1 + exp(z)) - y z without overflow
    loss = F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
    pairs = [(i, j) for i in range(len(x)) for j in range(i + 1)]
    found = rows.agg(
        F.count("*").alias("n"), F.sum(loss).alias("loss"),
        *[F.sum((F.col("p") - F.col("y")) * F.col(c)).alias(f"g{c}") for c in names],
        *[F.sum(F.col("p") * (1 - F.col("p")) * F.col(names[i]) * F.col(names[j])).alias(f"h{i}_{j}") for i, j in pairs],
    ).first()
    n, penalised = found["n"], np.array([reg] * (len(x) - 1) + [0.0])
    if not n:
        raise ValueError("no rows")
    w = np.array(weights, float)
    gradient = np.array([found[f"g{c}"] for c in names]) / n + penalised * w
    curvature = np.diag(penalised)
    for i, j in pairs:
        curvature[i, j] += found[f"h{i}_{j}"] / n
        if i != j:
            curvature[j, i] += found[f"h{i}_{j}"] / n
    loss = found["loss"] / n + float(penalised @ (w * w)) / 2
    return {"n": n, "loss": loss, "gradient": gradient, "curvature": curvature, "step": -np.linalg.lstsq(curvature, gradient, rcond=None)[0]}


def second_moments(df: DataFrame, vector: Column, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, covariance with n - 1) of an array<double> column with
    ``size`` values; null vectors are passed over.  A task sums its rows' products
    as one block; blocks are added by place, ``size ** 2`` sums in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, shift, total, products = 0, None, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            rows = batch.column(0).drop_null()
            if not len(rows):
                continue
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)
            # each task has its own origin, so large means cost no digits
            shift = x[0].copy() if shift is None else shift
            x = x - shift
            n, total, products = n + len(x), total + x.sum(0), products + x.T @ x
        if n:
            mean = total / n
            values = [[n], [(mean + shift).tolist()], [(products - n * np.outer(mean, mean)).ravel().tolist()]]
            types = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], ["n", "mean", "m2"])

    blocks = df.select(vector.alias("v")).mapInArrow(run, "n long, mean array<double>, m2 array<double>")
    held = blocks.select("n", "mean", "m2").persist()
    try:
        n, *means = held.agg(F.sum("n"), *[F.sum(F.col("n") * F.col("mean")[i]) for i in range(size)]).first()
        if not n:
            return 0, np.full(size, np.nan), np.full((size, size), np.nan)
        mean = np.array(means) / n
        # a block's products about the common mean: its own, and n times its mean's distance
        centre = F.array(*[F.lit(float(m)) for m in mean])
        off = F.zip_with("mean", centre, lambda a, b: a - b)
        rows = held.select("n", "m2", off.alias("off")).select("n", "m2", "off", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("i"))
        part = F.slice("m2", F.col("i") * size + 1, size)
        line = F.transform(part, lambda v, j: v + F.col("n") * F.get("off", F.col("i")) * F.get("off", j))
        summed = rows.select("i", F.posexplode(line).alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    finally:
        held.unpersist()
    covariance = np.full((size, size), np.nan)
    for i, j, v in summed:
        covariance[i, j] = v / (n - 1) if n > 1 else np.nan
    return n, mean, covariance


def spectrum(df: DataFrame, vector: Column, size: int, k: int, target: float = 0.95) -> DataFrame:
    """(component, variance, share, cumulative, reached_target, total, squared) of
    the ``k`` largest principal components: variance along each, its share of
    the total, and the sums of all ``size`` variances and of their squares,
    which are the covariance's trace and squared Frobenius norm."""
    _, _, covariance = second_moments(df, vector, size)
    values = np.sort(np.linalg.eigvalsh(covariance))[::-1]
    rows = [(i + 1, float(v), float(values.sum()), float((values * values).sum())) for i, v in enumerate(values[:k])]
    table = df.sparkSession.createDataFrame(rows, "component int, variance double, total double, squared double")
    upto = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # k rows
    share = table.withColumn("share", F.col("variance") / F.col("total"))
    share = share.withColumn("cumulative", F.sum("share").over(upto))
    return share.select("component", "variance", "share", "cumulative", (F.col("cumulative") >= target).alias("reached_target"), "total", "squared")

