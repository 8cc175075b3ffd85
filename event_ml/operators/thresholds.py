"""Threshold analysis of a prediction table: confusion counts at many
thresholds, business cost curve, its optimum and derived views.

Scale design: every row is mapped to one bucket = number of thresholds it
clears; one partial+final ``groupBy`` reduces the table to at most
``len(thresholds) + 1`` rows.  All later steps (cumulative counts per
threshold, cost, arg-min, sweeps) run on that tiny table; no per-threshold
pass over the data and no row x threshold blow-up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from event_ml.functions.columns import count_at_least, literal_table


def default_thresholds() -> list[float]:
    """0.10, 0.11, ..., 0.89 (80 two-decimal values)."""
    return [round(0.10 + 0.01 * i, 2) for i in range(80)]


def score_histogram(
    pred: DataFrame,
    score_col: str,
    label_col: str,
    thresholds: Sequence[float],
) -> DataFrame:
    """(bucket, pos, neg): bucket = number of thresholds <= score."""
    thr = sorted(float(t) for t in thresholds)
    is_pos = (F.col(label_col) == 1).cast("long")
    return pred.groupBy(count_at_least(thr, score_col).alias("bucket")).agg(
        F.sum(is_pos).alias("pos"),
        F.sum(1 - is_pos).alias("neg"),
    )


def threshold_confusion(
    pred: DataFrame,
    score_col: str,
    label_col: str,
    thresholds: Sequence[float],
    threshold_values: Sequence[float] | None = None,
) -> DataFrame:
    """(threshold, tp, fp, tn, fn) for ``prediction = score >= t``.

    ``threshold_values`` relabels the output (e.g. thresholds given in integer
    score units, reported as probabilities).  Rows where the 2x2 matrix would
    degenerate (labels and predictions all of one class) are not emitted.
    """
    spark = pred.sparkSession
    order = sorted(range(len(thresholds)), key=lambda i: float(thresholds[i]))
    values = list(threshold_values) if threshold_values is not None else list(thresholds)
    thr_rows = [(rank + 1, float(values[i])) for rank, i in enumerate(order)]
    hist = score_histogram(pred, score_col, label_col, [thresholds[i] for i in order])
    # The histogram has at most len(thresholds)+1 rows.  Pair every bucket
    # with the thresholds it clears (tiny x tiny non-equi join) and sum in
    # one aggregate; the class totals come from the same rows via
    # ``idx = 0`` (a threshold every bucket clears), so the data is scanned
    # once.
    thr0 = literal_table(spark, [(0, None), *thr_rows], "idx int, threshold double")
    paired = thr0.join(F.broadcast(hist), F.col("bucket") >= F.col("idx"), "left")
    cum = paired.groupBy("idx", "threshold").agg(
        F.coalesce(F.sum("pos"), F.lit(0)).cast("long").alias("tp"),
        F.coalesce(F.sum("neg"), F.lit(0)).cast("long").alias("fp"),
    )
    w_all = Window.partitionBy()
    totals_col = [
        F.max(F.when(F.col("idx") == 0, F.col("tp"))).over(w_all).alias("n_pos"),
        F.max(F.when(F.col("idx") == 0, F.col("fp"))).over(w_all).alias("n_neg"),
    ]
    out = cum.select("*", *totals_col).filter(F.col("idx") > 0).select(
        "threshold",
        "tp",
        "fp",
        (F.col("n_neg") - F.col("fp")).alias("tn"),
        (F.col("n_pos") - F.col("tp")).alias("fn"),
    )
    degenerate = ((F.col("tp") + F.col("fn") == 0) & (F.col("fp") == 0)) | (
        (F.col("tn") + F.col("fp") == 0) & (F.col("fn") == 0)
    )
    return out.filter(~degenerate)


def cost_curve(
    pred: DataFrame,
    score_col: str,
    label_col: str,
    thresholds: Sequence[float] | None = None,
    threshold_values: Sequence[float] | None = None,
    cost_fn: int = 3,
    cost_fp: int = 1,
) -> DataFrame:
    """(threshold, tp, fp, tn, fn, cost) with cost = cost_fn*FN + cost_fp*FP."""
    thresholds = list(thresholds) if thresholds is not None else default_thresholds()
    conf = threshold_confusion(pred, score_col, label_col, thresholds, threshold_values)
    return conf.withColumn(
        "cost", (F.lit(cost_fn) * F.col("fn") + F.lit(cost_fp) * F.col("fp")).cast("long")
    )


def cost_optimum(curve: DataFrame) -> DataFrame:
    """Minimum-cost row; the lowest threshold wins ties (first minimum)."""
    return curve.orderBy(F.col("cost").asc(), F.col("threshold").asc()).limit(1)


def cost_decomposition(curve: DataFrame, cost_fn: int = 3, cost_fp: int = 1) -> DataFrame:
    """Long form (threshold, component, cost) with FN cost and FP cost."""
    wide = curve.select(
        "threshold",
        (F.lit(cost_fn) * F.col("fn")).cast("long").alias("fn_cost"),
        (F.lit(cost_fp) * F.col("fp")).cast("long").alias("fp_cost"),
    )
    return wide.unpivot("threshold", ["fn_cost", "fp_cost"], "component", "cost")


def cost_ratio_sweep(
    curve: DataFrame, fn_weights: Sequence[int] = range(1, 11), cost_fp: int = 1
) -> DataFrame:
    """Optimum threshold for every FN weight (FP weight fixed)."""
    spark = curve.sparkSession
    weights = literal_table(spark, [(int(w),) for w in fn_weights], "fn_weight int")
    swept = curve.crossJoin(F.broadcast(weights)).withColumn(
        "cost_w", (F.col("fn_weight") * F.col("fn") + F.lit(cost_fp) * F.col("fp")).cast("long")
    )
    w = Window.partitionBy("fn_weight").orderBy(F.col("cost_w").asc(), F.col("threshold").asc())
    return (
        swept.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .select("fn_weight", "threshold", F.col("cost_w").alias("cost"), "fp", "fn")
    )


def optimum_rates(curve: DataFrame) -> DataFrame:
    """FP rate and FN rate at the optimum threshold."""
    opt = cost_optimum(curve)
    return opt.select(
        "threshold",
        "cost",
        F.round(F.try_divide(F.col("fp"), F.col("fp") + F.col("tn")), 6).alias("fp_rate"),
        F.round(F.try_divide(F.col("fn"), F.col("fn") + F.col("tp")), 6).alias("fn_rate"),
    )


def cost_reduction(curve: DataFrame, baseline_threshold: float = 0.5) -> DataFrame:
    """1 - min_cost / cost(baseline threshold)."""
    opt = cost_optimum(curve).select(
        F.col("threshold").alias("opt_threshold"), F.col("cost").alias("min_cost")
    )
    base = curve.filter(F.abs(F.col("threshold") - F.lit(baseline_threshold)) < 1e-9).select(
        F.col("cost").alias("baseline_cost")
    )
    return opt.crossJoin(base).select(
        "opt_threshold",
        "min_cost",
        "baseline_cost",
        F.round(1 - F.try_divide(F.col("min_cost"), F.col("baseline_cost")), 6).alias("reduction"),
    )


def confusion_counts(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(label, prediction, n) completed to the full 2x2 grid."""
    spark = pred.sparkSession
    grid = literal_table(spark, [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    counts = pred.groupBy(
        F.col(label_col).cast("double").alias("label"),
        F.col(pred_col).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")
    )


def confusion_normalised(counts: DataFrame) -> DataFrame:
    """Row-normalised confusion: n / (rows of that actual class)."""
    w = Window.partitionBy("label")
    return counts.select(
        "label",
        "prediction",
        "n",
        F.round(F.try_divide(F.col("n"), F.sum("n").over(w)), 6).alias("rate"),
    )


def classification_metrics(counts: DataFrame, digits: int = 4) -> DataFrame:
    """Accuracy and class-weighted precision / recall / F1 from 2x2 counts,
    in one pass over the 4-row table (same definitions as MLlib's
    MulticlassClassificationEvaluator)."""

    def cell(lbl: float, prd: float):
        return F.sum(F.when((F.col("label") == lbl) & (F.col("prediction") == prd), F.col("n")).otherwise(0))

    wide = counts.agg(
        cell(0.0, 0.0).alias("tn"),
        cell(0.0, 1.0).alias("fp"),
        cell(1.0, 0.0).alias("fn"),
        cell(1.0, 1.0).alias("tp"),
    )
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn

    def div(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)

    p1, r1 = div(tp, tp + fp), div(tp, tp + fn)
    p0, r0 = div(tn, tn + fn), div(tn, tn + fp)
    f1_1 = div(2 * p1 * r1, p1 + r1)
    f1_0 = div(2 * p0 * r0, p0 + r0)
    w1, w0 = div(tp + fn, n), div(tn + fp, n)
    return wide.select(
        F.round(div(tp + tn, n), digits).alias("accuracy"),
        F.round(w0 * p0 + w1 * p1, digits).alias("weighted_precision"),
        F.round(w0 * r0 + w1 * r1, digits).alias("weighted_recall"),
        F.round(w0 * f1_0 + w1 * f1_1, digits).alias("f1"),
    )
