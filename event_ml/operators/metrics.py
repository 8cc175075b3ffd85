"""Ranking metrics of a prediction table, exact and distributed.

All curves are built from ONE aggregated table with a row per distinct score
(partial aggregation map-side), given running counts in descending score
order with ``ordered_prefix`` (a two-level prefix sum, no single-task window),
which has the class totals too.  Every point's predecessor is derived from its
own running counts (``cum - this``); a point's successor, where it is needed,
is looked up across the blocks' ends.

Tie handling: all rows sharing a score form one curve point, and the exact
AUC counts a positive/negative tie as 1/2 (Mann-Whitney).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from event_ml.functions.prefix import ordered_prefix


def score_table(
    pred: DataFrame, score_col: str, label_col: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """(group..., score, pos, neg): one row per distinct score."""
    is_pos = (F.col(label_col) == 1).cast("long")
    return (
        pred.filter(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(*group_cols, F.col(score_col).alias("score"))
        .agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg"))
    )


def ranked_scores(
    pred: DataFrame,
    score_col: str,
    label_col: str,
    group_cols: Sequence[str] = (),
    n_blocks: int | None = None,
    neighbours: bool = False,
) -> DataFrame:
    """Per distinct score, descending: pos, neg, tp (= pos_cum), fp (=
    neg_cum), tp_before, fp_before and class totals n_pos, n_neg.
    ``neighbours`` adds pos_next and neg_next, those of the next lower score.
    """
    group_cols = list(group_cols)
    g = score_table(pred, score_col, label_col, group_cols)
    following = ["pos", "neg"] if neighbours else []
    r = ordered_prefix(
        g, "score", ["pos", "neg"], partition_cols=group_cols, descending=True, n_blocks=n_blocks, totals=True, next_cols=following
    )
    return r.select(
        *group_cols,
        "score",
        "pos",
        "neg",
        F.col("pos_cum").alias("tp"),
        F.col("neg_cum").alias("fp"),
        (F.col("pos_cum") - F.col("pos")).alias("tp_before"),
        (F.col("neg_cum") - F.col("neg")).alias("fp_before"),
        F.col("pos_total").alias("n_pos"),
        F.col("neg_total").alias("n_neg"),
        *[c + "_next" for c in following],
    )


def auc_exact(
    pred: DataFrame,
    score_col: str,
    label_col: str,
    group_cols: Sequence[str] = (),
    n_blocks: int | None = None,
) -> DataFrame:
    """Exact tie-aware AUC-ROC per group:
    sum_s pos_s * (neg below s + neg_s / 2) / (P * N), multiplied and
    accumulated as DECIMAL(38,0), so no count overflows."""
    return auc_from_ranked(ranked_scores(pred, score_col, label_col, group_cols, n_blocks), group_cols)


def auc_from_ranked(r: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact AUC from a ``ranked_scores`` table (reuse it for other curves)."""
    group_cols = list(group_cols)
    neg_below = F.col("n_neg") - F.col("fp")
    term = F.col("pos").cast("decimal(18,0)") * (2 * neg_below + F.col("neg")).cast("decimal(19,0)")
    agg = r.groupBy(*group_cols).agg(
        F.sum(term).alias("num2"),
        F.first("n_pos").alias("n_pos"),
        F.first("n_neg").alias("n_neg"),
    )
    denom = F.lit(2.0) * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return agg.select(
        *group_cols,
        "n_pos",
        "n_neg",
        F.when(denom > 0, F.col("num2").cast("double") / denom).alias("auc"),
    )


def auc_binned(
    pred: DataFrame,
    score_col: str,
    label_col: str,
    num_bins: int = 1000,
    n_blocks: int | None = None,
) -> DataFrame:
    """(n_bins, auc, auc_pr) of the curves through every ``grouping``-th distinct
    score, grouping = distinct scores div ``num_bins`` (below 2: every score).

    The running count of the distinct scores numbers the groups, so they are
    equally large whatever the partitioning; there are fewer than twice
    ``num_bins``.  No row of a class gives null for what divides by it.
    """
    if num_bins < 1:
        raise ValueError("num_bins must be positive")
    g = score_table(pred, score_col, label_col).withColumn("one", F.lit(1).cast("long"))
    r = ordered_prefix(g, "score", ["one"], descending=True, n_blocks=n_blocks, totals=True)
    grouping = F.greatest(F.lit(1).cast("long"), F.floor(F.col("one_total") / num_bins))
    bins = r.groupBy(F.floor((F.col("one_cum") - 1) / grouping).alias("bin")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # fewer than 2 * num_bins rows from here on
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    curve = bins.select("pos", "neg", *[F.sum(c).over(upto).alias(o) for c, o in (("pos", "tp"), ("neg", "fp"))], *[F.sum(c).over(every).alias(o) for c, o in (("pos", "n_pos"), ("neg", "n_neg"))])
    curve = curve.withColumns({"tp_before": F.col("tp") - F.col("pos"), "fp_before": F.col("fp") - F.col("neg")})
    area = F.try_divide(F.sum(F.col("neg") * (F.col("tp") + F.col("tp_before"))) / 2, F.max(F.col("n_pos").cast("double") * F.col("n_neg")))
    return curve.agg(F.count(F.lit(1)).alias("n_bins"), area.alias("auc")).crossJoin(F.broadcast(auc_pr(curve)))


def roc_points(ranked: DataFrame, group_cols: Sequence[str] = (), drop_collinear: bool = False) -> DataFrame:
    """(threshold, tp, fp, fpr, tpr) for every distinct score, plus the
    origin (threshold null, 0, 0).

    ``drop_collinear`` leaves out a point whose step is the next one's too (as
    many positives and negatives), which bends no line; the first and the last
    score stay.  ``ranked`` then needs its neighbours.  The area is unchanged.
    """
    group_cols = list(group_cols)
    if drop_collinear:
        ends = (F.col("tp_before") + F.col("fp_before") == 0) | F.col("pos_next").isNull()
        ranked = ranked.where(ends | (F.col("pos") != F.col("pos_next")) | (F.col("neg") != F.col("neg_next")))
    pts = ranked.select(
        *group_cols,
        F.col("score").cast("double").alias("threshold"),
        "tp",
        "fp",
        F.try_divide(F.col("fp"), F.col("n_neg")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )
    origin = ranked.select(*group_cols).distinct() if group_cols else ranked.limit(1).select()
    origin = origin.select(
        *group_cols,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0).cast("long").alias("tp"),
        F.lit(0).cast("long").alias("fp"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return pts.unionByName(origin)


def roc_auc_trapezoid(ranked: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under the ROC points (equals the exact AUC)."""
    group_cols = list(group_cols)
    n_neg, n_pos = F.col("n_neg").cast("double"), F.col("n_pos").cast("double")
    area = (
        (F.col("fp") - F.col("fp_before")) / n_neg
        * ((F.col("tp") + F.col("tp_before")) / n_pos) / 2
    )
    return ranked.groupBy(*group_cols).agg(F.sum(area).alias("roc_auc"))


def pr_points(ranked: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the end point
    (threshold null, precision 1, recall 0)."""
    group_cols = list(group_cols)
    pts = ranked.select(
        *group_cols,
        F.col("score").cast("double").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("n_pos") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("n_pos")).alias("recall"),
    )
    end = ranked.select(*group_cols).distinct() if group_cols else ranked.limit(1).select()
    end = end.select(
        *group_cols,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return pts.unionByName(end)


def average_precision(ranked: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """AP = sum_n (R_n - R_{n-1}) P_n over descending distinct scores."""
    group_cols = list(group_cols)
    term = F.col("pos") / F.col("n_pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return ranked.groupBy(*group_cols).agg(F.sum(term).alias("average_precision"))


def auc_pr(ranked: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Area under (recall, precision) by trapezoids, starting at (0, first
    precision) -- the definition of MLlib's areaUnderPR (without binning)."""
    group_cols = list(group_cols)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    prev_prec = F.when(F.col("tp_before") + F.col("fp_before") == 0, prec).otherwise(
        F.col("tp_before") / (F.col("tp_before") + F.col("fp_before"))
    )
    d_recall = F.col("pos") / F.col("n_pos")
    return ranked.groupBy(*group_cols).agg(F.sum(d_recall * (prec + prev_prec) / 2).alias("auc_pr"))


def leaderboard(metrics: DataFrame, metric_col: str, model_col: str = "model", baseline: float = 0.5) -> DataFrame:
    """Models ranked by a metric (descending) with the lift over a baseline.
    The metric table has one row per model, so the global window is tiny."""
    w = Window.orderBy(F.col(metric_col).desc())
    return metrics.select(
        model_col,
        metric_col,
        F.rank().over(w).alias("rank"),
        (F.col(metric_col) - F.lit(baseline)).alias("lift_over_baseline"),
    )


def top_k(df: DataFrame, value_col: str, k: int, tie_col: str | None = None) -> DataFrame:
    """Top-k rows by a value (descending), ranked 1..k."""
    order = [F.col(value_col).desc()] + ([F.col(tie_col).asc()] if tie_col else [])
    return df.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
