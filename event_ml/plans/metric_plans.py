"""Ranking-metric plans on the lineitem binding (score q, label y)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from event_ml.operators import metrics as m
from event_ml.operators.quality import describe_numeric
from event_ml.plans.registry import register
from event_ml.sources.tables import NUMERIC_FEATURES, SQL_EVENTS, events, read_table

SQL_RANKED = f"""WITH {SQL_EVENTS},
g AS (SELECT q AS score, CAST(SUM(y) AS BIGINT) AS pos, CAST(SUM(1 - y) AS BIGINT) AS neg
      FROM ev GROUP BY q),
r AS (SELECT score, pos, neg,
        CAST(SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
        CAST(SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
        CAST(SUM(pos) OVER () AS BIGINT) AS n_pos,
        CAST(SUM(neg) OVER () AS BIGINT) AS n_neg
      FROM g),
rb AS (SELECT *, tp - pos AS tp_before, fp - neg AS fp_before FROM r)"""


def ranked(spark, sf_dir):
    return m.ranked_scores(events(spark, sf_dir), "q", "label")


@register(
    "auc_exact",
    sql=SQL_RANKED
    + """
SELECT MAX(n_pos) AS n_pos, MAX(n_neg) AS n_neg,
       CAST(SUM(CAST(pos AS HUGEINT) * (2 * (n_neg - fp) + neg)) AS DOUBLE)
         / (CAST(2 AS DOUBLE) * CAST(MAX(n_pos) AS DOUBLE) * CAST(MAX(n_neg) AS DOUBLE)) AS auc,
       ROUND(SUM(CAST(fp - fp_before AS DOUBLE) / n_neg * (CAST(tp + tp_before AS DOUBLE) / n_pos) / 2), 10)
         AS roc_auc
FROM rb""",
)
def auc_exact(spark, sf_dir):
    r = ranked(spark, sf_dir)
    exact = m.auc_from_ranked(r)
    trap = m.roc_auc_trapezoid(r).select(F.round("roc_auc", 10).alias("roc_auc"))
    return exact.crossJoin(trap)


@register(
    "roc_points",
    sql=SQL_RANKED
    + """
SELECT CAST(score AS DOUBLE) AS threshold, tp, fp,
       CAST(fp AS DOUBLE) / n_neg AS fpr, CAST(tp AS DOUBLE) / n_pos AS tpr FROM rb
UNION ALL SELECT NULL, 0, 0, 0.0, 0.0""",
)
def roc_points(spark, sf_dir):
    return m.roc_points(ranked(spark, sf_dir))


@register(
    "roc_points_reduced",
    sql=SQL_RANKED
    + """,
n AS (SELECT *, LEAD(pos) OVER (ORDER BY score DESC) AS pos_next, LEAD(neg) OVER (ORDER BY score DESC) AS neg_next,
             LAG(pos) OVER (ORDER BY score DESC) AS pos_prev FROM rb)
SELECT CAST(score AS DOUBLE) AS threshold, tp, fp,
       CAST(fp AS DOUBLE) / n_neg AS fpr, CAST(tp AS DOUBLE) / n_pos AS tpr FROM n
WHERE pos_prev IS NULL OR pos_next IS NULL OR pos <> pos_next OR neg <> neg_next
UNION ALL SELECT NULL, 0, 0, 0.0, 0.0""",
)
def roc_points_reduced(spark, sf_dir):
    """ROC points without those between equal steps (an evaluation library's default)."""
    r = m.ranked_scores(events(spark, sf_dir), "q", "label", neighbours=True)
    return m.roc_points(r, drop_collinear=True)


@register(
    "auc_binned",
    sql=SQL_RANKED
    + """,
b AS (SELECT (row_number() OVER (ORDER BY score DESC) - 1) // GREATEST(1, (SELECT COUNT(*) FROM rb) // 1000) AS bin, pos, neg FROM rb),
c AS (SELECT bin, CAST(SUM(pos) AS DOUBLE) AS pos, CAST(SUM(neg) AS DOUBLE) AS neg FROM b GROUP BY bin),
d AS (SELECT pos, neg, SUM(pos) OVER (ORDER BY bin) AS tp, SUM(neg) OVER (ORDER BY bin) AS fp, SUM(pos) OVER () AS n_pos, SUM(neg) OVER () AS n_neg FROM c)
SELECT COUNT(*) AS n_bins, ROUND(SUM(neg * (tp + tp - pos)) / 2 / (MAX(n_pos) * MAX(n_neg)), 10) AS auc,
       ROUND(SUM(pos / n_pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN tp / (tp + fp) ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2), 10) AS auc_pr
FROM d""",
)
def auc_binned(spark, sf_dir):
    """The evaluator's curve of 1,000 groups of scores, by distributed running counts."""
    found = m.auc_binned(events(spark, sf_dir), "q", "label", num_bins=1000)
    return found.select("n_bins", F.round("auc", 10).alias("auc"), F.round("auc_pr", 10).alias("auc_pr"))


@register(
    "pr_points",
    sql=SQL_RANKED
    + """
SELECT CAST(score AS DOUBLE) AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
       CAST(tp AS DOUBLE) / n_pos AS recall FROM rb
UNION ALL SELECT NULL, 1.0, 0.0""",
)
def pr_points(spark, sf_dir):
    return m.pr_points(ranked(spark, sf_dir))


@register(
    "average_precision",
    sql=SQL_RANKED
    + """
SELECT ROUND(SUM(CAST(pos AS DOUBLE) / n_pos * (CAST(tp AS DOUBLE) / (tp + fp))), 10) AS average_precision
FROM rb""",
)
def average_precision(spark, sf_dir):
    return m.average_precision(ranked(spark, sf_dir)).select(
        F.round("average_precision", 10).alias("average_precision")
    )


@register(
    "auc_pr",
    sql=SQL_RANKED
    + """
SELECT ROUND(SUM(CAST(pos AS DOUBLE) / n_pos
   * ((CAST(tp AS DOUBLE) / (tp + fp))
      + CASE WHEN tp_before + fp_before = 0 THEN CAST(tp AS DOUBLE) / (tp + fp)
             ELSE CAST(tp_before AS DOUBLE) / (tp_before + fp_before) END) / 2), 10) AS auc_pr
FROM rb""",
)
def auc_pr(spark, sf_dir):
    return m.auc_pr(ranked(spark, sf_dir)).select(F.round("auc_pr", 10).alias("auc_pr"))


SQL_LEADERBOARD = f"""WITH {SQL_EVENTS},
g AS (SELECT l_linenumber AS model, q AS score, CAST(SUM(y) AS BIGINT) AS pos,
             CAST(SUM(1 - y) AS BIGINT) AS neg FROM ev GROUP BY l_linenumber, q),
r AS (SELECT model, score, pos, neg,
        SUM(neg) OVER (PARTITION BY model ORDER BY score DESC
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
        SUM(pos) OVER (PARTITION BY model) AS n_pos,
        SUM(neg) OVER (PARTITION BY model) AS n_neg FROM g),
a AS (SELECT model, CAST(SUM(CAST(pos AS HUGEINT) * (2 * (n_neg - fp) + neg)) AS DOUBLE)
         / (CAST(2 AS DOUBLE) * CAST(MAX(n_pos) AS DOUBLE) * CAST(MAX(n_neg) AS DOUBLE)) AS auc
      FROM r GROUP BY model)
SELECT model, auc, rank() OVER (ORDER BY auc DESC) AS rank, auc - CAST(0.5 AS DOUBLE) AS lift_over_baseline
FROM a"""


@register("leaderboard", sql=SQL_LEADERBOARD)
def leaderboard(spark, sf_dir):
    ev = events(spark, sf_dir).withColumnRenamed("l_linenumber", "model")
    per_model = m.auc_exact(ev, "q", "label", group_cols=["model"])
    return m.leaderboard(per_model, "auc", "model").withColumn("rank", F.col("rank").cast("long"))


@register(
    "doc_quality_auc",
    sql="""WITH j AS (SELECT d.lang, CAST(d.n_chars AS DOUBLE) AS score, l.quality AS y
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
g AS (SELECT lang, score, CAST(SUM(y) AS BIGINT) AS pos, CAST(SUM(1 - y) AS BIGINT) AS neg FROM j GROUP BY lang, score),
r AS (SELECT lang, score, pos, neg,
        SUM(neg) OVER (PARTITION BY lang ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
        SUM(pos) OVER (PARTITION BY lang) AS n_pos, SUM(neg) OVER (PARTITION BY lang) AS n_neg FROM g)
SELECT lang, CAST(MAX(n_pos) AS BIGINT) AS n_pos, CAST(MAX(n_neg) AS BIGINT) AS n_neg,
       CASE WHEN MAX(n_pos) * MAX(n_neg) > 0 THEN
         CAST(SUM(CAST(pos AS HUGEINT) * (2 * (n_neg - fp) + neg)) AS DOUBLE)
           / (CAST(2 AS DOUBLE) * CAST(MAX(n_pos) AS DOUBLE) * CAST(MAX(n_neg) AS DOUBLE)) END AS auc
FROM r GROUP BY lang""",
)
def doc_quality_auc(spark, sf_dir):
    """Second binding of the labelled table: labels joined to documents on
    doc_id (label = quality), score = document length; exact AUC per
    language.  The join is left to the planner (AQE broadcasts the labels
    side at runtime when it is small; a sort-merge join on the unique key
    otherwise)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("score"))
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return m.auc_exact(lab.join(docs, "doc_id"), "score", "label", group_cols=["lang"])


_SD_PARTS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, STDDEV_SAMP({c}) AS sd FROM lineitem" for c in NUMERIC_FEATURES
)


def importances(spark, sf_dir):
    """Each feature's share of the summed standard deviations (a ranking to take the top of)."""
    d = describe_numeric(read_table(spark, sf_dir, "lineitem"), NUMERIC_FEATURES, digits=None)
    return d.select(
        "feature",
        F.round(F.col("stddev") / F.sum("stddev").over(Window.partitionBy()), 6).alias("spread_share"),
    )


@register(
    "topk_importance",
    sql=f"""WITH s AS ({_SD_PARTS}),
t AS (SELECT feature, ROUND(sd / SUM(sd) OVER (), 6) AS spread_share FROM s)
SELECT feature, spread_share, row_number() OVER (ORDER BY spread_share DESC, feature) AS rank
FROM t ORDER BY spread_share DESC, feature LIMIT 3""",
)
def topk_importance(spark, sf_dir):
    return m.top_k(importances(spark, sf_dir), "spread_share", 3, tie_col="feature").withColumn(
        "rank", F.col("rank").cast("long")
    )
