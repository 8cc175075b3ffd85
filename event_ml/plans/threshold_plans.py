"""Threshold / business-cost plans on the lineitem binding.

Score p is an integer in 100..10000 (probability p/10000); threshold k/100
for k = 10..89 is applied as ``p >= 100*k`` so no float tie is ambiguous.
"""

from __future__ import annotations

from event_ml.operators import thresholds as th
from event_ml.plans.registry import register
from event_ml.sources.tables import SQL_EVENTS, scored_events

THRESHOLD_UNITS = [100 * k for k in range(10, 90)]
THRESHOLD_VALUES = [k / 100 for k in range(10, 90)]


def curve(spark, sf_dir):
    pred = scored_events(spark, sf_dir)
    return th.cost_curve(pred, "p", "label", THRESHOLD_UNITS, THRESHOLD_VALUES, cost_fn=3, cost_fp=1)


SQL_CURVE = f"""WITH {SQL_EVENTS},
th AS (SELECT CAST(range AS BIGINT) AS k FROM range(10, 90)),
conf AS (
  SELECT CAST(k AS DOUBLE) / CAST(100 AS DOUBLE) AS threshold,
         CAST(SUM(CASE WHEN p >= k*100 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(SUM(CASE WHEN p >= k*100 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(SUM(CASE WHEN p <  k*100 AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(SUM(CASE WHEN p <  k*100 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM th CROSS JOIN ev GROUP BY k),
curve AS (
  SELECT threshold, tp, fp, tn, fn, CAST(3*fn + fp AS BIGINT) AS cost FROM conf
  WHERE NOT ((tp + fn = 0 AND fp = 0) OR (tn + fp = 0 AND fn = 0)))"""

SQL_OPT = "opt AS (SELECT * FROM curve ORDER BY cost, threshold LIMIT 1)"


@register("cost_curve", sql=SQL_CURVE + "\nSELECT * FROM curve")
def cost_curve(spark, sf_dir):
    return curve(spark, sf_dir)


@register(
    "cost_optimum",
    sql=SQL_CURVE + f",\n{SQL_OPT}\nSELECT threshold, tp, fp, tn, fn, cost FROM opt",
)
def cost_optimum(spark, sf_dir):
    return th.cost_optimum(curve(spark, sf_dir))


@register(
    "cost_decomposition",
    sql=SQL_CURVE
    + """
SELECT threshold, 'fn_cost' AS component, CAST(3*fn AS BIGINT) AS cost FROM curve
UNION ALL
SELECT threshold, 'fp_cost' AS component, CAST(fp AS BIGINT) AS cost FROM curve""",
)
def cost_decomposition(spark, sf_dir):
    return th.cost_decomposition(curve(spark, sf_dir), 3, 1)


@register(
    "cost_ratio_sweep",
    sql=SQL_CURVE
    + """,
w AS (SELECT CAST(range AS INTEGER) AS fn_weight FROM range(1, 11)),
swept AS (SELECT fn_weight, threshold, CAST(fn_weight*fn + fp AS BIGINT) AS cost, fp, fn,
          row_number() OVER (PARTITION BY fn_weight ORDER BY fn_weight*fn + fp, threshold) AS rn
          FROM curve CROSS JOIN w)
SELECT fn_weight, threshold, cost, fp, fn FROM swept WHERE rn = 1""",
)
def cost_ratio_sweep(spark, sf_dir):
    return th.cost_ratio_sweep(curve(spark, sf_dir), range(1, 11), 1)


@register(
    "optimum_rates",
    sql=SQL_CURVE
    + f""",
{SQL_OPT}
SELECT threshold, cost,
       ROUND(CAST(fp AS DOUBLE) / (fp + tn), 6) AS fp_rate,
       ROUND(CAST(fn AS DOUBLE) / (fn + tp), 6) AS fn_rate
FROM opt""",
)
def optimum_rates(spark, sf_dir):
    return th.optimum_rates(curve(spark, sf_dir))


@register(
    "cost_reduction",
    sql=SQL_CURVE
    + f""",
{SQL_OPT}
SELECT opt.threshold AS opt_threshold, opt.cost AS min_cost, b.cost AS baseline_cost,
       ROUND(1 - CAST(opt.cost AS DOUBLE) / b.cost, 6) AS reduction
FROM opt CROSS JOIN (SELECT cost FROM curve WHERE abs(threshold - 0.5) < 1e-9) b""",
)
def cost_reduction(spark, sf_dir):
    return th.cost_reduction(curve(spark, sf_dir), 0.5)


SQL_COUNTS = f"""WITH {SQL_EVENTS},
pr AS (SELECT label, CASE WHEN p >= 5000 THEN 1.0 ELSE 0.0 END AS prediction FROM ev),
grid AS (SELECT CAST(a AS DOUBLE) AS label, CAST(b AS DOUBLE) AS prediction
         FROM (VALUES (0,0),(0,1),(1,0),(1,1)) t(a, b)),
cnt AS (SELECT label, prediction, COUNT(*) AS n FROM pr GROUP BY label, prediction),
counts AS (SELECT g.label, g.prediction, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
           FROM grid g LEFT JOIN cnt c ON g.label = c.label AND g.prediction = c.prediction)"""


def counts_at_half(spark, sf_dir):
    return th.confusion_counts(scored_events(spark, sf_dir), "label", "prediction")


@register("confusion_counts", sql=SQL_COUNTS + "\nSELECT * FROM counts")
def confusion_counts(spark, sf_dir):
    return counts_at_half(spark, sf_dir)


@register(
    "confusion_normalised",
    sql=SQL_COUNTS
    + """
SELECT label, prediction, n,
       ROUND(CAST(n AS DOUBLE) / SUM(n) OVER (PARTITION BY label), 6) AS rate FROM counts""",
)
def confusion_normalised(spark, sf_dir):
    return th.confusion_normalised(counts_at_half(spark, sf_dir))


@register(
    "classification_metrics",
    sql=SQL_COUNTS
    + """,
wide AS (SELECT
   CAST(SUM(CASE WHEN label = 0 AND prediction = 0 THEN n ELSE 0 END) AS DOUBLE) AS tn,
   CAST(SUM(CASE WHEN label = 0 AND prediction = 1 THEN n ELSE 0 END) AS DOUBLE) AS fp,
   CAST(SUM(CASE WHEN label = 1 AND prediction = 0 THEN n ELSE 0 END) AS DOUBLE) AS fn,
   CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN n ELSE 0 END) AS DOUBLE) AS tp
   FROM counts),
r AS (SELECT *, tp + fp + tn + fn AS n,
   CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
   CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
   CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
   CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0 FROM wide),
s AS (SELECT *,
   CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1_1,
   CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f1_0,
   CASE WHEN n = 0 THEN 0.0 ELSE (tp + fn) / n END AS w1,
   CASE WHEN n = 0 THEN 0.0 ELSE (tn + fp) / n END AS w0 FROM r)
SELECT ROUND(CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END, 4) AS accuracy,
       ROUND(w0 * p0 + w1 * p1, 4) AS weighted_precision,
       ROUND(w0 * r0 + w1 * r1, 4) AS weighted_recall,
       ROUND(w0 * f1_0 + w1 * f1_1, 4) AS f1
FROM s""",
)
def classification_metrics(spark, sf_dir):
    return th.classification_metrics(counts_at_half(spark, sf_dir))

