"""Data-quality plans: counts, null profiles, describe, quartiles, median fill."""

from __future__ import annotations

from pyspark.sql import functions as F

from event_ml.operators import quality as q
from event_ml.plans.registry import register
from event_ml.sources.tables import (
    NUMERIC_FEATURES,
    SQL_DIRTY,
    SQL_EVENTS,
    dirty_events,
    events,
    read_table,
)

DIRTY_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_empty", "l_const"]
FILL_COLS = ["l_quantity", "l_discount", "l_tax"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


@register("row_count", sql="SELECT COUNT(*) AS n_rows FROM lineitem")
def row_count(spark, sf_dir):
    return q.row_count(read_table(spark, sf_dir, "lineitem"))


@register(
    "label_distribution",
    sql=f"""WITH {SQL_EVENTS},
c AS (SELECT label, COUNT(*) AS "count" FROM ev GROUP BY label)
SELECT label, "count", ("count" * 20000 + SUM("count") OVER ()) // (2 * SUM("count") OVER ()) / 100 AS pct
FROM c""",
)
def label_distribution(spark, sf_dir):
    return q.label_distribution(events(spark, sf_dir), "label")


_NULL_PARTS = [
    f"""SELECT '{c}' AS feature,
       CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
       CAST(SUM(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END) AS BIGINT) AS null_or_nan_count,
       COUNT(*) AS n FROM dirty"""
    for c in DIRTY_COLS
]


@register(
    "null_profile",
    sql=f"""WITH {SQL_DIRTY},
prof AS ({_union(_NULL_PARTS)})
SELECT feature, null_count, null_or_nan_count,
       round_even(CAST(null_or_nan_count AS DOUBLE) / n * 100, 4) AS null_pct,
       COUNT(*) OVER () AS n_affected_columns
FROM prof WHERE null_or_nan_count > 0""",
)
def null_profile(spark, sf_dir):
    return q.null_profile(dirty_events(spark, sf_dir), DIRTY_COLS)


def _any(pred: str, cols) -> str:
    return " OR ".join(pred.format(c=c) for c in cols)


_INV = NUMERIC_FEATURES


@register(
    "invalid_rows",
    sql=f"""WITH {SQL_DIRTY}
SELECT COUNT(*) AS n_rows,
  CAST(SUM(CASE WHEN {_any('{c} IS NULL', _INV)} THEN 1 ELSE 0 END) AS BIGINT) AS n_null_rows,
  CAST(SUM(CASE WHEN {_any('COALESCE(isnan({c}), false)', _INV)} THEN 1 ELSE 0 END) AS BIGINT) AS n_nan_rows,
  CAST(SUM(CASE WHEN {_any('COALESCE(isinf({c}), false)', _INV)} THEN 1 ELSE 0 END) AS BIGINT) AS n_inf_rows,
  CAST(SUM(CASE WHEN {_any('{c} IS NULL OR COALESCE(isnan({c}), false) OR COALESCE(isinf({c}), false)', _INV)}
           THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid_rows
FROM dirty""",
)
def invalid_rows(spark, sf_dir):
    return q.invalid_summary(dirty_events(spark, sf_dir), _INV)


_DESC_PARTS = [
    f"""SELECT '{c}' AS feature, COUNT({c}) AS "count", ROUND(AVG({c}), 9) AS mean,
       ROUND(STDDEV_SAMP({c}), 9) AS stddev, MIN({c}) AS "min", MAX({c}) AS "max" FROM lineitem"""
    for c in NUMERIC_FEATURES
]


@register("describe_numeric", sql=_union(_DESC_PARTS))
def describe_numeric(spark, sf_dir):
    return q.describe_numeric(read_table(spark, sf_dir, "lineitem"), NUMERIC_FEATURES, digits=9)


_QUART_PARTS = [
    f"""SELECT '{c}' AS feature, COUNT({c}) AS "count",
       round_even(AVG({c}), 4) AS mean, round_even(STDDEV_SAMP({c}), 4) AS stddev,
       round_even(MIN({c}), 4) AS "min",
       round_even(quantile_cont({c}, 0.25), 4) AS q25,
       round_even(quantile_cont({c}, 0.5), 4) AS q50,
       round_even(quantile_cont({c}, 0.75), 4) AS q75,
       round_even(MAX({c}), 4) AS "max" FROM lineitem"""
    for c in NUMERIC_FEATURES
]


@register("describe_quartiles", sql=_union(_QUART_PARTS))
def describe_quartiles(spark, sf_dir):
    return q.describe_quartiles(read_table(spark, sf_dir, "lineitem"), NUMERIC_FEATURES)


_FILL_PARTS = [
    f"""SELECT '{c}' AS feature, m.med AS median,
       CAST(SUM(CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END) AS BIGINT) AS n_filled,
       ROUND(SUM(CASE WHEN {c} IS NULL OR isnan({c}) THEN m.med ELSE {c} END), 4) AS filled_sum
FROM dirty CROSS JOIN (SELECT quantile_cont({c}, 0.5) FILTER (WHERE NOT isnan({c})) AS med FROM dirty) m
GROUP BY m.med"""
    for c in FILL_COLS
]


@register("median_fill", sql=f"WITH {SQL_DIRTY}\n" + _union(_FILL_PARTS))
def median_fill(spark, sf_dir):
    dirty = dirty_events(spark, sf_dir)
    flagged = dirty.select(*FILL_COLS, *[(F.col(c).isNull() | F.isnan(c)).alias(f"gone_{c}") for c in FILL_COLS])
    filled, medians = q.median_fill(flagged, FILL_COLS, exact=True)
    one = filled.agg(
        *[F.count_if(f"gone_{c}").cast("long").alias(f"n_{c}") for c in FILL_COLS],
        *[F.round(F.sum(c), 4).alias(f"s_{c}") for c in FILL_COLS],
    )
    items = [
        F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").alias("n_filled"), F.col(f"s_{c}").alias("filled_sum"))
        for c in FILL_COLS
    ]
    stats = one.select(F.explode(F.array(*items)).alias("t")).select("t.*")
    return medians.join(F.broadcast(stats), "feature").select("feature", "median", "n_filled", "filled_sum")


@register(
    "distinct_violations",
    sql=f"""WITH {SQL_EVENTS}
SELECT label AS value, COUNT(*) AS n, label IN (0.0, 1.0) AS in_domain FROM ev GROUP BY label""",
)
def distinct_violations(spark, sf_dir):
    return q.distinct_values(events(spark, sf_dir), "label", [0.0, 1.0])


_ALLNULL_PARTS = [
    f"SELECT '{c}' AS feature, COUNT({c}) AS n_non_null, COUNT({c}) = 0 AS all_null FROM dirty"
    for c in DIRTY_COLS
]


@register("all_null_columns", sql=f"WITH {SQL_DIRTY}\n" + _union(_ALLNULL_PARTS))
def all_null_columns(spark, sf_dir):
    return q.all_null_columns(dirty_events(spark, sf_dir), DIRTY_COLS)
