"""Exploratory plans: correlations, histograms, separation, LOD values,
dimension sums, metric selection, dashboard filters, feature groups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from event_ml.functions.columns import literal_table
from event_ml.operators import explore as x
from event_ml.operators.features import EventFeatureEngineer
from event_ml.plans.registry import register
from event_ml.sources.tables import NUMERIC_FEATURES, SQL_EVENTS, events, read_table

FEATS = NUMERIC_FEATURES


def _union(parts):
    return "\nUNION ALL\n".join(parts)


_PAIRS = [(FEATS[i], FEATS[j]) for i in range(len(FEATS)) for j in range(i)]


@register(
    "correlation_pairs",
    sql=_union(
        [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, ROUND(CORR({a}, {b}), 6) AS r FROM lineitem" for a, b in _PAIRS]
    ),
)
def correlation_pairs(spark, sf_dir):
    return x.correlation_pairs(read_table(spark, sf_dir, "lineitem"), FEATS)


_LONG = _union([f"SELECT '{c}' AS feature, label, CAST({c} AS DOUBLE) AS value FROM ev" for c in FEATS])


@register(
    "density_histogram",
    sql=f"""WITH {SQL_EVENTS},
long AS ({_LONG}),
st0 AS (SELECT feature, label, MIN(value) AS vmin, MAX(value) AS vmax, COUNT(*) AS n FROM long GROUP BY feature, label),
st AS (SELECT feature, label, n,
         CASE WHEN vmin = vmax THEN vmin - CAST(0.5 AS DOUBLE) ELSE vmin END AS lo,
         CASE WHEN vmin = vmax THEN vmax + CAST(0.5 AS DOUBLE) ELSE vmax END AS hi FROM st0),
b AS (SELECT l.feature, l.label,
        CAST(LEAST(FLOOR((l.value - s.lo) * 60 / (s.hi - s.lo)), 59) AS INTEGER) AS bin
      FROM long l JOIN st s ON l.feature = s.feature AND l.label = s.label),
c AS (SELECT feature, label, bin, COUNT(*) AS cnt FROM b GROUP BY feature, label, bin),
g AS (SELECT s.*, CAST(r.range AS INTEGER) AS bin FROM st s CROSS JOIN range(60) r)
SELECT g.feature, g.label, g.bin, g.lo + g.bin * ((g.hi - g.lo) / 60) AS bin_lo,
       CAST(COALESCE(c.cnt, 0) AS BIGINT) AS "count",
       COALESCE(c.cnt, 0) / (g.n * ((g.hi - g.lo) / 60)) AS density
FROM g LEFT JOIN c ON g.feature = c.feature AND g.label = c.label AND g.bin = c.bin""",
)
def density_histogram(spark, sf_dir):
    return x.density_histogram(events(spark, sf_dir), FEATS, "label", bins=60)


_SEP = _union(
    [
        f"""SELECT '{c}' AS feature,
  AVG({c}) FILTER (WHERE label = 1) AS m1, AVG({c}) FILTER (WHERE label = 0) AS m0,
  VAR_SAMP({c}) FILTER (WHERE label = 1) AS v1, VAR_SAMP({c}) FILTER (WHERE label = 0) AS v0 FROM ev"""
        for c in FEATS
    ]
)


@register(
    "class_separation",
    sql=f"""WITH {SQL_EVENTS}, s AS ({_SEP})
SELECT feature, ROUND(m1, 9) AS mean_pos, ROUND(m0, 9) AS mean_neg,
       ROUND((m1 - m0) / SQRT((v1 + v0) / 2), 9) AS smd FROM s""",
)
def class_separation(spark, sf_dir):
    return x.class_separation(events(spark, sf_dir), FEATS, "label", digits=9)


@register(
    "lod_label_count",
    sql=f"""WITH {SQL_EVENTS}
SELECT row_key, label, COUNT(*) OVER (PARTITION BY label) AS label_count FROM ev""",
)
def lod_label_count(spark, sf_dir):
    ev = events(spark, sf_dir).select("row_key", "label")
    return x.with_group_value(ev, ["label"], F.count(F.lit(1)), "label_count").select(
        "row_key", "label", "label_count"
    )


_LONG_KEYED = _union(
    [f"SELECT row_key, '{c}' AS feature_name, CAST({c} AS DOUBLE) AS value FROM ev" for c in FEATS]
)


@register(
    "lod_feature_avg",
    sql=f"""WITH {SQL_EVENTS}, long AS ({_LONG_KEYED})
SELECT row_key, feature_name, value, ROUND(AVG(value) OVER (PARTITION BY feature_name), 9) AS feature_avg
FROM long""",
)
def lod_feature_avg(spark, sf_dir):
    ev = events(spark, sf_dir).select("row_key", *[F.col(c).cast("double").alias(c) for c in FEATS])
    long = x.unpivot_features(ev, ["row_key"], FEATS)
    out = x.with_group_value(long, ["feature_name"], F.avg("value"), "feature_avg")
    return out.select("row_key", "feature_name", "value", F.round("feature_avg", 9).alias("feature_avg"))


@register(
    "sum_by_dimension",
    sql="""SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty,
       ROUND(SUM(l_extendedprice), 2) AS sum_price, COUNT(*) AS n_rows
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def sum_by_dimension(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    out = x.group_sums(
        li, ["l_returnflag", "l_linestatus"], {"sum_qty": "l_quantity", "sum_price": "l_extendedprice"}, count="n_rows"
    )
    return out.withColumn("sum_price", F.round("sum_price", 2))


@register(
    "count_sum_unpivot",
    sql="""WITH w AS (SELECT l_returnflag, CAST(COUNT(*) AS DOUBLE) AS n_rows,
                  CAST(SUM(l_quantity) AS DOUBLE) AS sum_l_quantity FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, 'n_rows' AS measure_name, n_rows AS value FROM w
UNION ALL SELECT l_returnflag, 'sum_l_quantity', sum_l_quantity FROM w""",
)
def count_sum_unpivot(spark, sf_dir):
    return x.count_sum_long(read_table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity")


SQL_MODEL_METRICS = """mm AS (
  SELECT l_returnflag || '-' || l_linestatus AS model, COUNT(*) AS n_rows,
         ROUND(AVG(l_quantity), 9) AS avg_qty, ROUND(AVG(l_discount), 9) AS avg_disc,
         ROUND(AVG(l_extendedprice), 9) AS avg_price
  FROM lineitem GROUP BY l_returnflag, l_linestatus)"""


def model_metrics(spark, sf_dir):
    """Model metric table binding: one 'model' per (returnflag, linestatus)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(F.concat_ws("-", "l_returnflag", "l_linestatus").alias("model")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg("l_quantity"), 9).alias("avg_qty"),
        F.round(F.avg("l_discount"), 9).alias("avg_disc"),
        F.round(F.avg("l_extendedprice"), 9).alias("avg_price"),
    )


@register(
    "selected_metric",
    sql=f"WITH {SQL_MODEL_METRICS}\nSELECT model, 'avg_disc' AS metric, CAST(avg_disc AS DOUBLE) AS value FROM mm",
)
def selected_metric(spark, sf_dir):
    return x.select_metric(model_metrics(spark, sf_dir), "avg_disc", ["model"])


_IMP_PARTS = _union(
    [
        f"SELECT l_returnflag || '-' || l_linestatus AS model, '{c}' AS feature, STDDEV_SAMP({c}) AS sd "
        f"FROM lineitem GROUP BY l_returnflag, l_linestatus"
        for c in FEATS
    ]
)


@register(
    "semi_filter_model",
    sql=f"""WITH {SQL_MODEL_METRICS},
s AS ({_IMP_PARTS}),
imp AS (SELECT model, feature, ROUND(sd / SUM(sd) OVER (PARTITION BY model), 6) AS spread_share FROM s),
chosen AS (SELECT model FROM mm ORDER BY avg_disc DESC, model LIMIT 1)
SELECT model, feature, spread_share FROM imp WHERE model IN (SELECT model FROM chosen)""",
)
def semi_filter_model(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").withColumn(
        "model", F.concat_ws("-", "l_returnflag", "l_linestatus")
    )
    sd = li.groupBy("model").agg(*[F.stddev_samp(c).alias(c) for c in FEATS])
    long = sd.unpivot(["model"], FEATS, "feature", "sd")
    imp = long.select(
        "model",
        "feature",
        F.round(F.col("sd") / F.sum("sd").over(Window.partitionBy("model")), 6).alias("spread_share"),
    )
    chosen = model_metrics(spark, sf_dir).orderBy(F.col("avg_disc").desc(), F.col("model")).limit(1)
    return x.filter_by_selection(imp, chosen, "model")


# Feature dimension of the lineitem binding: (name, grp, ordinal).
ENG_NAMES = ["eng_price_per_qty", "eng_disc_plus_tax", "eng_flag_count", "eng_tax_per_disc", "eng_disc_tax_gap"]
FEATURE_DIM = [
    ("l_quantity", "low_level", 1),
    ("l_extendedprice", "low_level", 2),
    ("l_discount", "high_level", 3),
    ("l_tax", "high_level", 4),
] + [(n, "engineered", 5 + i) for i, n in enumerate(ENG_NAMES)]


def lineitem_engineer() -> EventFeatureEngineer:
    return EventFeatureEngineer(
        ratio_num="l_extendedprice",
        ratio_den="l_quantity",
        sum_cols=["l_discount", "l_tax"],
        flag_cols=["l_discount", "l_tax", "l_quantity", "l_extendedprice"],
        flag_thresholds=[0.05, 0.04, 25.0, 50000.0],
        ratio2_num="l_tax",
        ratio2_den="l_discount",
        diff_a="l_discount",
        diff_b="l_tax",
        output_cols=ENG_NAMES,
    )


SQL_ENG = """eng AS (
  SELECT ev.*,
    l_extendedprice / (l_quantity + 1e-6) AS eng_price_per_qty,
    l_discount + l_tax AS eng_disc_plus_tax,
    CAST(l_discount > CAST(0.05 AS DOUBLE) AS INTEGER) + CAST(l_tax > CAST(0.04 AS DOUBLE) AS INTEGER)
      + CAST(l_quantity > CAST(25 AS DOUBLE) AS INTEGER) + CAST(l_extendedprice > CAST(50000 AS DOUBLE) AS INTEGER)
      AS eng_flag_count,
    l_tax / (l_discount + 1e-6) AS eng_tax_per_disc,
    abs(l_discount - l_tax) AS eng_disc_tax_gap
  FROM ev)"""

_GRP_MEANS = _union(
    [f"SELECT '{n}' AS feature, AVG(CAST({n} AS DOUBLE)) AS mean FROM eng" for n, _, _ in FEATURE_DIM]
)
_DIM_VALUES = ", ".join(f"('{n}', '{g}', {o})" for n, g, o in FEATURE_DIM)


@register(
    "feature_groups",
    sql=f"""WITH {SQL_EVENTS}, {SQL_ENG},
m AS ({_GRP_MEANS}),
dim AS (SELECT name, grp, CAST(ordinal AS INTEGER) AS ordinal FROM (VALUES {_DIM_VALUES}) t(name, grp, ordinal))
SELECT m.feature, dim.grp, dim.ordinal, ROUND(m.mean, 9) AS mean FROM m LEFT JOIN dim ON m.feature = dim.name""",
)
def feature_groups(spark, sf_dir):
    eng = lineitem_engineer().transform(events(spark, sf_dir))
    names = [n for n, _, _ in FEATURE_DIM]
    means = eng.agg(*[F.avg(F.col(n).cast("double")).alias(n) for n in names])
    long = means.unpivot([], names, "feature", "mean")
    dim = literal_table(spark, FEATURE_DIM, "name string, grp string, ordinal int")
    return x.tag_features(long, "feature", dim).select("feature", "grp", "ordinal", F.round("mean", 9).alias("mean"))
