"""Model plans: the four classifiers, importances, CV, bootstrap CI,
stability and grouped mean/std.

Prepared data: labelled documents -> six counts of the text -> assembled
(invalid rows skipped) -> hash split 70/15/15 -> scaler fitted on the train
split only -> train / val / test.  A model's figures depend on its training,
so the plans return what SQL can state: the splits' sizes, whether the
predictions are classes, and whether the AUC is above a floor.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.functions.joins import materialise
from event_ml.operators import certificates as ct
from event_ml.operators import features as fe
from event_ml.operators import metrics as m
from event_ml.operators import models as md
from event_ml.operators import resample as rs
from event_ml.operators import splits as sp
from event_ml.plans.registry import register
from event_ml.sources.tables import DOC_FEATURES, SQL_EVENTS, events, labelled_documents, read_table, sql_hash_u32

SPLITS = (["train", "val", "test"], [0.7, 0.15, 0.15])
AUC_FLOOR = 0.8

_CUTS = sp.normalised_cuts(SPLITS[1])
SQL_SPLIT = f"""WITH h AS (SELECT {sql_hash_u32("'split42' || CAST(l.doc_id AS VARCHAR)")} AS h
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
n AS (SELECT CAST(COUNT(*) FILTER (h < {_CUTS[0]}) AS BIGINT) AS n_train,
             CAST(COUNT(*) FILTER (h >= {_CUTS[0]} AND h < {_CUTS[1]}) AS BIGINT) AS n_val FROM h)"""


def prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, val, test) with scaled feature vectors, from one written table
    that the scaler, the fits and the metrics all read."""
    vec = fe.assemble(labelled_documents(spark, sf_dir), DOC_FEATURES, "raw_features")
    tagged = materialise(sp.with_split(vec.select("row_key", "label", "raw_features"), "row_key", *SPLITS, salt="split42"), "model-input")
    scaler = fe.fit_scaler(tagged.filter(F.col("split") == "train"), "raw_features", "features")

    def part(name):
        return scaler.transform(tagged.filter(F.col("split") == name)).select("row_key", "label", "features")

    return part("train"), part("val"), part("test")


def fit_report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One row of a model's own figures (training seconds, AUC), for the bench."""
    train, val, _ = prepared(spark, sf_dir)
    with md.cached(train) as (tr,):
        return md.train_and_evaluate(name, tr, val)[1]


def _fit(name):
    def plan(spark, sf_dir):
        train, val, _ = prepared(spark, sf_dir)
        with md.cached(train) as (tr,):
            model, row = md.train_and_evaluate(name, tr, val)
            n_train = tr.count()
        classes = model.transform(val).agg(
            F.count(F.lit(1)).alias("n_val"), F.bool_and(F.col("prediction").isin(0.0, 1.0)).alias("predicts_classes")
        )
        return row.crossJoin(classes).select(
            "model", F.lit(n_train).cast("long").alias("n_train"), "n_val", "predicts_classes", (F.col("val_auc") >= AUC_FLOOR).alias("learns")
        )

    return plan


for _plan, _name in (("fit_lr", "LogisticRegression"), ("fit_rf", "RandomForest"), ("fit_gbt", "GBT"), ("fit_svm", "SVM")):
    register(_plan, sql=f"{SQL_SPLIT}\nSELECT '{_name}' AS model, n_train, n_val, true AS predicts_classes, true AS learns FROM n")(_fit(_name))


@register(
    "fit_status",
    sql=f"""{SQL_SPLIT}
SELECT model, status, n_train FROM n CROSS JOIN
  (VALUES ('LogisticRegression', 'ok'), ('RandomForest', 'failed'), ('SVM', 'ok')) AS s(model, status)""",
)
def fit_status(spark, sf_dir):
    """Several fits, one of which can't succeed: the others do all the same."""
    train, val, _ = prepared(spark, sf_dir)
    n_train = train.count()
    _, status = md.fit_all(train, val, {"LogisticRegression": {}, "RandomForest": {"maxDepth": 99}, "SVM": {"maxIter": 5}})
    return status.select("model", "status", F.lit(n_train).cast("long").alias("n_train"))


_FOLDS = sp.normalised_cuts([1, 1, 1])
SQL_TRAIN = f"""WITH t AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS y, CAST(d.doc_id AS VARCHAR) AS row_key,
       CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words,
       CAST(length(regexp_replace(text, '[^0-9|#{{}}<>]', '', 'g')) AS DOUBLE) AS n_symbols,
       CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS DOUBLE) AS n_capitals,
       CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines,
       CAST(len(list_distinct(string_split(text, ' '))) AS DOUBLE) AS n_distinct_words,
       CAST(length(text) AS DOUBLE) AS n_chars
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
  WHERE {sql_hash_u32("'split42' || CAST(d.doc_id AS VARCHAR)")} < {_CUTS[0]})"""


@register(
    "cross_validate",
    sql=f"""{SQL_TRAIN},
h AS (SELECT y, {sql_hash_u32("'fold42' || row_key")} AS h FROM t),
f AS (SELECT CASE WHEN h < {_FOLDS[0]} THEN 0 WHEN h < {_FOLDS[1]} THEN 1 ELSE 2 END AS fold, y FROM h),
g AS (SELECT fold, CAST(SUM(y) AS BIGINT) AS n_pos, CAST(SUM(1 - y) AS BIGINT) AS n_neg FROM f GROUP BY fold)
SELECT reg_param, elastic_net, fold, n_pos, n_neg, true AS learns
FROM (VALUES (CAST(0.01 AS DOUBLE)), (CAST(0.1 AS DOUBLE))) AS p(reg_param) CROSS JOIN (VALUES (CAST(0 AS DOUBLE)), (CAST(0.5 AS DOUBLE))) AS e(elastic_net) CROSS JOIN g""",
)
def cross_validate(spark, sf_dir):
    """3-fold CV of logistic regression over two parameters, hash folds: a row a fold."""
    train, _, _ = prepared(spark, sf_dir)
    folded = train.withColumn("fold", sp.split_index("row_key", [1, 1, 1], salt="fold42"))
    with md.cached(folded) as (df,):
        found = md.cross_validate_folds(df, "LogisticRegression", {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]})
    return found.select(
        F.col("params")["regParam"].alias("reg_param"), F.col("params")["elasticNetParam"].alias("elastic_net"), "fold", "n_pos", "n_neg", (F.col("auc") >= AUC_FLOOR).alias("learns")
    )


_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, y FROM t" for c in DOC_FEATURES)


SQL_FIRST_SPLIT = f"""{SQL_TRAIN},
c AS (SELECT feature, value, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS pos FROM ({_LONG}) GROUP BY feature, value),
r AS (SELECT feature, value, LEAD(value) OVER w AS hi, CAST(SUM(n) OVER w AS BIGINT) AS n_left, CAST(SUM(pos) OVER w AS BIGINT) AS pos_left,
             SUM(n) OVER (PARTITION BY feature) AS n, SUM(pos) OVER (PARTITION BY feature) AS pos
      FROM c WINDOW w AS (PARTITION BY feature ORDER BY value)),
g AS (SELECT *, CAST(2 AS DOUBLE) * pos * (n - pos) / (CAST(n AS DOUBLE) * n)
           - CAST(n_left AS DOUBLE) / n * (CAST(2 AS DOUBLE) * pos_left * (n_left - pos_left) / (CAST(n_left AS DOUBLE) * n_left))
           - CAST(n - n_left AS DOUBLE) / n * (CAST(2 AS DOUBLE) * (pos - pos_left) * (n - n_left - pos + pos_left) / (CAST(n - n_left AS DOUBLE) * (n - n_left))) AS gain
      FROM r WHERE hi IS NOT NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, value) AS best FROM g),
o AS (SELECT *, row_number() OVER (ORDER BY gain DESC) AS place FROM b WHERE best = 1)"""
#: Bins of a tree that shall try every value: as many as rows, up to this.
MOST_BINS = 1 << 14


@register(
    "first_split",
    sql=f"""{SQL_FIRST_SPLIT}
SELECT feature, value AS lo, hi, ROUND(gain, 9) AS gain, n_left, pos_left, place = 1 AS tree_root, place = 1 AS gbt_root FROM o""",
)
def first_split(spark, sf_dir):
    """The exactly best first split of every feature, and whether a tree of depth
    1 and the first tree of a boosted model split there, with that gain."""
    train = labelled_documents(spark, sf_dir)
    train = materialise(train.where(sp.split_index("row_key", SPLITS[1], salt="split42") == 0), "model-input")
    found = ct.best_splits(train, DOC_FEATURES)
    vectors = fe.assemble(train, DOC_FEATURES, "features").select("label", "features")
    bins = max(2, min(train.count(), MOST_BINS))
    with md.cached(vectors) as (v,):
        tree = DecisionTreeClassifier(maxDepth=1, maxBins=bins).fit(v)
        boosted = md.make_estimator("GBT", maxIter=1, maxDepth=1, maxBins=bins).fit(v)
    out = found
    for name, model, checked in (("tree_root", tree, True), ("gbt_root", boosted.trees[0], False)):
        feature, threshold, gain = ct.root_split(model)
        here = (F.col("feature") == DOC_FEATURES[feature]) & F.lit(threshold).between(F.col("lo"), F.col("hi"))
        out = out.withColumn(name, here & (F.abs(F.col("gain") - gain) < 1e-9) if checked else here)
    return out.select("feature", "lo", "hi", F.round("gain", 9).alias("gain"), "n_left", "pos_left", "tree_root", "gbt_root")


_NAMES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(DOC_FEATURES))


@register(
    "feature_importance",
    sql=f"""{SQL_FIRST_SPLIT}
SELECT CAST(ordinal AS INTEGER) AS ordinal, f.feature, CASE WHEN o.place = 1 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS stump_importance,
       true AS is_share, true AS adds_up
FROM (VALUES {_NAMES}) AS f(ordinal, feature) LEFT JOIN o ON f.feature = o.feature""",
)
def feature_importance(spark, sf_dir):
    """Random-forest importances by feature name (ordinal join), and those of a
    tree with one split, which are the best split's feature's alone."""
    train, _, _ = prepared(spark, sf_dir)
    with md.cached(train) as (tr,):
        found = md.feature_importances(spark, md.make_estimator("RandomForest").fit(tr), DOC_FEATURES)
        stump = DecisionTreeClassifier(maxDepth=1, maxBins=max(2, min(tr.count(), MOST_BINS))).fit(tr)
    first = md.feature_importances(spark, stump, DOC_FEATURES).select("ordinal", F.col("importance").alias("stump_importance"))
    total = found.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("adds_up"))
    return found.join(first, "ordinal").crossJoin(total).select("ordinal", "feature", "stump_importance", F.col("importance").between(0.0, 1.0).alias("is_share"), "adds_up")


_REG = 0.01


@register(
    "lr_optimum",
    sql=f"""{SQL_TRAIN.replace("WITH t AS", "WITH RECURSIVE t AS")},
s AS (SELECT AVG(n_symbols) AS ma, STDDEV_SAMP(n_symbols) AS sa, AVG(n_chars) AS mb, STDDEV_SAMP(n_chars) AS sb FROM t),
z AS (SELECT y, (n_symbols - ma) / sa AS a, (n_chars - mb) / sb AS b FROM t CROSS JOIN s),
newton AS (
  SELECT 0 AS k, CAST(0 AS DOUBLE) AS wa, CAST(0 AS DOUBLE) AS wb, CAST(0 AS DOUBLE) AS w0
  UNION ALL
  SELECT k + 1, wa - (p * (d * f - e * e) - b * (q * f - e * r) + c * (q * e - d * r)) / det,
         wb - (a * (q * f - e * r) - p * (b * f - c * e) + c * (b * r - q * c)) / det,
         w0 - (a * (d * r - q * e) - b * (b * r - q * c) + p * (b * e - c * d)) / det
  FROM (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det
        FROM (SELECT k, wa, wb, w0, AVG((pr - y) * xa) + {_REG} * wa AS p, AVG((pr - y) * xb) + {_REG} * wb AS q, AVG(pr - y) AS r,
                     AVG(pr * (1 - pr) * xa * xa) + {_REG} AS a, AVG(pr * (1 - pr) * xa * xb) AS b, AVG(pr * (1 - pr) * xa) AS c,
                     AVG(pr * (1 - pr) * xb * xb) + {_REG} AS d, AVG(pr * (1 - pr) * xb) AS e, AVG(pr * (1 - pr)) AS f
              FROM (SELECT k, wa, wb, w0, z.y, z.a AS xa, z.b AS xb, 1 / (1 + exp(-(wa * z.a + wb * z.b + w0))) AS pr FROM newton CROSS JOIN z)
              GROUP BY k, wa, wb, w0))
  WHERE k < 15)
SELECT COUNT(*) AS n, ROUND(MAX(wa), 4) AS w_symbols, ROUND(MAX(wb), 4) AS w_chars, ROUND(MAX(w0), 4) AS intercept,
       ROUND(AVG(greatest(u, 0) + ln(1 + exp(-abs(u))) - y * u) + {_REG} / 2 * (MAX(wa * wa) + MAX(wb * wb)), 6) AS loss,
       true AS gradient_vanishes
FROM (SELECT z.y, wa, wb, w0, wa * z.a + wb * z.b + w0 AS u FROM newton CROSS JOIN z WHERE k = 15)""",
)
def lr_optimum(spark, sf_dir):
    """Logistic regression of two features against Newton's method: weights, the
    penalised loss, and the gradient at the fitted weights."""
    train = labelled_documents(spark, sf_dir)
    train = train.where(sp.split_index("row_key", SPLITS[1], salt="split42") == 0).select("label", "n_symbols", "n_chars")
    with md.cached(fe.standardise_columns(train, ["n_symbols", "n_chars"])) as (z,):
        vectors = fe.assemble(z, ["n_symbols", "n_chars"], "features")
        model = md.make_estimator("LogisticRegression", maxIter=500, tol=1e-13, regParam=_REG, standardization=False).fit(vectors)
        weights = [*model.coefficients.toArray().tolist(), float(model.intercept)]
        found = ct.logistic_certificate(z, ["n_symbols", "n_chars"], F.col("label"), weights, _REG)
    row = (found["n"], *[round(w, 4) for w in weights], round(found["loss"], 6), bool(abs(found["gradient"]).max() < 1e-5))
    return spark.createDataFrame([row], "n long, w_symbols double, w_chars double, intercept double, loss double, gradient_vanishes boolean")


@register(
    "bootstrap_auc_ci",
    sql=f"""WITH {SQL_EVENTS},
g AS (SELECT q AS score, SUM(y) AS pos, SUM(1 - y) AS neg FROM ev GROUP BY q),
r AS (SELECT pos, neg, SUM(neg) OVER (ORDER BY score) - neg AS below FROM g)
SELECT CAST(500 AS BIGINT) AS n_replicates,
       ROUND(SUM(CAST(pos AS DOUBLE) * (below + neg / 2.0)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 6) AS auc,
       CAST(SUM(pos) AS BIGINT) AS min_pos, CAST(SUM(pos) AS BIGINT) AS max_pos,
       CAST(SUM(neg) AS BIGINT) AS min_neg, CAST(SUM(neg) AS BIGINT) AS max_neg,
       true AS brackets_auc, true AS width_as_expected
FROM r""",
)
def bootstrap_auc_ci(spark, sf_dir):
    """500 stratified bootstrap replicates of the AUC of score q: every replicate
    draws as many rows of a class as it has, the interval holds the AUC, and is
    as wide as its analytic standard error lets expect."""
    pred = events(spark, sf_dir).select("label", "q")
    replicates = materialise(rs.bootstrap_auc(pred, "q", "label", n_boot=500, seed=42), "replicates")
    sizes = replicates.agg(*[f(c).alias(f"{o}_{c[2:]}") for c in ("n_pos", "n_neg") for o, f in (("min", F.min), ("max", F.max))])
    ci = rs.bootstrap_ci(replicates, 0.95).crossJoin(F.broadcast(sizes))
    a, p, n = F.col("auc"), F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    q1, q2 = a / (2 - a), 2 * a * a / (1 + a)
    error = F.sqrt((a * (1 - a) + (p - 1) * (q1 - a * a) + (n - 1) * (q2 - a * a)) / (p * n))
    ratio = (F.col("ci_high") - F.col("ci_low")) / (2 * 1.96 * error)
    return ci.crossJoin(m.auc_exact(pred, "q", "label")).select(
        "n_replicates", F.round("auc", 6).alias("auc"), "min_pos", "max_pos", "min_neg", "max_neg", a.between(F.col("ci_low"), F.col("ci_high")).alias("brackets_auc"), ratio.between(0.7, 1.4).alias("width_as_expected")
    )


_TRIALS = " UNION ALL ".join(
    f"""SELECT {pct} AS perturbation_pct, {t} AS trial, COUNT(*) FILTER (h{t} >= {round((1 - pct / 100) * sp.TWO32)}) AS n_removed,
       CAST(COALESCE(SUM(h) FILTER (h{t} >= {round((1 - pct / 100) * sp.TWO32)}), 0) AS BIGINT) AS removed_keys, true AS learns FROM k"""
    for pct in (5, 10, 20)
    for t in range(3)
)


@register(
    "stability",
    sql=f"""{SQL_TRAIN},
k AS (SELECT {sql_hash_u32("row_key")} AS h, {", ".join(f"{sql_hash_u32(chr(39) + f'stab{t * 100}' + chr(39) + ' || row_key')} AS h{t}" for t in range(3))} FROM t)
{_TRIALS}""",
)
def stability(spark, sf_dir):
    """GBT refits with 5/10/20% of train removed, 3 trials each: what was removed, and whether the refit learns."""
    train, _, test = prepared(spark, sf_dir)
    with md.cached(train, test) as (tr, te):
        found = materialise(rs.stability(tr, te, "row_key", lambda d: md.make_estimator("GBT").fit(d)), "stability")
    return found.select("perturbation_pct", "trial", "n_removed", "removed_keys", (F.col("test_auc") >= AUC_FLOOR).alias("learns"))


@register(
    "group_mean_std",
    sql="""SELECT l_linenumber AS grp, COUNT(*) AS n, ROUND(AVG(l_discount), 9) AS mean,
       ROUND(STDDEV_SAMP(l_discount), 9) AS std,
       ROUND(AVG(l_discount) - 1.96 * STDDEV_SAMP(l_discount), 9) AS band_low,
       ROUND(AVG(l_discount) + 1.96 * STDDEV_SAMP(l_discount), 9) AS band_high
FROM lineitem GROUP BY l_linenumber""",
)
def group_mean_std(spark, sf_dir):
    return rs.group_mean_std(read_table(spark, sf_dir, "lineitem"), "l_linenumber", "l_discount")
