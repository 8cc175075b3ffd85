"""Feature plans: engineered columns, assembler report, standardisation
twin, vector serialisation, PCA variance."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from event_ml.functions.columns import vector_string
from event_ml.operators import certificates as ct
from event_ml.operators import features as fe
from event_ml.operators import scaling as sc
from event_ml.plans.explore_plans import ENG_NAMES, SQL_ENG, lineitem_engineer
from event_ml.plans.registry import register
from event_ml.sources.tables import NUMERIC_FEATURES, SQL_DIRTY, SQL_EVENTS, dirty_events, events, read_table

FEATS = NUMERIC_FEATURES


@register(
    "engineered_features",
    sql=f"""WITH {SQL_EVENTS}, {SQL_ENG}
SELECT row_key, CAST(y AS INTEGER) AS raw_label, CAST(y AS DOUBLE) AS label, {", ".join(ENG_NAMES)} FROM eng""",
)
def engineered_features(spark, sf_dir):
    ev = events(spark, sf_dir).select("row_key", F.col("y").alias("label"), *FEATS)
    out = lineitem_engineer().transform(fe.cast_label(ev, "label", "raw_label"))
    return out.select("row_key", "raw_label", "label", *ENG_NAMES)


_VALID = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATS)


@register(
    "assembler_report",
    sql=f"""WITH {SQL_DIRTY}
SELECT COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN {_VALID} THEN 1 ELSE 0 END) AS BIGINT) AS n_kept,
       CAST(SUM(CASE WHEN {_VALID} THEN 0 ELSE 1 END) AS BIGINT) AS n_dropped
FROM dirty""",
)
def assembler_report(spark, sf_dir):
    return fe.assembler_report(dirty_events(spark, sf_dir), FEATS)


_STD_STATS = ", ".join(f"AVG({c}) AS mu_{c}, STDDEV_SAMP({c}) AS sd_{c}" for c in FEATS)
_STD_Z = ", ".join(
    f"CASE WHEN sd_{c} = 0 THEN CAST(0 AS DOUBLE) ELSE ({c} - mu_{c}) / sd_{c} END AS z_{c}" for c in FEATS
)
_STD_OUT = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, ROUND(MAX(mu_{c}), 9) AS mean, ROUND(MAX(sd_{c}), 9) AS stddev,
       ROUND(AVG(z_{c}), 6) + CAST(0 AS DOUBLE) AS scaled_mean, ROUND(STDDEV_SAMP(z_{c}), 6) AS scaled_stddev FROM z"""
    for c in FEATS
)


@register(
    "standardise_sql",
    sql=f"""WITH st AS (SELECT {_STD_STATS} FROM lineitem),
z AS (SELECT st.*, {_STD_Z} FROM lineitem CROSS JOIN st)
{_STD_OUT}""",
)
def standardise_sql(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(*FEATS)
    z = fe.standardise_columns(li, FEATS, keep_stats=True)
    row = z.agg(
        *[F.first(f"_mu_{c}").alias(f"mu_{c}") for c in FEATS], *[F.first(f"_sd_{c}").alias(f"sd_{c}") for c in FEATS],
        *[F.avg(c).alias(f"zm_{c}") for c in FEATS], *[F.stddev_samp(c).alias(f"zs_{c}") for c in FEATS],
    )
    items = [
        F.struct(
            F.lit(c).alias("feature"),
            F.round(f"mu_{c}", 9).alias("mean"),
            F.round(f"sd_{c}", 9).alias("stddev"),
            (F.round(f"zm_{c}", 6) + F.lit(0.0)).alias("scaled_mean"),
            F.round(f"zs_{c}", 6).alias("scaled_stddev"),
        )
        for c in FEATS
    ]
    return row.select(F.explode(F.array(*items)).alias("s")).select("s.*")


_FMT = ", ".join(f"printf('%.6f', {c})" for c in FEATS)


@register(
    "vector_serialise",
    sql=f"""WITH {SQL_EVENTS}
SELECT row_key, label, concat_ws(',', {_FMT}) AS features FROM ev""",
)
def vector_serialise(spark, sf_dir):
    ev = events(spark, sf_dir).select("row_key", "label", *FEATS)
    vec = fe.assemble(ev, FEATS, "vec")
    return vec.select("row_key", "label", vector_string("vec").alias("features"))


@register(
    "pca_variance",
    sql="""WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT i, AVG(v) AS mean FROM e GROUP BY i),
d AS (SELECT vec_id, e.i, v - mean AS v FROM e JOIN m ON e.i = m.i),
c AS (SELECT a.i, b.i AS j, SUM(a.v * b.v) / (COUNT(*) - 1) AS cov FROM d a JOIN d b ON a.vec_id = b.vec_id GROUP BY a.i, b.i),
t AS (SELECT ROUND(SUM(cov) FILTER (i = j), 6) AS total_variance, ROUND(SUM(cov * cov), 6) AS squared_norm FROM c)
SELECT CAST(k.component AS INTEGER) AS component, t.total_variance, t.squared_norm, true AS ordered, true AS share_matches, true AS matches_projection
FROM (SELECT unnest(range(1, 21)) AS component) k CROSS JOIN t""",
)
def pca_variance(spark, sf_dir):
    """The 20 largest of 64 principal components of the embeddings: the spectrum's
    sums are the covariance's trace and squared norm; a component's variance is
    no larger than the one before, its cumulative share is the model's, and it
    is the variance of the projected column."""
    emb = read_table(spark, sf_dir, "embeddings").select(F.col("embedding").cast("array<double>").alias("embedding"), array_to_vector("embedding").alias("raw"))
    dims = len(emb.first()["embedding"])
    found = ct.spectrum(emb, F.col("embedding"), dims, k=20)
    model, shares = fe.fit_pca(emb, "raw", k=20, target=0.95)
    columns = model.transform(emb).select(*[vector_to_array("_pca")[i].alias(f"p{i}") for i in range(20)])
    spread = columns.agg(F.array(*[F.var_samp(f"p{i}") for i in range(20)]).alias("v"))
    spread = spread.select(F.posexplode("v").alias("i", "projected")).select((F.col("i") + 1).alias("component"), "projected")
    before = F.lag("variance").over(Window.orderBy("component"))
    same = (F.abs(F.col("share") - F.col("explained_variance")) < 1e-9) & (F.col("reached_target") == F.col("reached_model"))
    both = found.join(shares.select("component", "explained_variance", F.col("reached_target").alias("reached_model")), "component").join(spread, "component")
    return both.select(
        "component", F.round("total", 6).alias("total_variance"), F.round("squared", 6).alias("squared_norm"), F.coalesce(before >= F.col("variance"), F.lit(True)).alias("ordered"),
        same.alias("share_matches"), (F.abs(F.col("variance") - F.col("projected")) < 1e-6 * F.col("total")).alias("matches_projection"),
    )


@register(
    "partition_balance",
    sql="""SELECT CAST(p AS INTEGER) AS partitions, n AS n_rows, CAST(p AS BIGINT) AS n_filled, CAST(n AS DOUBLE) / p AS ideal_rows,
       CAST(1 AS DOUBLE) / p AS ideal_share, true AS balanced
FROM (SELECT COUNT(*) AS n FROM lineitem) CROSS JOIN (VALUES (8), (16), (32)) AS x(p)""",
)
def partition_balance(spark, sf_dir):
    """Rows of every partition after a repartition, against the ideal line: no
    partition exceeds its share by more than a row for each input partition."""
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey")
    found = sc.partition_balance(rows, (8, 16, 32))
    inputs = rows.select(F.spark_partition_id().alias("part")).distinct().count()
    return found.select("partitions", "n_rows", "n_filled", "ideal_rows", "ideal_share", (F.col("largest") - F.col("ideal_rows") <= inputs).alias("balanced"))
