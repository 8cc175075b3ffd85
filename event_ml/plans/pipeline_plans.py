"""Plans of single steps: preview, missing flags, the preparation chain, and
the approximate medians."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from event_ml.operators import features as fe
from event_ml.operators import quality as q
from event_ml.plans.registry import register
from event_ml.sources.tables import NUMERIC_FEATURES, SQL_DIRTY, dirty_events, read_table


@register("preview", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, sf_dir):
    """The first five rows by key."""
    return q.preview(read_table(spark, sf_dir, "orders"), 5, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


_FLAGS = "\nUNION ALL\n".join(
    f"SELECT row_key, '{c}' AS feature, CAST(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS INTEGER) AS missing FROM dirty" for c in NUMERIC_FEATURES
)


@register("missing_flags", sql=f"WITH {SQL_DIRTY}\n{_FLAGS}")
def missing_flags(spark, sf_dir):
    """One row a value: whether it is null."""
    return q.missing_flags(dirty_events(spark, sf_dir), "row_key", NUMERIC_FEATURES)


_CHAIN = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, COUNT(*) AS n_rows, CAST(0 AS DOUBLE) AS mean, CAST(1 AS DOUBLE) AS stddev FROM kept" for c in ("l_quantity", "l_discount", "l_tax")
)


@register(
    "prep_chain",
    sql=f"""WITH {SQL_DIRTY},
kept AS (SELECT * FROM dirty WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL
         AND NOT isnan(l_quantity) AND NOT isnan(l_discount) AND NOT isnan(l_tax))
{_CHAIN}""",
)
def prep_chain(spark, sf_dir):
    """Assemble (invalid rows skipped) and standardise as one Pipeline."""
    cols = ["l_quantity", "l_discount", "l_tax"]
    dirty = dirty_events(spark, sf_dir).select(*cols)
    out = fe.prep_pipeline(cols).fit(dirty).transform(dirty).select(vector_to_array("features").alias("v"))
    stats = out.agg(*[F.struct(F.count(F.lit(1)).alias("n"), F.avg(F.col("v")[i]).alias("m"), F.stddev_samp(F.col("v")[i]).alias("s")).alias(c) for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c)["n"].alias("n_rows"), (F.round(F.col(c)["m"], 6) + 0.0).alias("mean"), F.round(F.col(c)["s"], 6).alias("stddev")) for c in cols])
    return stats.select(F.explode(rows).alias("r")).select("r.*")


_SKETCH = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, true AS within_error FROM (SELECT 1)" for c in NUMERIC_FEATURES)


@register("median_sketch", sql=_SKETCH)
def median_sketch(spark, sf_dir):
    """Medians with a rank error of 0.001: the share of rows below each is
    within it of one half."""
    li = read_table(spark, sf_dir, "lineitem").select(*NUMERIC_FEATURES)
    medians = q.column_medians(li, NUMERIC_FEATURES, exact=False, rel_error=0.001)
    wide = medians.agg(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"med_{c}") for c in NUMERIC_FEATURES])
    ranks = li.crossJoin(F.broadcast(wide)).agg(
        *[F.struct(F.avg((F.col(c) < F.col(f"med_{c}")).cast("int")).alias("lo"), F.avg((F.col(c) <= F.col(f"med_{c}")).cast("int")).alias("hi")).alias(c) for c in NUMERIC_FEATURES]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), ((F.col(c)["lo"] <= 0.501) & (F.col(c)["hi"] >= 0.499)).alias("within_error")) for c in NUMERIC_FEATURES])
    return ranks.select(F.explode(rows).alias("r")).select("r.*")
