"""Split and sample plans (md5-hash membership, identical in DuckDB)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from event_ml.functions.columns import hash_u32, pct_half_up
from event_ml.operators import splits as sp
from event_ml.plans.registry import register
from event_ml.sinks.writers import scratch_path, write_csv
from event_ml.sources.tables import NUMERIC_FEATURES, SQL_EVENTS, events, sql_hash_u32

FP_MOD = 1000003  # key fingerprint modulus


def _fingerprint(key_col: str = "row_key"):
    return F.sum(F.pmod(hash_u32(key_col), F.lit(FP_MOD))).cast("long").alias("key_fp")


def _sql_fp(key: str = "row_key") -> str:
    return f"CAST(SUM({sql_hash_u32(key)} % {FP_MOD}) AS BIGINT) AS key_fp"


def _sql_case(h: str, cuts: list[int], names: list[str]) -> str:
    parts = " ".join(f"WHEN {h} < {c} THEN '{n}'" for c, n in zip(cuts[:-1], names[:-1]))
    return f"CASE {parts} ELSE '{names[-1]}' END"


def _split_sql(names, weights, salt, key_expr="row_key", extra_group=""):
    cuts = sp.normalised_cuts(weights)
    h = sql_hash_u32(f"'{salt}' || {key_expr}") if salt else sql_hash_u32(key_expr)
    return f"""WITH {SQL_EVENTS},
t AS (SELECT *, {_sql_case(h, cuts, names)} AS split FROM ev),
c AS (SELECT {extra_group}split, COUNT(*) AS n, {_sql_fp()} FROM t GROUP BY {extra_group}split)"""


def _sizes(tagged, group=()):
    counts = tagged.groupBy(*group, "split").agg(F.count(F.lit(1)).alias("n"), _fingerprint())
    total = F.sum("n").over(Window.partitionBy(*group))
    return counts.select(*group, "split", "n", pct_half_up(F.col("n"), total, 2).alias("pct"), "key_fp")


_SPLIT3 = (["train", "val", "test"], [0.7, 0.15, 0.15])
_HOLD = (["test", "train"], [0.12, 0.8])


@register(
    "hash_split_701515",
    sql=_split_sql(*_SPLIT3, "split42")
    + "\nSELECT split, n, (n * 20000 + SUM(n) OVER ()) // (2 * SUM(n) OVER ()) / 100 AS pct, key_fp FROM c",
)
def hash_split_701515(spark, sf_dir):
    return _sizes(sp.with_split(events(spark, sf_dir), "row_key", *_SPLIT3, salt="split42"))


@register(
    "holdout_split",
    sql=_split_sql(*_HOLD, "holdout42")
    + "\nSELECT split, n, (n * 20000 + SUM(n) OVER ()) // (2 * SUM(n) OVER ()) / 100 AS pct, key_fp FROM c",
)
def holdout_split(spark, sf_dir):
    return _sizes(sp.with_split(events(spark, sf_dir), "row_key", *_HOLD, salt="holdout42"))


@register(
    "stratified_split",
    sql=_split_sql(*_SPLIT3, "", key_expr="concat_ws('|', 'strat42', CAST(y AS VARCHAR), row_key)", extra_group="y, ")
    + """
SELECT y AS label, split, n,
       (n * 20000 + SUM(n) OVER (PARTITION BY y)) // (2 * SUM(n) OVER (PARTITION BY y)) / 100 AS pct, key_fp FROM c""",
)
def stratified_split(spark, sf_dir):
    ev = events(spark, sf_dir).select("row_key", F.col("y").alias("label"))
    tagged = sp.stratified_split(ev, "row_key", "label", *_SPLIT3, salt="strat42")
    # per-class sizes: each class is cut on its own; the union is the table
    return _sizes(tagged, group=("label",))


@register(
    "hash_sample",
    sql=f"""WITH {SQL_EVENTS}
SELECT COUNT(*) AS n, {_sql_fp()} FROM ev
WHERE {sql_hash_u32("'sample42' || row_key")} < {int(round(0.06 * sp.TWO32))}""",
)
def hash_sample(spark, sf_dir):
    s = sp.hash_sample(events(spark, sf_dir), "row_key", 0.06, salt="sample42")
    return s.agg(F.count(F.lit(1)).alias("n"), _fingerprint())


@register(
    "capped_sample",
    sql=f"""WITH {SQL_EVENTS},
k AS (SELECT GREATEST(1, CAST(FLOOR(COUNT(*) * 0.01) AS BIGINT)) AS k FROM ev),
r AS (SELECT row_key, row_number() OVER (ORDER BY {sql_hash_u32("'raw42' || row_key")}, row_key) AS rn FROM ev)
SELECT COUNT(*) AS n, {_sql_fp()} FROM r, k WHERE rn <= k.k""",
)
def capped_sample(spark, sf_dir):
    """Exact-size 1% sample, max(1, int(n * 0.01)) rows, no replacement."""
    ev = events(spark, sf_dir)
    s = sp.smallest_by_hash(ev, "row_key", lambda n: max(1, int(n * 0.01)), salt="raw42")
    return s.agg(F.count(F.lit(1)).alias("n"), _fingerprint())


_BI = ["row_key", "label", *NUMERIC_FEATURES]


@register("bi_sample", sql=f"WITH {SQL_EVENTS}\nSELECT {', '.join(_BI)} FROM ev")
def bi_sample(spark, sf_dir):
    """The export for a BI tool: all rows as header CSV, read back."""
    path = write_csv(events(spark, sf_dir).select(*_BI), scratch_path(spark, "bi-export"))
    schema = "row_key string, label double, " + ", ".join(f"{c} double" for c in NUMERIC_FEATURES)
    return spark.read.schema(schema).option("header", "true").csv(path)


@register(
    "capped_fraction",
    sql=f"""WITH {SQL_EVENTS},
f AS (SELECT CAST(ROUND(LEAST(1.0, 20000.0 / COUNT(*)) * {sp.TWO32}) AS BIGINT) AS cut FROM ev)
SELECT COUNT(*) AS n, {_sql_fp()} FROM ev, f WHERE {sql_hash_u32("'cap42' || row_key")} < f.cut""",
)
def capped_fraction(spark, sf_dir):
    """A sample of about 20,000 rows, or all: min(1, 20000 / n) of them."""
    ev = events(spark, sf_dir)
    return sp.hash_sample(ev, "row_key", sp.capped_fraction(ev.count(), 20_000), salt="cap42").agg(
        F.count(F.lit(1)).alias("n"), _fingerprint()
    )
