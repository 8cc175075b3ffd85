"""Sink round trips: what was written is read back and compared by a
fingerprint over all columns.  Output goes to a fresh folder under the
session's shared checkpoint directory and is deleted after its summary."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from event_ml.functions.columns import hash_u32
from event_ml.operators import features as fe
from event_ml.operators import models as md
from event_ml.operators import splits as sp
from event_ml.plans.metric_plans import SQL_LEADERBOARD, leaderboard
from event_ml.plans.model_plans import SPLITS, SQL_SPLIT, prepared
from event_ml.plans.registry import register
from event_ml.plans.split_plans import FP_MOD
from event_ml.plans.threshold_plans import SQL_CURVE, curve
from event_ml.schema import CORRUPT_COLUMN
from event_ml.sinks import writers as w
from event_ml.sources import files as fs
from event_ml.sources.tables import NUMERIC_FEATURES, SQL_EVENTS, events, read_table, sql_hash_u32

_CUTS = sp.normalised_cuts(SPLITS[1])

CSV_COLS = ["l_orderkey", "l_linenumber", *NUMERIC_FEATURES]
CSV_SCHEMA = T.StructType(
    [T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in NUMERIC_FEATURES]
)


def _fingerprint(columns, name="fp"):
    """An order-free sum over the text of all columns of a row."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.sum(F.pmod(hash_u32(text), F.lit(FP_MOD))).cast("long").alias(name)


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("bigint").alias(c)


def _sql_fp(columns) -> str:
    text = "concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '~')" for c in columns) + ")"
    return f"CAST(SUM({sql_hash_u32(text)} % {FP_MOD}) AS BIGINT) AS fp"


_SQL_CENTS = ", ".join(f"CAST(ROUND({c} * 100) AS BIGINT) AS {c}" for c in NUMERIC_FEATURES)


@register(
    "parquet_roundtrip",
    sql=f"""WITH {SQL_EVENTS},
c AS (SELECT row_key, CAST(label AS INTEGER) AS label, {_SQL_CENTS} FROM ev)
SELECT COUNT(*) AS n_rows, 6 AS n_cols, COUNT(DISTINCT label) AS n_label_partitions,
       {_sql_fp(["row_key", "label", *NUMERIC_FEATURES])}, true AS matches FROM c""",
)
def parquet_roundtrip(spark, sf_dir):
    """Write label-partitioned snappy Parquet, read back, verify."""
    df = events(spark, sf_dir).select("row_key", "label", *NUMERIC_FEATURES)
    path = w.write_parquet(df, w.scratch_path(spark, "events"), partition_by=["label"])
    back = spark.read.parquet(path)
    n_cols = len(back.columns)
    expected = df.count()
    cents = back.select("row_key", F.col("label").cast("int").alias("label"), *[_cents(c) for c in NUMERIC_FEATURES])
    found = cents.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(n_cols).alias("n_cols"),
        F.count_distinct("label").alias("n_label_partitions"),
        _fingerprint(["row_key", "label", *NUMERIC_FEATURES]),
    ).withColumn("matches", (F.col("n_rows") == F.lit(expected)) & F.lit(n_cols == len(df.columns)))
    return w.taken(found, path)


_SQL_LINES = f"c AS (SELECT l_orderkey, l_linenumber, {_SQL_CENTS} FROM lineitem)"


def _lines_summary(back):
    cents = back.select("l_orderkey", "l_linenumber", *[_cents(c) for c in NUMERIC_FEATURES])
    return cents.agg(F.count(F.lit(1)).alias("n_rows"), _fingerprint(CSV_COLS))


@register("csv_roundtrip", sql=f"WITH {_SQL_LINES}\nSELECT COUNT(*) AS n_rows, {_sql_fp(CSV_COLS)} FROM c")
def csv_roundtrip(spark, sf_dir):
    """Headerless CSV written in parallel, re-read with positional names."""
    li = read_table(spark, sf_dir, "lineitem").select(*CSV_COLS)
    path = w.write_csv(li, w.scratch_path(spark, "lineitem-csv"), header=False)
    return w.taken(_lines_summary(fs.read_csv_positional(spark, path, CSV_COLS, schema=CSV_SCHEMA)), path)


@register("csv_inferred", sql=f"WITH {_SQL_LINES}\nSELECT COUNT(*) AS n_rows, {_sql_fp(CSV_COLS)}, 'bigint,int,double,double,double,double' AS types FROM c")
def csv_inferred(spark, sf_dir):
    """Header CSV, skipped where it exists, read with inferred types."""
    li = read_table(spark, sf_dir, "lineitem").select(*CSV_COLS)
    path = w.scratch_path(spark, "lineitem-header-csv")
    w.write_csv(li, path, header=True, mode="ignore")
    w.write_csv(li.limit(0), path, header=True, mode="ignore")  # exists: nothing changes
    back = fs.read_csv_inferred(spark, path)
    order, number = back.dtypes[0][1].replace("int", "bigint").replace("bigbigint", "bigint"), back.dtypes[1][1]
    types = ",".join([order, number, *[t for _, t in back.dtypes[2:]]])
    return w.taken(_lines_summary(back).withColumn("types", F.lit(types)), path)


@register("csv_positional_inferred", sql=f"WITH {_SQL_LINES}\nSELECT COUNT(*) AS n_rows, {_sql_fp(CSV_COLS)} FROM c")
def csv_positional_inferred(spark, sf_dir):
    """Headerless CSV with inferred types, renamed by position."""
    li = read_table(spark, sf_dir, "lineitem").select(*CSV_COLS)
    path = w.write_csv(li, w.scratch_path(spark, "lineitem-plain-csv"), header=False)
    return w.taken(_lines_summary(fs.read_csv_positional(spark, path, CSV_COLS)), path)


_VEC_KEYS = ["row_key", "label", "features"]


@register(
    "split_vectors_csv",
    sql=f"""WITH {SQL_EVENTS},
t AS (SELECT row_key, CAST(label AS INTEGER) AS label, concat_ws(',', {", ".join(f"printf('%.6f', {c})" for c in NUMERIC_FEATURES)}) AS features,
             {sql_hash_u32("'split42' || row_key")} AS h FROM ev),
s AS (SELECT *, CASE WHEN h < {_CUTS[0]} THEN 'train' WHEN h < {_CUTS[1]} THEN 'val' ELSE 'test' END AS split FROM t)
SELECT split, COUNT(*) AS n_rows, {_sql_fp(_VEC_KEYS)} FROM s GROUP BY split""",
)
def split_vectors_csv(spark, sf_dir):
    """Each split written as CSV with its vectors as text, and read back."""
    ev = events(spark, sf_dir).select("row_key", "label", *NUMERIC_FEATURES)
    vec = fe.assemble(ev, NUMERIC_FEATURES, "features").select("row_key", "label", "features")
    parts = zip(SPLITS[0], sp.hash_split(vec, "row_key", SPLITS[1], salt="split42"))
    paths = {name: w.write_vectors_csv(part, w.scratch_path(spark, f"split-{name}"), keep=["row_key"]) for name, part in parts}
    schema = "row_key string, label double, features string"
    read = [spark.read.schema(schema).option("header", "true").csv(p).withColumn("split", F.lit(name)) for name, p in paths.items()]
    every = read[0].unionByName(read[1]).unionByName(read[2]).withColumn("label", F.col("label").cast("int"))
    return w.taken(every.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), _fingerprint(_VEC_KEYS)), *paths.values())


@register("schema_json", sql="""SELECT column_name AS "column", CASE column_type WHEN 'BIGINT' THEN 'LongType()' WHEN 'INTEGER' THEN 'IntegerType()' ELSE column_type END AS type
FROM (DESCRIBE SELECT doc_id, quality, toxic FROM labels)""")
def schema_json(spark, sf_dir):
    """The labels table's {column: type} as JSON, written and read back."""
    schema = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic").schema
    path = w.write_schema_json(spark, schema, w.scratch_path(spark, "schema"))
    found = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("column", "type"))
    return w.taken(found, path)


@register(
    "model_roundtrip",
    sql=f"{SQL_SPLIT}\nSELECT n_val, n_val AS n_equal FROM n",
)
def model_roundtrip(spark, sf_dir):
    """A fitted model saved and loaded: equal predictions on the val split."""
    train, val, _ = prepared(spark, sf_dir)
    model = md.make_estimator("LogisticRegression", maxIter=10).fit(train)
    path = w.scratch_path(spark, "model")
    md.save_model(model, path)
    again = md.load_model("LogisticRegression", path)
    both = model.transform(val).select("row_key", F.col("prediction").alias("a")).join(again.transform(val).select("row_key", F.col("prediction").alias("b")), "row_key")
    return w.taken(both.agg(F.count(F.lit(1)).alias("n_val"), F.count_if(F.col("a") == F.col("b")).cast("long").alias("n_equal")), path)


CURVE_SCHEMA = T.StructType(
    [T.StructField("threshold", T.DoubleType())]
    + [T.StructField(c, T.LongType()) for c in ("tp", "fp", "tn", "fn", "cost")]
)


@register("cost_curve_csv", sql=SQL_CURVE + "\nSELECT * FROM curve")
def cost_curve_csv(spark, sf_dir):
    """Result-table sink: the cost curve as one header CSV file for a BI
    tool, read back with its declared schema."""
    path = w.write_result_table(curve(spark, sf_dir), w.scratch_path(spark, "cost-curve"))
    return w.taken(fs.read_result_csv(spark, path, CURVE_SCHEMA), path)


RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("model", T.IntegerType()),
        T.StructField(
            "result",
            T.StructType(
                [
                    T.StructField("auc", T.DoubleType()),
                    T.StructField("rank", T.LongType()),
                    T.StructField("lift_over_baseline", T.DoubleType()),
                ]
            ),
        ),
    ]
)


@register("leaderboard_json", sql=SQL_LEADERBOARD)
def leaderboard_json(spark, sf_dir):
    """Nested results sink: one JSON object per model with a result struct,
    read back with the declared nested schema and flattened."""
    board = leaderboard(spark, sf_dir).select(
        "model", F.struct("auc", "rank", "lift_over_baseline").alias("result")
    )
    path = w.write_result_table(board, w.scratch_path(spark, "leaderboard"), fmt="json")
    back = spark.read.schema(RESULTS_SCHEMA).json(path)
    return w.taken(back.select("model", "result.auc", "result.rank", "result.lift_over_baseline"), path)


@register(
    "results_map_json",
    sql=f"""WITH board AS ({SQL_LEADERBOARD}),
{SQL_EVENTS},
p AS (SELECT l_linenumber AS model, CAST(MIN(q) AS DOUBLE) AS lowest, CAST(MAX(q) AS DOUBLE) AS highest, CAST(COUNT(*) AS DOUBLE) AS n_rows FROM ev GROUP BY l_linenumber)
SELECT CAST(b.model AS VARCHAR) AS model, auc AS val_auc, rank, unnest(map_keys(m)) AS param, unnest(map_values(m)) AS value
FROM board b JOIN (SELECT model, MAP {{'lowest': lowest, 'highest': highest, 'n_rows': n_rows}} AS m FROM p) p ON b.model = p.model""",
)
def results_map_json(spark, sf_dir):
    """All results as one object {model: {figures, params: {name: number}}}, read
    back with the declared map schema and flattened to a row a parameter."""
    ev = events(spark, sf_dir)
    found = ev.groupBy(F.col("l_linenumber").alias("model")).agg(
        F.create_map(F.lit("lowest"), F.min("q").cast("double"), F.lit("highest"), F.max("q").cast("double"), F.lit("n_rows"), F.count(F.lit(1)).cast("double")).alias("best_params")
    )
    board = leaderboard(spark, sf_dir).join(found, "model")  # a row a model
    entry = F.struct(F.col("model").cast("string"), F.struct(F.col("auc").alias("val_auc"), "rank", "best_params"))
    path = w.scratch_path(spark, "results")
    w.write_result_table(board.agg(F.map_from_entries(F.collect_list(entry)).alias("results")), path, fmt="json")
    back = spark.read.schema("results map<string, struct<val_auc: double, rank: bigint, best_params: map<string, double>>>").json(path)
    models = back.select(F.explode("results").alias("model", "r"))
    return w.taken(models.select("model", "r.val_auc", "r.rank", F.explode("r.best_params").alias("param", "value")), path)


_SQL_TEXT = "concat_ws(',', l_orderkey, l_linenumber, " + ", ".join(f"CAST(ROUND({c} * 100) AS BIGINT)" for c in NUMERIC_FEATURES[:-1]) + ")"


@register(
    "malformed_rows",
    sql=f"""SELECT COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN l_linenumber <> 7 THEN 1 ELSE 0 END) AS BIGINT) AS n_good,
       CAST(SUM(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS BIGINT) AS n_malformed,
       CAST(SUM(CASE WHEN l_linenumber = 7 THEN {sql_hash_u32(_SQL_TEXT)} % {FP_MOD} ELSE 0 END) AS BIGINT) AS raw_fp FROM lineitem""",
)
def malformed_rows(spark, sf_dir):
    """Every line-number-7 row is written one field short; a declared-schema
    PERMISSIVE scan keeps its raw text instead of dropping it."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[_cents(c) for c in NUMERIC_FEATURES])
    full = F.concat_ws(",", *[F.col(c).cast("string") for c in CSV_COLS])
    short = F.concat_ws(",", *[F.col(c).cast("string") for c in CSV_COLS[:-1]])
    lines = li.select(F.when(F.col("l_linenumber") == 7, short).otherwise(full).alias("value"))
    path, out = w.scratch_path(spark, "malformed-csv"), w.scratch_path(spark, "ingested")
    lines.write.mode("overwrite").text(path)
    ingested = fs.ingest_csv(spark, path, CSV_SCHEMA, out)
    _, bad = fs.split_malformed(ingested)
    raw = bad.agg(F.coalesce(F.sum(F.pmod(hash_u32(F.col(CORRUPT_COLUMN)), F.lit(FP_MOD))), F.lit(0)).cast("long").alias("raw_fp"))
    return w.taken(fs.ingest_report(ingested).crossJoin(raw), path, out)
