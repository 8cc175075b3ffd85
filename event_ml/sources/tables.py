"""Readers for the parquet tables and the bindings that map the labelled-event
concepts onto them (see README, "Bindings").

lineitem plays the labelled event table:
  label  y = (l_returnflag = 'R')
  row key  concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT))
  features l_quantity, l_extendedprice, l_discount, l_tax
  score    p = least(10000, round(l_quantity*100 + l_discount*50000)) in 100..10000,
           probability = p / 10000
  fine score q = the price in cents (nearly one value per row), for ranking
Every binding below is a projection, so Catalyst prunes the scan to the
columns a query uses and pushes its filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

NUMERIC_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def read_table(spark: SparkSession, sf_dir: str, name: str, balance: bool = False) -> DataFrame:
    """Parquet table.  ``balance`` spreads the rows over all cores with one
    round-robin exchange: a caller's choice, for input whose files have fewer
    row groups than the cluster has cores (a row group is the smallest unit
    that a scan can split).  It pays off before iterative work, not before a
    single scan + partial aggregate."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(spark.sparkContext.defaultParallelism) if balance else df


def lineitem_key() -> Column:
    return F.concat_ws(
        ":",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.col("l_quantity").cast("bigint").cast("string"),
    )


def lineitem_score() -> Column:
    raw = F.round(F.col("l_quantity") * 100 + F.col("l_discount") * 50000).cast("bigint")
    return F.least(F.lit(10000).cast("bigint"), raw)


def events(spark: SparkSession, sf_dir: str, balance: bool = False) -> DataFrame:
    """lineitem as a labelled event table (all bindings as columns)."""
    li = read_table(spark, sf_dir, "lineitem", balance=balance)
    return li.select(
        lineitem_key().alias("row_key"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        *NUMERIC_FEATURES,
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "l_suppkey",
        "l_orderkey",
        lineitem_score().alias("p"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("q"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_key, label, prob_1, prediction@0.5) -- the prediction-table form."""
    ev = events(spark, sf_dir)
    return ev.select(
        "row_key",
        "label",
        "p",
        (F.col("p") / F.lit(10000.0)).alias("prob_1"),
        (F.col("p") >= 5000).cast("double").alias("prediction"),
    )


def dirty_events(spark: SparkSession, sf_dir: str, balance: bool = False) -> DataFrame:
    """lineitem features with planted invalid values (the driver tables are
    clean): a null, a NaN and an infinity rule on three columns."""
    li = read_table(spark, sf_dir, "lineitem", balance=balance)
    return li.select(
        lineitem_key().alias("row_key"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.col("l_quantity"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45), F.lit(float("inf")))
        .otherwise(F.col("l_extendedprice"))
        .alias("l_extendedprice"),
        F.when(F.col("l_linenumber") == 3, F.lit(None).cast("double"))
        .otherwise(F.col("l_discount"))
        .alias("l_discount"),
        F.when(F.col("l_linenumber") == 5, F.lit(float("nan")))
        .otherwise(F.col("l_tax"))
        .alias("l_tax"),
        F.lit(None).cast("double").alias("l_empty"),
        F.lit(1.0).alias("l_const"),
    )


DOC_FEATURES = ["n_words", "n_symbols", "n_capitals", "n_lines", "n_distinct_words", "n_chars"]


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with a quality label: (row_key, label, six counts of the text).
    The label follows from the text, so models can learn it."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    words = F.split("text", " ")
    return docs.join(lab, "doc_id").select(
        F.col("doc_id").cast("string").alias("row_key"),
        "label",
        F.size(words).cast("double").alias("n_words"),
        F.regexp_count("text", F.lit("[0-9|#{}<>]")).cast("double").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("double").alias("n_capitals"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("double").alias("n_distinct_words"),
        F.length("text").cast("double").alias("n_chars"),
    )


# SQL twins of the bindings, for the DuckDB oracle strings.
SQL_KEY = (
    "concat_ws(':', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
    "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
    "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR))"
)
SQL_SCORE = "LEAST(10000, CAST(ROUND(l_quantity*100 + l_discount*50000) AS BIGINT))"
SQL_EVENTS = f"""ev AS (
  SELECT {SQL_KEY} AS row_key,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS label,
         l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber,
         l_returnflag, l_linestatus, l_suppkey, l_orderkey,
         {SQL_SCORE} AS p, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS q
  FROM lineitem)"""
SQL_DIRTY = f"""dirty AS (
  SELECT {SQL_KEY} AS row_key,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS label,
         l_quantity,
         CASE WHEN l_linenumber = 7 AND l_quantity > 45 THEN 'Infinity'::DOUBLE
              ELSE l_extendedprice END AS l_extendedprice,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN l_linenumber = 5 THEN 'NaN'::DOUBLE ELSE l_tax END AS l_tax,
         CAST(NULL AS DOUBLE) AS l_empty,
         CAST(1 AS DOUBLE) AS l_const
  FROM lineitem)"""


def sql_hash_u32(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"
