"""Distributed sinks.  Nothing is collected to the driver: every writer is a
``DataFrameWriter`` call, so each task writes its own partition.  Small
result tables (one row per model / threshold / trial) are coalesced to one
file for BI tools; data tables never are."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from event_ml.functions.columns import vector_string
from event_ml.schema import schema_to_json_map
from event_ml.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory (never
    a machine-local temp folder)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/event_ml-out/{name}-{uuid.uuid4().hex}"


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
    mode: str = "overwrite",
) -> str:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """Distributed CSV; mode 'ignore' skips an existing output."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)
    return path


def write_result_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """A small result table as ONE file (header CSV or JSON lines)."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.json(path)
    return path


def taken(summary: DataFrame, *paths: str) -> DataFrame:
    """A small summary of written tables, computed now; the tables are deleted."""
    spark = summary.sparkSession
    rows = summary.collect()
    for path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    return spark.createDataFrame(rows, summary.schema)


def write_vectors_csv(
    df: DataFrame, path: str, vec_col: str = "features", label_col: str = "label", keep: Sequence[str] = ()
) -> str:
    """Split sink with the vector as one comma-joined '%.6f' string."""
    out = df.select(*keep, F.col(label_col), vector_string(vec_col).alias(vec_col))
    return write_csv(out, path)


def write_schema_json(spark: SparkSession, schema: T.StructType, path: str) -> str:
    """``{column: type}`` JSON file, written through Spark to shared storage."""
    text = schema_to_json_map(schema)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def readback_check(
    spark: SparkSession, path: str, expected_rows: int, expected_cols: int, fmt: str = "parquet"
) -> DataFrame:
    """(n_rows, n_cols, matches) of what was written."""
    back = spark.read.format(fmt).load(path)
    n_cols = len(back.columns)
    return back.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(n_cols).alias("n_cols"),
        ((F.col("n_rows") == expected_rows) & F.lit(n_cols == expected_cols)).alias("matches"),
    )
