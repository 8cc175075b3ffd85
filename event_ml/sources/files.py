"""File scans: declared-schema CSV with corrupt-row capture, inferred CSV,
positional rename, parquet, and result-table read-back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from event_ml.schema import CORRUPT_COLUMN, with_corrupt_column


MALFORMED_FLAG = "_malformed"


def ingest_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    out_path: str,
    header: bool = False,
    compression: str = "snappy",
) -> DataFrame:
    """One-pass ingest: declared-schema CSV -> Parquet partitioned by a
    malformed flag (good rows under ``_malformed=false``, raw text of bad
    rows kept in ``_corrupt_record`` under ``_malformed=true``).

    Every column is written, so every field is parsed and malformed-row
    detection cannot depend on column pruning; nothing is cached, so this
    scales to inputs far larger than memory.  Returns the written table
    (partition pruning makes good/bad reads and counts cheap)."""
    raw = (
        spark.read.schema(with_corrupt_column(schema))
        .option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .csv(path)
    )
    flagged = raw.withColumn(MALFORMED_FLAG, F.col(CORRUPT_COLUMN).isNotNull())
    flagged.write.mode("overwrite").option("compression", compression).partitionBy(MALFORMED_FLAG).parquet(out_path)
    return spark.read.parquet(out_path)


def ingest_report(ingested: DataFrame) -> DataFrame:
    """(n_rows, n_good, n_malformed) of an ``ingest_csv`` table."""
    bad = F.col(MALFORMED_FLAG).cast("boolean")
    return ingested.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~bad).cast("bigint").alias("n_good"),
        F.count_if(bad).cast("bigint").alias("n_malformed"),
    )


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed raw lines) of an ``ingest_csv`` table."""
    good = df.filter(~F.col(MALFORMED_FLAG).cast("boolean")).drop(CORRUPT_COLUMN, MALFORMED_FLAG)
    bad = df.filter(F.col(MALFORMED_FLAG).cast("boolean")).select(CORRUPT_COLUMN)
    return good, bad


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Header + inferred types (an extra pass over the file; prefer declared)."""
    return spark.read.option("header", str(header).lower()).option("inferSchema", "true").csv(path)


def read_csv_positional(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Headerless CSV renamed by position (declared types when given)."""
    reader = spark.read.option("header", "false")
    if schema is not None:
        df = reader.schema(schema).csv(path)
    else:
        df = reader.option("inferSchema", "true").csv(path)
    return df.toDF(*names)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Result-table read-back (header, UTF-8, comma) with a declared schema."""
    return spark.read.schema(schema).option("header", "true").option("encoding", "UTF-8").csv(path)


FEATURE_IMPORTANCE_SCHEMA = T.StructType(
    [T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]
)
TRAINING_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("Algorithm", T.StringType()),
        T.StructField("Val AUC", T.DoubleType()),
        T.StructField("Train Time (s)", T.DoubleType()),
    ]
)
